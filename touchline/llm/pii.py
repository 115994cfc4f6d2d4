"""Personal data by weak supervision.

Base spans come from strict patterns and stay whatever follows. Candidates are the base spans and
what loose patterns find besides: long runs of digits, addresses written out in words, assigned
secrets. Labelers vote on each candidate: strict patterns, a gazetteer of words near it, check
digits, form and context. Each votes for, against or not at all.

How reliable the labelers are is estimated without labels by expectation-maximisation over the
counts of vote patterns in the whole corpus (two classes, labelers independent within a class). A
logistic span classifier is then trained on hashed features of a bounded sample of candidates
(``max_sample``, those with the smallest hash), with the estimated chances as targets, and decides
on every candidate.

NULL is the empty text. Positions are code points, ends are exclusive. Documents are read where they
lie; what is shuffled or sent to the driver are counts of vote patterns (at most 3 to the number of
labelers) and the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import free_name, slices
from touchline.session import written

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The same for long texts: a search that failed at the start of a run of digits is not begun again inside it,
# and an address is looked for from its @ on.
IP_SEARCH = re.compile("(?<![0-9])" + IP.pattern)
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

ADDRESS_IN_WORDS = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{1,63})+"
)
DIGITS = re.compile(r"\(?[0-9][\x20().0-9/-]{5,40}[0-9]")
SECRET = re.compile(
    r"(?:token|key|secret|password|passwd|pwd)[A-Za-z_]{0,20}[\x20]{0,4}[=:][\x20]{0,4}[\"']?[A-Za-z0-9+/_-]{8,}", re.I
)

NEAR = 32


class Gazetteer(NamedTuple):
    """Words that speak for a kind of personal data near it, and words that speak against any.

    A word of at least four letters also counts as the beginning of a longer one.
    """

    near: dict[str, tuple[str, ...]]
    against: tuple[str, ...]


# English, German, French and Spanish words; a table of one's own goes to ``train``.
GAZETTEER = Gazetteer(
    {
        "email": (
            "mail", "email", "e-mail", "contact", "write", "reach", "address", "kontakt", "schreiben", "adresse", "courriel",
            "contacter", "écrire", "correo", "escribir", "contacto", "dirección",
        ),
        "ip": (
            "ip", "ipv4", "host", "server", "address", "addr", "client", "gateway", "subnet", "login", "rechner", "adresse",
            "serveur", "servidor", "dirección",
        ),
        "card": (
            "card", "visa", "mastercard", "amex", "credit", "debit", "paid", "payment", "kredit", "karte", "bezahl", "carte",
            "bancaire", "paiement", "tarjeta", "crédito", "débito", "pago",
        ),
        "phone": (
            "phone", "telephone", "tel", "call", "mobile", "cell", "fax", "whatsapp", "sms", "dial", "ring", "contact", "telefon",
            "handy", "anruf", "rufen", "téléphone", "portable", "appeler", "appelez", "teléfono", "móvil", "llamar", "llame",
        ),
        "secret": ("token", "key", "secret", "password", "passwd", "pwd", "api", "auth", "credential", "bearer", "login"),
    },
    (
        "version", "isbn", "issn", "doi", "page", "pages", "section", "chapter", "figure", "table", "no", "nr", "year", "issue",
        "license", "order", "invoice", "serial", "part", "build", "release", "seite", "kapitel", "jahr", "bestellung", "rechnung",
        "chapitre", "année", "commande", "facture", "página", "capítulo", "año", "pedido", "factura", "score", "row", "line",
    ),
)

# Digits that are a date or a time are no number to call or to pay with.
DATE_OR_TIME = re.compile(r"(?<![0-9])(?:(?:19|20)\d\d[-/.](?:0?[1-9]|1[0-2])[-/.][0-3]?\d|[0-3]?\d[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)\d\d)(?![0-9])")
CARD_GROUPS = re.compile(r"\d{4}[ .-]\d{4}[ .-]\d{4}[ .-]\d{1,7}|\d{4}[ .-]\d{6}[ .-]\d{5}")
PHONE_GROUPS = re.compile(r"\(?\d{1,5}\)?(?:[ .()/-]{1,2}\d{2,6}){1,5}")

LABELERS = 6
FEATURE_BITS = 14
MAX_SAMPLE = 20_000
TRUST = 3.0


class Candidate(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    text: str
    before: str
    after: str


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-400:]) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


HAS_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> list[tuple[str, int, int]]:
    """The matches of EMAIL, in time that grows with the text only."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in EMAIL_NAME:
            start -= 1
        host = EMAIL_HOST.match(text, at) if start < at else None
        if host:
            found.append(("email", start, host.end()))
        last = host.end() if host else at + 1
        at = text.find("@", last)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the strict patterns (kind, start, end), by kind as listed, then start."""
    found = []
    if "@" in text:
        found += _emails(text)
    if HAS_DIGIT.search(text):
        if "." in text:
            found += [("ip", *m.span()) for m in IP_SEARCH.finditer(text) if is_ip(m[0])]
        found += [("card", *m.span()) for m in CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if is_phone(m[0])]
    return found


@lru_cache(maxsize=64)
def _word_search(listed: tuple[str, ...]) -> re.Pattern:
    """Finds a listed word, or one that begins with a listed word of at least four letters."""
    begins = "|".join(re.escape(w) for w in listed if len(w) >= 4)
    whole = "|".join(re.escape(w) for w in listed if len(w) < 4)
    choices = [c for c in (begins, f"(?:{whole})(?![^\\W_])" if whole else "") if c]
    return re.compile(rf"(?<![^\W_])(?:{'|'.join(choices) or '(?!)'})")


def _near(text: str, start: int, end: int) -> str:
    """What stands around a span, in lower case."""
    return f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".lower()


def _loose_spans(text: str, gazetteer: Gazetteer) -> list[tuple[str, int, int]]:
    """What might be personal data. Digits that fail the check digit may be a card only where words say so."""
    lower = text.lower()
    found = []
    if " at " in lower or "at)" in lower or "at]" in lower:
        if " dot " in lower or "dot)" in lower or "dot]" in lower or "(at)" in lower or "[at]" in lower:
            found += [("email", *m.span()) for m in ADDRESS_IN_WORDS.finditer(text)]
    if "=" in text or ":" in text:
        found += [("secret", *m.span()) for m in SECRET.finditer(text)]
    if HAS_DIGIT.search(text):
        for m in DIGITS.finditer(text):
            digits, (start, end) = _digits(m[0]), m.span()
            if DATE_OR_TIME.search(m[0]):
                continue
            if 13 <= len(digits) <= 19 and (luhn(digits) or _word_search(gazetteer.near["card"]).search(_near(text, start, end))):
                found.append(("card", start, end))
            elif 7 <= len(digits) <= 15:
                found.append(("phone", start, end))
    return found


def _votes(kind: str, text: str, before: str, after: str, base: bool, gazetteer: Gazetteer = GAZETTEER) -> tuple[int, ...]:
    """1 for personal data, -1 against, 0 for no opinion, from each labeler.

    They look at the strict pattern, words near it for and against, the check digit, repeated digits, and form. Digits that only look long enough have the form's vote alone.
    """
    near = (before + " " + after + (" " + text if kind == "secret" else "")).lower()
    digits = _digits(text)
    letters = sum(c.isalpha() for c in text)
    return (
        1 if base else 0,
        1 if _word_search(gazetteer.near[kind]).search(near) else 0,
        -1 if _word_search(gazetteer.against).search(near) else 0,
        (1 if luhn(digits) else -1) if kind == "card" else 0,
        -1 if len(digits) >= 7 and len(set(digits)) < 4 else 0,
        {
            "email": 1 if "@" in text or "dot" in text.lower() or "." in text else -1,
            "ip": 1 if text.count(".") == 3 else -1,
            "card": 1 if CARD_GROUPS.fullmatch(text) else 0,
            "phone": 1 if text[0] in "+(" or PHONE_GROUPS.fullmatch(text) and 9 <= len(digits) <= 15 else -1,
            "secret": 1 if len(digits) >= 3 and letters >= 3 else -1,
        }[kind],
    )


def candidates(text: str, gazetteer: Gazetteer = GAZETTEER) -> list[Candidate]:
    """Base spans, and loose ones that touch no base span and no loose one before them."""
    base = base_spans(text)
    loose = _loose_spans(text, gazetteer)
    if not base and not loose:
        return []
    taken = sorted((a, b) for _, a, b in base)
    kept = [(k, a, b, True) for k, a, b in base]
    if loose:
        limits = np.array(taken, np.int64).reshape(-1, 2)
        reach = np.maximum.accumulate(limits[:, 1]) if len(limits) else limits[:, 1]
        last = -1
        for k, a, b in sorted(loose, key=lambda s: (s[1], -s[2], s[0])):
            i = int(np.searchsorted(limits[:, 0], b))
            if a >= last and not (i and reach[i - 1] > a):
                kept.append((k, a, b, False))
                last = b
    out = []
    for k, a, b, is_base in kept:
        before, after = text[max(0, a - NEAR) : a], text[b : b + NEAR]
        out.append(Candidate(k, a, b, is_base, _votes(k, text[a:b], before, after, is_base, gazetteer), text[a:b], before, after))
    return out


def features(c: Candidate) -> np.ndarray:
    """Buckets of the candidate's hashed features."""
    shape = re.sub(r"(.)\1+", r"\1", re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", c.text[:64]))))
    left, right = re.findall(r"\w+|\S", c.before)[-2:], re.findall(r"\w+|\S", c.after)[:2]
    names = [f"kind {c.kind}", f"shape {c.kind} {shape[:24]}", f"digits {c.kind} {min(len(_digits(c.text)), 20)}"]
    names += [f"left {w.lower()}" for w in left] + [f"right {w.lower()}" for w in right]
    names += [f"vote {i} {v}" for i, v in enumerate(c.votes)] + [f"length {len(c.text).bit_length()}"]
    return np.unique(np.array([crc32(n.encode()) & ((1 << FEATURE_BITS) - 1) for n in names], np.int64))


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 60) -> dict[tuple[int, ...], float]:
    """The chance of being personal data for each vote pattern, by expectation-maximisation.

    Two classes, labelers independent within a class; having no opinion is a vote, too, since a labeler that
    only ever speaks against says something by that. It starts from the majority of the votes, which also
    says which class is which. Every count is smoothed by 1, and by ``TRUST`` more where a labeler is right.
    """
    if not patterns:
        return {}
    votes = np.array(list(patterns), np.int64)
    count = np.array(list(patterns.values()), float)
    chance = 1 / (1 + np.exp(-1.5 * votes.sum(axis=1)))
    one_hot = np.stack([votes < 0, votes == 0, votes > 0], axis=2).astype(float)
    for _ in range(rounds):
        logs = []
        for weight, right in ((count * chance, 2), (count * (1 - chance), 0)):
            table = np.einsum("p,plv->lv", weight, one_hot) + 1
            table[:, right] += TRUST
            table /= table.sum(axis=1, keepdims=True)
            share = (weight.sum() + 1) / (count.sum() + 2)
            logs.append(np.log(share) + np.einsum("plv,lv->p", one_hot, np.log(table)))
        chance = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -35, 35)))
    return dict(zip(patterns, chance.tolist()))


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    gazetteer: Gazetteer = GAZETTEER

    def chance(self, buckets: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[buckets].sum() + self.bias, -35, 35))))


def fit(rows: list[tuple[np.ndarray, float]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Logistic regression on soft targets, by adaptive gradient steps in the given order."""
    weights, bias = np.zeros(1 << FEATURE_BITS), 0.0
    seen, seen_bias = np.full(1 << FEATURE_BITS, 1e-2), 1e-2
    for _ in range(epochs):
        for buckets, target in rows:
            error = 1 / (1 + np.exp(-np.clip(weights[buckets].sum() + bias, -35, 35))) - target
            step = error + decay * weights[buckets]
            seen[buckets] += step * step
            weights[buckets] -= rate * step / np.sqrt(seen[buckets])
            seen_bias += error * error
            bias -= rate * error / np.sqrt(seen_bias)
    return Model(weights, float(bias))


def train(docs: DataFrame, text: str = "text", max_sample: int = MAX_SAMPLE, gazetteer: Gazetteer = GAZETTEER) -> Model:
    """Vote patterns over all documents, then the classifier on a bounded sample of candidates.

    The gazetteer goes with the model, so that the same words speak when it is used.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [c for t in part.column("text").to_pylist() for c in candidates(t or "", gazetteer)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["".join("-0+"[v + 1] for v in c.votes) for c in found], pa.string()),
                        pa.array([crc32("\0".join((c.kind, c.text, c.before, c.after)).encode()) for c in found], pa.int64()),
                        pa.array([features(c).astype("<i4").tobytes() for c in found], pa.binary()),
                    ],
                    ["votes", "deal", "features"],
                )

    found = docs.select(F.col(text).alias("text")).mapInArrow(collect, "votes string, deal bigint, features binary")
    # equal candidates, as copies of a text have, are counted together
    found = written(found.groupBy("votes", "deal", "features").agg(F.count(F.lit(1)).alias("n")), "candidates")
    parse = lambda s: tuple("-0+".index(c) - 1 for c in s)
    counts = {parse(r["votes"]): r["n"] for r in found.groupBy("votes").agg(F.sum("n").alias("n")).collect()}
    chances = reliabilities(dict(sorted(counts.items())))
    sample = found.orderBy("deal", "votes", "features").limit(max_sample).collect()
    model = fit([(np.frombuffer(r["features"], "<i4").astype(np.int64), chances[parse(r["votes"])]) for r in sample])
    return model._replace(gazetteer=gazetteer)


def spans_of(text: str, model: Model, threshold: float = 0.5) -> list[tuple[str, int, int, bool]]:
    """All spans of a text (kind, start, end, whether base), by kind as listed, then start."""
    found = [c for c in candidates(text, model.gazetteer) if c.base or model.chance(features(c)) >= threshold]
    return sorted(((c.kind, c.start, c.end, c.base) for c in found), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


def find(docs: DataFrame, model: Model, text: str = "text", name: str = "spans") -> DataFrame:
    """The input with an array of spans (kind, start, end, base). No shuffle; the model has a fixed size.

    If the input has a column of that name, the array gets the next free one (``spans_``).
    """
    name = free_name(name, docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    names, schema = docs.columns, docs.select("*", F.lit(None).cast(kind).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = [
                    [{"kind": k, "start": a, "end": b, "base": c} for k, a, b, c in spans_of(t or "", shared.value)]
                    for t in part.column(text).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, SPAN_TYPE)], [*names, name])

    return docs.mapInArrow(run, schema)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the one that starts first."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The input with all spans in the text masked; a NULL text stays NULL. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = [
                    t and mask(t, [(a, b, k) for k, a, b, _ in spans_of(t, shared.value)])
                    for t in part.column(text).to_pylist()
                ]
                columns = list(part.columns)
                columns[place] = pa.array(made, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)

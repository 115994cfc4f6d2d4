from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import fingerprints as fp

LINES = st.lists(st.text(alphabet="ab é", max_size=90), max_size=6)


@settings(max_examples=150, deadline=None)
@given(LINES, LINES, st.randoms())
def test_order_does_not_matter_and_paragraphs_go_in_and_out(a, b, random):
    whole = a + b
    mixed = whole[:]
    random.shuffle(mixed)
    assert np.array_equal(fp.vector("\n".join(whole)), fp.vector("\n".join(mixed)))
    if a and b:
        both = fp.add(fp.vector("\n".join(a)), fp.vector("\n".join(b)))
        assert np.array_equal(both, fp.vector("\n".join(whole)))
        assert np.array_equal(fp.subtract(both, fp.vector("\n".join(b))), fp.vector("\n".join(a)))
    assert np.array_equal(fp.read(fp.written(fp.vector("\n".join(whole)))), fp.vector("\n".join(whole)))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n", max_size=60), st.text(alphabet="ab \n", max_size=20), st.integers(0, 60))
def test_replaced_end_equals_a_fresh_fingerprint(text, end, keep):
    edited, changed = fp.replace_end(text, fp.vector(text), min(keep, len(text)), end)
    assert edited == text[: min(keep, len(text))] + end
    assert np.array_equal(changed, fp.vector(edited))


def test_different_multisets_differ():
    texts = ["", "\n", "a", "a\na", "a\nb", "ab", "b\na\na", " a"]
    assert len({fp.written(fp.vector(t)) for t in texts}) == len(texts)


def test_likeness_follows_what_is_shared():
    line = lambda kind, i: " ".join(hashlib.md5(f"{kind}{i}{j}".encode()).hexdigest()[:7] for j in range(8))
    base, other = ["\n".join(line(kind, i) for i in range(300)) for kind in ("base", "other")]
    half = "\n".join(line("base" if i < 150 else "half", i) for i in range(300))
    like = lambda a, b: fp.likeness(fp.vector(a), fp.vector(b))
    assert like(base, base) == 1 and 0.3 < like(base, half) < 0.7 and like(base, other) < 0.3


def brute_force(texts):
    rows = sorted(((d, t or "") for d, t in texts if d is not None), key=lambda r: (-r[0], r[1].encode()))
    out = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out.append((doc, text, edited, fp.likeness(fp.vector(text), fp.vector(after))))
    for doc, text in texts:
        if doc is None:
            text = text or ""
            out.append((None, text, text[: len(text) - len(text) // 3], 0.0))
    return sorted(
        repr(
            (d, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.written(fp.vector(t)), fp.written(fp.vector(e)),
             round(fp.likeness(fp.vector(t), fp.vector(e)), 9), round(n, 9))
        )
        for d, t, e, n in out
    )


def rows_of(df):
    return sorted(repr((*r[:5], round(r[5], 9), round(r[6], 9))) for r in map(tuple, df.collect()))


def test_all_kinds_of_rows(spark):
    assert rows_of(fp.edited_fingerprints(documents(spark))) == brute_force(TEXTS)


def test_neighbours_meet_across_ranges(spark):
    texts = [(i * 37 % 101, f"text {i}\n" * (i % 5)) for i in range(101)]
    for parts in (1, 3, 40):
        assert rows_of(fp.edited_fingerprints(documents(spark, texts).repartition(5), parts)) == brute_force(texts)


def test_one_document_follows_itself(spark):
    assert rows_of(fp.edited_fingerprints(documents(spark, [(4, "abcdef")]))) == brute_force([(4, "abcdef")])


def test_empty_table_and_plain_fingerprints(spark):
    assert fp.edited_fingerprints(no_documents(spark)).collect() == []
    got = fp.fingerprints(documents(spark)).collect()
    assert [r["fingerprint"] for r in got] == [fp.written(fp.vector(r["text"] or "")) for r in got]


def test_a_column_called_fingerprint_stays(spark):
    docs = documents(spark).withColumnRenamed("node", "Fingerprint")
    got = fp.fingerprints(docs).collect()
    assert {r["Fingerprint"] for r in got} == {"n"} and len({r["fingerprint_"] for r in got}) > 5

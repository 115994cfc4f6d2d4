"""HTML pages to elements.

One narrow job turns each page into ``nodes``: its elements and texts in document order. A node's
``pos`` is its place in that array and ``end_pos`` the place of the last node inside it, so whatever
lies inside a node is a slice of the array. Rules on a page are therefore expressions on one row:
no join, no shuffle, and time linear in the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.text import WHITE_SPACE, null_to_blank, strip

# HTML syntax.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
RAW_TEXT_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
BLANK_KEEPING_TAGS = frozenset(["pre", "textarea"])

NODE = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("end_pos", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("class", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()),
])


# Tags as most pages write them: plain names, values in double quotes, no character references. All others, and
# tags after which the text is read by other rules, take the parser's own way.
PLAIN_START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z][-a-zA-Z0-9_]*="[^"<>&]*")*)>')
PLAIN_ATTRIBUTE = re.compile(r' ([^=]+)="([^"]*)"')
PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
OTHER_TEXT_TAGS = frozenset(
    ["script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"]
)


class _Nodes(HTMLParser):
    """Collects the nodes of one page after another as columns, in document order.

    Texts get the tag ``#text``, or ``#raw`` inside scripts and the like.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.offsets = [0]
        self.pos: list[int] = []
        self.end_pos: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tag: list[str] = []
        self.css_class: list[str] = []
        self.text: list[str | None] = []
        self.attr_offsets = [0]
        self.attr_names: list[str] = []
        self.attr_values: list[str] = []
        self.open: list[int] = []
        self.raw_open = self.blank_open = 0  # open tags of RAW_TEXT_TAGS and BLANK_KEEPING_TAGS
        self.pending: list[str] = []

    def parse_starttag(self, i: int) -> int:
        m = PLAIN_START.match(self.rawdata, i)
        tag = m[1].lower() if m else ""
        if not m or tag in OTHER_TEXT_TAGS:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, [(name.lower(), value) for name, value in PLAIN_ATTRIBUTE.findall(m[2])] if m[2] else [])
        return m.end()

    def parse_endtag(self, i: int) -> int:
        m = PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if not m:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()

    def _add(self, tag: str, text: str | None, attrs: dict[str, str]) -> int:
        pos = len(self.pos) - self.offsets[-1]
        self.pos.append(pos)
        self.end_pos.append(pos)
        self.parent.append(self.open[-1] if self.open else -1)
        self.depth.append(len(self.open))
        self.tag.append(tag)
        self.css_class.append(" ".join(attrs["class"].split()) if "class" in attrs else "")
        self.text.append(text)
        if attrs:
            self.attr_names.extend(attrs)
            self.attr_values.extend(attrs.values())
        self.attr_offsets.append(len(self.attr_names))
        return pos

    def flush(self) -> None:
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending.clear()
        if not self.blank_open and not text.strip():
            text = "\n" if "\n" in text else " "
        self._add("#raw" if self.raw_open else "#text", text, {})

    def _close_to(self, depth: int) -> None:
        start = self.offsets[-1]
        last = len(self.pos) - start - 1
        while len(self.open) > depth:
            place = start + self.open.pop()
            self.end_pos[place] = last
            self.raw_open -= self.tag[place] in RAW_TEXT_TAGS
            self.blank_open -= self.tag[place] in BLANK_KEEPING_TAGS

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.flush()
        pos = self._add(tag, None, {name: value or "" for name, value in attrs})
        if tag not in VOID_TAGS:
            self.open.append(pos)
            self.raw_open += tag in RAW_TEXT_TAGS
            self.blank_open += tag in BLANK_KEEPING_TAGS

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        start = self.offsets[-1]
        for depth in range(len(self.open) - 1, -1, -1):
            if self.tag[start + self.open[depth]] == tag:
                self._close_to(depth)
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if data:
            self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not needed."""
        return j

    handle_decl = handle_pi = unknown_decl = handle_comment

    def add_page(self, html: str | None) -> None:
        self.reset()
        self.feed(html or "")
        self.close()
        self.flush()
        self._close_to(0)
        self.offsets.append(len(self.pos))

    def to_array(self) -> pa.ListArray:
        attrs = pa.MapArray.from_arrays(
            pa.array(self.attr_offsets, pa.int32()),
            pa.array(self.attr_names, pa.string()),
            pa.array(self.attr_values, pa.string()),
        )
        columns = [pa.array(c, pa.int32()) for c in (self.pos, self.end_pos, self.parent, self.depth)]
        texts = [pa.array(c, pa.string()) for c in (self.tag, self.css_class, self.text)]
        nodes = pa.StructArray.from_arrays(
            [*columns, *texts[:2], attrs, texts[2]], names=[f.name for f in NODE.fields]
        )
        return pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), nodes)


# Markup of pages whose tags are all plain and close in order, cut at its tags; a script is one piece. A lone "<" stays
# in a text, by which the page is known to be of the other kind.
_RAW = "{0}>(?:[^<]|<(?![/!])|</(?!(?i:{0}))[a-zA-Z][a-zA-Z0-9]*>)*+</{0}"
PLAIN_CUT = re.compile(f"<({_RAW.format('script')}|{_RAW.format('style')}|[^<>]*)>")
PLAIN_SKIPPED = re.compile(r"!--(?!-)(?:[^-]|-(?!-))*--|!(?i:doctype)[^<>]*")
VOID, OPEN, CLOSE, SKIPPED = range(4)
TAGS_KEPT = 2_000  # links make many tags that never come again; beyond this the next batch starts anew


class _PlainTags:
    """The distinct tags met so far, by their text between ``<`` and ``>``; ``number`` is -1 for tags that are not plain."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.kind: list[int] = []
        self.tag: list[str] = []
        self.css_class: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.titles: set[int] = set()

    def _read(self, text: str) -> int:
        kind, tag, attrs = None, "", {}
        if text in ("\0script", "\0style"):
            kind, tag = OPEN, text[1:]
        elif m := PLAIN_START.fullmatch(f"<{text}>"):
            tag = m[1].lower()
            attrs = {name.lower(): value for name, value in PLAIN_ATTRIBUTE.findall(m[2])}
            if tag == "title" or tag not in OTHER_TEXT_TAGS | RAW_TEXT_TAGS | BLANK_KEEPING_TAGS:
                kind = VOID if tag in VOID_TAGS else OPEN
        elif m := PLAIN_END.fullmatch(f"<{text}>"):
            tag = m[1].lower()
            kind = None if tag in VOID_TAGS else CLOSE
        elif PLAIN_SKIPPED.fullmatch(text):
            kind = SKIPPED
        number = -1 if kind is None else len(self.kind)
        if kind is not None:
            if kind == OPEN and tag == "title":
                self.titles.add(number)
            self.kind.append(kind)
            self.tag.append(tag)
            self.css_class.append(" ".join(attrs["class"].split()) if "class" in attrs else "")
            self.attrs.append(attrs)
        self.number[text] = number
        return number

    def pieces(self, html: str) -> tuple[list[str], list[int]] | None:
        """Texts and, between them, numbers of tags; None if the page has to be read by the parser."""
        parts = PLAIN_CUT.split(html)
        wide = []
        if "<script>" in html or "<style>" in html:
            wide = parts[:1]
            for tag, text in zip(parts[1::2], parts[2::2]):
                name, mark, raw = tag.partition(">")
                wide += [f"\0{name}", raw[: -len(name) - 2], f"/{name}", text] if mark else [tag, text]
            parts = wide
        texts, tags = parts[::2], parts[1::2]
        known = self.number
        numbers = [known[tag] if tag in known else self._read(tag) for tag in tags]
        if -1 in numbers or "\0" in html:
            return None
        if not self.titles.isdisjoint(numbers):  # only texts may stand in a title
            for n, number in enumerate(numbers):
                if number in self.titles and tags[n + 1 : n + 2] != ["/title"]:
                    return None
        raw = [n for n, tag in enumerate(tags, 1) if tag[:1] == "\0"] if wide else []
        if html.count("<") != len(tags) + sum(texts[n].count("<") for n in raw):
            return None
        clean = [t if not t or t.strip() else self._blank(t) for t in texts]
        if "&" in html:
            clean = [self._blank(unescape(t)) if "&" in t and n not in raw else clean[n] for n, t in enumerate(texts)]
        return clean, numbers

    @staticmethod
    def _blank(text: str) -> str:
        return text if not text or text.strip() else "\n" if "\n" in text else " "


def stripped(texts: pa.Array) -> pa.Array:
    return pc.utf8_trim(texts, WHITE_SPACE)


class PageNodes:
    """The nodes of pages that are all plain, as columns. Nodes of one tag share a number, by which its parts are found."""

    def __init__(
        self, tags: _PlainTags, starts: np.ndarray, page: np.ndarray, end: np.ndarray, depth: np.ndarray, is_open: np.ndarray,
        shown: np.ndarray, texts: pa.Array,
    ) -> None:
        self.names, self.classes, self.attrs = ["#text", "#raw", *tags.tag], ["", "", *tags.css_class], [{}, {}, *tags.attrs]
        self.starts, self.page, self.end, self.depth, self.is_open, self.shown = starts, page, end, depth, is_open, shown
        self.texts = texts  # of the nodes that are texts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def parents(self) -> np.ndarray:
        """The places of the nodes around the nodes, -1 for none."""
        # a node's parent is the last tag that was opened one level above it
        n, deepest = np.arange(len(self.page)), int(self.depth.max(initial=0)) + 2
        opens = np.flatnonzero(self.is_open)
        if not len(opens):
            return np.full(len(n), -1)
        key = (self.page * deepest + self.depth) * len(n) + n
        open_key = np.sort(key[opens] + len(n))  # what the tag holds lies one level deeper
        held = np.searchsorted(open_key, key, "right") - 1
        return np.where(self.depth > 0, open_key[held] % len(n), -1)

    def to_array(self) -> pa.ListArray:
        shown, start = self.shown, self.starts[self.page]
        parent = self.parents()
        names, classes = [pa.array(v, pa.string()).take(pa.array(shown)) for v in (self.names, self.classes)]
        is_text = shown < 2
        text = self.texts.take(pa.array(np.cumsum(is_text) - 1, mask=~is_text))
        n_attrs = np.array([len(a) for a in self.attrs])
        first_attr = np.concatenate([[0], np.cumsum(n_attrs)])
        counts = n_attrs[shown]
        offsets = np.concatenate([[0], np.cumsum(counts)])
        taken = pa.array(np.repeat(first_attr[shown] - offsets[:-1], counts) + np.arange(offsets[-1]))
        flat = [pa.array([x for a in self.attrs for x in part(a)], pa.string()).take(taken) for part in (dict.keys, dict.values)]
        attrs = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), *flat)
        places = (np.arange(len(shown)) - start, self.end - start, np.where(parent < 0, -1, parent - start), self.depth)
        columns = [pa.array(c, pa.int32()) for c in places]
        nodes = pa.StructArray.from_arrays([*columns, names, classes, attrs, text], names=[f.name for f in NODE.fields])
        return pa.ListArray.from_arrays(pa.array(self.starts, pa.int32()), nodes)


class _Cut:
    """Pages cut at their tags: how many tags each has, their numbers, and the texts between them that are not empty.

    Texts and tags take turns, and a page has one text more than tags.
    """

    def __init__(self, places: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, has_text: np.ndarray, texts: pa.Array) -> None:
        self.places, self.sizes, self.numbers, self.has_text, self.texts = places, sizes, numbers, has_text, texts

    def kept(self, pages: np.ndarray) -> _Cut:
        if pages.all():
            return self
        here = np.repeat(pages, self.sizes + 1)
        texts = self.texts.filter(pa.array(here[self.has_text]))
        numbers = self.numbers[np.repeat(pages, self.sizes)]
        return _Cut(self.places[pages], self.sizes[pages], numbers, self.has_text[here], texts)

    def and_pieces(self, places: list[int], pieces: list[tuple[list[str], list[int]]]) -> _Cut:
        """With pages cut by ``_PlainTags.pieces`` behind these."""
        if not places:
            return self
        texts = [t for page, _ in pieces for t in page]
        more = (places, [len(n) for _, n in pieces], [n for _, page in pieces for n in page], [bool(t) for t in texts])
        own = (self.places, self.sizes, self.numbers, self.has_text)
        joined = [np.concatenate([a, np.array(b, a.dtype)]) for a, b in zip(own, more)]
        return _Cut(*joined, pa.concat_arrays([self.texts, pa.array([t for t in texts if t], pa.string())]))


def _cleaned(texts: pa.Array) -> pa.Array:
    """Texts between tags with their character references replaced, and blank ones as one blank or line end."""
    referring = np.flatnonzero(pc.match_substring(texts, "&").to_numpy(zero_copy_only=False))
    if len(referring):
        read = pa.array([unescape(t) for t in texts.take(pa.array(referring)).to_pylist()], pa.string())
        places = np.arange(len(texts))
        places[referring] = len(texts) + np.arange(len(read))
        texts = pa.concat_arrays([texts, read]).take(pa.array(places))
    blank = pc.equal(pc.binary_length(stripped(texts)), 0)
    if pc.any(blank).as_py():
        lines = pc.match_substring(texts.filter(blank), "\n")
        texts = pc.replace_with_mask(texts, blank, pc.if_else(lines, "\n", " "))
    return texts


def _cut_at_tags(tags: _PlainTags, html: pa.Array) -> _Cut:
    """The pages that hold only plain tags and no script or style, cut at once by their bytes."""
    offsets = np.frombuffer(html.buffers()[1], np.int32)[html.offset : html.offset + len(html) + 1].astype(np.int64)
    data = np.frombuffer(html.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    first, data = offsets[0], data[offsets[0] :]
    bad = np.zeros(len(html), bool)
    bad[np.searchsorted(offsets, np.flatnonzero(data == 0) + first, "right") - 1] = True
    marks = np.flatnonzero((data & 0xFD) == 0x3C) + first  # both < and >
    opens = data[marks - first] == 0x3C
    page_of_mark = np.repeat(np.arange(len(html)), np.diff(np.searchsorted(marks, offsets)))
    paired = np.zeros(len(marks), bool)
    paired[:-1] = opens[:-1] & ~opens[1:] & (page_of_mark[:-1] == page_of_mark[1:])
    bad[page_of_mark[opens & ~paired]] = True
    paired &= ~bad[page_of_mark]
    tag_start = np.flatnonzero(paired)
    page_of_tag = page_of_mark[tag_start]
    starts, stops = marks[tag_start], marks[tag_start + 1] + 1
    sizes = np.bincount(page_of_tag, minlength=len(html))

    # the texts and tags of the pages lie one behind the other
    page_of_text = np.repeat(np.arange(len(html)), sizes + 1)
    place_of_text = 2 * np.arange(len(page_of_text)) - page_of_text
    place_of_tag = 2 * np.arange(len(starts)) + page_of_tag + 1
    borders = np.empty(len(page_of_text) + len(starts) + 1, np.int32)
    borders[place_of_text[np.cumsum(sizes + 1) - sizes - 1]] = offsets[:-1]
    borders[-1] = offsets[-1]
    borders[place_of_tag], borders[place_of_tag + 1] = starts, stops
    pieces = pa.StringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders), html.buffers()[2] or pa.py_buffer(b""))
    found = pieces.take(pa.array(place_of_tag)).dictionary_encode()
    known = tags.number
    texts_of_tags = [t[1:-1] for t in found.dictionary.to_pylist()]
    number_of = np.array([known[t] if t in known else tags._read(t) for t in texts_of_tags] or [0], np.int64)
    numbers = number_of[found.indices.to_numpy()]

    bad[page_of_tag[numbers < 0]] = True
    if tags.titles:  # only texts may stand in a title
        titles = np.flatnonzero(np.isin(numbers, list(tags.titles)))
        end = known.get("/title", -1)
        followed = np.append(np.where(page_of_tag[1:] == page_of_tag[:-1], numbers[1:], -1), -1)
        bad[page_of_tag[titles[(followed[titles] != end) | (end < 0)]]] = True
    has_text = np.diff(borders)[place_of_text] > 0
    texts = pieces.take(pa.array(place_of_text[has_text]))
    cut = _Cut(np.arange(len(html)), sizes, numbers, has_text, texts).kept(~bad)
    cut.texts = _cleaned(cut.texts)
    return cut


def _plain_nodes(tags: _PlainTags, cut: _Cut) -> tuple[PageNodes, np.ndarray]:
    """Nodes of pages cut at their tags, and which of the pages close all tags in order; only those nodes are right."""
    sizes, numbers, n_pages = cut.sizes, cut.numbers, len(cut.sizes)
    page_of_text, page_of_tag = np.repeat(np.arange(n_pages), sizes + 1), np.repeat(np.arange(n_pages), sizes)
    place_of_text = 2 * np.arange(len(page_of_text)) - page_of_text
    place_of_tag = 2 * np.arange(len(numbers)) + page_of_tag + 1
    size = len(page_of_text) + len(numbers)
    page = np.repeat(np.arange(n_pages), 2 * sizes + 1)
    kind = np.full(size, SKIPPED, np.int8)
    kind[place_of_tag] = np.array(tags.kind or [0], np.int8)[numbers]
    is_text = np.zeros(size, bool)
    is_text[place_of_text] = cut.has_text
    is_open, is_close = kind == OPEN, kind == CLOSE
    is_node = is_text | is_open | (kind == VOID)
    starts = np.concatenate([[0], np.cumsum(2 * sizes + 1)])
    summed = np.cumsum(is_open.astype(np.int8) - is_close, dtype=np.int64)
    before = np.concatenate([[0], summed])[starts]
    level = summed - before[page]
    good = (np.minimum.reduceat(level, starts[:-1]) >= 0) & (before[1:] == before[:-1])
    nodes_so_far = np.cumsum(is_node)
    node_starts = np.concatenate([[0], nodes_so_far])[starts]

    # an open tag and the next close tag of its level belong together, as each page leaves no tag open
    tag_of = np.full(size, -1, np.int64)
    tag_of[place_of_tag] = numbers
    ends = np.flatnonzero((is_open | is_close) & good[page])
    level_of_end = level[ends] + is_close[ends]
    small = np.uint16 if level_of_end.max(initial=0) < 1 << 16 else np.int64  # numpy sorts short numbers by their digits
    order = ends[np.argsort(level_of_end.astype(small), kind="stable")]
    opened, closed = order[::2], order[1::2]
    name_ids = {name: n for n, name in enumerate(dict.fromkeys(tags.tag))}
    name_of = np.array([name_ids[name] for name in tags.tag] or [0])
    good[page[opened[name_of[tag_of[opened]] != name_of[tag_of[closed]]]]] = False

    node = np.flatnonzero(is_node)
    end = np.arange(len(node))
    end[nodes_so_far[opened] - 1] = nodes_so_far[closed] - 1
    shown = tag_of[node] + 2
    shown[is_text[node]] = 0
    raw_numbers = [tags.number[t] for t in ("\0script", "\0style") if t in tags.number]
    if raw_numbers:
        after_raw = np.zeros(size, bool)
        after_raw[1:] = np.isin(tag_of[:-1], raw_numbers)
        shown[(is_text & after_raw)[node]] = 1
    return PageNodes(tags, node_starts, page[node], end, level[node] - is_open[node], is_open[node], shown, cut.texts), good


def _groups_of(tags: _PlainTags, html: pa.Array) -> list[tuple[np.ndarray, PageNodes | pa.ListArray]]:
    """The nodes of pages by their places: at once where all tags are plain and close in order, by the parser for all others."""
    if not len(html):
        return []
    cut = _cut_at_tags(tags, html)
    odd = np.setdiff1d(np.arange(len(html)), cut.places)
    pages = dict(zip(odd.tolist(), html.take(pa.array(odd)).to_pylist()))
    pieces = {n: found for n, page in pages.items() if (found := tags.pieces(page)) is not None}
    cut = cut.and_pieces(list(pieces), list(pieces.values()))
    groups: list[tuple[np.ndarray, PageNodes | pa.ListArray]] = []
    if len(cut.places):
        nodes, good = _plain_nodes(tags, cut)
        if not good.all():
            cut = cut.kept(good)
            nodes, _ = _plain_nodes(tags, cut) if len(cut.places) else (None, good)
        if nodes is not None:
            groups.append((cut.places, nodes))
    others = np.setdiff1d(np.arange(len(html)), cut.places)
    if len(others):
        parser = _Nodes()
        for page in html.take(pa.array(others)).to_pylist():
            parser.add_page(page)
        groups.append((others, parser.to_array()))
    return groups


def _in_order(groups: list[tuple[np.ndarray, pa.Array]]) -> pa.Array:
    """One value for each page, from values of groups of pages."""
    places = np.concatenate([p for p, _ in groups])
    if len(groups) == 1 and (np.diff(places) > 0).all():
        return groups[0][1]
    return pa.concat_arrays([a for _, a in groups]).take(pa.array(np.argsort(places)))


def _nodes_of(tags: _PlainTags, pages: list[str | None] | pa.Array) -> pa.ListArray:
    """The nodes of each page."""
    html = pages if isinstance(pages, pa.Array) else pa.array(pages, pa.string())
    groups = _groups_of(tags, pc.fill_null(html, ""))
    if not groups:
        return _Nodes().to_array()
    return _in_order([(p, n if isinstance(n, pa.ListArray) else n.to_array()) for p, n in groups])


# Nodes take several times the room of their page, so a batch goes out when its pages hold this many bytes; what is made
# from nodes takes less.
BYTES_PER_BATCH, BYTES_PER_MADE_BATCH = 500_000, 2_000_000


def _per_batch(
    batches: Iterator[pa.RecordBatch], names: list[str], columns: Callable[[_PlainTags, pa.Array], list[pa.Array]], size: int
) -> Iterator[pa.RecordBatch]:
    """The batches with columns made from pages in place of ``html``."""
    tags = _PlainTags()
    for batch in batches:
        html = pc.fill_null(batch.column(batch.schema.get_field_index("html")), "")
        kept = [i for i, name in enumerate(batch.schema.names) if name != "html"]
        out = [*[batch.schema.names[i] for i in kept], *names]
        held = np.cumsum(pc.binary_length(html).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = held[start - 1] if start else 0
            row = min(int(np.searchsorted(held, before + size)) + 1, batch.num_rows)
            made = columns(tags, html.slice(start, row - start).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(start, row - start) for i in kept], *made], names=out)
            start = row
            if len(tags.kind) > TAGS_KEPT or len(tags.number) > 2 * TAGS_KEPT:
                tags = _PlainTags()


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _per_batch(batches, ["nodes"], lambda tags, html: [_nodes_of(tags, html)], BYTES_PER_BATCH)


def page_nodes(pages: DataFrame) -> DataFrame:
    """The pages with ``nodes array<struct>`` in place of ``html``; all other columns are kept."""
    kept = [f for f in pages.schema.fields if f.name != "html"]
    return pages.mapInArrow(_tokenise, T.StructType([*kept, T.StructField("nodes", T.ArrayType(NODE))]))


def with_columns_of_nodes(
    pages: DataFrame, columns: Callable[[PageNodes | pa.ListArray], list[pa.Array]], fields: list[T.StructField]
) -> DataFrame:
    """The pages with columns in place of ``html`` that an Arrow function makes from the nodes of many pages at once."""
    kept = [f for f in pages.schema.fields if f.name != "html"]
    names = [f.name for f in fields]

    def made(tags: _PlainTags, html: pa.Array) -> list[pa.Array]:
        groups = [(places, columns(nodes)) for places, nodes in _groups_of(tags, html)]
        return [_in_order([(places, found[i]) for places, found in groups]) for i in range(len(fields))]

    return pages.mapInArrow(lambda batches: _per_batch(batches, names, made, BYTES_PER_MADE_BATCH), T.StructType([*kept, *fields]))


def elements(pages: DataFrame) -> DataFrame:
    """One row per element or text."""
    kept = [c for c in pages.columns if c != "html"]
    return page_nodes(pages).select(*kept, F.inline("nodes"))


# --- Rules on the nodes of many pages at once --------------------------------------------------


class NodeBatch:
    """The nodes of a batch of pages as one sequence; nodes are known by their places in it.

    Nodes of a kind are kept as sorted places, so those inside a node are a range of them.
    """

    def __init__(self, nodes: PageNodes | pa.ListArray) -> None:
        self.n_pages = len(nodes)
        if isinstance(nodes, PageNodes):
            self.starts, self.page, self.end, self.shown, raw = nodes.starts[:-1], nodes.page, nodes.end, nodes.shown, nodes.texts
            self._parents, self._attrs = nodes.parents, nodes.attrs
            (self.tags, self.tag), (self.classes, self.css_class) = [self._numbered(v) for v in (nodes.names, nodes.classes)]
            is_text = self.shown < 2
        else:
            offsets = nodes.offsets.to_numpy().astype(np.int64)
            flat = nodes.values.slice(offsets[0], offsets[-1] - offsets[0])
            self.starts = offsets[:-1] - offsets[0]
            self.page = np.repeat(np.arange(len(nodes)), np.diff(offsets))
            self.end = flat.field("end_pos").to_numpy().astype(np.int64) + self.starts[self.page]
            parent = flat.field("parent").to_numpy().astype(np.int64)
            self._parents = lambda: np.where(parent < 0, -1, parent + self.starts[self.page])
            self._attrs = flat.field("attrs")
            # the distinct tags and classes, and which of them each node has
            (self.tags, self.tag), (self.classes, self.css_class) = [
                (d.dictionary.to_pylist(), d.indices.to_numpy(zero_copy_only=False))
                for d in (flat.field(c).dictionary_encode() for c in ("tag", "class"))
            ]
            is_text = self.tagged("#text", "#raw")
            raw = flat.field("text").filter(pa.array(is_text))
        shown = self.tagged("#text")
        self.raw_places = np.flatnonzero(shown)
        self.raw_texts = raw if len(raw) == len(self.raw_places) else raw.filter(pa.array(shown[is_text]))
        texts = stripped(self.raw_texts)
        filled = pc.greater(pc.binary_length(texts), 0)
        self.texts = texts.filter(filled)
        self.text_places = self.raw_places[filled.to_numpy(zero_copy_only=False)]

    def _numbered(self, values: list[str]) -> tuple[list[str], np.ndarray]:
        numbers = {v: n for n, v in enumerate(dict.fromkeys(values))}
        return list(numbers), np.array([numbers[v] for v in values])[self.shown]

    @cached_property
    def parent(self) -> np.ndarray:
        return self._parents()

    def tagged(self, *tags: str) -> np.ndarray:
        return np.array([t in tags for t in self.tags], bool)[self.tag]

    def classed(self, *names: str) -> np.ndarray:
        """Nodes with any of the names, which are read as ``with_class`` reads them."""
        fits = lambda c, name: f" {name[1:]} " in f" {c} " if name.startswith(".") else name in c
        return np.array([any(fits(c, name) for name in names) for c in self.classes], bool)[self.css_class]

    def with_attr(self, name: str, value: str | None = None) -> np.ndarray:
        """Nodes with the attribute, of the value if one is given."""
        if isinstance(self._attrs, list):
            fits = [name in a and value in (None, a[name]) for a in self._attrs]
            return np.array(fits, bool)[self.shown]
        found = pc.map_lookup(self._attrs, pa.scalar(name), "first")
        return (pc.is_valid(found) if value is None else pc.fill_null(pc.equal(found, value), False)).to_numpy(zero_copy_only=False)

    def inside(self, places: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node the range of those of the places that lie inside of it."""
        return np.searchsorted(places, nodes, "right"), np.searchsorted(places, self.end[nodes], "right")

    def joined_ranges(self, lo: np.ndarray, hi: np.ndarray, separator: str = " ", texts: pa.Array | None = None) -> pa.Array:
        """Texts of ranges, which by default are those of the stripped texts."""
        texts = self.texts if texts is None else texts
        counts = hi - lo
        if (counts == 1).all():
            return texts.take(pa.array(lo))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        taken = texts.take(pa.array(np.repeat(lo - offsets[:-1], counts) + np.arange(offsets[-1])))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), taken), separator)

    def joined_texts(self, nodes: np.ndarray, separator: str = " ") -> pa.Array:
        """Stripped texts inside each node."""
        return self.joined_ranges(*self.inside(self.text_places, nodes), separator)

    def joined(self, nodes: np.ndarray, separator: str = " ") -> list[str]:
        return self.joined_texts(nodes, separator).to_pylist()

    def joined_pages(self, separator: str = " ") -> pa.Array:
        """Stripped texts of each page."""
        borders = np.searchsorted(self.text_places, [*self.starts, len(self.page)])
        return self.joined_ranges(borders[:-1], borders[1:], separator)

    def plain(self, nodes: np.ndarray) -> list[str]:
        """All text inside each node as it stands, stripped at both ends."""
        whole = self.joined_ranges(*self.inside(self.raw_places, nodes), "", self.raw_texts)
        return stripped(whole).to_pylist()

    def select_inside(self, *masks: np.ndarray) -> np.ndarray:
        """Places of nodes of the last kind, inside one of the kind before it, and so on."""
        hits = np.flatnonzero(masks[0])
        for mask in masks[1:]:
            places = np.flatnonzero(mask)
            if not len(hits):
                return places[:0]
            furthest = np.maximum.accumulate(self.end[hits])
            before = np.searchsorted(hits, places, "left") - 1
            hits = places[(before >= 0) & (furthest[before] >= places)]
        return hits

    def nth(self, places: np.ndarray, n: int = 0) -> np.ndarray:
        """The n-th of the sorted places on each page that has as many."""
        at = np.searchsorted(self.page[places], np.arange(self.n_pages)) + n
        there = at < len(places)
        there[there] = self.page[places[at[there]]] == np.flatnonzero(there)
        return places[at[there]]

    def page_texts(self, nodes: np.ndarray, texts: list[str], missing: str | None = "") -> list[str | None]:
        """One text for each page, from texts of nodes of which no two are on one page."""
        out: list[str | None] = [missing] * self.n_pages
        for page, text in zip(self.page[nodes].tolist(), texts):
            out[page] = text
        return out


# --- Rules on the nodes of one page ---------------------------------------------------------

Test = Callable[[Column], Column]


def with_tag(*tags: str) -> Test:
    return lambda n: n["tag"].isin(*tags)


def with_class(name: str) -> Test:
    """``.name`` is a whole class, ``name`` a part of the class text."""
    if not name.startswith("."):
        return lambda n: n["class"].contains(name)
    return lambda n: F.concat(F.lit(" "), n["class"], F.lit(" ")).contains(f" {name[1:]} ")


def with_attr(name: str, value: str | None = None) -> Test:
    if value is None:
        return lambda n: n["attrs"][name].isNotNull()
    return lambda n: F.coalesce(n["attrs"][name] == value, F.lit(False))


def both(*tests: Test) -> Test:
    def test(n: Column) -> Column:
        result = tests[0](n)
        for other in tests[1:]:
            result = result & other(n)
        return result

    return test


def select(nodes: Column, test: Test) -> Column:
    """Nodes that pass, in document order."""
    return F.filter(nodes, test)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def inside(nodes: Column, node: Column) -> Column:
    """What lies inside a node, without the node itself. ``nodes`` must be all nodes of the page.

    The nodes are taken by their places: a slice would go through the whole page each time.
    """
    places = lambda n: F.when(n["end_pos"] > n["pos"], F.sequence(n["pos"] + 1, n["end_pos"])).otherwise(
        F.array().cast("array<int>")
    )
    return let(node, lambda n: F.transform(places(n), lambda pos: F.get(nodes, pos)))


def select_inside(nodes: Column, *tests: Test) -> Column:
    """Nodes passing the last test, inside one passing the test before it, and so on.

    Each node comes once, in document order, also when the outer nodes lie in each other.
    """
    hits = select(nodes, tests[0])
    for test in tests[1:]:
        hits = F.flatten(F.transform(hits, lambda outer: select(inside(nodes, outer), test)))
    places = F.array_sort(F.array_distinct(F.transform(hits, lambda n: n["pos"])))
    return F.transform(places, lambda pos: F.get(nodes, pos))


def first(found: Column) -> Column:
    return F.get(found, 0)


def strings(nodes: Column) -> Column:
    """Stripped texts that are not blank."""
    texts = F.transform(F.filter(nodes, lambda n: n["tag"] == "#text"), lambda n: strip(n["text"]))
    return F.filter(texts, lambda t: t != "")


def joined_text(nodes: Column, separator: str = " ") -> Column:
    """Stripped texts with a separator between them."""
    return F.array_join(strings(nodes), separator)


def plain_text(nodes: Column) -> Column:
    """All text as it stands, stripped at both ends."""
    texts = F.transform(F.filter(nodes, lambda n: n["tag"] == "#text"), lambda n: n["text"])
    return strip(F.array_join(texts, ""))


def text_of(nodes: Column, node: Column) -> Column:
    """Text inside a node; '' for a NULL node."""
    return null_to_blank(plain_text(inside(nodes, node)))

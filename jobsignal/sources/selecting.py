"""Selectors run as one automaton over the nodes of a page, while it is shredded.

All selectors of a layout are compiled together. A *symbol* is the set of compounds (tag and attribute tests) that a
start tag passes; a *state* is the set of path steps that the open elements have matched. The transition table maps
(state, symbol) to the state inside the element and the selectors that end at it; it is filled as pairs occur, and
symbols are looked up by tag and the attributes that any selector looks at. So a node costs one look-up, however many
selectors there are.

The pass emits hits only: a page becomes an array of the nodes that some selector ended at, in document order, after the
root. ``id`` is the place in this array and ``last`` that of the last hit inside the node, so that subtrees are slices
here too and the functions of ``jobsignal.functions.dom`` apply; ``parent`` is the place of the direct parent if it is
a hit. ``hits`` has a bit per selector; texts and attribute values that a selector asks for come along.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape, unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignal.dictionaries import Selector
from jobsignal.functions.dom import Path, Test
from jobsignal.sources.shred import _BLOCK, _CUT, _ENDS, _OPAQUE, _P, _P_STOP, _RANK, _ROWS_PER_BATCH, _TAGS_KEPT, _VOID, _read_tag, _Shredder

# Functions of this module and the selectors they hold travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[Selector.__module__])

HITS_TYPE = "array<struct<id:int,last:int,parent:int,hits:int,text:string,value:string,beg:int,fin:int>>"


@dataclass(frozen=True)
class Pick:
    """A selector, the text to take along and the attribute to take along.

    ``path`` is a tag, an attribute selector or a CSS path. ``text`` is "joined" (trimmed text nodes), "raw", or
    "joined without TAG" (leaving out the first such node inside).
    """

    path: str | Selector | Path
    text: str = ""
    attr: str = ""


class Picks:
    """The automaton of named selectors; at most 31 of them."""

    def __init__(self, **picks: Pick) -> None:
        self.picks = picks
        self.names = list(picks)
        self._compounds: dict[str, list[tuple[int, str, tuple[str, ...], bool]]] = {}  # tag -> step bit, attribute, values, exact case
        self._first = self._final = 0
        self._ends: dict[int, int] = {}  # last step's bit -> selector's bit
        step = 1
        for i, pick in enumerate(picks.values()):
            path = pick.path
            steps = [(path, "", (), True)] if isinstance(path, str) else [(path.tag, path.attr, path.values, False)] if isinstance(
                path, Selector) else [(tag, "class" if classes else "", classes, True) for tag, classes in path]
            self._first |= step
            for tag, attr, values, exact in steps:
                self._compounds.setdefault(tag, []).append((step, attr, values, exact))
                step <<= 1
            self._ends[step >> 1] = 1 << i
            self._final |= step >> 1
        self._looked_at = {tag: sorted({attr for _, attr, _, _ in tests if attr}) for tag, tests in self._compounds.items()}
        self.cut_out = frozenset(pick.text.rsplit(" ", 1)[1] for pick in picks.values() if pick.text.startswith("joined without "))
        self._symbols: dict[tuple, int] = {}
        self._table: dict[tuple[int, int], tuple[int, int]] = {}
        self.sources: dict[str, tuple | None] = {}
        self._wants: dict[int, tuple[str, tuple[str, ...]]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_symbols": {}, "_table": {}, "sources": {}, "_wants": {}}

    def test(self, *names: str) -> Test:
        """Node test for ``jobsignal.functions.dom``: hit by any of the named selectors."""
        mask = sum(1 << self.names.index(name) for name in names)
        return lambda n: f"({n}.hits & {mask}) != 0"

    def symbol(self, tag: str, attrs: dict[str, str]) -> int:
        looked_at = self._looked_at.get(tag)
        if looked_at is None:
            return 0
        key = (tag, *map(attrs.get, looked_at))
        found = self._symbols.get(key)
        if found is None:
            if len(self._symbols) > 10_000:  # memory only: tests are run again
                self._symbols.clear()
            found = self._symbols[key] = sum(bit for bit, attr, values, exact in self._compounds[tag] if not attr or _passes(attrs.get(attr), attr, values, exact))
        return found

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """State inside an element and the selectors that end at it."""
        found = self._table.get((state, symbol))
        if found is None:
            matched = symbol & (self._first | state << 1 & ~self._first)
            ended = sum(name for bit, name in self._ends.items() if matched & bit)
            found = self._table[state, symbol] = state | matched, ended
        return found


    def read(self, source: str) -> tuple | None:
        """A plain tag as kind, name, attributes, symbol, normalized source and whether it is void, else None."""
        if len(self.sources) >= _TAGS_KEPT:  # memory only: tags are read again
            self.sources.clear()
        tag = _read_tag(source)
        if tag is not None:
            kind, name, attrs = tag
            void = name in _VOID
            start = "".join(f' {k}="{escape(v, quote=False)}"' for k, v in attrs.items())
            tag = kind, name, attrs, 0 if kind == "end" else self.symbol(name, attrs), f"<{name}{start}{'/' if void else ''}>", void
        self.sources[source] = tag
        return tag

    def wants(self, ended: int) -> tuple[str, tuple[str, ...]]:
        """Text and attributes to take along with a node that the given selectors ended at."""
        found = self._wants.get(ended)
        if found is None:
            asked = [pick for i, pick in enumerate(self.picks.values()) if ended >> i & 1]
            found = self._wants[ended] = next((p.text for p in asked if p.text), ""), tuple(p.attr for p in asked if p.attr)
        return found


def _passes(value: str | None, attr: str, values: tuple[str, ...], exact: bool) -> bool:
    """Attribute test: declarations of a style, tokens of a class, else substrings."""
    if value is None:
        return False
    if attr == "style":
        return {item.strip() for item in value.lower().split(";")}.issuperset(values)
    if attr == "class":
        tokens = (value if exact else value.lower()).split()
        return set(tokens).issuperset(values if exact else [v.lower() for v in values])
    return value != "" and all(v in value for v in values)


class _Selecting(_Shredder):
    """Collects nodes and the selectors that end at them."""

    def __init__(self, picks: Picks, with_markup: bool) -> None:
        super().__init__(with_markup)
        self.picks, self.states = picks, [0]
        self.hits: list[tuple[int, list]] = []

    def start(self, tag: str, kept: dict[str, str]) -> list:
        node = super().start(tag, kept)
        below, ended = self.picks.step(self.states[-1], self.picks.symbol(tag, kept))
        if ended:
            self.hits.append((ended, node))
        if tag not in _VOID:
            self.states.append(below)
        return node

    def _close_to(self, depth: int) -> None:
        super()._close_to(depth)
        del self.states[depth:]


def select_one(html: str, picks: Picks, with_markup: bool = False) -> tuple[list[tuple], str]:
    """Hits of one document (id, last, parent, hits, text, value, beg, fin), the root first, and its markup."""
    return select_plain(html, picks, with_markup) or select_any(html, picks, with_markup)


def select_plain(html: str, picks: Picks, with_markup: bool = False) -> tuple[list[tuple], str] | None:
    """The same for a document all of which is plain markup (see ``jobsignal.sources.shred``), else None.

    One loop that nests elements as ``_Shredder`` does, but keeps hits and texts only and makes no nodes.
    """
    pieces = _CUT.split(html)
    between, sources, tags = pieces[::2], picks.sources, []
    for source in pieces[1::2]:
        tag = sources.get(source, 0)
        if tag == 0:
            tag = picks.read(source)
        if tag is None:
            return None
        tags.append(tag)
    if "<" in "".join(between):
        return None
    table, step, cut_out = picks._table, picks.step, picks.cut_out
    # Open elements: names, states of the automaton, places of their hits; open elements that may be cut out of a text.
    names, states, places, cutting = ["#root"], [0], [-1], []
    texts: list[str] = []
    cuts: list[list] = []  # tag, first text, first text after
    hits: list[list] = []  # selectors, last, parent, attributes, beg, fin, first text, first text after, first cut, first cut after
    markup: list[str] = []
    size = 0

    def close() -> None:
        nonlocal size
        name, place = names.pop(), places.pop()
        states.pop()
        if with_markup:
            markup.append(f"</{name}>")
            size += len(name) + 3
        if place > 0:
            hit = hits[place - 1]
            hit[1], hit[5], hit[7], hit[9] = len(hits), size, len(texts), len(cuts)
        if cutting and cutting[-1][0] == len(names):
            cutting.pop()[1][2] = len(texts)

    def close_implied(ending: frozenset, stop: frozenset) -> None:
        for depth in range(len(names) - 1, 0, -1):
            if names[depth] in stop:
                return
            if names[depth] in ending:
                while len(names) > depth:
                    close()
                return

    def close_named(name: str) -> None:
        rank = _RANK.get(name, 0)
        for depth in range(len(names) - 1, 0, -1):
            if names[depth] == name:
                while len(names) > depth:
                    close()
                return
            if _RANK.get(names[depth], 0) > rank:
                return

    def add_text(text: str) -> None:
        nonlocal size
        if "&" in text:
            text = unescape(text)
        opaque = names[-1] in _OPAQUE
        if not opaque:
            texts.append(text)
        if with_markup:
            markup.append(text if opaque else escape(text, quote=False))
            size += len(markup[-1])

    for text, (kind, name, attrs, symbol, source, void) in zip(between, tags):
        if text:
            add_text(text)
        if kind == "end":
            if names[-1] == name:
                close()
            else:
                close_named(name)
            continue
        if name in _BLOCK and "p" in names:
            close_implied(_P, _P_STOP)
        if name in _ENDS:
            ending, stop = _ENDS[name]
            if not ending.isdisjoint(names):
                close_implied(ending, stop)
        below, ended = table.get((states[-1], symbol)) or step(states[-1], symbol)
        begin = size
        if with_markup:
            markup.append(source)
            size += len(source)
        if name in cut_out:
            cuts.append([name, len(texts), len(texts)])
            if not void:
                cutting.append((len(names), cuts[-1]))
        if ended:
            # Cuts of a hit are those after its own start tag.
            hits.append([ended, len(hits) + 1, places[-1], attrs, begin, size, len(texts), len(texts), len(cuts), len(cuts)])
        if not void:
            names.append(name)
            states.append(below)
            places.append(len(hits) if ended else -1)
            if kind == "both":
                close()
    if between[-1]:
        add_text(between[-1])
    while len(names) > 1:
        close()

    stripped = [text.strip() for text in texts]
    rows: list[tuple] = [(0, len(hits), -1, 0, None, None, 0, len(markup))]
    for i, (ended, last, parent, attrs, begin, end, first, after, cut, cut_after) in enumerate(hits, 1):
        how, asked = picks.wants(ended)
        text = value = None
        if how == "raw":
            text = "".join(texts[first:after])
        elif how:
            text = "".join(stripped[first:after])
            if how != "joined":
                tag = how.rsplit(" ", 1)[1]
                gone = next((c for c in cuts[cut:cut_after] if c[0] == tag), None)
                if gone:
                    text = "".join(stripped[first:gone[1]] + stripped[gone[2]:after])
        for attr in asked:
            value = attrs.get(attr)
            if value is not None:
                break
        rows.append((i, last, parent, ended, text, value, begin, end))
    return rows, "".join(markup)


def select_any(html: str, picks: Picks, with_markup: bool = False) -> tuple[list[tuple], str]:
    """The same for any document, by its nodes."""
    reader = _Selecting(picks, with_markup)
    nodes = reader.read(html)
    texts = [n for n in nodes if n[3] == "#text"]
    places = [n[0] for n in texts]
    spans = [span for _, span in reader.hits]
    starts = [span[0] for span in spans]
    place_of = {start: i + 1 for i, start in enumerate(starts)}
    asked = list(picks.picks.values())
    rows: list[tuple] = [(0, len(spans), -1, 0, None, None, 0, len(reader.markup))]
    for i, (ended, node) in enumerate(reader.hits, 1):
        text = value = None
        for bit, pick in enumerate(asked):
            if ended >> bit & 1:
                if pick.text and text is None:
                    inside = texts[bisect_right(places, node[0]):bisect_right(places, node[1])]
                    if pick.text.startswith("joined without "):
                        tag = pick.text.rsplit(" ", 1)[1]
                        cut = next((n for n in nodes[node[0] + 1:node[1] + 1] if n[3] == tag), None)
                        inside = [n for n in inside if cut is None or not cut[0] < n[0] <= cut[1]]
                    text = "".join([n[5] if pick.text == "raw" else n[5].strip() for n in inside])
                if pick.attr and value is None:
                    value = node[4].get(pick.attr)
        rows.append((i, bisect_right(starts, node[1]), place_of.get(node[2], -1), ended, text, value, node[6], node[7]))
    return rows, "".join(reader.markup)


def select(df: DataFrame, picks: Picks, html: str = "html", with_markup: bool = False) -> DataFrame:
    """Replace the html column by ``nodes``, the hits of ``picks`` (and ``markup`` when asked for).

    Runs per partition, without a shuffle. A null html is an empty page: the root alone.
    """
    kept = [f for f in df.schema.fields if f.name != html]
    schema = T.StructType(list(kept)).add("nodes", T.DataType.fromDDL(HITS_TYPE))
    if with_markup:
        schema = schema.add("markup", "string")
    names = [f.name for f in kept]
    columns = list(zip(["id", "last", "parent", "hits", "text", "value", "beg", "fin"], [pa.int32()] * 4 + [pa.string()] * 2 + [pa.int32()] * 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_PER_BATCH):
                part = batch.slice(start, _ROWS_PER_BATCH)
                offsets, rows, markups = [0], [], []
                for page in part.column(html).to_pylist():
                    hits, markup = select_one(page or "", picks, with_markup)
                    rows += hits
                    offsets.append(len(rows))
                    markups.append(markup)
                fields = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows), columns)]
                nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names=[n for n, _ in columns]))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), nodes, *([pa.array(markups, pa.string())] if with_markup else [])],
                                                 names=[*names, "nodes", *(["markup"] if with_markup else [])])

    return df.select(*names, html).mapInArrow(run, schema)


def text(fragment: Column) -> Column:
    """The text taken along with the fragment's node."""
    return F.get(fragment, F.lit(0))["text"]


def value(fragment: Column) -> Column:
    """The attribute value taken along with the fragment's node."""
    return F.get(fragment, F.lit(0))["value"]

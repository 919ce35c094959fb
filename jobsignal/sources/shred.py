"""HTML shredding: one Arrow pass that turns markup into an array of node structs.

Only tokenizing and nesting happen in Python; every selector runs on the resulting
column in the JVM (``jobsignal.functions.dom``). Plain markup is cut at its tags by one
pattern and each distinct tag is read once; anything else goes through the tokenizer of
the standard library.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import escape, unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from jobsignal.functions.dom import NODES_TYPE

# Functions of this module travel to the workers by value; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OPAQUE = frozenset(["script", "style", "template"])
_BLOCK = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split())
# A start tag ends these open elements, searching up to a boundary element.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_P = frozenset(["p"])
_P_STOP = frozenset(["table", "td", "th", "button", "body"])
# An end tag never reaches across an open element of a higher rank than its own.
_RANK = {"div": 1, "td": 2, "th": 2, "tr": 3, "thead": 4, "tbody": 4, "tfoot": 4, "table": 5, "body": 6, "html": 7}
_ROWS_PER_BATCH = 256

# Plain markup: tags without angle brackets inside, quoted attributes, no element whose content is read differently.
_CUT = re.compile(r"(<[^<>]*>)")
_PLAIN_TAG = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f]+[a-zA-Z][a-zA-Z0-9_:.-]*="[^"]*")*)[ \t\r\n\f]*(/?)>')
_PLAIN_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9_:.-]*)="([^"]*)"')
_READ_DIFFERENTLY = frozenset("script style textarea title iframe noembed noframes noscript plaintext xmp svg math".split())
_TAGS_KEPT = 20_000
_tags: dict[str, tuple[str, str, dict] | None] = {}


def _read_tag(source: str) -> tuple[str, str, dict] | None:
    """Kind (start, end or both), name and attributes of a plain tag, else None."""
    found = _PLAIN_TAG.fullmatch(source)
    if not found:
        return None
    slash, name, attrs, closed = found.groups()
    name = name.lower()
    if name in _READ_DIFFERENTLY or slash and (attrs or closed):
        return None
    kept: dict[str, str] = {}
    for key, value in _PLAIN_ATTR.findall(attrs):
        kept.setdefault(key.lower(), unescape(value))
    return "end" if slash else "both" if closed else "start", name, kept


class _Shredder(HTMLParser):
    """Collects nodes in document order, with normalized markup when wanted."""

    def __init__(self, with_markup: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.with_markup = with_markup
        self.nodes: list[list] = [[0, 0, -1, "#root", {}, None, 0, 0]]
        self.open = [0]
        self.markup: list[str] = []
        self.size = 0
        self.pending: list[str] = []

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not used

    def _write(self, piece: str) -> None:
        self.markup.append(piece)
        self.size += len(piece)

    def _add(self, tag: str, attrs: dict, text: str | None) -> list:
        node_id = len(self.nodes)
        node = [node_id, node_id, self.open[-1], tag, attrs, text, self.size, 0]
        self.nodes.append(node)
        return node

    def _flush(self) -> None:
        if self.pending:
            data = "".join(self.pending)
            self.pending = []
            opaque = self.nodes[self.open[-1]][3] in _OPAQUE
            node = self._add("#raw" if opaque else "#text", {}, data)
            if self.with_markup:
                self._write(data if opaque else escape(data, quote=False))
                node[7] = self.size

    def _close_to(self, depth: int) -> None:
        """Close open elements so that ``depth`` of them stay open."""
        while len(self.open) > depth:
            node = self.nodes[self.open.pop()]
            if self.with_markup and node[3] != "#root":
                self._write(f"</{node[3]}>")
            node[1], node[7] = len(self.nodes) - 1, self.size

    def _end_implied(self, tags: frozenset, stop: frozenset) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.nodes[self.open[depth]][3]
            if name in stop:
                return
            if name in tags:
                self._close_to(depth)
                return

    def feed_plain(self, html: str) -> bool:
        """Read the whole document if all of it is plain markup; else read nothing."""
        pieces = _CUT.split(html)
        tags = []
        for source in pieces[1::2]:
            tag = _tags.get(source, 0)
            if tag == 0:
                if len(_tags) >= _TAGS_KEPT:
                    _tags.clear()
                tag = _tags[source] = _read_tag(source)
            if tag is None:
                return False
            tags.append(tag)
        if any("<" in text for text in pieces[::2]):
            return False
        for text, (kind, name, attrs) in zip(pieces[::2], tags):
            if text:
                self.pending.append(unescape(text) if "&" in text else text)
            if kind == "end":
                self.handle_endtag(name)
            else:
                self.start(name, attrs)
                if kind == "both" and name not in _VOID:
                    self.handle_endtag(name)
        if pieces[-1]:
            self.pending.append(unescape(pieces[-1]))
        return True

    def handle_starttag(self, tag: str, attrs: list) -> None:
        kept: dict[str, str] = {}
        for name, value in attrs:
            kept.setdefault(name, value if value is not None else "")
        self.start(tag, kept)

    def start(self, tag: str, kept: dict[str, str]) -> list:
        """Add the node of a start tag; returns it."""
        self._flush()
        if tag in _BLOCK:
            self._end_implied(_P, _P_STOP)
        if tag in _ENDS:
            self._end_implied(*_ENDS[tag])
        void = tag in _VOID
        node = self._add(tag, kept, None)
        if self.with_markup:
            source = "".join(f' {k}="{escape(v, quote=False)}"' for k, v in kept.items())
            self._write(f"<{tag}{source}{'/' if void else ''}>")
            node[7] = self.size
        if not void:
            self.open.append(node[0])
        return node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        rank = _RANK.get(tag, 0)
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.nodes[self.open[depth]][3]
            if name == tag:
                self._close_to(depth)
                return
            if _RANK.get(name, 0) > rank:
                return

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def read(self, html: str) -> list[list]:
        """Nodes of a whole document."""
        if not self.feed_plain(html):
            try:
                self.feed(html)
                self.close()
            except AssertionError:
                # The tokenizer gives up on malformed declarations; keep what was read and say so.
                self.nodes[0][4]["shred-error"] = "1"
        self._flush()
        self._close_to(0)
        return self.nodes


def shred_one(html: str, with_markup: bool = True) -> tuple[list[list], str]:
    """Nodes and normalized markup of one document."""
    shredder = _Shredder(with_markup)
    return shredder.read(html), "".join(shredder.markup)


def _node_arrays(htmls: list[str | None], with_markup: bool) -> tuple[pa.Array, pa.Array]:
    offsets, flat, markups = [0], [], []
    for html in htmls:
        nodes, markup = shred_one(html or "", with_markup)
        flat.extend(nodes)
        offsets.append(len(flat))
        markups.append(markup if with_markup else None)
    ids, lasts, parents, tags, attrs, texts, begs, fins = zip(*flat) if flat else ((),) * 8
    map_offsets, keys, values = [0], [], []
    for a in attrs:
        keys.extend(a.keys())
        values.extend(a.values())
        map_offsets.append(len(keys))
    fields = [
        pa.array(ids, pa.int32()), pa.array(lasts, pa.int32()), pa.array(parents, pa.int32()),
        pa.array(tags, pa.string()),
        pa.MapArray.from_arrays(pa.array(map_offsets, pa.int32()), pa.array(keys, pa.string()),
                                pa.array(values, pa.string())),
        pa.array(texts, pa.string()), pa.array(begs, pa.int32()), pa.array(fins, pa.int32()),
    ]
    structs = pa.StructArray.from_arrays(fields, names=["id", "last", "parent", "tag", "attrs", "text", "beg", "fin"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(markups, pa.string())


def shred(df: DataFrame, html: str = "html", with_markup: bool = False) -> DataFrame:
    """Replace the html column by ``nodes`` (and ``markup`` when asked for).

    Runs per partition, without a shuffle. Output batches are kept small because one
    page can be much larger as nodes than as text.
    """
    kept = [f for f in df.schema.fields if f.name != html]
    schema = T.StructType(list(kept)).add("nodes", T.DataType.fromDDL(NODES_TYPE))
    if with_markup:
        schema = schema.add("markup", "string")
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_PER_BATCH):
                part = batch.slice(start, _ROWS_PER_BATCH)
                nodes, markup = _node_arrays(part.column(html).to_pylist(), with_markup)
                columns = [part.column(n) for n in names] + [nodes] + ([markup] if with_markup else [])
                yield pa.RecordBatch.from_arrays(
                    columns, names=names + ["nodes"] + (["markup"] if with_markup else []))

    return df.select(*names, html).mapInArrow(run, schema)

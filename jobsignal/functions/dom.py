"""Selectors over shredded HTML as higher-order functions.

A *fragment* is a slice of a page's node array, in document order, whose first
element is the scope itself. Because node ids are positions and every node knows the
id of its last descendant, a subtree is one contiguous slice: no parent walks.

The bodies are written as SQL text and parsed once per use: a selector is dozens of
small expressions, and building those one API call at a time takes longer than
running them on a small page set.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignal.dictionaries import Selector
from jobsignal.functions.scalars import STRIP, WS, apply_sql, literal

NODE_TYPE = ("struct<id:int,last:int,parent:int,tag:string,attrs:map<string,string>,"
             "text:string,beg:int,fin:int>")
NODES_TYPE = f"array<{NODE_TYPE}>"

# A node test: name of the lambda variable -> SQL condition.
Test = Callable[[str], str]
Path = tuple[tuple[str, tuple[str, ...]], ...]

_names = (f"n{i}" for i in count())


def _let(value: str, body: Callable[[str], str]) -> str:
    v = next(_names)
    return f"get(transform(array({value}), {v} -> {body(v)}), 0)"


def _each(function: str, array: str, body: Callable[[str], str]) -> str:
    v = next(_names)
    return f"{function}({array}, {v} -> {body(v)})"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, {literal(STRIP)}, '')"


# ------------------------------------------------------------------------ tests

def tag_is(tag: str) -> Test:
    return lambda n: f"{n}.tag = {literal(tag)}"


def _attr(node: str, name: str) -> str:
    return f"try_element_at({node}.attrs, {literal(name)})"


def _listed(value: str, wanted: tuple[str, ...], glue: str, blanks: str) -> str:
    """All wanted items occur in a list; separators are evened out first, so an item
    is a plain search between two of them."""
    even = f"regexp_replace(concat('{glue}', {value}, '{glue}'), {literal(f'(?U){blanks}')}, '{glue}')"
    return _let(even, lambda v: " AND ".join(f"contains({v}, {literal(glue + w + glue)})" for w in wanted))


def _classes(value: str, wanted: tuple[str, ...]) -> str:
    return _listed(value, wanted, " ", f"{WS}+")


def attr_test(name: str, wanted: tuple[str, ...]) -> Test:
    """Attribute test: declarations of a style, tokens of a class, else substrings."""
    def test(n: str) -> str:
        value = _attr(n, name)
        if name == "style":
            return _listed(f"lower({value})", wanted, ";", f"{WS}*(?:;{WS}*)+")
        if name == "class":
            return _classes(f"lower({value})", tuple(w.lower() for w in wanted))
        return " AND ".join([f"{value} <> ''"] + [f"contains({value}, {literal(w)})" for w in wanted])

    return lambda n: f"coalesce({test(n)}, false)"


def matches(selector: Selector) -> Test:
    of_attr = attr_test(selector.attr, selector.values)
    return lambda n: f"{n}.tag = {literal(selector.tag)} AND {of_attr(n)}"


def any_of(*tests: Test) -> Test:
    return lambda n: "(" + " OR ".join(f"({t(n)})" for t in tests) + ")"


def step_matches(step: tuple[str, tuple[str, ...]]) -> Test:
    """One compound of a CSS path: tag plus case-sensitive classes."""
    tag, classes = step

    def test(n: str) -> str:
        own = f"{n}.tag = {literal(tag)}"
        if not classes:
            return own
        return f"{own} AND coalesce({_classes(_attr(n, 'class'), classes)}, false)"

    return test


# -------------------------------------------------------------------- SQL bodies

def _inside(f: str) -> str:
    return f"slice({f}, 2, size({f}))"


def _piece(f: str, n: str) -> str:
    return f"slice({f}, {n}.id - {f}[0].id + 1, {n}.last - {n}.id + 1)"


def _find_all(fragment: str, test: Test) -> str:
    return _let(fragment, lambda f: _each("transform", _each("filter", _inside(f), test), lambda n: _piece(f, n)))


def _find(fragment: str, test: Test) -> str:
    return _let(fragment, lambda f: "get({}, 0)".format(_each(
        "transform", f"slice({_each('filter', _inside(f), test)}, 1, 1)", lambda n: _piece(f, n))))


def _below(nodes: str, ancestors: str, test: Test) -> str:
    return _let(ancestors, lambda up: _each("filter", nodes, lambda n: f"{test(n)} AND " + _each(
        "exists", up, lambda a: f"{a}.id < {n}.id AND {n}.id <= {a}.last")))


def _select(fragment: str, path: Path, page: str) -> str:
    up = _each("filter", page, step_matches(path[0]))
    for step in path[1:-1]:
        up = _below(page, up, step_matches(step))
    return _let(fragment, lambda f: _each(
        "transform", _below(_inside(f), up, step_matches(path[-1])), lambda n: _piece(f, n)))


def _texts(f: str) -> str:
    return _each("filter", f, tag_is("#text"))


def _text(f: str) -> str:
    return f"array_join({_each('transform', _texts(f), lambda n: _strip(f'{n}.text'))}, '')"


def _raw_text(f: str) -> str:
    return f"array_join({_each('transform', _texts(f), lambda n: f'{n}.text')}, '')"


# ------------------------------------------------------------- column functions

def scope(fragment: Column) -> Column:
    return F.get(fragment, F.lit(0))


def nodes_where(fragment: Column, test: Test) -> Column:
    """Matching nodes without their subtrees."""
    return apply_sql(fragment, lambda f: _each("filter", f, test))


def any_node(fragment: Column, test: Test) -> Column:
    return apply_sql(fragment, lambda f: _each("exists", f, test))


def find_all(fragment: Column, test: Test) -> Column:
    """Fragments of all descendants that pass the test."""
    return apply_sql(fragment, lambda f: _find_all(f, test))


def find(fragment: Column, test: Test) -> Column:
    """Fragment of the first descendant that passes the test, else NULL."""
    return apply_sql(fragment, lambda f: _find(f, test))


def first(fragment: Column, test: Test) -> Column:
    """The first descendant that passes the test as a node without its subtree, else NULL."""
    def node(f: str) -> str:
        n, i = next(_names), next(_names)
        return f"get(filter({f}, ({n}, {i}) -> {i} > 0 AND {test(n)}), 0)"

    return apply_sql(fragment, node)


def select(fragment: Column, path: Path, page: Column | None = None) -> Column:
    """Fragments under the scope matching a path whose ancestors may lie above it."""
    if page is None:
        return apply_sql(fragment, lambda f: _select(f, path, f))
    both = F.struct(fragment.alias("f"), page.alias("p"))
    return apply_sql(both, lambda s: _select(f"{s}.f", path, f"{s}.p"))


def select_one(fragment: Column, path: Path, page: Column | None = None) -> Column:
    return F.get(select(fragment, path, page), F.lit(0))


def find_after(page: Column, anchor_id: Column, tag: str | Test) -> Column:
    """First node with a tag (or passing a test) that starts after the anchor in document order."""
    test = tag_is(tag) if isinstance(tag, str) else tag
    both = F.struct(page.alias("p"), anchor_id.alias("a"))
    return apply_sql(both, lambda s: _let(f"{s}.a", lambda a: _find(
        f"{s}.p", lambda n: f"{n}.id > {a} AND {test(n)}")))


def children(fragment: Column, tag: str | Test) -> Column:
    """Fragments of the direct children with a tag (or passing a test)."""
    test = tag_is(tag) if isinstance(tag, str) else tag
    return apply_sql(fragment, lambda f: _let(f"{f}[0].id", lambda p: _find_all(
        f, lambda n: f"{n}.parent = {p} AND {test(n)}")))


def text(fragment: Column) -> Column:
    """Trimmed text nodes joined without a separator."""
    return apply_sql(fragment, _text)


def raw_text(fragment: Column) -> Column:
    return apply_sql(fragment, _raw_text)


def text_without(fragment: Column, tag: str) -> Column:
    """Text of the scope minus its first nested ``tag``."""
    return apply_sql(fragment, lambda f: _let(f"{_find(f, tag_is(tag))}[0]", lambda cut: _text(_each(
        "filter", f, lambda n: f"{cut}.id IS NULL OR {n}.id < {cut}.id OR {n}.id > {cut}.last"))))


def attr_of(fragment: Column, name: str) -> Column:
    return F.try_element_at(scope(fragment)["attrs"], F.lit(name))


def heading_id(page: Column, tag: str, keywords: list[str]) -> Column:
    """Id of the first ``tag`` whose lower-cased text contains a keyword."""
    def talks(f: str) -> str:
        return _let(f"lower({_raw_text(f)})", lambda low: " OR ".join(f"contains({low}, {literal(k)})" for k in keywords))

    return apply_sql(page, lambda p: f"get({_each('filter', _find_all(p, tag_is(tag)), talks)}, 0)[0].id")


def table_entries(fragment: Column, row: Test = tag_is("tr"), cell: Test = tag_is("td"), text_of: Callable[[str], str] = _text) -> Column:
    """``array<struct<k,v>>`` of the rows with exactly two cells, in row order."""
    def rows(f: str) -> str:
        cells = _each("transform", _find_all(f, row), lambda r: _find_all(r, cell))
        pairs = _each("filter", cells, lambda c: f"size({c}) = 2")
        return _each("transform", pairs, lambda c: f"named_struct('k', {text_of(f'{c}[0]')}, 'v', {text_of(f'{c}[1]')})")

    return apply_sql(fragment, rows)


def last_wins(entries: Column) -> Column:
    """One entry per key in first-seen order, holding the last value given."""
    def merged(es: str) -> str:
        keys = f"array_distinct({_each('transform', es, lambda e: f'{e}.k')})"
        return _each("transform", keys, lambda k: f"element_at({_each('filter', es, lambda e: f'{e}.k = {k}')}, -1)")

    return apply_sql(entries, merged)

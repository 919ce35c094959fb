"""Column functions: numbers, salaries, urls, dates, keys and text clean-up.

All of them are compositions of built-in Spark functions, so they stay in the JVM
and can be used in batch and streaming plans alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignal import dictionaries as D

# Unicode white space plus the four separators that count as blanks in text data.
WS = r"[\s\x1c-\x1f]"
STRIP = rf"(?U)\A{WS}+|{WS}+\z"
_NUMBER_TEXT = (
    rf"(?U)\A{WS}*([-+]?(?:[0-9]+|(?:[0-9]+[.][0-9]*|[.][0-9]+)(?:[eE][-+]?[0-9]+)?)){WS}*\z"
)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def apply_sql(c: Column, body: Callable[[str], str]) -> Column:
    """Column of an SQL expression over one variable, evaluated once per row."""
    return F.get(F.call_function("transform", F.array(c), F.expr(f"arg -> {body('arg')}")), F.lit(0))


def strip(c: Column) -> Column:
    """Trim Unicode white space on both sides."""
    return F.regexp_replace(c, STRIP, "")


def group_or_null(c: Column, pattern: str, index: int = 1) -> Column:
    """First match's group, NULL when there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, index), F.lit(""))


def to_numeric(c: Column) -> Column:
    """Text to double; a comma is a decimal point; anything else is NULL."""
    return group_or_null(F.replace(c, F.lit(","), F.lit(".")), _NUMBER_TEXT).cast("double")


def render_number(c: Column) -> Column:
    """Double to text without a trailing ``.0`` on whole numbers."""
    whole = (c == F.floor(c)) & (F.abs(c) < F.lit(9.0e15))
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def truthy(c: Column) -> Column:
    """Drop a zero the way an unset number is dropped."""
    return F.nullif(c, F.lit(0.0))


def salary_bounds(c: Column) -> Column:
    """``struct(lo, hi)`` of a salary at the very end of the text.

    Both salary shapes use digits, signs, points, commas and a dollar only, so they
    are looked for in the text's last run of those characters. A range is tried before
    a single amount at every place; each text is searched once and bound, as columns
    under conditions would be computed anew wherever they are used.
    """
    tail = F.regexp_extract(c, r"[$+\-.,0-9]+\z", 0)
    shape = rf"\$?(?:{D.NUMERIC_PATTERN}-)?{D.NUMERIC_PATTERN}\z"
    number = lambda text: F.when(text != "", F.replace(text, F.lit(","), F.lit(".")).cast("double"))

    def bounds(low: Column, high: Column) -> Column:
        return F.struct(F.when(low != "", number(low)).otherwise(number(high)).alias("lo"), number(high).alias("hi"))

    return let(tail, lambda t: let(F.regexp_extract(t, shape, 1), lambda low: let(
        F.regexp_extract(t, shape, 2), lambda high: bounds(low, high))))


def matches_any(c: Column, patterns: list[str]) -> Column:
    """Whether any pattern occurs; patterns without special characters are plain searches."""
    result = F.lit(False)
    for pattern in patterns:
        special = any(ch in r"\^$.|?*+()[]{}" for ch in pattern)
        result = result | (c.rlike(pattern) if special else F.contains(c, F.lit(pattern)))
    return result


def strip_markup(c: Column) -> Column:
    """Remove runs of ``*``, ``_`` and backticks, then halve double spaces once."""
    return F.replace(F.regexp_replace(c, r"[*_`]+", ""), F.lit("  "), F.lit(" "))


def html_to_text(c: Column) -> Column:
    """Markup to plain text: block tags become line ends, other tags vanish.

    A text without tags, line ends, tabs and runs of blanks only has to be trimmed; all other steps would leave it alone.
    """
    def steps(text: Column) -> Column:
        for pattern, replacement in D.TEXT_STEPS:
            text = F.regexp_replace(text, pattern.replace("{WS}", WS), replacement)
        return text

    return let(c, lambda text: F.when(text.rlike(r"[<\n\t]|  "), steps(text)).otherwise(strip(text)))


def _synonym(x: str, name: str) -> str:
    pairs = D.synonym_pairs(name)
    entries = ", ".join(f"{literal(text)}, {literal(target)}" for text, target in pairs)
    return f"coalesce(try_element_at(map({entries}), {x}), {x})" if pairs else x


def clean(c: Column, name: str) -> Column:
    """Blank to NULL, synonyms, then cut the dictionary's fragments, then trim."""
    def body(x: str) -> str:
        value = _synonym(x, name)
        for fragment in D.removal_order(name):
            value = f"replace({value}, {literal(fragment)}, '')"
        trim = lambda v: f"regexp_replace({v}, {literal(STRIP)}, '')"
        return f"CASE WHEN {trim(x)} <> '' THEN {trim(value)} END"

    return apply_sql(c, body)


def canonical_url(c: Column) -> Column:
    return F.split_part(c, F.lit("-"), F.lit(1))


def unwrap_tracking_url(c: Column) -> Column:
    """Target of a click-tracking link; links that carry none stay unchanged."""
    query = F.regexp_extract(c, r"\A[^?#]*\?([^#]*)", 1)
    packed = F.try_url_decode(group_or_null(query, r"(?:\A|&)p=([^&]+)"))

    def inner_json(p: Column) -> Column:
        padding = F.substring(F.lit("==="), F.lit(1), F.pmod(-F.length(p), F.lit(4)))
        standard = F.replace(F.replace(F.concat(p, padding), F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
        # \w stands for letters and digits, as no underscore is left. Spelled as ranges, Java's search for the negated
        # class takes some fifty times as long where nothing is found, and links hardly ever have anything to cut.
        plain = F.regexp_replace(standard, r"[^\w+/=]", "")
        outer = F.try_validate_utf8(F.try_to_binary(plain, F.lit("base64")).cast("string"))
        return F.get_json_object(outer, "$.p")

    def target(inner: Column) -> Column:
        url = F.replace(F.get_json_object(inner, "$.url"), F.lit("\\/"), F.lit("/"))
        return F.when((inner != "") & F.json_object_keys(inner).isNotNull(), F.coalesce(canonical_url(url), F.lit("")))

    return F.coalesce(let(let(packed, inner_json), target), c)


_TIME = r"(?:[T ,]+(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?)?(?:\s*(Z|GMT|UTC|[+-]\d{2}:?\d{2}))?\z"
_DIGITS = rf"\A(\d{{1,4}})[-/.](\d{{1,2}})[-/.](\d{{1,4}}){_TIME}"
_NAMED = rf"\A(\d{{1,2}}) ([A-Za-z]{{3}})[a-z]*[.,]? (\d{{4}}|\d{{2}}){_TIME}"
_ZONES = (("EDT", "-0400"), ("EST|CDT", "-0500"), ("CST|MDT", "-0600"), ("MST|PDT", "-0700"), ("PST", "-0800"))
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def parse_date(c: Column) -> Column:
    """Day-first date text to ``timestamp_ntz`` in UTC; unreadable text is NULL.

    In all-digit dates the day comes before the month wherever that gives a month,
    also after a leading year. Weekday names and zone comments are ignored, fractions of a second
    are cut, two-digit years lie between 1969 and 2068, and a named month may come first.
    """
    plain = F.regexp_replace(strip(c), r"\A[A-Za-z]{3,9},\s*|\s*\([^)]*\)\z", "")
    plain = F.regexp_replace(plain, r"\A([A-Za-z]{3,9})\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})", "$2 $1 $3")
    for names, offset in _ZONES:
        plain = F.regexp_replace(plain, rf"\s(?:{names})\z", f" {offset}")
    return let(plain, lambda text: let(_date_fields(text), _build_date))


def _date_fields(text: Column) -> Column:
    """Numbers of a date text: ``a b c`` in writing order, clock, zone and the shape."""
    def read(pattern: str, month: Column, kind: int) -> Column:
        number = lambda i: F.coalesce(F.regexp_extract(text, pattern, i).try_cast("int"), F.lit(0))
        return F.struct(number(1).alias("a"), month.alias("b"), number(3).alias("c"), number(4).alias("h"),
                        number(5).alias("mi"), number(6).alias("s"), F.regexp_extract(text, pattern, 7).alias("zone"),
                        F.lit(kind).alias("kind"))

    at = F.instr(F.lit(_MONTHS), F.lower(F.regexp_extract(text, _NAMED, 2)))
    month = F.when(at % 3 == 1, F.floor(at / 3) + 1).cast("int")
    digits = lambda kind: read(_DIGITS, F.regexp_extract(text, _DIGITS, 2).try_cast("int"), kind)
    return (F.when(text.rlike(_NAMED), read(_NAMED, month, 0))
            .when(text.rlike(_DIGITS) & text.rlike(r"\A\d{4}"), digits(2)).when(text.rlike(_DIGITS), digits(1)))


def _build_date(f: Column) -> Column:
    year_first = f["kind"] == 2
    written = F.when(year_first, f["a"]).otherwise(f["c"])
    short = (f["kind"] == 0) & (written < 100)
    year = F.when(short & (written < 69), written + 2000).when(short, written + 1900).otherwise(written)
    late, early = F.when(year_first, f["c"]).otherwise(f["b"]), F.when(year_first, f["b"]).otherwise(f["a"])
    swap = (f["kind"] > 0) & (late > 12)
    month, day = F.when(swap, early).otherwise(late), F.when(swap, late).otherwise(early)
    local = F.try_make_timestamp_ntz(year, month, day, f["h"], f["mi"], f["s"])
    sign = F.when(F.startswith(f["zone"], F.lit("-")), 1).otherwise(-1)
    clock = F.regexp_replace(f["zone"], "[^0-9]", "")
    minutes = F.coalesce(F.substring(clock, 1, 2).try_cast("int") * 60 + F.substring(clock, 3, 2).try_cast("int"),
                         F.lit(0))
    return F.timestamp_add("MINUTE", sign * minutes, local)


def vacancy_key(date: Column, message_id: Column, part_no: Column) -> Column:
    """Natural key of a vacancy: md5 of the JSON text ``["date", id, part]``."""
    return F.md5(F.concat(
        F.lit('["'), F.date_format(date, "dd/MM/yyyy HH:mm:ss"), F.lit('", '),
        message_id.cast("string"), F.lit(", "), part_no.cast("string"), F.lit("]")))


def split_middot(c: Column, keep_blanks: bool) -> Column:
    """Trimmed pieces between middle dots, with or without the blank ones."""
    pieces = F.split(strip(c), rf"(?U){WS}*·{WS}*", -1)
    return pieces if keep_blanks else F.filter(pieces, lambda p: p != "")


def missing_report(fields: list[tuple[str, Column | None]], bare_single: bool) -> Column:
    """Audit text over ``(column, expected)``: NULL, a name, or ``n | m, names``.

    ``expected`` None means the column is always expected.
    """
    optional = {name: F.coalesce(e, F.lit(False)) for name, e in fields if e is not None}
    wanted = F.struct(F.lit(True).alias("always"), *[e.alias(name) for name, e in optional.items()])
    values = F.struct(*[F.col(name).isNull().alias(name) for name, _ in fields])

    def body(x: str) -> str:
        need = [f"{x}.w.{name if name in optional else 'always'}" for name, _ in fields]
        names = ", ".join(f"IF({w} AND {x}.m.{name}, '{name}', NULL)" for w, (name, _) in zip(need, fields))
        expected = " + ".join(f"int({w})" for w in need)
        many = f"concat(size(missing), ' | ', {expected}, ', ', array_join(missing, ', '))"
        single = "WHEN size(missing) = 1 THEN missing[0]" if bare_single else ""
        return (f"get(transform(array(array_compact(array({names}))), missing -> "
                f"CASE {single} WHEN size(missing) > 0 THEN {many} END), 0)")

    return apply_sql(F.struct(wanted.alias("w"), values.alias("m")), body)

"""Secret scan: fixed patterns, and a battery of randomness tests over all long tokens.

Tokens of at least MIN_LENGTH key characters get an encoding by their alphabet. '=' is padding at the end of a token and
else parts names from values, which are tokens of their own. Where the characters but '-' have a smaller alphabet, as in
UUIDs, '-' only groups them and is left out of the tests. Three tests ask whether the token could
be random in that encoding: chi-squared uniformity of its symbols, the number of runs above and below the middle of
the alphabet, and the serial correlation of neighbouring symbols. Fisher's method joins the three probabilities.

Most long tokens are ordinary words or paths, for which randomness is rejected. Rejections are made by the
Benjamini-Hochberg rule over all tokens of the corpus with the same encoding and length band, as short tokens give
the tests less power than long ones: of the tokens dismissed as ordinary, at most FALSE_RATE are expected to be
random. The others are reported.

Only DataFrame functions are used. The rule needs ranks of probabilities over the corpus; they come from counts
on a fixed grid of probabilities, never from a sort of all tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignal.llm.common import staged, text_of

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, ACCESS_LENGTH = "AKIA[A-Z0-9]+", 20
HEX, HEX_LENGTH = "[0-9a-f]{24,}", 24  # runs are maximal, so shorter ones are those that would be dropped
ASSIGN_LENGTH = 6

MIN_LENGTH = 20
TOKEN = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}(?:=+(?![A-Za-z0-9+/_=-]))?"
FALSE_RATE = 0.05
GRID = 400  # steps of the probability grid, 1/10 in -log10 each; the last one holds all smaller ones
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "base26": LOWER,
    "hex": DIGITS + "abcdef",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
}
KINDS = ("assign", "access", "hex", "random")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _matches(name: str, pattern: str, group: int = 0) -> list[Column]:
    """Matches of ``pattern`` in ``_text``, their ``group`` part, and the texts between them."""
    text = F.col("_text")
    return [F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(f"{name}_all"),
            *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias(f"{name}_part")] if group else []),
            F.split(text, pattern, -1).alias(f"{name}_gaps")]


def _spans(name: str, least: int, part: str = "all") -> Column:
    """start and end of the matches ``name`` whose ``part`` has at least ``least`` code points.

    Positions are sums of the lengths of the matches and of what stands between them.
    """
    whole = F.col(f"{name}_all")
    sizes = F.zip_with(whole, F.col(f"{name}_{part}"), lambda w, f: F.struct(F.char_length(w).alias("n"), (F.char_length(f) >= least).alias("ok")))
    steps = F.zip_with(F.slice(F.col(f"{name}_gaps"), 1, F.size(whole)), sizes,
                       lambda g, p: F.struct(F.char_length(g).alias("gap"), p["n"].alias("n"), p["ok"].alias("ok")))
    def placed(own: Column) -> Column:
        ends = running(F.transform(own, lambda p: (p["gap"] + p["n"]).cast("long")), lambda x, y: x + y)
        spans = F.zip_with(ends, own, lambda end, p: F.when(p["ok"], F.struct((end - p["n"]).cast("int").alias("start"), end.cast("int").alias("end"))))
        return F.filter(spans, lambda s: s.isNotNull())

    return _let(steps, placed)


def running(values: Column, join) -> Column:
    """Running results of ``join`` (associative, 0 changes nothing) over an array of longs.

    Blocks of about the cube root of the length are run through apart from each other, and then the results of the
    blocks; so an array is never copied once per element, and a text with a million matches takes seconds.
    """
    none = F.expr("cast(array() as array<bigint>)")

    def through(part: Column, value, also_last: bool) -> Column:
        def step(acc: Column, x: Column) -> Column:
            total = join(acc["total"], value(x))
            return F.struct(total.alias("total"), F.concat(acc["seen"], F.array(total if also_last else acc["total"])).alias("seen"))

        return F.aggregate(part, F.struct(F.lit(0).cast("long").alias("total"), none.alias("seen")), step, lambda acc: acc["seen"])

    def blocks(own: Column) -> Column:
        n = F.greatest(F.size(own), F.lit(0))
        width = F.greatest(F.ceil(F.cbrt(n)), F.lit(16)).cast("int")
        starts = F.when(n > 0, F.sequence(F.lit(1), n, width)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: through(F.slice(own, i, width), lambda x: x, True))

    def carried(parts: Column) -> Column:
        before = through(parts, lambda part: F.element_at(part, -1), False)
        return F.flatten(F.zip_with(parts, before, lambda part, c: F.transform(part, lambda x: join(c, x))))

    return _let(_let(values, blocks), carried)


def _outside(tokens: Column, base: Column) -> Column:
    """The tokens that lie within no base span.

    In order of their starts, base spans first, a token lies within one if the largest end so far is not before its own.
    """
    def settled(rows: Column) -> Column:
        furthest = running(F.transform(rows, lambda r: F.when(r["order"] == 0, r["end"]).otherwise(0).cast("long")), F.greatest)
        apart = F.zip_with(rows, furthest, lambda r, most: F.when((r["order"] == 1) & (most < r["end"]), F.struct(r["start"].alias("start"), r["end"].alias("end"))))
        return F.filter(apart, lambda s: s.isNotNull())

    def row(span: Column, order: int) -> Column:
        return F.struct(span["start"].alias("start"), F.lit(order).alias("order"), span["end"].alias("end"))

    both = F.concat(F.transform(base, lambda b: row(b, 0)), F.transform(tokens, lambda t: row(t, 1)))
    return F.when(F.size(tokens) > 0, _let(F.array_sort(both), settled)).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17), correct to 1e-7."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _two_sided(z: Column) -> Column:
    return F.least(2 * _normal_tail(F.abs(z)), F.lit(1.0))


def encoding(token: Column) -> Column:
    """Name of the smallest alphabet that can hold the token without its padding.

    Null for digits and for words of one case joined by signs: such tokens are numbers, names and paths; no test of
    randomness is made of them.
    """
    mixed = F.lit(False)
    for one, other in (("[0-9]", "[A-Za-z]"), ("[a-z]", "[A-Z]")):
        mixed = mixed | (token.rlike(one) & token.rlike(other))
    name = (F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(token.rlike("^[A-Z2-7]+$"), "base32")
            .when(token.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36").when(token.rlike("^[0-9A-Za-z]+$"), "base62").otherwise("base64"))
    return F.when(mixed, name).when(token.rlike("^([a-z]+|[A-Z]+)$"), "base26")


def _ungrouped(token: Column) -> Column:
    """The token without '-' if what is left is long enough and has a smaller alphabet than base64, else the token."""
    return _let(F.replace(token, F.lit("-"), F.lit("")), lambda rest: F.when(
        (F.char_length(rest) >= MIN_LENGTH) & rest.rlike("^[0-9A-Za-z]+$"), rest).otherwise(token))


def _symbols(token: Column, name: Column) -> Column:
    """Numbers of the token's symbols in its alphabet, from 0."""
    folded = F.when(name.isin("base26", "hex", "base36"), F.lower(token)).otherwise(F.translate(token, "-_", "+/"))
    alphabet = F.lit("")
    for kind, chars in ALPHABETS.items():
        alphabet = F.when(name == kind, chars).otherwise(alphabet)
    return F.transform(F.split(folded, ""), lambda c: F.instr(alphabet, c) - 1)


def _size(name: Column) -> Column:
    size = F.lit(64)
    for kind, chars in ALPHABETS.items():
        size = F.when(name == kind, len(chars)).otherwise(size)
    return size.cast("double")


def _total(numbers: Column, of=lambda x: x) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + of(x.cast("double")))


def _uniform(symbols: Column, n: Column, size: Column) -> Column:
    """Chi-squared test of equal frequencies, by the cube-root transform to the normal distribution."""
    counts = F.transform(F.sequence(F.lit(0), size.cast("int") - 1), lambda k: F.size(F.filter(symbols, lambda s: s == k)))
    chi = _total(counts, lambda c: c * c) * size / n - n
    spread = 2 / (9 * (size - 1))
    return _normal_tail((F.pow(F.greatest(chi, F.lit(0.0)) / (size - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def _neighbours(symbols: Column, of) -> Column:
    last = F.size(symbols) - 1
    return F.zip_with(F.slice(symbols, 1, last), F.slice(symbols, 2, last), of)


def _runs(symbols: Column, n: Column, size: Column) -> Column:
    """Runs test above and below the middle of the alphabet; one-sided tokens can't be random."""
    turns = _total(_neighbours(symbols, lambda a, b: ((a * 2 >= size) != (b * 2 >= size)).cast("double")))

    def tested(pairs: Column) -> Column:
        variance = pairs * (pairs - n) / (n * n * (n - 1))
        return F.when(variance > 0, _two_sided((turns - pairs / n) / F.sqrt(variance))).otherwise(F.lit(1e-12))

    high = _total(symbols, lambda s: (s * 2 >= size).cast("double"))
    return _let(_let(high, lambda h: 2 * h * (n - h)), tested)


def _serial(symbols: Column, n: Column, size: Column) -> Column:
    """Correlation of neighbouring symbols."""
    middle, deviation = (size - 1) / 2, (size * size - 1) / 12
    return _two_sided(_total(_neighbours(symbols, lambda a, b: (a - middle) * (b - middle))) / (deviation * F.sqrt(n - 1)))


def randomness(symbols: Column, size: Column) -> Column:
    """Probability that symbols 0 .. size - 1 drawn at random look as uneven as these."""
    n = F.size(symbols).cast("double")
    logs = F.lit(0.0)
    for test in (_uniform, _runs, _serial):
        logs = logs - F.log(F.greatest(test(symbols, n, size), F.lit(1e-300)))
    # Fisher: twice the sum is chi-squared with six degrees of freedom
    return _let(logs, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _step(p: Column) -> Column:
    """Grid step of a probability: 0 for those near 1, null for null."""
    return _let(p, lambda x: F.when(x.isNotNull(), F.least(F.floor(-F.log10(F.greatest(x, F.lit(1e-300))) * 10), F.lit(GRID - 1)).cast("int")))


def _tokens() -> Column:
    """Long tokens with start, end, stratum (encoding and length band) and grid step of the joint probability."""
    def tested(token: Column, span: Column) -> Column:
        def judged(bare: Column, name: Column) -> Column:
            p = F.when(name.isNotNull() & (F.char_length(bare) >= MIN_LENGTH),
                       _let(_symbols(bare, name), lambda s: _let(_size(name), lambda size: randomness(s, size))))
            band = F.least(F.floor(F.log2(F.char_length(bare).cast("double") / MIN_LENGTH)), F.lit(9)).cast("int")
            return F.struct(span["start"].alias("start"), span["end"].alias("end"),
                            F.concat(name, F.lit(":"), band.cast("string")).alias("stratum"), _step(p).alias("step"))

        return _let(_ungrouped(F.regexp_replace(token, "=+$", "")), lambda bare: _let(encoding(bare), lambda name: judged(bare, name)))

    return F.filter(F.zip_with("token_all", _spans("token", 0), tested), lambda t: t["step"].isNotNull())


def thresholds(found: DataFrame, rate: float = FALSE_RATE) -> DataFrame:
    """stratum and the smallest grid step that is dismissed, from counts per step: at most 10 bands times 6 encodings."""
    counts = found.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.step").count()
    below = Window.partitionBy("stratum").orderBy(F.desc("step"))  # at most GRID rows: smaller probabilities first
    ranked = counts.withColumn("rank", F.sum("count").over(below)).withColumn("m", F.sum("count").over(Window.partitionBy("stratum")))
    dismissed = F.pow(F.lit(10.0), -F.col("step") / 10) <= rate * F.col("rank") / F.col("m")
    return ranked.filter(dismissed).groupBy("stratum").agg(F.min("step").alias("step"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def scan(docs: DataFrame, rate: float = FALSE_RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, base_spans, n_random of every row.

    Spans are kind:start:end in code points, end exclusive, by start and then kind, comma-joined; the base spans are
    those of the fixed patterns, ``random`` ones are added by the tests unless they lie inside a base span. A null or
    empty text has none. Repeated rows are scanned alike (and count as often in the corpus-wide rule); other columns
    are ignored; an empty table gives no rows.
    """
    matches = docs.select("doc_id", text_of().alias("_text")).select(
        "doc_id", *_matches("assign", ASSIGN, 2), *_matches("access", ACCESS), *_matches("hex", HEX), *_matches("token", TOKEN))
    found = staged(matches.select(
        "doc_id", _spans("assign", ASSIGN_LENGTH, "part").alias("assign"), _spans("access", ACCESS_LENGTH).alias("access"),
        _spans("hex", HEX_LENGTH).alias("hex"), _tokens().alias("tokens")), "secret-candidates")
    limits = thresholds(found, rate).agg(F.map_from_entries(F.collect_list(F.struct("stratum", "step"))).alias("limits"))
    base = F.concat(*(_of_kind(F.col(k), k) for k in KINDS[:3]))
    rows = found.select("*", base.alias("base")).withColumn("limits", limits.scalar())
    left = F.filter("tokens", lambda t: t["step"] < F.coalesce(F.try_element_at("limits", t["stratum"]), F.lit(GRID)))
    rows = rows.withColumn("left", left).withColumn("random", _outside(F.col("left"), F.col("base")))
    return rows.select(
        "doc_id", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.concat("base", _of_kind(F.col("random"), "random"))).alias("spans"),
        _text(F.col("base")).alias("base_spans"), F.size("random").cast("long").alias("n_random"))

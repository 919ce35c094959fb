"""Mixing sources to target weights by entropy balancing.

Every source gets a word target. Among all document rates between 0 and CEILING whose words add up to the target,
the rates nearest to one in (bounded) relative entropy are an exponential tilt of the document's size:
rate = CEILING / (1 + exp(-theta * x)), x the size over the source's mean size and theta the dual variable of the
source. The dual is convex and one-dimensional per source; Newton steps on all sources at once are one grouped
sum over (source, size) counts each. Rates are then rounded to whole copies: a hash decides about the fraction, and
the hash threshold of a source is set from cumulative sums, so that the copies meet the target.

All of it is DataFrame operations. Decisions depend on a row and its source's parameters alone, so they can be
applied to the documents without moving them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignal.llm.common import WORD_PATTERN, small, staged, text_of

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE = 1.5  # of all words
CEILING = 2  # copies of a document, and target over size of a source
BINS = 4096  # hash bins per source and level
LEVELS = 6  # of rounding: each later one fills what is left of the target with documents that fit into it
TOLERANCE, MOST_STEPS = 1e-7, 80

HASHED = 2.0**53


def sized(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source and size (words of the text, 0 for null) of every row."""
    return docs.select("doc_id", F.col(source).cast("string").alias("source"), words(text).alias("size"))


def words(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD_PATTERN)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``k``: the place in code point order from 0, null last. Sorted by ranges, not in one task."""
    order = F.col("source").asc_nulls_last()
    parts = staged(sources.repartitionByRange(order).sortWithinPartitions(order)
                   .withColumn("_id", F.monotonically_increasing_id()), "sorted-sources")
    place, part = F.col("_id").bitwiseAND((1 << 33) - 1), F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = parts.groupBy(part.alias("_part")).count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return parts.withColumn("_part", part).join(starts, "_part").select(*sources.columns, (place + F.col("_start")).alias("k"))


def with_targets(sources: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (source, source_size, n) with k, weight and target.

    Targets are proportional to the weights and stop at CEILING times the source's size. Each round closes the
    sources above their limit and deals the rest out again; only sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int"))
    table = staged(ranked(sources).withColumn("weight", weight), "sources")
    limit = F.lit(CEILING) * F.col("source_size")
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words per unit of weight; grows as sources close
    while True:
        closed = limit <= F.col("weight") * F.lit(level)
        full, opened = table.agg(F.sum(F.when(closed, limit)), F.sum(F.when(~closed, F.col("weight")))).first()
        if not opened:
            break
        higher = (total - (full or 0)) / opened
        if higher <= level:
            break
        level = higher
    return table.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level)))


def _rate(theta: Column, size: Column, mean: Column) -> Column:
    return CEILING / (1 + F.exp(-theta * size / mean))


def fitted(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the dual variable ``theta`` of each, null where the target is the ceiling.

    Newton steps are kept inside a bracket that every evaluation narrows, so they converge from any start. Sums are
    decimal: they don't depend on the order of rows, and reruns agree.
    """
    known = small(sources.select(F.col("source").alias("_source"), "k", "mean"))
    counts = staged(rows.filter("size > 0").join(known, F.col("source").eqNullSafe(F.col("_source")))
                    .groupBy("k", "mean", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts")
    state = staged(sources.filter(f"source_size > 0 and target < {CEILING} * source_size")
                   .select("k", "target", F.lit(0.0).alias("theta"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")), "dual")
    exact = "decimal(38,6)"
    for _ in range(MOST_STEPS):
        rate = _rate(F.col("theta"), F.col("size"), F.col("mean"))
        taken = F.col("n") * F.col("size") * rate
        slope = taken * (1 - rate / CEILING) * F.col("size") / F.col("mean")
        sums = counts.join(small(state), "k").groupBy("k").agg(
            F.sum(taken.cast(exact)).cast("double").alias("taken"), F.sum(slope.cast(exact)).cast("double").alias("slope"))
        over = F.col("taken") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("theta")), F.when(over, F.col("theta")).otherwise(F.col("high"))
        newton = F.col("theta") - (F.col("taken") - F.col("target")) / F.greatest("slope", F.lit(1e-6))
        near = F.greatest(F.least(newton, F.col("theta") + 4), F.col("theta") - 4)
        inside = (F.coalesce(near > F.col("new_low"), F.lit(True))) & (F.coalesce(near < F.col("new_high"), F.lit(True)))
        moved = (state.join(sums, "k").withColumn("new_low", low).withColumn("new_high", high)
                 .withColumn("next", F.round(F.when(inside, near).otherwise(F.coalesce((F.col("new_low") + F.col("new_high")) / 2, near)), 12)))
        moved = staged(moved.withColumn("miss", F.abs(F.col("taken") - F.col("target")) / F.col("target")), "dual")
        worst = moved.agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            state = moved.select("k", "theta")
            break
        state = moved.select("k", "target", F.col("next").alias("theta"), F.col("new_low").alias("low"), F.col("new_high").alias("high"))
    else:
        raise RuntimeError(f"no tilt within {MOST_STEPS} steps: the worst source misses its target by a share of {worst}")
    return sources.join(state.select("k", "theta"), "k", "left")


def _hash(level: int) -> Column:
    """A number in [0, 1) from doc_id, size and level."""
    return F.shiftrightunsigned(F.xxhash64("_id", "_size", F.lit(level)), 11).cast("double") / HASHED


def _rated(df: DataFrame) -> DataFrame:
    """``df`` with the whole and the fractional part of each row's rate."""
    rate = F.when(F.col("_theta").isNull(), F.lit(float(CEILING))).otherwise(_rate(F.col("_theta"), F.col("_size"), F.col("_mean")))
    rated = df.withColumn("_rate", F.round(F.least(rate, F.lit(float(CEILING))), 9)).withColumn("_base", F.floor("_rate"))
    return rated.withColumn("_fraction", F.col("_rate") - F.col("_base"))


def _bin(level: int) -> Column:
    """Bin of the row at a rounding level, null where it can't be chosen there.

    Level 0 ranks by hash over fraction, so rates decide; later levels by another hash, what fits into the rest.
    """
    if level == 0:
        scaled = F.when(F.col("_fraction") > 0, F.floor(_hash(0) / F.col("_fraction") * (BINS // 2)))
        return F.when(scaled < BINS, scaled)
    return F.when(F.col("_size") <= F.col(f"_limit{level}"), F.floor(_hash(level) * BINS))


def _most(level: int) -> Column:
    """Copies below which a level may add one: the first three give a row one more than its base, the last ones up to the ceiling."""
    return F.least(F.col("_base") + 1, F.lit(CEILING)) if level < 3 else F.lit(CEILING).cast("long")


def _copied(df: DataFrame, levels: int) -> DataFrame:
    """``df`` with ``_copies`` after the first ``levels`` levels of rounding."""
    rated = _rated(df)
    if not levels:
        return rated.withColumn("_copies", F.col("_base"))
    steps = F.array(*(F.struct(_bin(i).alias("bin"), F.col(f"_cut{i}").cast("long").alias("cut"), _most(i).alias("most")) for i in range(levels)))
    return rated.withColumn("_copies", F.aggregate(steps, F.col("_base"), lambda n, s: F.when((s["bin"] <= s["cut"]) & (n < s["most"]), n + 1).otherwise(n)))


def _attach(rows: DataFrame, params: DataFrame, source: str) -> DataFrame:
    return rows.join(small(params), rows[source].eqNullSafe(params["_source"]), "left")


def parameters(rows: DataFrame) -> DataFrame:
    """Per source: target, dual variable and rounding cuts, all a row needs to know its number of copies.

    ``rows`` has doc_id, source and size. Columns begin with an underscore.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    table = with_targets(sources).withColumn("mean", F.when(F.col("source_size") > 0, F.col("source_size") / F.col("n")).otherwise(1.0))
    table = fitted(rows, staged(table, "targets"))
    params = staged(table.select(*(F.col(c).alias(f"_{c}") for c in ("source", "k", "source_size", "target", "mean", "theta"))), "params")
    narrow = rows.select(F.col("doc_id").alias("_id"), "source", F.col("size").alias("_size")).filter("_size > 0")
    whole = _rated(_attach(narrow, params, "source")).groupBy("_k").agg(F.sum(F.col("_base") * F.col("_size")).alias("_whole"))
    params = staged(params.join(whole, "_k", "left").withColumn(
        "_rest", F.greatest(F.floor("_target") - F.coalesce("_whole", F.lit(0)), F.lit(0))).drop("_whole"), "params")
    upto = Window.partitionBy("_k").orderBy("_bin")  # at most BINS rows
    for level in range(LEVELS):
        if level:
            params = params.withColumn(f"_limit{level}", F.col("_rest"))
        bins = (_copied(_attach(narrow, params, "source"), level).filter(F.col("_copies") < _most(level))
                .withColumn("_bin", _bin(level)).filter("_bin is not null")
                .groupBy("_k", "_bin").agg(F.sum("_size").alias("_words")).withColumn("_sum", F.sum("_words").over(upto)))
        cuts = (bins.join(small(params.select("_k", "_rest")), "_k").filter("_sum <= _rest").groupBy("_k")
                .agg(F.max("_bin").alias(f"_cut{level}"), F.max("_sum").alias("_filled")))
        params = params.join(cuts, "_k", "left").withColumn("_rest", F.col("_rest") - F.coalesce("_filled", F.lit(0))).drop("_filled")
        params = staged(params.withColumn(f"_cut{level}", F.coalesce(f"_cut{level}", F.lit(-1))), "params")
    return params


def with_copies(rows: DataFrame, params: DataFrame, doc_id: str, source: str, size: str) -> DataFrame:
    """``rows`` with ``_copies`` and the columns of ``params``."""
    named = rows.withColumns({"_id": F.col(doc_id), "_size": F.col(size)})
    copied = _copied(_attach(named, params, source), LEVELS)
    return copied.withColumn("_copies", F.when(F.col("_size") > 0, F.col("_copies")).otherwise(1))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row; taken is copies times size.

    Null and empty texts have size 0 and take 0 words; the null source is the last source; rows that repeat a doc_id
    and size are copied alike; other columns are ignored; an empty table gives no rows.
    """
    rows = staged(sized(docs), "sizes")
    return with_copies(rows, parameters(rows), "doc_id", "source", "size").select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is copied, columns as they were; texts without words stay once."""
    rows = staged(sized(docs), "sizes")
    marked = docs.withColumns({"_text_source": F.col("source").cast("string"), "_words": words()})
    copied = with_copies(marked, parameters(rows), "doc_id", "_text_source", "_words").filter("_copies > 0")
    return copied.select(*docs.columns, F.explode(F.expr("sequence(1L, _copies)")).alias("_copy")).drop("_copy")

"""Keyed upserts as set-based transforms: target and batch in, new target out.

Nothing relies on row order. Every merge takes an explicit order, and the last
writer of a key is the row with the largest order value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], writes: str | None = None) -> DataFrame:
    """Newest row per key; ``writes`` names an extra column counting the key's rows.

    ``max_by`` combines on the map side, so a key that owns a large share of the rows
    reaches its reducer as one row per map task.
    """
    values = [c for c in df.columns if c not in keys]
    counted = [F.count(F.lit(1)).alias(writes)] if writes else []
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_row"), *counted)
            .select(*keys, *[F.col(f"_row.`{v}`").alias(v) for v in values], *([writes] if writes else [])))


def without_older(df: DataFrame, keys: list[str], order: list[str], row: str) -> DataFrame:
    """Newest row per key of a written table whose column ``row`` is unique and breaks ties.

    Only keys and order are shuffled. The rows that lost, few as a rule, are then taken out by an anti join, so wide
    columns stay where they are unless the losers outgrow the broadcast threshold.
    """
    place = F.struct(*order, row)
    newest = df.groupBy(*keys).agg(F.max(place).alias("_newest"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys, "_newest")
    rows = df.select(*keys, place.alias("_place")).alias("r")
    lost = rows.join(newest.alias("n"), _same_key(keys, "r", "n")).where("_place < _newest").select(F.col(f"_place.{row}").alias("_lost"))
    return df.join(lost, F.col(row) == F.col("_lost"), "left_anti")


def _same_key(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], update: list[str], order: list[str],
           on_match: dict[str, Column] | None = None, collapsed: bool = False) -> DataFrame:
    """Update the given columns of known keys (NULLs included) and insert new keys.

    The result has the target's columns plus ``outcome`` (kept, updated, added).
    ``on_match`` gives extra values for existing rows, written with the target's own
    column names. No key columns at all means insert only. The target's wide rows are
    joined on the left side only, so a batch small enough for Spark's broadcast
    threshold never makes the target shuffle; a larger one falls back to a sort-merge
    join over unique keys on both sides.
    """
    if not keys:
        rows = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                              for c in target.columns], F.lit("added").alias("outcome"))
        return target.withColumn("outcome", F.lit("kept")).unionByName(rows)
    newest = batch if collapsed else latest_per_key(batch, keys, order)
    incoming = newest.withColumn("_hit", F.lit(True)).alias("b")
    hit = F.coalesce(F.col("b._hit"), F.lit(False))
    extra = on_match or {}

    def merged(c: str) -> Column:
        if c in extra:
            return F.when(hit, extra[c]).otherwise(F.col(f"t.{c}")).alias(c)
        if c in update:
            return F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        return F.col(f"t.{c}").alias(c)

    changed = target.alias("t").join(incoming, _same_key(keys, "t", "b"), "left").select(
        *[merged(c) for c in target.columns],
        F.when(hit, F.lit("updated")).otherwise("kept").alias("outcome"))
    known = target.select(*keys).alias("t").join(newest.select(*keys).alias("b"), _same_key(keys, "t", "b"), "left_semi")
    fresh = newest.alias("b").join(known.alias("k"), _same_key(keys, "b", "k"), "left_anti")
    given = set(keys) | set(update)
    added = fresh.select(
        *[F.col(c) if c in given else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns],
        F.lit("added").alias("outcome"))
    return changed.unionByName(added)


def count_outcomes(kind: str, batch: DataFrame, keys: list[str], target: DataFrame) -> DataFrame:
    """``label, n`` of a sequential upsert of the batch: new keys count as added once,
    every other write is an update."""
    writes = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("w"))
    known = writes.alias("b").join(target.select(*keys).alias("t"), _same_key(keys, "b", "t"), "left_semi")
    totals = writes.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("keys")).withColumn(
        "added", F.col("keys") - known.agg(F.count(F.lit(1))).scalar())
    rows = F.array(
        F.struct(F.lit(f"{kind} added").alias("label"), F.col("added").alias("n")),
        F.struct(F.lit(f"{kind} updated").alias("label"), (F.col("total") - F.col("added")).alias("n")))
    return totals.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def value_key(value: Column) -> Column:
    """Key of an attribute value, of 128 bits at most; long texts are grouped and joined by it. Texts that are shorter than
    a digest stand for themselves."""
    return F.when(F.octet_length(value) < 16, value.cast("binary")).otherwise(F.unhex(F.md5(value)))


def append_links(links: DataFrame, batch: DataFrame) -> DataFrame:
    """Append links that are not there yet; existing ones stay. A link without attribute or value is never there.

    Keys of links travel as one array per vacancy, which is put together before the shuffle, and are compared where a vacancy's
    arrays meet.
    """
    columns, keys = links.columns, ["data_hash", "attr_id", "_value"]
    own = batch.select(*columns).withColumn("_value", value_key(F.col("attr_value"))).repartition("data_hash").dropDuplicates(keys)
    own = own.groupBy("data_hash").agg(F.collect_list(F.struct(*[c for c in own.columns if c != "data_hash"])).alias("_own"))
    known = links.select("data_hash", F.struct("attr_id", value_key(F.col("attr_value")).alias("_value")).alias("_link"))
    known = known.groupBy("data_hash").agg(F.collect_set("_link").alias("_known"))

    def there(e: Column) -> Column:
        return e["attr_id"].isNotNull() & e["_value"].isNotNull() & F.coalesce(
            F.array_contains("_known", F.struct(e["attr_id"].alias("attr_id"), e["_value"].alias("_value"))), F.lit(False))

    added = own.join(known, "data_hash", "left").select("data_hash", F.explode(F.filter("_own", lambda e: ~there(e))).alias("_link"))
    return links.unionByName(added.select("data_hash", "_link.*").select(*columns))


def upsert_links(links: DataFrame, batch: DataFrame) -> DataFrame:
    """Links of values to vacancies with the source and time of their last writer; links never go."""
    # A rerun of an older message must not move the time back. A vacancy has one month, its message's.
    columns = ["attr_id", "attr_value", "data_hash", "attr_source_id", "written", "month"]
    rows = links.select(*columns).unionByName(batch.select(*columns)).withColumn("_value", value_key(F.col("attr_value")))
    newest = rows.groupBy("data_hash", "attr_id", "_value").agg(
        F.max(F.struct("written", "attr_source_id")).alias("_last"), F.max("month").alias("month"), F.first("attr_value").alias("attr_value"))
    return newest.select("data_hash", "attr_id", "attr_value", "_last.attr_source_id", "_last.written", "month")


def upsert_attrs(attrs: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Attribute values keyed by (attr, value); the source is the last writer's."""
    keys = ["attr_id", "_value"]
    rows = batch.select("attr_id", value_key(F.col("attr_value")).alias("_value"), "attr_value", "attr_source_id", *order)
    newest = rows.groupBy(*keys).agg(F.max_by("attr_source_id", F.struct(*order)).alias("attr_source_id"), F.first("attr_value").alias("attr_value"))
    stored = attrs.withColumn("_value", value_key(F.col("attr_value")))
    return upsert(stored, newest, keys, ["attr_value", "attr_source_id"], order, collapsed=True).drop("_value")


def cascade_delete(children: dict[str, tuple[DataFrame, str]], deleted: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every child table without the rows whose parent key was deleted."""
    gone = deleted.select(F.col(key).alias("_gone")).distinct()
    return {name: df.join(gone, F.col(column) == F.col("_gone"), "left_anti")
            for name, (df, column) in children.items()}


def restore_from_backup(target: DataFrame, backup: DataFrame, key: str, columns: list[str],
                        order: list[str]) -> DataFrame:
    """Overwrite columns, NULLs included, of the rows whose key is in the backup."""
    newest = latest_per_key(backup.select(key, *columns, *[c for c in order if c not in columns]), [key], order)
    saved = newest.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    hit = F.col("_key").isNotNull()
    return target.join(saved, F.col(key) == F.col("_key"), "left").select(
        *[F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in target.columns])

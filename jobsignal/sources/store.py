"""Vacancy store: parquet tables in folders of their own per run, published by a manifest.

A run writes what it changes into new folders with a unique name and then publishes one manifest: for every table and
partition the folders that hold it, those of the run before for what it left alone. Readers follow the newest manifest
only. So a run that dies, before or after another one commits, is never seen, and two runs never write the same folder.
A manifest is written whole under a name of its own and then renamed, never over another one; a manifest that can't be
read (left by a copy that broke off, say) is passed over.

Tables of messages and vacancies are written by source and month (``schemas.PARTITIONS``). A run replaces the partitions
that its rows fall into or that hold older versions of them; files of all others stay as they are. Tables of texts
only grow: a run adds a folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal import schemas as S

# Table -> partition (its path below a folder, "" for all of an unpartitioned table) -> folders.
Manifest = dict[str, dict[str, list[str]]]


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        root = self._path("")
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._begin()

    def _begin(self) -> None:
        """Start a run on top of the newest manifest."""
        self.run = max(self._runs(), default=0) + 1
        self._base = self.manifest()
        self._name = f"run-{self.run}-{uuid.uuid4().hex[:12]}"
        self._staged: Manifest = {}

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _runs(self) -> list[int]:
        """Numbers of the committed runs, oldest first."""
        path = self._path("_commits")
        if not self._fs.exists(path):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(path)]
        return sorted(int(n[4:]) for n in names if n.startswith("run-") and n[4:].isdigit())

    def committed(self) -> int:
        """Number of the newest run whose manifest is whole."""
        return next((run for run in reversed(self._runs()) if self._load(run) is not None), 0)

    def _load(self, run: int) -> Manifest | None:
        """The manifest of a run, None if it is not whole."""
        try:
            text = self.spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(self._fs.open(self._path(f"_commits/run-{run}")))
            return json.loads(bytes(text).decode())
        except (Py4JJavaError, ValueError):
            return None

    def manifest(self, run: int | None = None) -> Manifest:
        """What a committed run published, the newest whole one unless one is named."""
        run = self.committed() if run is None else run
        return run and self._load(run) or {}

    def read(self, table: str, only: set[str] | None = None) -> DataFrame:
        """Newest committed version, or an empty frame with the table's schema; ``only`` names the partitions wanted."""
        schema = S.TABLES.get(table)
        held = self.manifest().get(table, {})
        paths = [f"{self.path}/{folder}/{part}".rstrip("/") for part, folders in held.items() if only is None or part in only for folder in folders]
        if paths:
            return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(*paths)
        if schema is None:
            raise KeyError(f"no committed version of {table}")
        return self.spark.createDataFrame([], schema)

    def _write(self, table: str, df: DataFrame) -> tuple[str, list[str]]:
        """Write this run's rows of a table; returns the folder and the partitions in it."""
        folder = f"{table}/{self._name}"
        columns = S.TABLES[table].names if table in S.TABLES else df.columns
        parts = S.PARTITIONS.get(table, {})
        rows = df.select(*columns, *[F.expr(value).alias(name) for name, value in parts.items()])
        # Rows of a partition come together first, large partitions in several tasks: few files, none of them huge.
        rows = rows.hint("rebalance", *parts) if parts else rows
        rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{self.path}/{folder}")
        written = [""]
        for _ in parts:
            written = [f"{at}/{s.getPath().getName()}".lstrip("/") for at in written
                       for s in self._fs.listStatus(self._path(f"{folder}/{at}".rstrip("/"))) if s.isDirectory()]
        return folder, written

    def stage(self, table: str, df: DataFrame, replaced: set[str] | None = None) -> DataFrame | None:
        """Write this run's version of a table, or of its partitions ``replaced``; an unpartitioned one is returned as read back.

        A staged batch has exact sizes, which lets Spark decide broadcasts on facts,
        and it is what later steps re-read if an executor is lost.
        """
        folder, written = self._write(table, df)
        kept = {} if replaced is None else {part: f for part, f in self._base.get(table, {}).items() if part not in replaced}
        self._staged[table] = kept | {part: [folder] for part in written}
        return self.spark.read.parquet(f"{self.path}/{folder}") if replaced is None and table not in S.PARTITIONS else None

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to an unpartitioned table."""
        folder, _ = self._write(table, rows)
        self._staged[table] = {"": [*self._staged.get(table, self._base.get(table, {})).get("", []), folder]}

    @staticmethod
    def _part_name(table: str) -> Column:
        """Path of the partition that a row is in."""
        value = lambda sql: F.coalesce(F.expr(sql).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        return F.concat_ws("/", *[F.concat(F.lit(f"{p}="), value(sql)) for p, sql in S.PARTITIONS[table].items()]).alias("part")

    def merge(self, table: str, keys: list[str], batch: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the partitions that ``batch`` changes by ``merged`` of their rows.

        Those are the partitions of the batch's rows and of the stored rows with their keys, found by a scan of keys alone.
        As many names reach the driver as there are partitions.
        """
        name = self._part_name(table)
        hit = self.read(table).join(batch.select(*keys), keys, "left_semi").select(name)
        changed = {r.part for r in batch.select(name).union(hit).distinct().collect()}
        self.stage(table, merged(self.read(table, changed)), changed)

    def drop_rows(self, table: str, key: str, gone: DataFrame) -> DataFrame:
        """Stage a table without the rows whose ``key`` is in ``gone``; only partitions that hold such rows are written anew."""
        name = self._part_name(table)
        changed = {r.part for r in self.read(table).join(gone, key, "left_semi").select(name).distinct().collect()}
        self.stage(table, self.read(table, changed).join(gone, key, "left_anti"), changed)
        return self.read(table).join(gone, key, "left_anti")

    def commit(self) -> int:
        """Publish everything staged by this run; fails if another run was faster.

        After a failure the store is at the start of a new run, on top of what the other one published.
        """
        run, tables = self.run, self._base | {t: parts for t, parts in self._staged.items() if not t.startswith("_")}
        written, target = self._path(f"_commits/.{self._name}"), self._path(f"_commits/run-{run}")
        stream = self._fs.create(written, False)
        stream.write(bytearray(json.dumps(tables).encode()))
        stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 0)  # none: never over an existing file
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(written, target, options)
        except Py4JJavaError as error:
            self._fs.delete(written, False)
            self._begin()
            raise RuntimeError(f"run {run} was published by another writer; stage its changes again") from error
        self._begin()
        return run

    def expire(self, keep: int = 2) -> int:
        """Delete the folders and manifests that none of the newest ``keep`` runs needs; returns the number of folders.

        Folders of the run after the newest one stay: it may be at work.
        """
        runs = self._runs()
        kept = [run for run in runs if self._load(run) is not None][-max(keep, 1):]
        needed = {folder for run in kept for parts in self.manifest(run).values() for folders in parts.values() for folder in folders}
        dropped = 0
        for status in self._fs.listStatus(self._path("")):
            table = status.getPath().getName()
            if table == "_commits" or not status.isDirectory():
                continue
            for version in self._fs.listStatus(status.getPath()):
                name = version.getPath().getName()
                number = name.split("-")[1] if name.startswith("run-") else ""
                if number.isdigit() and int(number) <= self.committed() and f"{table}/{name}" not in needed:
                    dropped += bool(self._fs.delete(version.getPath(), True))
        for run in runs:
            if run < min(kept, default=0):
                self._fs.delete(self._path(f"_commits/run-{run}"), False)
        return dropped

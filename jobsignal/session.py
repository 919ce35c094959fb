"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results depend on: dates are formatted and parsed in UTC.

    How inputs are split is left to the session: ``spark.sql.files.maxPartitionBytes`` and
    ``spark.sql.files.minPartitionNum`` for scans, ``spark.sql.shuffle.partitions`` for shuffles. Streams keep
    their state in RocksDB with a changelog, so it is not bounded by an executor's heap. Batches for Arrow are
    small, so a Python worker's memory follows a few megabytes of text and not 10,000 rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}
_SHARED: set[tuple[str, str]] = set()


def work_folder(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, the context's checkpoint folder or the warehouse.

    Only a session without executors of its own may fall back to a temporary folder. On a cluster a ``file:`` folder
    can be a mount that all machines share or a folder of each machine, so it is tried before it is used.
    """
    context = spark.sparkContext
    app, cluster = context.applicationId, not _single(context.master)
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or _LOCAL_FOLDERS.get(app)
    if not base and cluster:
        base = spark.conf.get("spark.sql.warehouse.dir")
    elif not base:
        base = _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="jobsignal-")
        context.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/jobsignal-{app}"
    if cluster and (app, folder) not in _SHARED:
        path = context._jvm.org.apache.hadoop.fs.Path(base)
        if path.getFileSystem(context._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
            require_shared(spark, folder)
        _SHARED.add((app, folder))
    return folder


def input_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of what is staged for an input; its name is free of what stores refuse in names, as the colon of a uri."""
    name = re.sub(r"[^\w.-]", "_", sf_dir.strip("/"))
    return f"{work_folder(spark)}/{name}-{zlib.crc32(sf_dir.encode()):08x}"


def require_shared(spark: SparkSession, folder: str) -> None:
    """Raise unless rows that tasks write to ``folder`` are found there again, by the driver and by other tasks."""
    rows, probe = 4 * max(2, spark.sparkContext.defaultParallelism), f"{folder}/shared-{uuid.uuid4().hex}"
    try:
        spark.range(0, rows, 1, rows).write.parquet(probe)
        found = spark.read.schema("id bigint").parquet(probe).count()
    except Exception as error:
        raise RuntimeError(f"{folder} can't be written and read by all machines; set spark.checkpoint.dir to a folder they share") from error
    if found != rows:
        raise RuntimeError(f"{folder} is a folder of each machine: {found} of {rows} rows came back; set spark.checkpoint.dir to a folder they share")


def _single(master: str) -> bool:
    """Whether driver and tasks are one process, so that any folder is shared."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None

"""The shared folder on clusters, and folders named after inputs."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle

from jobsignal import session
from jobsignal.dictionaries import Selector
from jobsignal.plans import datasets as T
from jobsignal.sources.selecting import Pick, Picks


def events(spark, folder):
    spark.sql("SELECT 1L user_id, 2L event_id, 'view' event_type, 1D value, TIMESTAMP_NTZ'2024-01-01 00:00:00' ts").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_a_mount_is_a_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    rows = T.fetch_results(spark, events(spark, tmp_path)).select("event_id", "status").collect()
    assert [tuple(r) for r in rows] == [(2, 200)]


def test_a_folder_that_loses_rows_is_refused(spark, tmp_path, monkeypatch):
    (tmp_path / "file").write_text("")
    with pytest.raises(RuntimeError, match="written and read by all machines"):
        session.require_shared(spark, f"{tmp_path}/file/folder")
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: 0)
    with pytest.raises(RuntimeError, match="0 of"):
        session.require_shared(spark, str(tmp_path))


@pytest.mark.parametrize("checkpoint, expected", [(None, "hdfs://n/warehouse"), ("hdfs://n/set/1", "hdfs://n/set/1")])
def test_a_cluster_without_the_setting_uses_what_is_shared(monkeypatch, checkpoint, expected):
    monkeypatch.setattr(session, "require_shared", lambda spark, folder: None)
    scheme = SimpleNamespace(getFileSystem=lambda conf: SimpleNamespace(getUri=lambda: SimpleNamespace(getScheme=lambda: "hdfs")))
    hadoop = SimpleNamespace(fs=SimpleNamespace(Path=lambda base: scheme))
    context = SimpleNamespace(
        applicationId=f"app-{checkpoint}", master="spark://somewhere:7077", getCheckpointDir=lambda: checkpoint,
        _jvm=SimpleNamespace(org=SimpleNamespace(apache=SimpleNamespace(hadoop=hadoop))),
        _jsc=SimpleNamespace(hadoopConfiguration=lambda: None))
    conf = {"spark.sql.warehouse.dir": "hdfs://n/warehouse"}
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, other=None: conf.get(name, other)))
    assert session.work_folder(spark) == f"{expected}/jobsignal-app-{checkpoint}"


def test_folders_of_inputs_named_by_uri(spark):
    """HDFS refuses a colon in a name."""
    valid = spark.sparkContext._jvm.org.apache.hadoop.hdfs.DFSUtilClient.isValidName
    names = [session.input_folder(spark, d).removeprefix("file:") for d in ("hdfs://n:8020/in/sf0.1", "/in/sf0.1", "/in_sf0.1")]
    assert all(map(valid, names)) and len(set(names)) == 3


def test_selectors_reach_workers_that_have_no_copy_of_the_library(tmp_path):
    blob = tmp_path / "pickled"
    blob.write_bytes(cloudpickle.dumps(Picks(link=Pick(Selector("a", "href", ("/",))))))
    load = f"from pyspark import cloudpickle; assert cloudpickle.loads(open({str(blob)!r}, 'rb').read()).names == ['link']"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", load], cwd=tmp_path, env=env, check=True, timeout=60)

"""Where queries stage tables in sessions on a cluster."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from pricewright import stage as staging
from pricewright.stage import shared_dir


class _Session:
    """Just enough of a session on a cluster that names no folder for checkpoints."""

    def __init__(self, master, warehouse):
        class conf:
            get = staticmethod(lambda key, *d: {"spark.sql.warehouse.dir": warehouse}.get(key, *d))

        class context:
            environment, folder = {}, None

        context.master = master
        context.getCheckpointDir = staticmethod(lambda: context.folder)
        context.setCheckpointDir = staticmethod(lambda path: setattr(context, "folder", path))
        self.conf, self.sparkContext = conf, context


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_a_cluster_that_names_no_folder_stages_below_the_warehouse(master):
    run = entry._with_code(lambda spark, folder: shared_dir(spark))
    session = _Session(master, "hdfs://name/warehouse/")
    assert run(session, "") == "hdfs://name/warehouse/pricewright-checkpoints"


def test_a_mounted_folder_is_shared(spark, monkeypatch):
    folder = shared_dir(spark)
    before = set(os.listdir(folder.removeprefix("file:")))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert shared_dir(spark) == folder
    assert set(os.listdir(folder.removeprefix("file:"))) == before


def test_a_folder_of_each_machine_is_not_shared(spark, monkeypatch, tmp_path):
    # The files of other machines' tasks do not come to the driver's.
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: os.makedirs(path))
    assert not staging._is_mounted(spark, str(tmp_path))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(staging, "_MOUNTED", set())
    monkeypatch.setattr(staging, "_is_mounted", lambda spark, folder: False)
    with pytest.raises(ValueError, match="no shared store"):
        shared_dir(spark)


_RUN = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.config(map={
    "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "1g",
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1",
    "spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": sys.argv[1] + "/warehouse",
}).getOrCreate()
rows = [(1, 'a "b"\\nc'), (2, None), (3, "d\\n\\n,e")]
spark.createDataFrame(rows, "doc_id long, text string").write.parquet(sys.argv[1] + "/documents.parquet")
import __spark_entry__ as entry
found = entry.queries()["csv_multiline_records"](spark, sys.argv[1]).collect()
assert sorted(r.doc_id for r in found) == [1, 2, 3], found
spark.stop()
"""


def test_a_query_on_a_cluster_that_names_no_folder(tmp_path):
    (tmp_path / "conf").mkdir()
    environment = os.environ | {"PYTHONPATH": entry.HERE, "SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run(
        [sys.executable, "-c", _RUN, str(tmp_path)],
        env=environment, cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_folder_that_is_not_shared_gives_way_to_the_warehouse(monkeypatch):
    monkeypatch.setattr(staging, "_is_mounted", lambda spark, folder: False)
    session = _Session("local-cluster[2,1,1024]", "hdfs://name/warehouse")
    session.sparkContext.folder = "file:/tmp/own"
    with pytest.warns(UserWarning, match="file:/tmp/own is no shared store"):
        assert shared_dir(session) == "hdfs://name/warehouse/pricewright-checkpoints"
    assert session.sparkContext.folder == "hdfs://name/warehouse/pricewright-checkpoints"


def test_a_folder_that_tasks_cannot_write_to_is_not_shared(spark, tmp_path):
    (tmp_path / "file").write_text("")
    assert not staging._is_mounted(spark, str(tmp_path / "file" / "checkpoints"))


def test_a_query_whose_named_folder_each_executor_has_for_itself(tmp_path):
    # Every process works in a folder of its own; the staged file of one read as empty in the others.
    (tmp_path / "conf").mkdir()
    named = '"spark.checkpoint.dir": "/proc/self/cwd/checkpoints",'
    run = _RUN.replace("config(map={", "config(map={" + named)
    environment = os.environ | {"PYTHONPATH": entry.HERE, "SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run(
        [sys.executable, "-c", run, str(tmp_path)],
        env=environment, cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]

"""Written intermediate tables.

A job that joins a large fact table to aggregated dimensions writes those dimensions
first and joins the written tables. That gives three things at once:

* the lineage is cut on shared storage, so a lost executor costs a task, not the chain;
* the planner knows each file size, so it broadcasts a dimension only when it is really
  below ``spark.sql.autoBroadcastJoinThreshold`` and never shuffles the fact for it;
* above that size both join inputs are plain shuffles, the shape in which adaptive
  execution can split a hot key of the fact side over many tasks.
"""

from __future__ import annotations

import re
import uuid
import warnings

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Else the checkpoint folder of the context. Without either it is an error. On a cluster a local
    file path may be a mount that all machines share, which its name does not tell; so it is tried.
    Files of one machine alone are lost to the others, and a table staged there would read as empty:
    such a folder gives way to one below the warehouse, and if that is no better, it is an error.
    YARN has a store of its own, and there a file path is not tried.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _is_shared(spark, folder):
        named, folder = folder, warehouse_dir(spark)
        if not folder or not _is_shared(spark, folder):
            raise ValueError(f"{named} is no shared store; set spark.checkpoint.dir to one")
        if _BELOW not in (spark.sparkContext.getCheckpointDir() or ""):
            warnings.warn(f"{named} is no shared store; tables are staged in {folder}")
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_BELOW = "pricewright-checkpoints"


def warehouse_dir(spark: SparkSession) -> str | None:
    """The folder for staged tables below the warehouse, which all executors reach."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    return warehouse and f"{warehouse.rstrip('/')}/{_BELOW}"


def _is_shared(spark: SparkSession, folder: str) -> bool:
    master = spark.sparkContext.master
    if re.match(r"local(\[.*)?$", master) or _scheme(spark, folder) != "file":
        return True
    return master != "yarn" and _is_mounted(spark, folder)


#: Application and folder of those that executors were found to share with the driver, or not to.
_MOUNTED: set[tuple[str, str]] = set()
_REFUSED: set[tuple[str, str]] = set()


def _is_mounted(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds the files that tasks, one for each core, have written there.

    Executors that come later are not asked. Where tasks cannot write, it is not.
    """
    known = spark.sparkContext.applicationId, folder
    if known not in _MOUNTED | _REFUSED:
        tasks = max(spark.sparkContext.defaultParallelism, 2)
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/pricewright-{uuid.uuid4().hex}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(path.toString())
            found = [f.getPath().getName() for f in files.listStatus(path)]
        except (Py4JError, PySparkException):
            found = []
        finally:
            files.delete(path, True)
        written = sum(name.startswith("part-") for name in found)
        (_REFUSED if written < tasks else _MOUNTED).add(known)
    return known in _MOUNTED


def _scheme(spark: SparkSession, folder: str) -> str:
    """The scheme of a path, or of the default file system for a path without one."""
    if ":" not in folder.split("/")[0]:
        folder = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:/"
    return folder.split(":")[0]


class Stage:
    """A run-private folder of written tables. Its owner calls :meth:`remove` when results are
    consumed, or uses it as a context manager."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/pricewright-{uuid.uuid4().hex}"
        #: Names in the catalog of the bucketed tables written here and below.
        self._names: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def sub(self, name: str) -> Stage:
        """A folder of its own below this one, so that jobs which share a stage, or one job run
        twice, never write the same table. It goes with this stage."""
        below = Stage(self.spark, f"{self.root}/{name}-{uuid.uuid4().hex[:12]}")
        below._names = self._names
        return below

    def table(
        self, df: DataFrame, name: str, bucketed: tuple[str, int] | None = None
    ) -> DataFrame:
        """Write ``df`` once and return a reader over the written files.

        With ``bucketed``, a column and a number, rows are dealt into that many sorted files by the
        column, and tables with equal numbers are joined on it without an exchange.
        """
        if bucketed is None:
            df.write.mode("error").parquet(self.path(name))
            return self.spark.read.schema(df.schema).parquet(self.path(name))
        column, buckets = bucketed
        known = f"pricewright_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, column).write.mode("error").format("parquet")
        writer = writer.bucketBy(buckets, column).sortBy(column).option("path", self.path(name))
        writer.saveAsTable(known)
        self._names.append(known)
        return self.spark.table(known)

    def counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """As :meth:`table`, with the number of rows, counted by the tasks that write them."""
        seen = Observation()
        table = self.table(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
        return table, seen.get["rows"]

    def forget(self) -> None:
        """Take bucketed tables out of the catalog; their files stay."""
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names.clear()

    def remove(self) -> None:
        """Delete the folder, wherever it is. Tables read from it are no longer usable."""
        self.forget()
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *error: object) -> None:
        self.remove()

"""Cutting lineage through tables in the folder that driver and executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where that setting is
missing and the master is local (tests, a laptop) is a local folder made and used instead.

Results are read from staged tables after an operator has returned, so it cannot delete them
itself; ``clear`` does, for all operators of a session, once its results have been used.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
#: Spark's own switch for dropping a finished query's shuffle files at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a few short columns that a task sorts in memory.
TASK_ROWS = 1_000_000


_local: dict[str, str] = {}
_made: list[str] = []
_shared: dict[tuple, DataFrame] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, or a fresh local one where a local master names none."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that driver and executors share")
        folder = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="markerloom-")
        _local[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def shared(spark: SparkSession, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
    """A table over staged data that several queries of a session read: made at first, and anew after ``clear``."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def clear(spark: SparkSession) -> None:
    """Delete every staged table of this driver; results that were not written elsewhere are lost."""
    _shared.clear()
    while _made:
        _delete(spark, _made.pop())


class Staging:
    """Named Parquet tables of one operator run, each readable by every later stage.

    A written table survives lost executors and is read back with real sizes, which adaptive
    execution needs for its broadcast decisions.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _made.append(self.root)

    def put(self, df: DataFrame, name: str, release: bool = False, arrow_rows: int | None = None) -> DataFrame:
        """Write ``df`` and read it back.

        ``release`` drops the query's shuffle files at once; ``arrow_rows`` bounds the rows that a
        Python task of the query is sent at a time, for tables of long texts.
        """
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        wanted = ({_CLEANUP: "true"} if release else {}) | ({_BATCH: str(arrow_rows)} if arrow_rows else {})
        before = {key: self.spark.conf.get(key, None) for key in wanted}
        try:
            for key, value in wanted.items():
                self.spark.conf.set(key, value)
            df.write.parquet(path)
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        back = self.spark.read.schema(df.schema).parquet(path)
        _paths[back] = path
        return back

    def drop(self, df: DataFrame | None) -> None:
        """Delete a staged table that nothing reads any more."""
        if df is not None and (path := _paths.pop(df, None)):
            _delete(self.spark, path)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``keys``, to more tasks than the session's where a task would get too many."""
    return df.repartition(*_tasks(df.sparkSession, rows), *keys)


def dealt_by_range(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """As ``dealt``, by ranges of ``keys``."""
    return df.repartitionByRange(*_tasks(df.sparkSession, rows), *keys)


def _tasks(spark: SparkSession, rows: int) -> list[int]:
    """No number where the session's own does (adaptive execution may then join small shares), else one for ``rows``."""
    tasks = -(-rows // TASK_ROWS)
    return [tasks] if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else []


def small_side(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """A staged table of a few short columns as a join's side: broadcast up to ``max_rows`` rows.

    The rows are counted first (cheap on a staged table); a longer table is joined by a shuffle.
    """
    return F.broadcast(df) if df.count() <= max_rows else df

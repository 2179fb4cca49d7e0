"""Session settings, the shared work folder, and the size check for broadcasts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import CancelledError, ThreadPoolExecutor
from pathlib import Path
from threading import Event, Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast up to this many rows. Sides are narrow (keys and at most about
# thirty numbers), so half a million rows stay near 100 MB; a 360,765-cell city grid passes.
BROADCAST_ROWS = 500_000

T = TypeVar("T")


def build_session(master: str | None = None, app: str = "sensorgrid", **conf: str) -> SparkSession:
    """Session with adaptive execution on. Values in ``conf`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    The cluster names it in ``spark.checkpoint.dir``. A folder of our own is set only where none
    is configured and the session is local; a cluster without one is an error, because a folder
    on one machine would not survive the loss of that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sensorgrid-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Stage:
    """A place in the shared folder that holds one table at a time.

    Compared with ``checkpoint()`` a staged table takes one job instead of two, is columnar and
    compressed, and tells Catalyst its size.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        """Write ``df``, which may read the table held so far, and go on from the copy."""
        path = work_path(self.spark, self.name)
        df.write.parquet(path)
        self.clear()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Give the space back."""
        if self.path:
            remove_path(self.spark, self.path)
            self.path = None


class BucketedStage:
    """A place in the shared folder for tables that are dealt into buckets by a key.

    Tables of one key and number of buckets are joined by the key without a shuffle. Held tables
    are known to the session's catalog under names of their own until they are cleared.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets
        self.table = self.path = None

    def put(self, df: DataFrame) -> DataFrame:
        """Write ``df``, which may read the table held so far, and go on from the copy."""
        path = work_path(self.spark, self.name)
        table = path.rsplit("/", 1)[1].replace("-", "_")
        dealt = df.repartition(self.buckets, self.key)
        dealt.write.bucketBy(self.buckets, self.key).format("parquet").option("path", path).saveAsTable(table)
        self.clear()
        self.table, self.path = table, path
        return self.spark.table(table)

    def clear(self) -> None:
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            remove_path(self.spark, self.path)
            self.table = self.path = None


def plan_bytes(df: DataFrame) -> int:
    """The size of ``df`` that the optimised plan's statistics state; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], T]], workers: int) -> list[T]:
    """Results of ``tasks`` in order, of which ``workers`` run at a time, each as Spark jobs.

    Every task has a scheduler pool of its own, which a session in fair mode serves alike. The first
    error is raised once the tasks that have begun are over; tasks that have not begun never do.
    """
    sc, failed = spark.sparkContext, Event()

    @inheritable_thread_target(spark)
    def pooled(number: int, task: Callable[[], T]) -> T:
        if failed.is_set():
            raise CancelledError
        sc.setLocalProperty("spark.scheduler.pool", f"side-{number % workers}")
        try:
            return task()
        except BaseException:
            failed.set()
            raise

    with ThreadPoolExecutor(max_workers=workers) as pool:
        begun = [pool.submit(pooled, k, task) for k, task in enumerate(tasks)]
        return [future.result() for future in begun]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stage a table of moderate size that lazy results go on reading; it is left in the folder."""
    return Stage(df.sparkSession, "stage").put(df)


_shipped: set[str] = set()
_shipping = Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The functions that run there are found by name, wherever the driver was started from.
    """
    sc = spark.sparkContext
    with _shipping:
        if sc.applicationId not in _shipped:
            package = Path(__file__).resolve().parent
            archive = Path(tempfile.mkdtemp(prefix="sensorgrid-")) / "sensorgrid"
            sc.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
            _shipped.add(sc.applicationId)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows, counted now if not known.

    Above the bound ``df`` is marked for a sort-merge join, in which adaptive execution splits
    skewed partitions. Left to itself Catalyst would go by the size of the files, and regular keys
    are stored in so few bytes that it would broadcast many millions of them.
    """
    if rows is None:
        rows = df.count()
    return F.broadcast(df) if rows <= max_rows else df.hint("merge")

"""Tables written between the rounds of an iteration, in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None
_run = uuid.uuid4().hex
_used: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where it is unset, a folder of our own."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own = _own or tempfile.mkdtemp(prefix="reliefspark-")
        base = _own
    return base if ":" in base.split("/")[0] else f"file://{base}"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in this driver's own part of it, which goes when its Python ends."""
    run = f"{shared_folder(spark).rstrip('/')}/relief-{_run}"
    if not _used:
        atexit.register(_tidy)
    _used[run] = spark
    return f"{run}/{name}-{uuid.uuid4().hex[:12]}"


def _tidy() -> None:
    for folder, spark in _used.items():
        with suppress(Exception):  # the session may have ended
            if spark.sparkContext._jsc is not None:
                clean(spark, folder)


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet and read again: later rounds start from files, whatever executor is lost."""
    path = fresh_folder(df.sparkSession, "round")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._relief_path = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes a table of cut() that nothing reads any more."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._relief_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with `name`: 0, 1, ... in ascending order of the column `order` (no two equal).

    Rows are dealt out by ranges and numbered in their partitions; the partitions' row counts, one small row
    each, give the offsets, so that no task sees all rows. One written table fixes the ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("__at", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumns({"__part": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))}))
    total, offsets = 0, []
    for part, rows in sorted(map(tuple, ranged.groupBy("__part").count().collect())):
        offsets.append((part, total))
        total += rows
    # One row a partition.
    before = F.broadcast(df.sparkSession.createDataFrame(offsets, "__part long, __before long"))
    return ranged.join(before, "__part").withColumn(name, F.col("__at") + F.col("__before")).drop("__part", "__at", "__before")


class StageTimes:
    """Wall-clock seconds of named stages; a stage that runs again adds up."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - began

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, seconds, percent) in order of first use."""
        total = sum(self.seconds.values()) or 1.0
        return spark.createDataFrame([(n, s, 100 * s / total) for n, s in self.seconds.items()], "stage string, seconds double, percent double")


def clean(spark: SparkSession, *folders: str) -> list[str]:
    """Deletes the folders of intermediate stages that are there; returns those."""
    gone = []
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True):
            gone.append(folder)
    return gone

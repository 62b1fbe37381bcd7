"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.session import ensure_checkpoint_dir


class Workspace:
    """A folder of Parquet tables that cut lineage, under ``spark.checkpoint.dir``.

    Each table is written once and read by several later branches; a lost
    executor re-reads it. While a table is written Spark is asked to remove
    the shuffle files of that execution at its end: the table replaces them, so
    the disk holds one step at a time. ``drop`` removes the folder; who made it calls that when
    the operator's result has been written (``owned`` collects those that operators make themselves).
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        if _collecting.get():
            _collecting.get()[-1].append(self)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with settings(self.spark, {CLEANUP: "true", **MODEST_BATCHES}):
            df.write.options(**TABLE_OPTIONS).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self, name: str) -> None:
        """Remove one table that no later step reads."""
        self._remove(f"{self.root}/{name}")

    def drop(self) -> None:
        self._remove(self.root)

    def _remove(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def splittable(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows, with whole-number ``keys`` written as expressions, so that a join on them shuffles ``df`` anew.

    For the aggregated side of a join on the keys it was grouped by. AQE splits a hot key of the other
    side only where both inputs of the join come straight from a shuffle, not from an aggregation above one.
    """
    return df.select(*[F.expr(f"{c} ^ 0").alias(c) if c in keys else F.col(c) for c in df.columns])


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of one write; what the session had comes back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Arrow batches of whole texts, small enough for a Python worker and the executor's direct memory to hold several
MODEST_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

#: a writer holds a row group in memory and a reader its columns; 16 MB of them, where Spark's default is 128
TABLE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(16 << 20)}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_collecting: ContextVar[tuple[list[Workspace], ...]] = ContextVar("collecting", default=())


@contextmanager
def owned():
    """Collects the workspaces that are made inside, by the same thread, for who writes the result and drops them then."""
    mine: list[Workspace] = []
    token = _collecting.set((*_collecting.get(), mine))
    try:
        yield mine
    finally:
        _collecting.reset(token)

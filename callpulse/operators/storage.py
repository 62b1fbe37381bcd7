"""Tables in shared storage that are written more than once.

A commit is one empty file in a hidden folder beside the data, whose name holds a number, a key and a
value; the highest number of a key holds. Files are created, never renamed or
overwritten, so a reader sees the state before or after a commit, and data that
was written without its commit (a failed run) is seen by nobody.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.functions.timefns import add_days
from callpulse.operators.calls import label_span
from callpulse.sources.tables import SCORE_SCHEMA

_NAME = re.compile(r"(\d+)~([^~]+)~([^~]+)")


def conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class Commits:
    """Key to value, in ``folder/_commits``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_commits")
        self._new = lambda name: spark._jvm.org.apache.hadoop.fs.Path(self._path, name)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _all(self) -> list[tuple[int, str, str]]:
        if not self._fs.exists(self._path):
            return []
        found = (_NAME.fullmatch(f.getPath().getName()) for f in self._fs.listStatus(self._path))
        return sorted((int(m[1]), m[2], m[3]) for m in found if m)

    def current(self) -> dict[str, str]:
        return {key: value for _, key, value in self._all()}

    def values(self) -> set[str]:
        return {value for _, _, value in self._all()}

    def publish(self, key: str, value: str) -> None:
        if "~" in key + value or "/" in key + value or not key or not value:
            raise ValueError("keys and values name folders")
        number = max((n for n, _, _ in self._all()), default=0) + 1
        # the name is new whatever another writer publishes at the same time; equal numbers go by key and value
        self._fs.create(self._new(f"{number:010d}~{key}~{value}"), False).close()


def _fresh() -> str:
    return uuid.uuid4().hex


# -- score table ------------------------------------------------------------------


def append_scores(df: DataFrame, path: str, run: str | None = None) -> None:
    """One run's rows into the typed score table, partitioned by day of ``date_pred``.

    A run of the same name replaces the earlier one (a retried job); without a name every call appends.
    """
    run, attempt = run or _fresh(), _fresh()
    out = conform(df, SCORE_SCHEMA).withColumn("pred_day", F.to_date("date_pred"))
    out.write.partitionBy("pred_day").parquet(f"{path}/run={run}/attempt={attempt}")
    Commits(df.sparkSession, path).publish(run, attempt)


def read_scores(spark: SparkSession, path: str, since=None) -> DataFrame:
    """Committed rows of the score table; with ``since`` (a date) only the partitions of that day and later."""
    runs = Commits(spark, path).current()
    if not runs:
        return spark.createDataFrame([], SCORE_SCHEMA)
    folders = [f"{path}/run={run}/attempt={attempt}" for run, attempt in sorted(runs.items())]
    schema = SCORE_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " ") + ", pred_day date"
    df = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    if since is not None:
        df = df.where(F.col("pred_day") >= F.lit(since).cast("date"))
    return df.select(*SCORE_SCHEMA.names)


# -- calls by month ---------------------------------------------------------------------


def write_calls(calls: DataFrame, path: str) -> None:
    """Call log partitioned by month of ``start_time``; a month that is written again replaces itself."""
    (
        calls.withColumn("month", F.trunc("start_time", "month"))
        .repartition("month", F.pmod(F.xxhash64("call_id"), F.lit(16)))  # a month is not one task
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def read_calls(spark: SparkSession, path: str, labels: DataFrame | None = None, cfg=None) -> DataFrame:
    """Stored calls; with labels, only the months that one of their windows touches.

    The bounds come from the labels while the query runs and prune partitions before files are opened. Whole
    days are kept at both ends, as the missed status belongs to a day.
    """
    calls = spark.read.parquet(path)
    if labels is not None:
        span = label_span(labels, cfg)
        lo, hi = F.trunc(add_days(span.getField("lo"), -1), "month"), span.getField("hi")
        calls = calls.where((F.col("month") >= lo) & (F.col("month") <= F.to_date(hi)))
    return calls.drop("month")

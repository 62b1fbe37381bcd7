"""Readers with explicit schemas.

Parquet inputs are read lazily so that Catalyst pushes filters and column
pruning into the scan; CSV review files are read with a declared schema,
never inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpulse.functions.timefns import parse_utc

DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("opp_id", T.LongType()),
        T.StructField("account_id", T.LongType()),
        T.StructField("review_ts", T.TimestampNTZType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_id", T.LongType()),
    ]
)

SCORE_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("opp_id", T.LongType()),
        T.StructField("proba", T.DoubleType()),
        T.StructField("mandate_delta_days", T.DoubleType()),
        T.StructField("pct_in_global", T.DoubleType()),
        T.StructField("days_since_last", T.DoubleType()),
        T.StructField("agent_experience_days", T.DoubleType()),
        T.StructField("no_callback_ratio", T.DoubleType()),
        T.StructField("unanswered_in", T.DoubleType()),
        T.StructField("missing_values", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date_pred", T.TimestampNTZType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("date_pred", T.TimestampNTZType()),
        T.StructField("opp_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("proba", T.DoubleType()),
        T.StructField("treatment", T.StringType()),
    ]
)


class Tables:
    """Lazy accessor for the driver parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


#: the column that holds the text of a malformed row
BAD_ROW = "_bad_row"


def read_reviews_csv(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One review export (header row, declared schema). ``extra`` names trailing columns
    that some exports carry; they are read as strings and dropped. Malformed rows are left out;
    ``read_reviews_tolerant`` gives them back."""
    return read_reviews_tolerant(spark, path, extra)[0]


def read_reviews_tolerant(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(reviews, quarantined rows) of one export.

    ``review_ts`` is read as text and parsed by ``parse_utc``: a bad date becomes null and the row stays, as an unknown date.
    A row whose other fields do not have their types, or which has too many or too few fields, is quarantined: its text as ``bad_row``.
    """
    text_dates = [T.StructField(f.name, T.StringType() if f.name == "review_ts" else f.dataType) for f in REVIEW_SCHEMA.fields]
    schema = T.StructType(text_dates + [T.StructField(c, T.StringType()) for c in (*extra, BAD_ROW)])
    df = spark.read.csv(
        path, header=True, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW, enforceSchema=True
    )
    # a scan of some columns would not notice that the others are malformed: all are read, whatever is selected later
    df = df.where(F.xxhash64(*REVIEW_SCHEMA.names) >= F.lit(-(1 << 63)))
    good = df.where(F.col(BAD_ROW).isNull()).withColumn("review_ts", parse_utc("review_ts")).select(*REVIEW_SCHEMA.names)
    bad = df.where(F.col(BAD_ROW).isNotNull()).select(F.col(BAD_ROW).alias("bad_row"), F.lit(path).alias("path"))
    return good, bad

"""Feature matrix assembly and imputation.

The per-KEY call features are filled with *call-weighted* medians: each KEY
counts as many times as it has call rows, which is what a per-call feature
table would give. The median is computed exactly without materialising the repeated rows (``callpulse.operators.median``:
exact, with bounded state per task). Medians are fitted once, like
``pyspark.ml.feature.Imputer``, and applied as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.config import KEY, MEDIAN_FILL_COLUMNS, MODEL_FEATURES, Config
from callpulse.operators.median import exact_medians
from callpulse.operators.warehouse import PUNCTUALITY_COLUMNS
from callpulse.session import materialize

CALL_FEATURE_COLUMNS = (
    *KEY,
    "n_rows",
    "n_calls_global",
    "in_global",
    "out_global",
    "pct_in_global",
    "pct_out_global",
    *[f"{p}_{c}" for c in ("expert", "bizdev", "customer_care") for p in ("n_calls", "in", "out", "pct_in", "pct_out")],
    "first_call",
    "last_call",
    "mean_wait_days",
    "avg_duration",
    "avg_duration_alt",
    "unanswered_in",
    "unanswered_out",
    "pct_missed_in",
    "pct_missed_out",
    "duration_in",
    "total_duration",
    "in_time_share",
    "n_calls_gt_600",
    "n_calls_ge_180",
    "n_voicemails",
    "n_missed_rows",
    "n_no_callback_rows",
    "missed_ratio",
    "no_callback_ratio",
    "last_call_out",
    "agent_absent",
    *PUNCTUALITY_COLUMNS,
    "max_start",
    "max_mandate",
    "total_time",
    "days_since_last",
    "days_since_first",
    "no_callback_count",
    "same_day_callback_count",
    "total_missed",
    "multi_call_days_global",
    "multi_call_days_7d",
    "multi_call_days_14d",
    "n_gaps_14d",
    "agent_experience_days",
    "n_experts",
    "n_interlocutors",
)

_NON_NUMERIC = {"account_id", "opp_id", "ref_date", "first_call", "last_call", "max_start", "max_mandate"}


def as_double(df: DataFrame, keep: set[str] = _NON_NUMERIC) -> DataFrame:
    """Cast every feature column to double (one numeric type for the model and the sinks)."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast("double").alias(c) for c in df.columns])


def fit_medians(features: DataFrame, cols, weight: str | None = None) -> dict[str, float | None]:
    """Fit step: exact medians as driver-side scalars (one value per column), bounded per task."""
    return exact_medians(features, cols, weight)


def weighted_medians(features: DataFrame, cols=MEDIAN_FILL_COLUMNS, weight: str = "n_rows") -> DataFrame:
    """One-row frame: median of each column, each KEY weighted by ``weight`` (nulls skipped)."""
    med = fit_medians(features, cols, weight)
    schema = ", ".join(f"{c} double" for c in cols)
    return features.sparkSession.createDataFrame([tuple(med[c] for c in cols)], schema)


def fill(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in values.items()})


def call_features_all(raw: DataFrame, cfg: Config, impute: str = "median") -> DataFrame:
    """Filled call features; KEYs lacking a real call, punctuality stats or a fill value are dropped.

    ``impute="median"``: the call-weighted median of the KEYs that have a value, as in the original;
    ``impute="zero"``: a KEY without such calls has none, so 0.
    """
    if impute not in ("median", "zero"):
        raise ValueError(impute)
    fills = fit_medians(raw, MEDIAN_FILL_COLUMNS, weight="n_rows") if impute == "median" else dict.fromkeys(MEDIAN_FILL_COLUMNS, 0.0)
    out = fill(raw, fills)
    required = ["first_call", "last_call", "max_mandate", *PUNCTUALITY_COLUMNS, *MEDIAN_FILL_COLUMNS]
    out = out.na.drop(how="any", subset=required)
    return as_double(out.select(*CALL_FEATURE_COLUMNS))


CRM_FEATURE_COLUMNS = (
    "days_r1_to_assembly",
    "days_assembly_to_sent",
    "last_stage",
    "days_last_stage_to_ref",
    "days_suspensive_to_ref",
    "days_created_to_sent",
    "days_created_to_mandate",
    "days_mandate_to_ref",
    "days_sent_to_ref",
)


def features_joined(call_features: DataFrame, crm: DataFrame, checkpoint: bool = True) -> DataFrame:
    """Call features left-joined to the CRM features and label on KEY.

    The CRM side is written first: it cuts the lineage (a lost executor re-reads it) and keeps the optimizer's
    constraint inference from growing with the number of derived columns. The call side is a projection of the written
    raw features.
    """
    c = crm.select(*KEY, "rating", "mandate_delta_days", *CRM_FEATURE_COLUMNS)
    if checkpoint:
        c = materialize(c)
    c = c.withColumnsRenamed({k: f"_{k}" for k in KEY})
    # the date is no key of the join: what groups by opportunity afterwards needs no other shuffle
    same_date = (call_features["ref_date"] <= c["_ref_date"]) & (call_features["ref_date"] >= c["_ref_date"])
    same_opp = (call_features["account_id"] == c["_account_id"]) & (call_features["opp_id"] == c["_opp_id"])
    return call_features.join(c, same_opp & same_date, "left").drop(*[f"_{k}" for k in KEY])


PER_CALL_FEATURES = ("n_rows", "n_calls_global", "avg_duration", "days_since_last", "n_experts", "agent_experience_days")


def per_call(window: DataFrame, features: DataFrame, columns=PER_CALL_FEATURES) -> DataFrame:
    """The features of each KEY beside every call row of it, with the call's own punctuality (one row per call and label).

    KEYs without features (no named agent) are left out, as in the feature table. A KEY with very many calls is
    split: both sides of the join come straight from a shuffle.
    """
    f = features.select(*KEY, *columns).withColumns({"account_id": F.expr("account_id ^ 0"), "opp_id": F.expr("opp_id ^ 0")})
    rows = window.select(*KEY, "label_opp_id", "call_id", "start_time", *PUNCTUALITY_COLUMNS)
    return rows.join(f, list(KEY))


SCORE_IMPUTED = tuple(f for f in MODEL_FEATURES if f != "mandate_delta_days")


def impute_trace(matrix: DataFrame, cfg: Config) -> DataFrame:
    """Scoring matrix: one row per (account, opportunity), model features median-filled.

    ``missing_values`` lists, in feature order, each column that was filled
    (" / name" per column). Rows without a mandate delta stay out.
    """
    # keep-first per (account, opp): latest reference date, then smallest KEY order (total order)
    # fixed-width picks keep the aggregation hash-based; a null at the latest date stays a null
    doubles = matrix.select("account_id", "opp_id", "ref_date", *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES])
    m = doubles.groupBy("account_id", "opp_id").agg(*[F.max_by(c, "ref_date").alias(c) for c in MODEL_FEATURES])
    m = materialize(m)  # read by the three median passes and the fill
    med = fit_medians(m, SCORE_IMPUTED)
    trace = F.concat(*[F.when(F.col(c).isNull(), F.lit(f" / {c}")).otherwise(F.lit("")) for c in SCORE_IMPUTED])
    m = m.withColumn("missing_values", trace)
    m = fill(m, med)
    return m.na.drop(how="any", subset=list(MODEL_FEATURES))

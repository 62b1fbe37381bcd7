"""Model steps: label, class weights, split, random forest with leaf limits, scoring.

The split is deterministic, by opportunity and stratified: all rows of one
opportunity land on the same side, so shifted copies of a label cannot leak
across, and each class gives the same share of its opportunities to the test.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.config import KEY, MODEL_FEATURES, Config
from callpulse.operators.forest import ForestModel, ForestParams, fit_forest
from callpulse.operators.ranking import exact_auc
from callpulse.session import materialize

HASH_SLOTS = 10000

SCORE_COLUMNS = (
    "account_id",
    "opp_id",
    "proba",
    "mandate_delta_days",
    "pct_in_global",
    "days_since_last",
    "agent_experience_days",
    "no_callback_ratio",
    "unanswered_in",
    "missing_values",
    "url",
    "date_pred",
)


def label_is_good(df: DataFrame, cfg: Config) -> DataFrame:
    """``is_good`` = rating above the threshold (unknown rating counts as not good); ambiguous ratings dropped."""
    r = F.col("rating")
    out = df.withColumn("is_good", F.coalesce(r > cfg.good_rating_above, F.lit(False)))
    return out.where(r.isNull() | ~r.isin(*cfg.ambiguous_ratings))


def training_rows(matrix: DataFrame, cfg: Config) -> DataFrame:
    """Labelled rows with every model feature present."""
    rows = label_is_good(matrix, cfg).select(*KEY, *MODEL_FEATURES, "is_good")
    return rows.na.drop(how="any", subset=["account_id", "opp_id", *MODEL_FEATURES])


def class_weights(rows: DataFrame) -> DataFrame:
    """Balanced weights n / (k * n_class), one row per class, of the rows given (the train side)."""
    counts = rows.groupBy("is_good").agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()  # over the k class rows only
    return counts.select(
        "is_good",
        "n_class",
        (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"),
    )


def split_flag(rows: DataFrame, cfg: Config) -> DataFrame:
    """``is_test``, stratified: within each class (an opportunity is good if one of its rows is) the
    opportunities with the lowest hashes, as many as fit ``test_fraction`` of the class.

    The hash has ``HASH_SLOTS`` values, so the running counts are over at most that many rows a class.
    """
    rows = materialize(rows)  # read by the sides and by the flag
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("opp_id").cast("string"), F.lit(str(cfg.seed)))), 1, 8), 16, 10)
    opps = rows.groupBy("opp_id").agg(F.max("is_good").alias("_good")).withColumn("_slot", h.cast("bigint") % HASH_SLOTS)
    slots = opps.groupBy("_good", "_slot").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("_good")
    taken = F.sum("n").over(whole.orderBy("_slot")) <= cfg.test_fraction * F.sum("n").over(whole)
    sides = opps.join(slots.select("_good", "_slot", taken.alias("is_test")), ["_good", "_slot"])
    return rows.join(sides.select("opp_id", "is_test"), "opp_id")


def correlated_features(rows: DataFrame, threshold: float = 0.85, features=MODEL_FEATURES) -> DataFrame:
    """Feature pairs with |Pearson r| above ``threshold`` (upper triangle).

    One distributed pass (``pyspark.ml.stat.Correlation`` on the assembled
    vector); only the k x k matrix (k = number of features) reaches the
    driver. Constant columns give NaN and are never reported. The second
    feature of each pair is the one a correlation filter drops; off by
    default in training.
    """
    import math

    from pyspark.ml.stat import Correlation

    rows = materialize(rows.select(*features))  # the row matrix is read several times
    vec = VectorAssembler(inputCols=list(features), outputCol="_v").transform(rows).select("_v")
    m = Correlation.corr(vec, "_v", "pearson").first()[0].toArray()
    out = [
        (a, b, float(m[i, j]))
        for i, a in enumerate(features)
        for j, b in enumerate(features)
        if j > i and not math.isnan(m[i, j]) and abs(m[i, j]) > threshold
    ]
    return rows.sparkSession.createDataFrame(out, "feature_a string, feature_b string, corr double")


def forest_params(cfg: Config) -> ForestParams:
    return ForestParams(
        num_trees=cfg.num_trees,
        max_depth=cfg.max_depth,
        max_leaf_nodes=cfg.max_leaf_nodes,
        min_samples_leaf=cfg.min_instances_per_node,
        min_samples_split=cfg.min_samples_split,
        max_bins=cfg.max_bins,
        seed=cfg.seed,
    )


def train(matrix: DataFrame, cfg: Config) -> tuple[ForestModel, DataFrame]:
    """Fit on the train side; metrics frame with AUC on hard predictions (as reported) and on probabilities."""
    rows = split_flag(training_rows(matrix, cfg), cfg)
    # read by the weights, the fit and the scoring; few rows, each sent down all trees, so dealt out to all cores
    rows = materialize(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism))
    fitted = rows.where(~F.col("is_test"))
    weights = {r["is_good"]: r["weight"] for r in class_weights(fitted).collect()}  # a row a class
    model = fit_forest(fitted, MODEL_FEATURES, "is_good", forest_params(cfg), (weights.get(False, 0.0), weights.get(True, 0.0)))
    # the forest is applied once, the AUCs read it
    pred = materialize(model.transform(rows).select("is_good", "is_test", "prediction", F.col("p_good").alias("probability")))
    return model, model_metrics(pred)


def model_metrics(pred: DataFrame) -> DataFrame:
    """One row: rows and AUCs of both sides, from is_good, is_test, prediction and probability."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("score")) for k in ("prediction", "probability")]))
    long = pred.select("is_good", "is_test", kinds.alias("s")).select("is_good", "is_test", "s.kind", "s.score")
    auc = exact_auc(long, F.col("is_good"), F.col("score"), {"is_test": F.col("is_test"), "kind": F.col("kind")})
    sides = []
    for side, test in (("train", False), ("test", True)):
        own = lambda kind: (F.col("is_test") == test) & (F.col("kind") == kind)  # noqa: B023, E731
        sides += [
            F.coalesce(F.max(F.when(own("prediction"), F.col("n_pos") + F.col("n_neg"))), F.lit(0)).alias(f"n_{side}"),
            F.max(F.when(own("prediction"), F.col("auc"))).alias(f"auc_{side}_prediction"),
            F.max(F.when(own("probability"), F.col("auc"))).alias(f"auc_{side}_probability"),
        ]
    return auc.agg(*sides)


def scoring_matrix(ctx, cfg: Config) -> DataFrame:
    """Features of open opportunities at the run date, imputed with trace (same loaders as training)."""
    from callpulse.operators import assemble as AS
    from callpulse.operators import cells as CE
    from callpulse.operators import crm as CR
    from callpulse.operators import labels as LA
    from callpulse.operators import warehouse as WH

    lab = LA.labels_score(WH.mandates_open(ctx.opps, cfg), cfg)
    lab = materialize(LA.of_accounts(lab, CE.accounts_of(ctx.cells)))  # read by both sides; accounts without calls have no features
    calls = AS.call_features_all(CE.features_from_cells(ctx.cells, lab, cfg), cfg)
    crm = CR.crm_features(CR.crm_clean(ctx.opps_train, lab, cfg, train=True))
    return AS.impute_trace(AS.features_joined(calls, crm), cfg)


def score_output(model: ForestModel, imputed: DataFrame, cfg: Config) -> DataFrame:
    """The 12-column score table rows for the run date."""
    p = model.transform(imputed)
    out = p.select(
        "account_id",
        "opp_id",
        F.bround("p_good", 3).alias("proba"),
        *[F.col(c).cast("double") for c in SCORE_COLUMNS[3:9]],
        "missing_values",
        F.concat(F.lit(cfg.url_prefix), F.col("opp_id").cast("string")).alias("url"),
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("date_pred"),
    )
    return out.distinct()

"""Named queries over the test tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query exercises one operator family of the library on the whole input
tables (through the adapters). ``callpulse.plans.oracle`` holds the DuckDB
SQL twin of each query that has one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.config import KEY, Config
from callpulse.functions.timefns import floor_days, minutes_between, round_to_day
from callpulse.operators import alerts as AL
from callpulse.operators import assemble as AS
from callpulse.operators import calls as CA
from callpulse.operators import cells as CE
from callpulse.operators import crm as CR
from callpulse.operators import labels as LA
from callpulse.operators import ml as ML
from callpulse.operators import storage as ST
from callpulse.operators import warehouse as WH
from callpulse.operators.ranking import exact_auc
from callpulse.session import ensure_checkpoint_dir, materialize
from callpulse.sources import adapters as A
from callpulse.sources.tables import SCORE_SCHEMA, Tables, read_reviews_csv, read_reviews_tolerant


class Ctx:
    """Domain tables and intermediate frames of one scale factor, built lazily once."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config | None = None):
        self.spark = spark
        self.t = Tables(spark, sf_dir)
        self.cfg = cfg or Config()

    # domain tables
    @cached_property
    def calls(self):
        return A.calls(self.t)

    @cached_property
    def opps(self):
        return A.opps(self.t)

    @cached_property
    def users(self):
        return A.agents(self.t)

    @cached_property
    def stages(self):
        return A.opp_stages(self.t)

    # warehouse
    def call_base(self, by: str = "agent", missed: bool = True) -> DataFrame:
        t = self.t
        return WH.call_base(
            self.calls, self.opps, self.users, A.absences(t), A.appointments(t), A.tasks(t), self.cfg, by, missed
        )

    @cached_property
    def register(self):
        """The call register of training, written once, for queries that read it more than once."""
        return materialize(self.call_base("agent", missed=False))

    @cached_property
    def cells(self):
        """Day cells of the whole history, written once: training and scoring read the same ones."""
        written = self.__dict__.get("register")
        return materialize(CE.day_cells(self.call_base("agent", missed=False) if written is None else written, self.cfg))

    @cached_property
    def agents(self):
        """First expert call and folded name per agent, from the calls and users alone."""
        u = self.users.select(F.col("email").alias("users_email"), "role_id")
        named = WH.calls_with_opps(self.calls, self.opps).where(F.col("record_type_id") == self.cfg.main_record_type)
        return CA.agent_dimension(named.select("agent", "users_email", "start_time").join(u, "users_email", "left"), self.cfg)

    @cached_property
    def opps_train(self):
        return WH.opps_train(self.opps, self.stages, self.users, self.cfg)

    @cached_property
    def labels_train(self):
        # the three review sources live in one derived table here (one scan); the union of
        # separate source files is exercised by ``review_csv_roundtrip``
        m = WH.mandates_train(A.mandate_events(self.t), A.bank_requests(self.t))
        return LA.labels_train(m, A.reviews(self.t), self.cfg)

    @cached_property
    def labels_shifted(self):
        return LA.shift_labels(self.labels_train, self.cfg)

    @cached_property
    def labels(self):
        """The shifted labels, written once: the call side, the CRM side and the call window read them."""
        return materialize(self.labels_shifted)

    @cached_property
    def call_window(self):
        return CA.call_window(self.call_base("agent"), self.labels, self.cfg, checkpoint=False, agents=self.agents)

    @cached_property
    def call_raw(self):
        # the call side reads the labels once: they are written only where another side reads them too
        return CE.features_from_cells(self.cells, self.__dict__.get("labels", self.labels_shifted), self.cfg)

    @cached_property
    def call_features(self):
        return AS.call_features_all(self.call_raw, self.cfg)

    @cached_property
    def crm_clean(self):
        return CR.crm_clean(self.opps_train, self.labels_shifted, self.cfg, train=True)

    @cached_property
    def crm_features(self):
        return CR.crm_features(self.crm_clean)

    @cached_property
    def matrix(self):
        # the call side keeps its KEYs in the join, so the CRM side is derived for its accounts only
        labels = materialize(LA.of_accounts(self.labels, CE.accounts_of(self.call_raw)))
        crm = CR.crm_clean(self.opps_train, labels, self.cfg, train=True)
        return AS.features_joined(self.call_features, CR.crm_features(crm))


def _raw_view(cols: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return AS.as_double(Ctx(spark, sf_dir).call_raw.select(*KEY, *cols))

    return q


RAW_VIEWS: dict[str, tuple[str, ...]] = {
    "call_mix_global": ("n_calls_global", "in_global", "out_global", "pct_in_global", "pct_out_global"),
    "call_mix_by_role": tuple(
        f"{p}_{c}" for c in ("expert", "bizdev", "customer_care") for p in ("n_calls", "in", "out", "pct_in", "pct_out")
    ),
    "call_duration_stats": (
        "avg_duration",
        "avg_duration_alt",
        "duration_in",
        "total_duration",
        "in_time_share",
        "total_time",
        "n_calls_gt_600",
        "n_calls_ge_180",
    ),
    "unanswered_calls": ("unanswered_in", "unanswered_out", "pct_missed_in", "pct_missed_out"),
    "voicemails": ("n_voicemails",),
    "call_span_wait": ("mean_wait_days", "days_since_last", "days_since_first"),
    "first_last_call": ("first_call", "last_call", "max_start", "max_mandate"),
    "multi_call_days": ("multi_call_days_global", "multi_call_days_7d", "multi_call_days_14d"),
    "agent_experience": ("agent_experience_days",),
    "long_gaps": ("n_gaps_14d",),
    "distinct_experts": ("n_experts",),
    "distinct_interlocutors": ("n_interlocutors",),
    "last_call_out": ("last_call_out",),
    "absent_at_last_call": ("agent_absent", "no_show", "on_time", "late_lt5", "late_lt15", "late_ge_15"),
    "missed_pivot": (
        "no_callback_count",
        "same_day_callback_count",
        "total_missed",
        "n_missed_rows",
        "n_no_callback_rows",
        "missed_ratio",
        "no_callback_ratio",
    ),
}


def q_day_round(spark, sf_dir):
    r = A.reviews(Tables(spark, sf_dir))
    return r.select("review_id", "review_ts", round_to_day("review_ts").alias("ref_day"))


def q_floor_days(spark, sf_dir):
    o = A.opps(Tables(spark, sf_dir))
    return o.select(
        "opp_id",
        floor_days("mandate_signed_at", "created_at").alias("days_to_mandate"),
        floor_days("compromise_at", "created_at").alias("days_to_compromise"),
        floor_days("suspensive_at", "mandate_signed_at").alias("days_mandate_to_suspensive"),
        minutes_between("created_at", "mandate_signed_at").alias("minutes_to_mandate"),
    )


WINDOW_COLUMNS = (
    *KEY,
    "label_opp_id",
    "call_id",
    "start_time",
    "direction",
    "duration_s",
    "agent",
    "agent_norm",
    "role",
    "missed_status",
    "absence_flag",
    "first_expert_call",
    "mandate_delta_days",
)


def q_call_window_join(spark, sf_dir):
    return Ctx(spark, sf_dir).call_window.select(*WINDOW_COLUMNS)


def q_missed_status(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return WH.missed_status(WH.calls_with_opps(c.calls, c.opps), c.cfg)


def q_scheduled_slots(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return WH.scheduled_slots(A.appointments(c.t), c.users, c.cfg, "agent")


def q_realised_calls(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return WH.realised_calls(A.tasks(c.t), c.opps, c.users, c.cfg, "agent")


def _punct(by):
    def q(spark, sf_dir):
        c = Ctx(spark, sf_dir)
        s = WH.scheduled_slots(A.appointments(c.t), c.users, c.cfg, by)
        r = WH.realised_calls(A.tasks(c.t), c.opps, c.users, c.cfg, by)
        return WH.punctuality(s, r, by)

    return q


def _call_base(by):
    def q(spark, sf_dir):
        return Ctx(spark, sf_dir).call_base(by)

    return q


def q_opps_train(spark, sf_dir):
    return Ctx(spark, sf_dir).opps_train


def q_opps_open(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return WH.opps_open(c.opps, c.stages, c.users, A.reassignments(c.t), c.cfg)


def q_mandates_train(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return WH.mandates_train(A.mandate_events(t), A.bank_requests(t))


def q_mandates_open(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return WH.mandates_open(c.opps, c.cfg)


def q_labels_train(spark, sf_dir):
    return Ctx(spark, sf_dir).labels_train


def q_labels_shifted(spark, sf_dir):
    return Ctx(spark, sf_dir).labels_shifted


def q_labels_score(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return LA.labels_score(WH.mandates_open(c.opps, c.cfg), c.cfg)


CRM_CLEAN_COLUMNS = (
    "opp_id",
    "account_id",
    "ref_date",
    "created_at",
    "compromise_at",
    "suspensive_at",
    "lost_at",
    "sent_at",
    "mandate_signed_at",
)


def q_crm_clean(spark, sf_dir):
    return Ctx(spark, sf_dir).crm_clean.select(*CRM_CLEAN_COLUMNS)


def q_crm_clean_score(spark, sf_dir):
    """The scoring variant: early lost dates stay."""
    c = Ctx(spark, sf_dir)
    return CR.crm_clean(c.opps_train, c.labels_shifted, c.cfg, train=False).select(*CRM_CLEAN_COLUMNS)


def q_stage_deltas(spark, sf_dir):
    f = Ctx(spark, sf_dir).crm_features
    return f.select(
        *KEY,
        "days_r1_to_assembly",
        "days_assembly_to_sent",
        "days_suspensive_to_ref",
        "days_created_to_sent",
        "days_created_to_mandate",
        "days_mandate_to_ref",
        "days_sent_to_ref",
    )


def q_last_stage(spark, sf_dir):
    f = Ctx(spark, sf_dir).crm_features
    return f.select(*KEY, "last_stage_at", "last_stage", "days_last_stage_to_ref")


def q_crm_features(spark, sf_dir):
    f = Ctx(spark, sf_dir).crm_features
    return f.select(*KEY, "rating", "mandate_delta_days", *AS.CRM_FEATURE_COLUMNS)


def q_call_features_raw(spark, sf_dir):
    from callpulse.operators.assemble import CALL_FEATURE_COLUMNS

    return AS.as_double(Ctx(spark, sf_dir).call_raw.select(*CALL_FEATURE_COLUMNS))


def q_weighted_medians(spark, sf_dir):
    return AS.weighted_medians(Ctx(spark, sf_dir).call_raw)


def q_call_features_all(spark, sf_dir):
    return Ctx(spark, sf_dir).call_features


def q_features_joined(spark, sf_dir):
    return Ctx(spark, sf_dir).matrix


def q_label_is_good(spark, sf_dir):
    m = Ctx(spark, sf_dir).matrix
    return ML.label_is_good(m, Config()).select(*KEY, "rating", "is_good")


def q_class_weights(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    rows = ML.training_rows(c.matrix, c.cfg).select("opp_id", "is_good")
    return ML.class_weights(ML.split_flag(rows, c.cfg).where("not is_test"))


def q_stratified_split(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    rows = ML.training_rows(c.matrix, c.cfg).select(*KEY, "is_good")
    return ML.split_flag(rows, c.cfg).select(*KEY, "is_good", "is_test")


def q_correlated_features(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return ML.correlated_features(ML.training_rows(c.matrix, c.cfg))


def q_review_csv_roundtrip(spark, sf_dir):
    """Reviews exported per source as CSV to shared storage, read back with the declared schema, then labelled."""
    c = Ctx(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/review_export_{uuid.uuid4().hex}"
    r = A.reviews(c.t)
    frames = []
    for s in A.REVIEW_SOURCES:
        path = f"{root}/{s}"
        part = r.where(F.col("source") == s).select("opp_id", "account_id", "review_ts", "rating", "review_id")
        if s == "nps":  # the survey export carries one extra column, dropped on read
            part = part.withColumn("journey_step", F.lit("after_mandate"))
        part.write.mode("overwrite").option("header", True).csv(path)
        schema_extra = ("journey_step",) if s == "nps" else ()
        df = read_reviews_csv(spark, path, extra=schema_extra)
        frames.append(df.withColumn("source", F.lit(s)))
    m = WH.mandates_train(A.mandate_events(c.t), A.bank_requests(c.t))
    return LA.labels_train(m, LA.union_reviews(*frames), c.cfg)


def q_impute_trace(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return AS.impute_trace(c.matrix, c.cfg)


def q_latest_scores(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return AL.latest_scores(A.scores(c.t), c.opps, c.cfg)


def q_alerts_ranked(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return AL.alerts_ranked(A.scores(c.t), c.opps, c.cfg)


def q_alert_history_merge(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return AL.merge_history(A.alert_history(c.t), A.previous_alerts(c.t))


def q_alerts_new(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    latest = AL.alerts_ranked(A.scores(c.t), c.opps, c.cfg)
    hist = AL.merge_history(A.alert_history(c.t), A.previous_alerts(c.t))
    return AL.new_alerts(latest, hist, c.cfg)


def q_name_fold(spark, sf_dir):
    from callpulse.functions.text import fold_text

    t = A.name_texts(Tables(spark, sf_dir))
    return t.select("conv_id", "turn", fold_text(F.col("text")).alias("text_folded"))


def q_train_score(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    cfg = Config()
    model, metrics = ML.train(c.matrix, cfg)
    return metrics


def q_score_output(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    cfg = Config()
    model, _ = ML.train(c.matrix, cfg)
    return ML.score_output(model, ML.scoring_matrix(c, cfg), cfg)


def q_call_window_stored(spark, sf_dir):
    """The call window from calls stored by month, of which the labels' dates prune the partitions."""
    c = Ctx(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/calls_{uuid.uuid4().hex}"
    ST.write_calls(c.calls, path)
    labels = materialize(c.labels_shifted)
    agents = c.agents
    c.calls = ST.read_calls(spark, path, labels, c.cfg)
    return CA.call_window(c.call_base("agent"), labels, c.cfg, checkpoint=False, agents=agents).select(*WINDOW_COLUMNS)


def q_call_window_score(spark, sf_dir):
    """The account-level register (scoring variant) joined to the labels of the open mandates."""
    c = Ctx(spark, sf_dir)
    labels = LA.labels_score(WH.mandates_open(c.opps, c.cfg), c.cfg)
    return CA.call_window(c.call_base("account"), labels, c.cfg, agents=c.agents).select(*WINDOW_COLUMNS, *WH.PUNCTUALITY_COLUMNS)


def q_per_call(spark, sf_dir):
    """One row per call of a KEY: the call's own punctuality beside the features of its KEY."""
    c = Ctx(spark, sf_dir)
    window = CA.call_window(c.register, c.labels, c.cfg, checkpoint=False)  # the cells read the written register too
    return AS.per_call(window, c.call_raw)


def q_scoring_matrix(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return ML.scoring_matrix(c, c.cfg)


def q_score_auc(spark, sf_dir):
    """Exact AUC of stored scores against the labels of their opportunities, per day, on scores and on hard predictions."""
    c = Ctx(spark, sf_dir)
    good = ML.label_is_good(c.labels_train, c.cfg).select("opp_id", "is_good")
    s = A.scores(c.t).where(F.col("opp_id").isNotNull()).join(good, "opp_id")
    hard = F.when(F.col("proba") > 0.5, 1.0).otherwise(0.0)
    kinds = F.array(F.struct(F.lit("probability").alias("kind"), F.col("proba").alias("score")), F.struct(F.lit("prediction").alias("kind"), hard.alias("score")))
    s = s.select("date_pred", "is_good", F.explode(kinds).alias("k"))
    return exact_auc(s, F.col("is_good"), F.col("k.score"), {"date_pred": F.col("date_pred"), "kind": F.col("k.kind")})


def q_score_auc_total(spark, sf_dir):
    """The same over all days: one running rank over the whole table."""
    c = Ctx(spark, sf_dir)
    good = ML.label_is_good(c.labels_train, c.cfg).select("opp_id", "is_good")
    s = A.scores(c.t).where(F.col("opp_id").isNotNull()).join(good, "opp_id")
    return exact_auc(s, F.col("is_good"), F.col("proba"))


def q_sink_roundtrip(spark, sf_dir):
    """The score table written in two runs, one of them a retry after half of its rows, and read back."""
    s = A.scores(Tables(spark, sf_dir))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scores_{uuid.uuid4().hex}"
    missing = [f.name for f in SCORE_SCHEMA.fields if f.name not in s.columns]
    s = materialize(s.withColumns({c: F.lit(None) for c in missing}))
    odd = F.dayofmonth("date_pred") % 2 == 1
    ST.append_scores(s.where(odd & (F.col("proba") < 0.5)), path, run="odd-days")
    ST.append_scores(s.where(~odd), path, run="even-days")
    ST.append_scores(s.where(odd), path, run="odd-days")
    return ST.read_scores(spark, path).select("account_id", "opp_id", "proba", "url", "date_pred")


def q_latest_scores_stored(spark, sf_dir):
    """Latest scores from the stored table, of which only the partitions of the last days are read."""
    c = Ctx(spark, sf_dir)
    s = A.scores(c.t)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scores_{uuid.uuid4().hex}"
    missing = [f.name for f in SCORE_SCHEMA.fields if f.name not in s.columns]
    ST.append_scores(s.withColumns({m: F.lit(None) for m in missing}), path)
    since = c.cfg.as_of - dt.timedelta(days=c.cfg.alert_max_age_days)
    return AL.latest_scores(ST.read_scores(spark, path, since), c.opps, c.cfg)


def q_review_dates_parsed(spark, sf_dir):
    """Reviews exported with dates as text, some zoned, some bad, and some malformed rows; read back tolerantly.

    One row per review that could be read, its date in UTC or null; malformed rows as their number, review_id -1.
    """
    r = A.reviews(Tables(spark, sf_dir))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/review_text_{uuid.uuid4().hex}"
    k = F.col("review_id")
    wall = F.date_format("review_ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(k % 11 == 0, F.lit("not a date"))
        .when(k % 13 == 0, F.lit("2023-02-30 10:00:00"))
        .when(k % 5 == 0, F.concat(F.date_format(F.col("review_ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(k % 3 == 0, F.concat(wall, F.lit("Z")))
        .otherwise(wall)
    )
    rating = F.when(k % 17 == 0, F.lit("four")).otherwise(F.col("rating").cast("string"))
    r.select("opp_id", "account_id", text.alias("review_ts"), rating.alias("rating"), "review_id").write.option("header", True).csv(path)
    good, bad = read_reviews_tolerant(spark, path)
    n = bad.agg(F.count("bad_row").alias("n"))
    return good.select("review_id", "review_ts", F.lit(1).cast("bigint").alias("n")).unionByName(
        n.select(F.lit(-1).cast("bigint").alias("review_id"), F.lit(None).cast("timestamp_ntz").alias("review_ts"), "n")
    )


def q_feature_correlations(spark, sf_dir):
    """Correlated pairs of call features over all KEYs (no KEY is left out, so there are rows at every scale)."""
    c = Ctx(spark, sf_dir)
    return ML.correlated_features(AS.as_double(c.call_raw).select(*CORRELATED), features=CORRELATED)


#: call features without nulls
CORRELATED = (
    "n_calls_global", "in_global", "out_global", "pct_in_global", "n_calls_expert", "n_calls_bizdev", "avg_duration",
    "unanswered_in", "unanswered_out", "pct_missed_in", "total_duration", "n_missed_rows", "last_call_out", "total_time",
)


def q_cells_two_days(spark, sf_dir):
    """Features from kept cells: the history up to a cut is written first, later calls add theirs and the kept agent state is merged."""
    c = Ctx(spark, sf_dir)
    cut = F.lit(CELLS_CUT).cast("timestamp_ntz")
    register = materialize(c.call_base("agent", missed=False))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cells_{uuid.uuid4().hex}"
    old = materialize(CE.day_cells(register.where(F.col("start_time") < cut), c.cfg))
    new = materialize(CE.day_cells(register.where(F.col("start_time") >= cut), c.cfg))
    CE.write_cells(old, path)
    CE.write_cells(new, path)
    agents = CE.merge_agents(CE.agent_state(old), CE.agent_state(new))
    labels = c.labels_shifted
    raw = CE.features_from_cells(CE.read_cells(spark, path, labels, c.cfg), labels, c.cfg, agents)
    return AS.as_double(raw.select(*AS.CALL_FEATURE_COLUMNS))


def q_call_features_zero(spark, sf_dir):
    """Features with 0 instead of a median where a KEY has no such calls."""
    c = Ctx(spark, sf_dir)
    return AS.call_features_all(c.call_raw, c.cfg, impute="zero")


def q_call_features_distinct(spark, sf_dir):
    """Raw features with each call counted once per reference date, however many labels the account has there."""
    c = Ctx(spark, sf_dir)
    raw = CE.features_from_cells(c.cells, c.labels_shifted, c.cfg, distinct_ref_dates=True)
    return AS.as_double(raw.select(*AS.CALL_FEATURE_COLUMNS))


#: a midnight in the middle of the test calls
CELLS_CUT = "2024-01-16 00:00:00"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "day_round": q_day_round,
    "floor_days": q_floor_days,
    "call_window_join": q_call_window_join,
    **{name: _raw_view(cols) for name, cols in RAW_VIEWS.items()},
    "missed_status": q_missed_status,
    "scheduled_slots": q_scheduled_slots,
    "realised_calls": q_realised_calls,
    "punctuality_by_agent": _punct("agent"),
    "punctuality_by_account": _punct("account"),
    "call_base_train": _call_base("agent"),
    "call_base_score": _call_base("account"),
    "opps_train": q_opps_train,
    "opps_open": q_opps_open,
    "mandates_train": q_mandates_train,
    "mandates_open": q_mandates_open,
    "labels_train": q_labels_train,
    "labels_shifted": q_labels_shifted,
    "labels_score": q_labels_score,
    "crm_clean": q_crm_clean,
    "crm_clean_score": q_crm_clean_score,
    "stage_deltas": q_stage_deltas,
    "last_stage": q_last_stage,
    "crm_features": q_crm_features,
    "call_features_raw": q_call_features_raw,
    "weighted_medians": q_weighted_medians,
    "call_features_all": q_call_features_all,
    "features_joined": q_features_joined,
    "impute_trace": q_impute_trace,
    "label_is_good": q_label_is_good,
    "correlated_features": q_correlated_features,
    "review_csv_roundtrip": q_review_csv_roundtrip,
    "class_weights": q_class_weights,
    "stratified_split": q_stratified_split,
    "latest_scores": q_latest_scores,
    "alerts_ranked": q_alerts_ranked,
    "alert_history_merge": q_alert_history_merge,
    "alerts_new": q_alerts_new,
    "name_fold": q_name_fold,
    "train_score": q_train_score,
    "score_output": q_score_output,
    "call_window_stored": q_call_window_stored,
    "call_window_score": q_call_window_score,
    "per_call": q_per_call,
    "scoring_matrix": q_scoring_matrix,
    "score_auc": q_score_auc,
    "score_auc_total": q_score_auc_total,
    "sink_roundtrip": q_sink_roundtrip,
    "latest_scores_stored": q_latest_scores_stored,
    "review_dates_parsed": q_review_dates_parsed,
    "feature_correlations": q_feature_correlations,
    "cells_two_days": q_cells_two_days,
    "call_features_zero": q_call_features_zero,
    "call_features_distinct": q_call_features_distinct,
}

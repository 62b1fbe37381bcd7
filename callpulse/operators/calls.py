"""Call features per KEY = (account_id, opp_id, ref_date).

Two ways lead to the same features:

* ``callpulse.operators.cells`` aggregates calls once into day cells that know no
  label, and joins the cells to the labels. The jobs and queries use it.
* ``call_features_raw`` below starts from calls already joined to labels
  (``call_window``); it works for any reference times and any hand-made rows.

``call_window`` joins calls to the labels of their account with the 60-day look-back: an equi-join on the
account and on the period of ``window_days`` that the call falls in; a label is in the
two periods that its window touches, so a hot account's calls meet only labels near in time.

Null semantics follow the feature definitions: filtered counts are null
when the KEY has no matching call (later median-filled), call-mix counts
are 0, an all-null duration sum is 0 when the KEY has such calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.config import KEY, MISSED_NO_CALLBACK, MISSED_SAME_DAY, Config
from callpulse.functions.exprs import cap, nullif_zero, pct, ratio
from callpulse.functions.text import fold_text
from callpulse.functions.timefns import add_days, floor_days
from callpulse.operators.warehouse import ABSENT, PUNCTUALITY_COLUMNS
from callpulse.session import materialize

ROLE_EXPERT = "expert"
ROLE_BIZDEV = "bizdev"
ROLE_OTHER = "other"


def agent_dimension(call_base: DataFrame, cfg: Config) -> DataFrame:
    """One row per distinct agent name: first call made under an expert role (whole history,
    null if none) and the folded name. The fold runs on distinct names only."""
    expert = F.col("role_id").isin(*cfg.expert_roles)
    d = call_base.where(F.col("agent").isNotNull()).groupBy("agent").agg(
        F.min(F.when(expert, F.col("start_time"))).alias("first_expert_call")
    )
    return d.withColumn("agent_norm", fold_text(F.col("agent")))


def period(ts, days: int):
    """Number of the ``days``-long period since 1970 that a time falls in."""
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.floor(us / F.lit(days * 86_400_000_000)).cast("int")


def touched_periods(labels: DataFrame, cfg: Config) -> DataFrame:
    """Labels once per period (``_per``) that their window touches: one or two."""
    span = cfg.window_days
    ends = F.array_distinct(F.array(period(add_days("ref_date", -span), span), period(F.col("ref_date"), span)))
    return labels.withColumn("_per", F.explode(ends))


def join_windows(rows: DataFrame, labels: DataFrame, at: str, cfg: Config) -> DataFrame:
    """Rows x labels of the same account with ``ref_date - window < at < ref_date``.

    Each pair meets in one period only, that of the row.
    """
    span = cfg.window_days
    lab = touched_periods(labels, cfg).withColumnRenamed("account_id", "_acc")
    r = rows.withColumn("_row_per", period(F.col(at), span))
    cond = (
        (r["account_id"] == lab["_acc"])
        & (r["_row_per"] == lab["_per"])
        & (r[at] < lab["ref_date"])
        & (r[at] > add_days(lab["ref_date"], -span))
    )
    return r.join(lab, cond).drop("_acc", "_per", "_row_per")


def label_span(labels: DataFrame, cfg: Config):
    """(lo, hi): no row at or outside these times is in a window; one scalar subquery, used for both bounds."""
    return labels.select(
        F.struct(add_days(F.min("ref_date"), -cfg.window_days).alias("lo"), F.max("ref_date").alias("hi"))
    ).scalar()


def call_window(call_base: DataFrame, labels: DataFrame, cfg: Config, checkpoint: bool = True, agents: DataFrame | None = None) -> DataFrame:
    """Calls x labels of the same account with ``ref_date - window < start_time < ref_date``.

    Any opportunity of the account matches (many-to-many); the KEY keeps the
    call's own opportunity. The date bound of the labels reaches the scan of the calls, before the register's
    joins. ``agents``: the per-agent dimension, by default that of ``call_base`` over its whole history.
    """
    if checkpoint:
        labels = materialize(labels)  # read by the date bounds and by the join
    agents = agent_dimension(call_base, cfg) if agents is None else agents
    span = label_span(labels, cfg)
    c = call_base.where((F.col("start_time") > span.getField("lo")) & (F.col("start_time") < span.getField("hi")))
    c = c.withColumn("duration_s", cap("duration_s", cfg.duration_cap_s))
    # AQE turns this into a broadcast join when the measured dimension is small
    c = c.join(agents, "agent", "left")
    role = (
        F.when(F.col("role_id").isin(*cfg.expert_roles), F.lit(ROLE_EXPERT))
        .when(F.col("role_id") == cfg.bizdev_role, F.lit(ROLE_BIZDEV))
        .otherwise(F.lit(ROLE_OTHER))
    )
    c = c.withColumn("role", role)
    lab = labels.select(
        "account_id",
        F.col("opp_id").alias("label_opp_id"),
        "ref_date",
        "rating",
        "mandate_date",
        "mandate_delta_days",
    )
    return join_windows(c, lab, "start_time", cfg)


# Total order of calls inside a KEY, (start time, call id), as one decimal: microseconds since
# 1970 shifted by 20 digits, more than any call id has. Decimals keep the aggregation hash-based.
_ORDER_EPOCH = "1970-01-01 00:00:00"
_ORDER_SHIFT = "1" + "0" * 20


def call_order():
    us = F.timestamp_diff("MICROSECOND", F.lit(_ORDER_EPOCH).cast("timestamp_ntz"), F.col("start_time"))
    high = us.cast("decimal(17,0)") * F.lit(_ORDER_SHIFT).cast("decimal(21,0)")
    return (high + F.col("call_id").cast("decimal(20,0)")).cast("decimal(38,0)")


def _last(name: str, value, cond, order):
    """(max ordering, value at it) over rows meeting ``cond``; both fixed-width."""
    o = F.when(cond, order)
    return [F.max(o).alias(f"{name}_ord"), F.max_by(value, o).alias(f"last_{name}")]


def _is_in():
    return F.col("direction") == "in"


def _is_out():
    return F.col("direction") == "out"


def call_cells(cw: DataFrame, cfg: Config) -> DataFrame:
    """All partial measures at the (KEY, day, agent, agent_norm) grain (map-side combined)."""
    d = F.col("duration_s")
    real = d > cfg.real_call_s
    lo7, lo14 = (add_days("ref_date", -w) for w in cfg.recent_windows)
    expert = F.col("role_id").isin(*cfg.expert_roles)
    bizdev = F.col("role_id") == cfg.bizdev_role
    care = bizdev & (F.col("manager_name") == cfg.customer_care_manager)
    kept_mgr = ~F.coalesce(F.col("manager_name").isin(*cfg.excluded_managers), F.lit(False))
    order = call_order()

    def n(cond):
        return F.count_if(F.coalesce(cond, F.lit(False)))

    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("start_time").alias("n_start"),
        n(_is_in()).alias("n_in"),
        n(_is_out()).alias("n_out"),
    ]
    for name, cat in (("expert", expert), ("bizdev", bizdev), ("customer_care", care)):
        aggs += [
            n(cat & F.col("start_time").isNotNull()).alias(f"n_{name}"),
            n(cat & _is_in()).alias(f"in_{name}"),
            n(cat & _is_out()).alias(f"out_{name}"),
        ]
    aggs += [
        n(real).alias("n_real"),
        n(real & (F.col("start_time") > lo7)).alias("n_real_7"),
        n(real & (F.col("start_time") > lo14)).alias("n_real_14"),
        n(real & kept_mgr).alias("n_real_kept"),
        F.min(F.when(real, F.col("start_time"))).alias("first_real"),
        F.max(F.when(real, F.col("start_time"))).alias("last_real"),
        F.min(F.when(real & _is_out(), F.col("start_time"))).alias("first_real_out"),
        F.max(F.when(real & _is_out(), F.col("start_time"))).alias("last_real_out"),
        F.sum(d).alias("sum_dur"),
        F.count(d).alias("n_dur"),
        F.sum(F.when(_is_in(), d)).alias("sum_dur_in"),
        n(_is_in() & d.isNull() & expert).alias("n_unanswered_in"),
        n(_is_out() & d.isNull()).alias("n_unanswered_out"),
        n(d > cfg.long_call_s).alias("n_gt_600"),
        n(d >= cfg.medium_call_s).alias("n_ge_180"),
        n((d >= cfg.voicemail_min_s) & (d < cfg.voicemail_max_s) & _is_out()).alias("n_voicemail"),
        F.count("missed_status").alias("n_missed_rows"),
        n(F.col("missed_status") == MISSED_NO_CALLBACK).alias("n_no_callback"),
        n(F.col("missed_status") == MISSED_SAME_DAY).alias("n_same_day"),
        # "value at the last call" picks: fixed-width max_by keeps the aggregation hash-based
        *_last("dir", F.when(_is_in(), F.lit(0)).otherwise(F.lit(1)), F.col("direction").isNotNull(), order),
        *_last("abs", F.when(F.col("absence_flag") == ABSENT, F.lit(1)).otherwise(F.lit(0)), F.col("absence_flag").isNotNull(), order),
        F.max(F.when(F.col("no_show").isNotNull(), order)).alias("pun_ord"),
        *[F.max_by(c, F.when(F.col("no_show").isNotNull(), order)).alias(f"last_{c}") for c in PUNCTUALITY_COLUMNS],
        F.min("start_time").alias("min_start"),
        F.min("first_expert_call").alias("first_expert_call"),
        F.max("start_time").alias("max_start"),
        F.max("mandate_date").alias("max_mandate"),
    ]
    return cw.groupBy(*KEY, F.to_date("start_time").alias("day"), "agent", "agent_norm").agg(*aggs)


def _flat(cells: DataFrame, cfg: Config) -> DataFrame:
    s = lambda c: F.sum(c)
    aggs = [
        s("n_rows").alias("n_rows"),
        s("n_start").alias("n_calls_global"),
        s("n_in").alias("in_global"),
        s("n_out").alias("out_global"),
    ]
    for name in ("expert", "bizdev", "customer_care"):
        aggs += [s(f"n_{name}").alias(f"n_calls_{name}"), s(f"in_{name}").alias(f"in_{name}"), s(f"out_{name}").alias(f"out_{name}")]
    aggs += [
        s("n_real_kept").alias("n_real_kept"),
        F.min("first_real").alias("first_call"),
        F.max("last_real").alias("last_call"),
        s("sum_dur").alias("sum_dur"),
        s("n_dur").alias("n_dur"),
        s("sum_dur_in").alias("sum_dur_in"),
        s("n_unanswered_in").alias("unanswered_in"),
        s("n_unanswered_out").alias("unanswered_out"),
        s("n_gt_600").alias("n_gt_600"),
        s("n_ge_180").alias("n_ge_180"),
        s("n_voicemail").alias("n_voicemail"),
        s("n_missed_rows").alias("n_missed_rows"),
        s("n_no_callback").alias("n_no_callback"),
        s("n_same_day").alias("n_same_day"),
        F.max_by("last_dir", "dir_ord").alias("last_dir"),
        F.max_by("last_abs", "abs_ord").alias("last_abs"),
        *[F.max_by(f"last_{c}", "pun_ord").alias(f"last_{c}") for c in PUNCTUALITY_COLUMNS],
        F.max("max_start").alias("max_start"),
        F.max("max_mandate").alias("max_mandate"),
    ]
    return flat_columns(cells.groupBy(*KEY).agg(*aggs))


def flat_columns(g: DataFrame, more: dict | None = None) -> DataFrame:
    """Ratios, null rules and names of the flat features, from the sums and picks per KEY; ``more``: further columns of g."""
    cols = [
        *KEY,
        "n_rows",
        "n_calls_global",
        "in_global",
        "out_global",
        pct("in_global", F.col("in_global") + F.col("out_global")).alias("pct_in_global"),
        pct("out_global", F.col("in_global") + F.col("out_global")).alias("pct_out_global"),
    ]
    for name in ("expert", "bizdev", "customer_care"):
        tot = F.col(f"in_{name}") + F.col(f"out_{name}")
        cols += [
            f"n_calls_{name}",
            f"in_{name}",
            f"out_{name}",
            pct(f"in_{name}", tot).alias(f"pct_in_{name}"),
            pct(f"out_{name}", tot).alias(f"pct_out_{name}"),
        ]
    avg = ratio("sum_dur", F.when(F.col("n_dur") > 0, F.col("n_dur")))
    duration_in = F.when(F.col("in_global") > 0, F.coalesce(F.col("sum_dur_in"), F.lit(0.0)))
    total = F.coalesce(F.col("sum_dur"), F.lit(0.0))
    cols += [
        "n_real_kept",
        "first_call",
        "last_call",
        ratio(floor_days("last_call", "first_call"), "n_calls_global").alias("mean_wait_days"),
        F.coalesce(avg, F.lit(0.0)).alias("avg_duration"),
        avg.alias("avg_duration_alt"),
        "unanswered_in",
        "unanswered_out",
        F.coalesce(ratio("unanswered_in", "in_global"), F.lit(0.0)).alias("pct_missed_in"),
        F.coalesce(ratio("unanswered_out", "out_global"), F.lit(0.0)).alias("pct_missed_out"),
        duration_in.alias("duration_in"),
        total.alias("total_duration"),
        ratio(duration_in, total).alias("in_time_share"),
        nullif_zero("n_gt_600").alias("n_calls_gt_600"),
        nullif_zero("n_ge_180").alias("n_calls_ge_180"),
        nullif_zero("n_voicemail").alias("n_voicemails"),
        "n_missed_rows",
        nullif_zero("n_no_callback").alias("n_no_callback_rows"),
        "n_no_callback",
        "n_same_day",
        ratio("n_missed_rows", "n_calls_global").alias("missed_ratio"),
        ratio(nullif_zero("n_no_callback"), "n_calls_global").alias("no_callback_ratio"),
        F.coalesce(F.col("last_dir"), F.lit(1)).alias("last_call_out"),
        F.coalesce(F.col("last_abs"), F.lit(0)).alias("agent_absent"),
        *[F.col(f"last_{c}").alias(c) for c in PUNCTUALITY_COLUMNS],
        "max_start",
        "max_mandate",
        (F.col("n_calls_global") * F.coalesce(avg, F.lit(0.0))).alias("total_time"),
        floor_days("ref_date", "last_call").alias("days_since_last"),
        floor_days("ref_date", "first_call").alias("days_since_first"),
        *[c.alias(name) for name, c in (more or {}).items()],
    ]
    return g.select(*cols)


def _daily(cells: DataFrame, cfg: Config) -> DataFrame:
    """Multi-call days and long outbound gaps from the per-day roll-up (<= window_days rows per KEY)."""
    d = cells.groupBy(*KEY, "day").agg(
        F.sum("n_real").alias("n_real"),
        F.sum("n_real_7").alias("n_real_7"),
        F.sum("n_real_14").alias("n_real_14"),
        F.min("first_real_out").alias("first_out"),
        F.max("last_real_out").alias("last_out"),
    )
    # previous outbound call = last outbound call of the nearest earlier day that has one
    w = Window.partitionBy(*KEY).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_prev_out", F.last(F.col("last_out"), ignorenulls=True).over(w))
    gap = F.coalesce(floor_days("first_out", "_prev_out") > cfg.gap_days, F.lit(False))
    g = d.groupBy(*KEY).agg(
        F.count_if(F.col("n_real") > 1).alias("mc_global"),
        F.count_if(F.col("n_real_7") > 1).alias("mc_7"),
        F.count_if(F.col("n_real_14") > 1).alias("mc_14"),
        F.count_if(gap).alias("gaps"),
    )
    has = F.col("mc_global") > 0
    return g.select(
        *KEY,
        F.when(has, F.col("mc_global")).alias("multi_call_days_global"),
        F.when(has, F.col("mc_7")).alias("multi_call_days_7d"),
        F.when(has, F.col("mc_14")).alias("multi_call_days_14d"),
        nullif_zero("gaps").alias("n_gaps_14d"),
    )


def _experience(cells: DataFrame) -> DataFrame:
    """Median over the KEY's agents of days between the agent's first expert call and first call here."""
    a = (
        cells.where(F.col("agent").isNotNull())
        .groupBy(*KEY, "agent")
        .agg(F.min("min_start").alias("s"), F.min("first_expert_call").alias("f"))
    )
    days = floor_days("s", "f")
    a = a.withColumn("exp", F.when(days < 0, F.lit(0)).otherwise(days).cast("double"))
    return a.groupBy(*KEY).agg(F.median("exp").alias("agent_experience_days"))


def _agents(cells: DataFrame) -> DataFrame:
    """Distinct folded agent names with >2 / >0 real calls (managers excluded)."""
    a = (
        cells.where(F.col("agent_norm").isNotNull())
        .groupBy(*KEY, "agent_norm")
        .agg(F.sum("n_real_kept").alias("n"))
    )
    return a.groupBy(*KEY).agg(
        F.count_if(F.col("n") > 2).alias("n_experts_raw"), F.count_if(F.col("n") > 0).alias("n_interlocutors_raw")
    )


def call_features_raw(cw: DataFrame, cfg: Config, checkpoint: bool = True) -> DataFrame:
    """Per-KEY call features before median imputation (KEYs with at least one named agent)."""
    cells = call_cells(cw, cfg)
    if checkpoint:
        cells = materialize(cells)
    out = (
        missed_counts(_flat(cells, cfg))
        .join(_daily(cells, cfg), list(KEY), "left")
        .join(_experience(cells), list(KEY), "inner")
        .join(_agents(cells), list(KEY), "left")
    )
    out = agent_counts(out)
    # read by the median fit and by the fill: one row per KEY, written once
    return materialize(out) if checkpoint else out


def missed_counts(flat: DataFrame) -> DataFrame:
    """Missed-status cells counted at the (account, opportunity) grain, across reference dates."""
    w = Window.partitionBy("account_id", "opp_id")
    flat = flat.withColumn("no_callback_count", nullif_zero(F.sum("n_no_callback").over(w)).cast("double"))
    flat = flat.withColumn("same_day_callback_count", nullif_zero(F.sum("n_same_day").over(w)).cast("double"))
    return flat.withColumn(
        "total_missed", F.coalesce(F.col("no_callback_count") + F.col("same_day_callback_count"), F.lit(0.0))
    )


def agent_counts(out: DataFrame) -> DataFrame:
    out = out.withColumn("n_experts", F.coalesce(F.col("n_experts_raw"), F.lit(0)))
    out = out.withColumn(
        "n_interlocutors",
        F.when(F.col("n_real_kept") > 0, F.coalesce(F.col("n_interlocutors_raw"), F.lit(0))),
    )
    return out.drop("n_experts_raw", "n_interlocutors_raw", "n_no_callback", "n_same_day")

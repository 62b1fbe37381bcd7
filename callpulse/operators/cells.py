"""Call features from day cells that know no label.

Plan:

1. ``day_cells`` - ONE aggregation of the call register per (account, opportunity, slot, agent), whose calls are
   shuffled as they are: a call is little more than half as wide as the sums it begins, and few calls share a cell. A slot is a day, its exact midnight apart: windows start and end
   at midnights, both ends excluded, so a slot is in a window as a whole or not at all. Cells add up and
   are kept: the next day's calls only add their own cells (``write_cells``, ``read_cells``), and the
   first expert call of each agent is merged from the kept state (``agent_state``, ``merge_agents``).
2. ``slots`` - cells summed over agents, with what a slot knows about its day (missed
   status, real calls of the whole day) and about the past (the outbound call before it): ordered states, label-free too.
3. ``features_from_cells`` - slots x labels and named agents' cells x labels, each aggregated to KEY once. All of it
   stays partitioned by opportunity: the account's dates come to its opportunities as short lists, one a period. Labels
   of one account and date are one row with a multiplicity, by which counts and sums are multiplied.

Reference dates are midnights, as the label builders make them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.config import KEY, Config
from callpulse.functions.exprs import cap, nullif_zero
from callpulse.functions.text import fold_text
from callpulse.functions.timefns import floor_days
from callpulse.operators.calls import _is_in, _is_out, _last, agent_counts, call_order, flat_columns, label_span, missed_counts, period, touched_periods
from callpulse.operators.labels import of_accounts
from callpulse.operators.warehouse import ABSENT, PUNCTUALITY_COLUMNS, missed_call
from callpulse.session import materialize

OPP = ("account_id", "opp_id")
CATEGORIES = ("expert", "bizdev", "customer_care")
#: measures of a cell that add up
SUMS = (
    "n_rows", "n_in", "n_out",
    *[f"{p}_{c}" for c in CATEGORIES for p in ("n", "in", "out")],
    "n_real", "n_real_kept", "sum_dur", "n_dur", "sum_dur_in", "n_unanswered_in", "n_unanswered_out",
    "n_gt_600", "n_ge_180", "n_voicemail", "n_missed", "n_short",
)
#: picks at the last call: ordering column and the values taken there
PICKS = {"dir_ord": ("last_dir",), "abs_ord": ("last_abs",), "pun_ord": tuple(f"last_{c}" for c in PUNCTUALITY_COLUMNS)}
MINS = ("first_real", "first_real_out", "min_start", "first_expert")
MAXS = ("last_real", "last_real_out", "max_start")


def slot_of(ts):
    """Midnight for a time at midnight, else one microsecond after it."""
    day = F.to_date(ts).cast("timestamp_ntz")
    return F.when(ts == day, day).otherwise(F.timestamp_add("MICROSECOND", F.lit(1), day))


def day_cells(register: DataFrame, cfg: Config) -> DataFrame:
    """Measures per (account_id, opp_id, slot, agent) of calls that have a start time."""
    d = F.col("_d")
    real = d > cfg.real_call_s
    start = F.col("start_time")
    expert = F.col("role_id").isin(*cfg.expert_roles)
    bizdev = F.col("role_id") == cfg.bizdev_role
    care = bizdev & (F.col("manager_name") == cfg.customer_care_manager)
    kept_mgr = ~F.coalesce(F.col("manager_name").isin(*cfg.excluded_managers), F.lit(False))
    order = call_order()

    def n(cond):
        return F.count_if(F.coalesce(cond, F.lit(False)))

    aggs = [F.count(F.lit(1)).alias("n_rows"), n(_is_in()).alias("n_in"), n(_is_out()).alias("n_out")]
    for name, cat in zip(CATEGORIES, (expert, bizdev, care)):
        aggs += [n(cat).alias(f"n_{name}"), n(cat & _is_in()).alias(f"in_{name}"), n(cat & _is_out()).alias(f"out_{name}")]
    aggs += [
        n(real).alias("n_real"),
        n(real & kept_mgr).alias("n_real_kept"),
        F.sum(d).alias("sum_dur"),
        F.count(d).alias("n_dur"),
        F.sum(F.when(_is_in(), d)).alias("sum_dur_in"),
        n(_is_in() & d.isNull() & expert).alias("n_unanswered_in"),
        n(_is_out() & d.isNull()).alias("n_unanswered_out"),
        n(d > cfg.long_call_s).alias("n_gt_600"),
        n(d >= cfg.medium_call_s).alias("n_ge_180"),
        n((d >= cfg.voicemail_min_s) & (d < cfg.voicemail_max_s) & _is_out()).alias("n_voicemail"),
        n(missed_call(cfg)).alias("n_missed"),
        n(F.col("duration_s") < cfg.callback_below_s).alias("n_short"),
        *_last("dir", F.when(_is_in(), F.lit(0)).otherwise(F.lit(1)), F.col("direction").isNotNull(), order),
        *_last("abs", F.when(F.col("absence_flag") == ABSENT, F.lit(1)).otherwise(F.lit(0)), F.col("absence_flag").isNotNull(), order),
        F.max(F.when(F.col("no_show").isNotNull(), order)).alias("pun_ord"),
        *[F.max_by(c, F.when(F.col("no_show").isNotNull(), order)).alias(f"last_{c}") for c in PUNCTUALITY_COLUMNS],
        F.min(F.when(real, start)).alias("first_real"),
        F.min(F.when(real & _is_out(), start)).alias("first_real_out"),
        F.min("start_time").alias("min_start"),
        F.min(F.when(expert, start)).alias("first_expert"),
        F.max(F.when(real, start)).alias("last_real"),
        F.max(F.when(real & _is_out(), start)).alias("last_real_out"),
        F.max("start_time").alias("max_start"),
    ]
    c = register.where(start.isNotNull()).withColumn("slot", slot_of(start))
    c = c.repartition(*OPP, "slot", "agent")  # calls, not their wider partial sums, go to the cell
    return c.withColumn("_d", cap("duration_s", cfg.duration_cap_s)).groupBy(*OPP, "slot", "agent").agg(*aggs)


# -- kept cells and agents ----------------------------------------------------------


def write_cells(cells: DataFrame, path: str) -> None:
    """Cells into a table partitioned by day; a day that is written again replaces itself."""
    (
        cells.withColumn("day", F.to_date("slot"))
        .repartition("day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def read_cells(spark, path: str, labels: DataFrame | None = None, cfg: Config | None = None) -> DataFrame:
    """Kept cells; with labels, only the days that one of their windows can touch (pruned partitions)."""
    cells = spark.read.parquet(path)
    if labels is not None:
        span = label_span(labels, cfg)
        lo, hi = F.to_date(span.getField("lo")), F.to_date(span.getField("hi"))
        cells = cells.where((F.col("day") >= lo) & (F.col("day") <= hi))
    return cells.drop("day")


def agent_state(cells: DataFrame) -> DataFrame:
    """agent, first_expert_call (null if none) of the cells given."""
    return cells.where(F.col("agent").isNotNull()).groupBy("agent").agg(F.min("first_expert").alias("first_expert_call"))


def merge_agents(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Kept state and that of new cells: one row per agent name."""
    return kept.unionByName(new).groupBy("agent").agg(F.min("first_expert_call").alias("first_expert_call"))


# -- ordered states of an opportunity -------------------------------------------------


def _rolled(g, weight=None):
    times = (lambda c: F.col(c) * weight) if weight is not None else F.col
    return [
        *[F.sum(times(c)).alias(c) for c in SUMS if c in g.columns],
        *[F.min(c).alias(c) for c in MINS if c in g.columns],
        *[F.max(c).alias(c) for c in MAXS],
        *[F.max(o).alias(o) for o in PICKS],
        *[F.max_by(v, o).alias(v) for o, vs in PICKS.items() for v in vs],
    ]


def slots(cells: DataFrame, cfg: Config) -> DataFrame:
    """Cells summed over agents per (account, opportunity, slot), with the states of the day and of the past.

    ``ends_day``: the last slot of its day; ``real_day``: real calls of the whole day; ``prev_out``: the last real outbound call
    before the slot; ``gap``: more than ``gap_days`` lie between that and the slot's first one; n_missed_rows,
    n_no_callback and n_same_day: calls of the slot by the missed status of the day.
    """
    s = cells.repartition(*OPP)  # all that follows is by opportunity
    s = s.groupBy(*OPP, "slot").agg(*_rolled(s.drop("first_expert", "min_start")))
    # slots follow each other in time: their picks are ordered by the slot, which is cheaper to compare than call orders
    s = s.withColumns({o: F.when(F.col(o).isNotNull(), F.col("slot")) for o in PICKS})
    day = Window.partitionBy(*OPP, F.to_date("slot"))
    past = Window.partitionBy(*OPP).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    missed, short = F.sum("n_missed").over(day) > 0, F.sum("n_short").over(day)
    s = s.withColumns(
        {
            "ends_day": F.col("slot") == F.max("slot").over(day),
            "real_day": F.sum("n_real").over(day),
            "prev_out": F.last("last_real_out", ignorenulls=True).over(past),
            "n_missed_rows": F.when(missed, F.col("n_rows")).otherwise(F.lit(0)),
            "n_no_callback": F.when(missed & (short == 0), F.col("n_rows")).otherwise(F.lit(0)),
            "n_same_day": F.when(missed & (short > 0), F.col("n_rows")).otherwise(F.lit(0)),
        }
    )
    gap = F.coalesce(floor_days("first_real_out", "prev_out") > cfg.gap_days, F.lit(False))
    return s.withColumn("gap", gap).drop("n_missed", "n_short")


# -- windows --------------------------------------------------------------------------


def account_dates(labels: DataFrame, distinct: bool = False) -> DataFrame:
    """account_id, ref_date, times (labels of the account at that date; 1 if ``distinct``), mandate_date (their latest)."""
    times = F.lit(1).cast("long") if distinct else F.count(F.lit(1))
    return labels.groupBy("account_id", "ref_date").agg(times.alias("times"), F.max("mandate_date").alias("mandate_date"))


def accounts_of(cells: DataFrame, checkpoint: bool = True) -> DataFrame:
    """account_id of the cells, each once; written, so that joins see its size before they shuffle the other side."""
    accounts = cells.select("account_id").distinct()
    return materialize(accounts) if checkpoint else accounts


def _opp_dates(near: DataFrame, dates: DataFrame, cfg: Config) -> DataFrame:
    """account_id, opp_id, _per, _dates: the account's dates that rows of the opportunity in that period can meet.

    Dates are distinct midnights, so a list has at most two windows of days. Lists come to the opportunities, which stay
    where they are: their rows, wide or many, are not shuffled to the labels, and neither are the features of their KEYs.
    """
    lists = touched_periods(dates, cfg).groupBy("account_id", "_per").agg(
        F.collect_list(F.struct("ref_date", "times", "mandate_date")).alias("_dates")
    )
    own = near.select(*OPP, period(F.col("slot"), cfg.window_days).alias("_per")).distinct()
    return own.join(lists, ["account_id", "_per"]).repartition(*OPP)


def _day(ts):
    """Day number of a time; pairs are compared by these, which costs less than times moved by days."""
    return F.unix_date(F.to_date(ts))


def _past(ts):
    """Number of the first midnight that is not before the time: a time is after midnight n if this is above n."""
    return _day(ts) + F.when(ts == F.to_date(ts).cast("timestamp_ntz"), F.lit(0)).otherwise(F.lit(1))


def _meet(rows: DataFrame, opp_dates: DataFrame, cfg: Config) -> DataFrame:
    """Rows of opportunities (kept by opportunity) x the dates of their account with ``ref_date - window < slot < ref_date``.

    ``_day``, ``_past`` and ``_ref``: day numbers of slot and date, dates being midnights.
    """
    at, span = F.col("slot"), cfg.window_days
    d = opp_dates.withColumnsRenamed({"account_id": "_acc", "opp_id": "_opp"})
    rows = rows.withColumns({"_day": _day(at), "_past": _past(at)})
    r = rows.withColumn("_row_per", period(at, span))
    # the period is no key of the join: by the opportunity alone, the rows need no other shuffle
    same_period = (r["_row_per"] <= d["_per"]) & (r["_row_per"] >= d["_per"])
    j = r.join(d, (r["account_id"] == d["_acc"]) & (r["opp_id"] == d["_opp"]) & same_period)
    j = j.withColumn("_date", F.explode("_dates")).select(*rows.columns, "_date.*", _day(F.col("_date.ref_date")).alias("_ref"))
    return j.where((F.col("_day") < F.col("_ref")) & (F.col("_past") > F.col("_ref") - span))


def _flat(slot_rows: DataFrame, opp_dates: DataFrame, cfg: Config) -> DataFrame:
    j = _meet(slot_rows.withColumn("_out_past", _past(F.col("prev_out"))), opp_dates, cfg)
    k = F.col("times")

    def multi_call_days(since):
        # the window's first day counts without its midnight
        real = F.when(F.col("_day") > since, F.col("real_day")).otherwise(F.col("n_real"))
        return F.count_if(F.col("ends_day") & (F.col("_past") > since) & (real * k > 1))

    lo, (lo7, lo14) = F.col("_ref") - cfg.window_days, (F.col("_ref") - w for w in cfg.recent_windows)
    g = j.groupBy(*KEY).agg(
        *_rolled(j, k),
        *[F.sum(F.col(c) * k).alias(c) for c in ("n_missed_rows", "n_no_callback", "n_same_day")],
        F.max("mandate_date").alias("max_mandate"),
        multi_call_days(lo).alias("mc_global"),
        multi_call_days(lo7).alias("mc_7"),
        multi_call_days(lo14).alias("mc_14"),
        F.count_if(F.col("gap") & (F.col("_out_past") > lo)).alias("gaps"),
    )
    names = {"n_in": "in_global", "n_out": "out_global", "n_unanswered_in": "unanswered_in", "n_unanswered_out": "unanswered_out"}
    names |= {f"n_{c}": f"n_calls_{c}" for c in CATEGORIES} | {"first_real": "first_call", "last_real": "last_call"}
    g = g.withColumnsRenamed(names).withColumn("n_calls_global", F.col("n_rows"))
    has = F.col("mc_global") > 0
    days = {f"multi_call_days_{a}": F.when(has, F.col(f"mc_{b}")) for a, b in (("global", "global"), ("7d", "7"), ("14d", "14"))}
    return flat_columns(g, {**days, "n_gaps_14d": nullif_zero("gaps")})


def _agents(cells: DataFrame, opp_dates: DataFrame, agents: DataFrame, cfg: Config) -> DataFrame:
    """Experience and distinct folded names per KEY, of calls with an agent name: per opportunity a map from its dates."""
    named = cells.where(F.col("agent").isNotNull()).select(*OPP, "slot", "agent", "n_real_kept", "min_start")
    named = named.join(agents, "agent", "left").repartition(*OPP)  # all that follows is by opportunity
    j = _meet(named, opp_dates, cfg)
    a = j.groupBy(*KEY, "agent", "agent_norm").agg(
        F.sum(F.col("n_real_kept") * F.col("times")).alias("n"), F.min("min_start").alias("s"), F.min("first_expert_call").alias("first_expert_call")
    )
    days = floor_days("s", "first_expert_call")
    name = Window.partitionBy(*KEY, "agent_norm")
    a = a.select(
        *KEY,
        F.when(days < 0, F.lit(0)).otherwise(days).cast("double").alias("exp"),
        F.sum("n").over(name).alias("n"),
        (F.row_number().over(name.orderBy("agent")) == 1).alias("once"),
    )
    a = a.groupBy(*KEY).agg(
        F.median("exp").alias("agent_experience_days"),
        F.count_if(F.col("once") & (F.col("n") > 2)).alias("n_experts_raw"),
        F.count_if(F.col("once") & (F.col("n") > 0)).alias("n_interlocutors_raw"),
    )
    entry = F.struct("ref_date", F.struct("agent_experience_days", "n_experts_raw", "n_interlocutors_raw"))
    return a.groupBy(*OPP).agg(F.map_from_entries(F.collect_list(entry)).alias("_agents"))


def _with_agents(flat: DataFrame, agents: DataFrame) -> DataFrame:
    """The KEYs that have named agents, with their features; a join by opportunity, so neither side is shuffled for it."""
    out = flat.join(agents, list(OPP)).withColumn("_a", F.col("_agents")[F.col("ref_date")]).where(F.col("_a").isNotNull())
    return out.select(*flat.columns, "_a.*")


def features_from_cells(
    cells: DataFrame, labels: DataFrame, cfg: Config, agents: DataFrame | None = None, checkpoint: bool = True, distinct_ref_dates: bool = False
) -> DataFrame:
    """Per-KEY call features before median imputation (KEYs with at least one named agent).

    ``agents``: kept state of ``agent_state`` over the whole history; by default that of the cells given.
    Calls meet labels by account, so two labels of one account and date count each call twice, as in the original;
    with ``distinct_ref_dates`` once.
    """
    agents = agent_state(cells) if agents is None else agents
    agents = agents.select("agent", "first_expert_call", fold_text(F.col("agent")).alias("agent_norm"))
    # dates of accounts without calls meet nothing: they go before lists are made of them
    dates = of_accounts(account_dates(labels, distinct_ref_dates), accounts_of(cells, checkpoint))
    if checkpoint:
        dates = materialize(dates)  # read by the bounds and by both joins
    span = label_span(dates, cfg)
    # the midnight of the first day too: it is in no window, but it belongs to its day
    near = cells.where((F.col("slot") >= span.getField("lo")) & (F.col("slot") < span.getField("hi")))
    by_opp = _opp_dates(near, dates, cfg)
    out = agent_counts(_with_agents(missed_counts(_flat(slots(near, cfg), by_opp, cfg)), _agents(near, by_opp, agents, cfg)))
    return materialize(out) if checkpoint else out

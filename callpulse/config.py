"""Job configuration.

All business literals (role codes, stage names, manager exclusions, thresholds)
live here so that the transforms stay generic. The defaults describe the
synthetic test tables built by ``callpulse.sources.adapters``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

KEY = ("account_id", "opp_id", "ref_date")

# The six process-stage date columns, in the order that decides
# the "last stage" name on ties (later entry wins).
STAGE_COLUMNS = ("to_reach_at", "r1_at", "search_no_docs_at", "search_docs_at", "assembly_at", "sent_at")

# The twelve CRM date columns masked at the reference date.
CRM_DATE_COLUMNS = (
    "created_at",
    "to_reach_at",
    "r1_at",
    "search_no_docs_at",
    "search_docs_at",
    "assembly_at",
    "sent_at",
    "lost_at",
    "offer_edited_at",
    "mandate_signed_at",
    "compromise_at",
    "suspensive_at",
)

# The 37 model features, in one shared order for fit and score.
MODEL_FEATURES = (
    "n_calls_global",
    "pct_in_global",
    "n_calls_bizdev",
    "pct_in_bizdev",
    "pct_out_bizdev",
    "mean_wait_days",
    "avg_duration",
    "unanswered_in",
    "unanswered_out",
    "multi_call_days_global",
    "multi_call_days_7d",
    "multi_call_days_14d",
    "n_calls_gt_600",
    "last_call_out",
    "n_experts",
    "n_interlocutors",
    "n_calls_ge_180",
    "no_callback_count",
    "n_voicemails",
    "duration_in",
    "pct_missed_in",
    "pct_missed_out",
    "n_gaps_14d",
    "agent_experience_days",
    "days_since_last",
    "days_since_first",
    "missed_ratio",
    "no_callback_ratio",
    "in_time_share",
    "mandate_delta_days",
    "days_r1_to_assembly",
    "days_suspensive_to_ref",
    "days_created_to_sent",
    "no_show",
    "on_time",
    "late_ge_15",
    "agent_absent",
)

# Call-feature columns whose gaps are filled with the
# call-weighted median of the keys that have a value.
MEDIAN_FILL_COLUMNS = (
    "n_gaps_14d",
    "multi_call_days_global",
    "multi_call_days_7d",
    "multi_call_days_14d",
    "n_calls_gt_600",
    "n_calls_ge_180",
    "same_day_callback_count",
    "no_callback_ratio",
    "missed_ratio",
    "no_callback_count",
    "in_time_share",
    "n_no_callback_rows",
    "duration_in",
    "mean_wait_days",
    "n_interlocutors",
    "avg_duration_alt",
    "n_voicemails",
    "agent_experience_days",
)

MISSED_NO_CALLBACK = "no_callback"
MISSED_SAME_DAY = "same_day_callback"


@dataclass(frozen=True)
class Config:
    """Parameters of the feature, label, model and alert steps."""

    as_of: dt.date = dt.date(2024, 1, 30)
    # roles
    expert_roles: tuple[str, ...] = ("EXPERT", "EXPERT_MANAGER")
    bizdev_role: str = "BIZDEV"
    customer_care_manager: str = "NATION_3"
    excluded_managers: tuple[str, ...] = ("NATION_7", "NATION_3")
    # CRM record filters
    main_record_type: str = "MAIN"
    closed_stages: tuple[str, ...] = ("offer_edited", "offer_signed", "granted", "lost", "funds_released")
    excluded_owner_names: tuple[str, ...] = ("Émilie 0", "José 1")
    scoring_lead_owner: str = "LEAD_OWNER_MAIN"
    alert_excluded_lead_owners: tuple[str, ...] = ("LEAD_OWNER_JUNIOR", "LEAD_OWNER_SENIOR")
    # appointment / task text filters (SQL LIKE patterns on lower-cased text)
    schedule_status_like: str = "%confirmed%"
    schedule_type: str = "Call"
    schedule_subject_like: str = "%téléphonique%"
    # call thresholds (seconds)
    duration_cap_s: float = 3600.0
    real_call_s: float = 10.0
    missed_below_s: float = 60.0
    callback_below_s: float = 5.0
    voicemail_min_s: float = 20.0
    voicemail_max_s: float = 60.0
    long_call_s: float = 600.0
    medium_call_s: float = 180.0
    gap_days: int = 14
    # windows (days before the reference date)
    window_days: int = 60
    recent_windows: tuple[int, int] = (7, 14)
    # labels
    review_min_date: dt.date = dt.date(2020, 6, 1)
    shift_days: tuple[int, ...] = (14,)
    good_rating_above: float = 3.0
    ambiguous_ratings: tuple[float, ...] = (3.5, 4.0)
    compromise_min_date: dt.date = dt.date(2017, 1, 1)
    # CRM cleaning
    suspensive_max_days: int = 300
    suspensive_fill_days: int = 93
    lost_before_stage_days: int = -2
    # model
    num_trees: int = 500
    max_depth: int = 15
    min_instances_per_node: int = 80
    max_leaf_nodes: int = 14
    min_samples_split: int = 175
    max_bins: int = 64
    test_fraction: float = 0.25
    seed: int = 7
    # alerts
    alert_max_age_days: int = 1
    alert_recent_days: int = 8
    url_prefix: str = "https://crm.example.org/opportunity/"
    # scale knobs

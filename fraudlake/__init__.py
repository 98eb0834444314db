"""fraudlake: card-transaction fraud-risk lakehouse on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
built-ins; actions only happen in sinks, in the exact-quantile selection and
in :func:`fraudlake.plans.lakehouse.run`.
"""

from fraudlake.operators.bronze import add_control_columns
from fraudlake.operators.exercises import extra_flags, rescore_compare
from fraudlake.operators.gold import alerts, effectiveness, metrics
from fraudlake.operators.profile import (
    describe,
    describe_long,
    null_profile,
    preview,
    target_distribution,
)
from fraudlake.operators.quality import (
    DEFAULT_RULES,
    EXTRA_RULES,
    Rule,
    quality_alerts,
    quality_report,
    quality_summary,
)
from fraudlake.operators.reports import (
    dash_by_level,
    dash_by_score,
    dash_kpis,
    dash_profile,
    fraud_by_channel,
    fraud_profile,
    history,
    top_confirmed,
)
from fraudlake.operators.runlog import log_entry, payload
from fraudlake.operators.silver import (
    build_silver,
    flag_prevalence,
    level_distribution,
    qa_summary,
    thresholds,
    typed,
    with_flags,
    with_qa,
    with_score,
)
from fraudlake.operators.versions import (
    read_as_of,
    snapshot_diff,
    snapshot_history,
    write_snapshot,
)
from fraudlake.sources.csv import read_csv

__all__ = [
    "DEFAULT_RULES", "EXTRA_RULES", "Rule", "add_control_columns", "alerts",
    "build_silver", "dash_by_level", "dash_by_score", "dash_kpis", "dash_profile",
    "describe", "describe_long", "effectiveness", "extra_flags", "flag_prevalence",
    "fraud_by_channel", "fraud_profile", "history", "level_distribution", "log_entry",
    "metrics", "null_profile", "payload", "preview", "qa_summary", "quality_alerts",
    "quality_report", "quality_summary", "read_as_of", "read_csv", "rescore_compare",
    "snapshot_diff", "snapshot_history", "target_distribution", "thresholds",
    "top_confirmed", "typed", "with_flags", "with_qa", "with_score", "write_snapshot",
]

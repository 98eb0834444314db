"""Write PLANS.md: formatted physical plans of the main registered queries.

    python tools/plans.py [sf_dir]

Plans are taken after execution (final adaptive plans) on the given scale
factor; file paths are shortened.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

def quantile_passes(spark, sf_dir: str) -> list[str]:
    """Executed plans of the threshold passes over stored Bronze."""
    from pyspark.sql.classic.dataframe import DataFrame

    from fraudlake.functions.quantile import exact_quantiles
    from fraudlake.plans import catalog
    from fraudlake.session import scratch_path
    from fraudlake import schema as S

    path = scratch_path(spark, "plans-bronze")
    catalog.bronze_of(spark, sf_dir).write.parquet(path)
    plans, collect = [], DataFrame.collect

    def spy(self):
        rows = collect(self)
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return rows

    DataFrame.collect = spy
    try:
        exact_quantiles(spark.read.parquet(path), list(S.MEASURES))
    finally:
        DataFrame.collect = collect
    return plans


KEYS = ("gold_effectiveness", "gold_metrics", "quality_report", "fraud_by_channel",
        "top_confirmed_fraud", "profile_target", "run_log_entry", "snapshot_as_of",
        "snapshot_history", "snapshot_diff")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from fraudlake.plans import catalog
    from fraudlake.session import local_session

    spark = local_session(8)
    qs = catalog.queries()
    out = ["# Physical plans of the main queries", "",
           f"Final adaptive plans (`explain()` after execution) at `{os.path.basename(sf_dir)}`,",
           "written by `tools/plans.py`. Exact thresholds appear as literals.", ""]
    for key in KEYS:
        df = qs[key](spark, sf_dir)
        df.collect()  # at most 60k rows at sf0.01; makes the adaptive plan final
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:[^,\]\s]*/", "…/", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {key}", "", "```", plan.rstrip(), "```", ""]
    for k, plan in enumerate(quantile_passes(spark, sf_dir), 1):
        plan = re.sub(r"#\d+L?", "", re.sub(r"file:[^,\]\s]*/", "…/", plan))
        out += [f"## thresholds, pass {k} over stored Bronze", "", "```", plan.rstrip(), "```", ""]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()

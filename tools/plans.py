"""Write the physical plans of key queries to PLANS.md (as planned, before AQE refinement).

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qualis.catalog import QUERIES  # noqa: E402
from qualis.session import build_session  # noqa: E402

KEY = ("weighted_score", "dim_user", "fact_manual_reviews", "fact_conversations", "incr_fact_autoqa_ratings",
       "subs_merge", "check_relationships", "score_by_month", "top_agents")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    out = ["# Physical plans (as planned; AQE may refine them at runtime)", "",
           f"Generated by `tools/plans.py` at `{sf_dir}`, local[8], 16 shuffle partitions.", ""]
    for name in KEY:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

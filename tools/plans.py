"""Write PLANS.md: final (post-AQE) physical plans of a few headline queries
at $BENCH_SF_DIR, for plan review."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assay.plans import QUERIES  # noqa: E402
from assay.session import get_session  # noqa: E402

HEADLINE = ["scorecard", "skip_cascade_linear", "snapshot_diff", "manifest_reconcile", "duplicate_keys",
            "frame_compare_keyed", "lint_findings"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session()
    out = ["# PLANS", "", f"Final physical plans (after adaptive execution) at `{sf_dir}`, local[8]; generated by "
           "`tools/plans.py`.", ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.executedPlan().executeCollect()          # run this very plan so AQE finalises it
        plan = qe.executedPlan().toString()
        out += [f"## {name}", "", "```", plan.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()

"""Print the executed (AQE final) physical plans of the main queries as Markdown.

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stocktake.plans.queries import QUERIES  # noqa: E402
from stocktake.session import build_session  # noqa: E402

SHOWN = ["analysis_full", "listing_with_placeholders", "listing_subfolders", "rekey_counts", "pending_accounts"]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)  # expression ids
    return "\n".join(line[:220] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print(f"# Executed plans ({os.path.basename(sf_dir)}, AQE final plans, expression ids removed)\n")
    print("Generated by `python scripts/show_plans.py`. Lines are cut at 220 characters.\n")
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        plan = final_plan(df)
        n_shuffle = len(re.findall(r"Exchange hashpartitioning", plan))
        n_reused = plan.count("ReusedExchange")
        n_bhj = plan.count("BroadcastHashJoin")
        print(f"## `{name}`\n")
        print(f"hash exchanges: {n_shuffle}, reused exchanges: {n_reused}, broadcast hash joins: {n_bhj}\n")
        print("```\n" + plan + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

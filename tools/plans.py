"""Plan survey of registered queries: scans, shuffles, reuse and anything that would not scale."""

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freshet.catalog import load_all  # noqa: E402
from freshet.catalog.registry import ENTRIES, run  # noqa: E402
from freshet.session import build_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition")


def executed_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0] if "== Initial Plan ==" in text else text


def main():
    load_all()
    names = sys.argv[1:] or [n for n in ENTRIES if n not in ("gbt_walk_forward", "candidate_selection", "feature_ablation")]
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("OFF")
    for n in names:
        plan = executed_plan(run(n, spark, "/root/testdata/sf0.01"))
        scans = re.findall(r"(\w+)\.parquet", plan)
        counts = {t: scans.count(t) for t in sorted(set(scans))}
        print(
            f"{n}: scans {counts} exchanges {len(re.findall(r'(?<!Reused)Exchange (?:hash|range|Single)', plan))} reused {plan.count('ReusedExchange')}"
            f" bad {[b for b in BAD if b in plan]}",
            flush=True,
        )


main()

"""Write the physical-plan skeletons of the headline queries to PLANS.md.

    python scripts/plan_report.py [sf_dir]
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candela.plans import queries as Q  # noqa: E402
from candela.session import get_session  # noqa: E402

NAMES = ["bars_by_supplier", "ohlcv_features", "ohlcv_features_segmented", "weekly_rollup",
         "clean_bars", "market_open_events", "payload_validation"]
KEEP = ("Exchange", "Sort ", "Window", "Aggregate", "Scan", "Join", "Generate", "Union", "BroadcastExchange")


def skeleton(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+", "", line)
        if "Scan" in line:
            head = line.split("[")[0]
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            rs = re.search(r"ReadSchema: (\S+)", line)
            line = f"{head} PushedFilters={pf.group(1) if pf else '[]'} ReadSchema={rs.group(1) if rs else '?'}"
        out.append(line[:170])
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    parts = ["# Physical plans of the headline queries",
             "",
             f"Generated by `scripts/plan_report.py` on {os.path.basename(sf)} (AQE off, to show the",
             "static plan; at run time AQE may coalesce partitions or split skewed ones).",
             "Only exchanges, sorts, windows, aggregates, joins, generators and scans are kept.", ""]
    qs = Q.queries()
    for name in NAMES:
        parts += [f"## {name}", "", "```"] + skeleton(qs[name](spark, sf)) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()

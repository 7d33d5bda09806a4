"""Print the operator skeleton of a registered query's physical plan.

    python scripts/plan_shape.py <query> [sf_dir]
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candela.plans import queries as Q  # noqa: E402
from candela.session import get_session  # noqa: E402

name = sys.argv[1]
sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
spark = get_session("local[8]", 8)
df = Q.queries()[name](spark, sf)
plan = df._jdf.queryExecution().executedPlan().toString()
for line in plan.splitlines():
    m = re.match(r"^([\s:+\-|]*)(\*?\(?\d*\)?\s*[A-Za-z]+)", line)
    if not m:
        continue
    head = m.group(1) + m.group(2)
    extra = ""
    if "Exchange" in line or "Sort [" in line or "Window [" in line:
        extra = " " + re.sub(r"#\d+", "", line[len(m.group(0)):])[:140]
    if "Scan" in line:
        rs = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        extra = f" ReadSchema={rs.group(1) if rs else '?'} PushedFilters={pf.group(1) if pf else '?'}"
    print(head + extra)
spark.stop()

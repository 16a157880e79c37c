"""Print a one-screen plan summary per query: shuffles, broadcasts, scans
with their read schema and pushed filters, and any nested-loop or Cartesian
join. Usage: python tests/plan_report.py SF_DIR [name ...]"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tablewise.catalog import REGISTRY
    from tablewise.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    for name, q in REGISTRY.items():
        if (names and name not in names) or name.startswith("stream_"):
            continue
        p = plan_text(q.build(spark, sf_dir))
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p))
        bcast = p.count("BroadcastExchange")
        bad = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in p]
        print(f"{q.survey_id} {name}: shuffles={shuffles} broadcasts={bcast} {' '.join(bad)}")
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", p):
            cols = m.group(1).replace("#", "").split(",")
            cols = [re.sub(r"\d+L?$", "", c) for c in cols]
            print(f"    scan cols={cols} pushed=[{m.group(2)[:120]}]")


if __name__ == "__main__":
    main(sys.argv)

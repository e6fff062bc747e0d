"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and forces full evaluation with the ``noop`` sink
(every row is computed, nothing is collected to the driver).  Prints one
JSON line: {"metric", "value", "unit", "queries", "sf"}.

Warm-up: the whole headline set runs once, untimed, on the smallest scale
factor ($BENCH_WARMUP_DIR, default the sf0.001 tables): JVM JIT and
generated-code compilation are paid there, since the plans have the same
shape at every scale.  Each query is then timed once at the target scale,
DataFrame construction included.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hirewave.plans import registry  # noqa: E402
from hirewave.session import build_session  # noqa: E402

HEADLINE = [
    "silver_all_dates",      # full cleaning job, unexploded silver
    "silver_exploded",       # + explode and contiguous ids per date
    "funnel_counts",         # per-date validation counts
    "department_counts",
    "dedup_postings",
    "join_companies",
    "skill_taxonomy",
    "title_taxonomy",
    "verticals",
    "parse_skills_sniff",
    "page_links",
    "page_fields",
    "detail_fields",
    "detail_lists",
    "facet_plan",
    "search_urls",
    "posted_date",
    "union_boards",
]

# timed and printed beside the headline, not part of its total: queries that land tables
LANDING = [
    "validation_table",      # postings landed by day, then the daily job end to end
    "land_by_run_date",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="hirewave-bench", shuffle_partitions=2 * cpus)
    qs = registry.queries()
    warm = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm):
        for name in names:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    landing: dict[str, float] = {}
    for name in [] if sys.argv[1:] else LANDING:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        landing[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "landing": landing, "sf": float(m.group(1)) if m else None}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

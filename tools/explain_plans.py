"""Write PLANS.md: physical plans of key queries with operator counts.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirewave.plans import registry  # noqa: E402
from hirewave.session import build_session  # noqa: E402

NOTES = """What to read in them:

* `silver_all_dates`: one shuffle (the dedup aggregate, partial + final);
  the date / manager / valid-date filters sit in the scan's Filter below
  the dedup; the companies side is broadcast by the planner on its measured
  size (no hint).  The rule projection (53 + 59 branch CASEs) runs as a
  plain `Project`: its generated method exceeds the whole-stage limit, so
  Spark compiles the projection on its own.
* Dedup and the per-date sniff are `SortAggregate`: `min` over strings /
  structs has a variable-length buffer, which the hash aggregate cannot
  hold; the hash of the keys leads the sort key.  Sort aggregation spills
  and keeps map-side partial aggregation.
* `funnel_counts`: column pruning drops the survivor struct, so the dedup
  becomes a `HashAggregate`; the per-date tables are joined by broadcast
  (bounded by the calendar); company counts are scalar subqueries.
* `facet_plan` / `search_urls`: one ROLLUP (`Expand` + `HashAggregate`),
  windows over the aggregated rows only.
* `page_plan`: an extra small shuffle spreads the page chunks before the
  expansion.
* `scan_partition`: `PartitionFilters` on year / month / day, nothing else.
* `remaining_dates`: anti join against a broadcast date list; the
  fallback is an `EXISTS` subquery.
* `detail_fields_parsed`: the one `MapInPandas` (HTML parser), fed by
  Arrow batches."""

KEYS = ["silver_all_dates", "funnel_counts", "join_companies", "dedup_postings", "sniff_format",
        "facet_plan", "page_plan", "search_urls", "scan_partition", "remaining_dates", "detail_fields_parsed"]
COUNT = ["Exchange hashpartitioning", "Exchange rangepartitioning", "BroadcastExchange", "BroadcastHashJoin",
         "SortMergeJoin", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "Generate",
         "MapInPandas", "PythonUDF"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    q = registry.queries()
    out = ["# PLANS", "", f"Physical plans (`explain()` after a run: the AQE final plan) at `{sf}`, generated by "
           "`tools/explain_plans.py`.  Counts are of operator names in the plan text (final and initial plan "
           "both appear, so most counts are doubled).", "", NOTES, ""]
    for k in KEYS:
        df = q[k](spark, sf)
        df.collect()   # run this very plan: explain() then shows the AQE final plan
        text = plan_text(df)
        counts = {c: len(re.findall(re.escape(c), text)) for c in COUNT}
        pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
        pf = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
        codegen = len(re.findall(r"\*\(\d+\)", text))
        out += [f"## {k}", "",
                "| " + " | ".join(c for c in COUNT if counts[c]) + " | codegen stages |",
                "|" + "---|" * (sum(1 for c in COUNT if counts[c]) + 1),
                "| " + " | ".join(str(counts[c]) for c in COUNT if counts[c]) + f" | {codegen} |", ""]
        if any(pushed):
            out += ["Pushed filters: " + "; ".join(sorted({p for p in pushed if p}))[:600], ""]
        if any(pf):
            out += ["Partition filters: " + "; ".join(sorted({p for p in pf if p}))[:400], ""]
        lines = [ln if len(ln) <= 220 else ln[:220] + " …" for ln in re.sub(r"file:/\S+/", "", text.strip()).splitlines()]
        out += ["```", "\n".join(lines[:90]), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

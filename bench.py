"""Benchmark: run the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Adapter tables and the upstream job outputs that later jobs read (search
views and clicks, category paths, exact intent) are written once in a
setup step, as the warehouse tables they stand for; each job is then timed
on its own, fully computed through the ``noop`` sink (every column, no
collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "search_views",          # J1
    "search_clicks",         # J2
    "category_paths",        # J3
    "category_mapping",      # J4
    "keyword_facts",         # J5
    "keyword_intent_exact",  # J6
    "keyword_intent_fuzzy",  # J7
    "enrich_terms",          # J8
    "normalized_text",       # norm_str over every document
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from siftkit.registry import QUERIES, context
    from siftkit.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="siftkit-bench")
    t0 = time.time()
    ctx = context(spark, sf_dir)
    for name in ("fx_view", "fx_click", "fx_sessions", "fx_members", "fx_stopwords", "fx_category",
                 "fx_kw_category", "fx_keywords", "fx_ner", "fx_brand", "fx_attributes", "fx_seller",
                 "fx_status_v1", "fx_status_v2", "fx_responses"):
        ctx.fx[name]
    ctx.views(), ctx.clicks(), ctx.paths(), ctx.exact()
    setup = time.time() - t0

    timings = {}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](ctx).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_job_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "setup_sec": round(setup, 3),
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Seconds per headline query; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from notevalue.plans import registry
from notevalue.session import build_session

HEADLINE = (
    "flagship_constant_on_test", "c1_parse_reviews", "c2_reject_funnel", "c5_deduplicate", "c6_duplicate_report", "c9_holdout",
    "c10_balance", "c13_describe_target", "c15_facet_profile", "p1_training_prompts", "p5_length_profile", "v2_score",
    "v5_score_slice", "m4_term_table", "m6_metadata", "m8_tfidf_note", "r1_knn", "r2_neighbour_price", "r3_context",
    "e2_valid_replies", "e3_enrich", "e5_budget_prefix", "l1_page_text", "l4_listings", "l9_plan", "t1_stream_plan",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = build_session("notevalue-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    registry.QUERIES["v2_score"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()

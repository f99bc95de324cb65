"""Time the headline queries and print one JSON line.

The flagship runs once untimed before, to warm up the session and the Python workers.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Every query builds its
inputs from the given tables each time; nothing is cached between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rejoinder.plans.catalog import CATALOG  # noqa: E402
from rejoinder.session import build_session  # noqa: E402

HEADLINE = [
    "assess_queries",
    "assess_queries_hybrid",
    "search_lexical_v2",
    "search_semantic",
    "lexical_score_v2",
    "knn_sentences",
    "extract_pairs",
    "evaluate_pairs",
    "pairs_to_nodes",
    "split_sentences",
    "parse_judge",
    "toxicity_reduction",
    "topic_overview",
    "stratified_sample",
    "mitigation_running_counts",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR"},
    )
    CATALOG[HEADLINE[0]](spark, path).count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        CATALOG[name](spark, path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    name = os.path.basename(path.rstrip("/"))
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": name}))


if __name__ == "__main__":
    main()

"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from rankloom.catalog import registry
from rankloom.session import build_session

HEADLINE = (
    "p6_tech_tokens",
    "a2_length_stats",
    "r2_tfidf_topk",
    "r5_bm25_plus_topk",
    "r5_bm25_okapi_topk",
    "d7_knn_topk",
    "j6_all_pairs_topk",
    "h4_hybrid_search",
    "c5_naive_bayes",
    "c5_naive_bayes_50k",
    "k4_pair_rerank",
    "m6_evaluate_many_k",
    "o1_hybrid_submission",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", int(cpus), {"spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    # one untimed pass starts the JVM, the code generator and the Python workers
    queries["h4_hybrid_search"](spark, sf_dir.rsplit("/", 1)[0] + "/sf0.001").write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()

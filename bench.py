"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every query is computed in full
(all rows, all columns) into a sink that discards them; a query's time includes building its plan.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = (
    "a02_resample_trades",
    "b01_forward_fill",
    "b05_clean_price_data",
    "c00_all_indicators",
    "c08_rsi",
    "d03_targets",
    "e03_news_features",
    "f01_split_global_time",
    "f03_create_sequences",
    "f04_scale_standard",
    "f08_feature_scores",
    "f13_prepare_data",
    "g01_feature_text",
    "g06_tokenize",
    "h04_hash_embedding",
    "h06_search_cosine",
    "h14_chunk_text",
    "h15_clean_documents",
    "i02_price_metrics",
    "i09_max_drawdown",
    "i13_confidence_metrics",
    "j06_feature_importance",
    "k04_describe",
    "k09_correlations",
    "l03_experiment_summary",
)


def main(names: list[str]) -> None:
    from barflow.plans import QUERIES
    from barflow.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session("bench", cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs) if repeats < 3 else statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINE))

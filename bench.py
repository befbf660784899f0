"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from tokenloom.plans import catalog
from tokenloom.session import local_session

HEADLINE = [
    "web_token_report",
    "clean_web",
    "dialog_pairs",
    "byte_budget",
    "tokenize_ws",
    "vocab_build",
    "vocab_extend",
    "encode_all",
    "sink_ids",
    "chunk_windows",
    "context_windows",
    "ngram_counts",
    "cross_entropy",
    "next_token",
    "greedy_generate",
    "tfidf",
    "fuzzy_match",
    "stream_clean",
    "stream_windows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "12g")
    spark.read.parquet(f"{folder}/documents.parquet").count()
    times = {}
    for name in names:
        begin = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

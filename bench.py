"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.
``index_build`` and ``judgements`` are timed on their own, as later queries read
their stored tables. Every query runs twice and the second run counts. Arguments
restrict the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from textloom.plans.index import build_index
from textloom.registry import QUERIES
from textloom.registry.base import containing_documents, workspace
from textloom.session import local_session, scratch_path

HEADLINE = [
    "tokenize",
    "term_vectors",
    "doc_freq",
    "field_stats",
    "partition_counts",
    "invert_index",
    "best_terms_doc_tf",
    "best_terms_doc_tfidf",
    "best_terms_coll_idf",
    "best_term_occurrences",
    "tfidf_log10",
    "vector_norms",
    "search_jm",
    "search_classic",
    "relevance_report",
    "mean_metrics",
    "lambda_sweep",
    "train_test_jm",
    "similar_docs_bin",
    "similar_docs_tf",
    "similar_docs_tfidf",
    "kmeans_fixed_rounds",
    "kmeans_seeded",
    "welch_p_value",
    "wilcoxon_p_value",
    "upsert_documents",
    "parse_marked_records",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, app_name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{folder}/documents.parquet"))  # starts the executor threads
    wanted = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}

    def timed(name, action):
        # The first run compiles the plan; the second is what is reported.
        for _ in range(2):
            start = time.perf_counter()
            action()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    shared = workspace(spark, folder)
    timed("index_build", lambda: build_index(shared.texts, scratch_path(spark, "bench-index")))
    timed("judgements", lambda: run(containing_documents(shared.documents, shared.queries)))
    for name in wanted:
        timed(name, lambda: run(QUERIES[name](spark, folder)))
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()

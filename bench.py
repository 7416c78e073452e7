"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Every query
is run once on small data first, so that class loading and compilation are not measured, and
then timed from building the frame to the last row written to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from paperloom.plans import QUERIES
from paperloom.session import local_session

HEADLINE = (
    "filtered_search", "embedding_search", "id_join_inner", "pending_extraction", "datasets_of_articles", "literature_graph_edges",
    "article_dataset_edges", "scan_signal", "scan_spans", "profile_lineitem", "profile_documents", "meta_analysis", "meta_analysis_tails",
    "compare_identifications", "compare_quantitative", "compare_dep", "average_rank", "average_rank_pooled", "upsert_articles", "add_links",
    "file_category", "response_raw_data", "build_context", "pubmed_articles", "jats_text", "validate_articles",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=8, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    seconds = {}
    for name in names:
        if os.path.isdir(small):
            run(spark, name, small)
        seconds[name] = round(run(spark, name, folder), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()

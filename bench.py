"""Wall time of the headline queries, one JSON line.

BENCH_SF_DIR: folder of the tables (default sf0.1); BENCH_CPUS: local cores.
Every query is run once to warm up on the smallest tables, then timed to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.session import local_session  # noqa: E402
from quarry.workload.queries import REGISTERED  # noqa: E402

HEADLINE = (
    "elements_from_text",
    "elements_from_html",
    "token_counts",
    "html_table_markdown",
    "chunk_documents",
    "chunk_basic",
    "chunk_overlap",
    "chunk_semantic",
    "document_text",
    "hash_embed",
    "prepare_vectors",
    "index_upsert",
    "bm25_postings",
    "bm25_score",
    "bm25_search",
    "dense_topk",
    "semantic_search",
    "hybrid_rrf",
    "search_expanded",
    "hyde_search",
    "advanced_search",
    "search_chunks",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        for name in names:
            run(spark, name, smallest)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line.  Every query runs to completion through the
``noop`` sink (full execution, nothing collected).  ``index_build`` is
the one-time indexing job; the ranking queries then search the stored
index, as the reference searches its stored index.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trawl.operators.index import index_for  # noqa: E402
from trawl.plans.catalog import QUERIES  # noqa: E402
from trawl.session import build_session  # noqa: E402
from trawl.sources import tables  # noqa: E402

HEADLINE = (
    "tfidf_topk",
    "bm25_topk",
    "compare_models",
    "candidate_docs",
    "query_term_idf",
    "adhoc_search",
    "index_stats",
    "compare_analyzers",
    "corpus_documents",
    "topics_parse",
    "extract_tag",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session()
    # Warm-up outside the timings: JVM start and JIT compilation of the
    # code paths, by running the same queries once on the smallest tables.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm) and warm.rstrip("/") != sf_dir:
        index_for(spark, tables.corpus(spark, warm), warm, "standard")
        for key in HEADLINE:
            run(QUERIES[key](spark, warm))
    times: dict[str, float] = {}
    t = time.time()
    index_for(spark, tables.corpus(spark, sf_dir), sf_dir, "standard")
    times["index_build"] = time.time() - t
    for key in HEADLINE:
        t = time.time()
        run(QUERIES[key](spark, sf_dir))
        times[key] = time.time() - t
    total = sum(times.values())
    print(json.dumps({"metric": "total_query_time", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()}, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

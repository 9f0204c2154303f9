"""Command line for the reference's three programs and its ad-hoc search.

  python -m trawl.cli index CORPUS_DIR INDEX_DIR [--analyzer standard] [--term new]
  python -m trawl.cli compare-analyzers CORPUS_DIR [--term new]
  python -m trawl.cli tfidf-runs INDEX_DIR TOPICS OUT_DIR [--k 1000]
  python -m trawl.cli model-runs INDEX_DIR TOPICS OUT_DIR [--k 1000]
  python -m trawl.cli all-docs INDEX_DIR "query text" OUT_DIR
  python -m trawl.cli adhoc INDEX_DIR "query text" [--k 10] [--model tfidf]
"""

from __future__ import annotations

import argparse

from trawl.operators import rank, stats
from trawl.operators.index import open_index, write_index
from trawl.session import build_session
from trawl.sources import runfiles, topics, trectext


def _corpus(spark, a):
    docs, rejected = trectext.read_trectext(spark, a.corpus, mode=a.mode, encoding=a.encoding,
                                              line_end={"lf": "\n", "cr": "\r"}[a.line_end])
    return trectext.number_documents(docs), rejected


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="trawl")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("index"); p.add_argument("corpus"); p.add_argument("index")
    p.add_argument("--analyzer", default="standard"); p.add_argument("--term", default="new")
    reads = [p]
    p = sub.add_parser("compare-analyzers"); p.add_argument("corpus"); p.add_argument("--term", default="new")
    for p in [*reads, p]:
        p.add_argument("--mode", choices=("split", "whole"), default="split")
        p.add_argument("--encoding", default="utf-8")
        p.add_argument("--line-end", choices=("lf", "cr"), default="lf")
    for name in ("tfidf-runs", "model-runs"):
        p = sub.add_parser(name); p.add_argument("index"); p.add_argument("topics"); p.add_argument("out")
        p.add_argument("--k", type=int, default=rank.DEFAULT_K)
    p = sub.add_parser("adhoc"); p.add_argument("index"); p.add_argument("query")
    p.add_argument("--k", type=int, default=10); p.add_argument("--model", default="tfidf")
    p = sub.add_parser("all-docs"); p.add_argument("index"); p.add_argument("query"); p.add_argument("out")
    a = ap.parse_args(argv)

    spark = build_session()
    if a.cmd == "index":
        docs, rejected = _corpus(spark, a)
        index = write_index(docs, a.index, a.analyzer)
        rejected.show(truncate=80)
        stats.index_stats(index, a.term).show(truncate=False)
    elif a.cmd == "compare-analyzers":
        docs, _ = _corpus(spark, a)
        stats.compare_analyzers(docs, a.term).show(truncate=False)
    elif a.cmd in ("tfidf-runs", "model-runs"):
        index = open_index(spark, a.index)
        parsed, rejected = topics.read_topics(spark, a.topics)
        rejected.show(truncate=80)
        queries = rank.query_forms(parsed)
        if a.cmd == "tfidf-runs":
            runfiles.write_tfidf_run(rank.ranked_runs(index, queries, ["tfidf"], a.k), a.out)
        else:
            runfiles.write_models_run(rank.ranked_runs(index, queries, list(rank.MODELS), a.k), a.out)
    elif a.cmd == "all-docs":
        rank.tfidf_all_docs(open_index(spark, a.index), a.query).write.option("header", True).csv(a.out)
    elif a.cmd == "adhoc":
        index = open_index(spark, a.index)
        if a.model == "tfidf":
            rank.tfidf_topk_all_docs(index, a.query, a.k).show(a.k, truncate=False)
        else:
            (rank.ranked_runs(index, rank.adhoc_queries(spark, a.query), [a.model], a.k)
             .orderBy("rank").show(a.k, truncate=False))
    spark.stop()


if __name__ == "__main__":
    main()

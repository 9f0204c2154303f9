"""Norm coding, idf and every ranker against a plain-Python brute force."""

import math

import pytest
from pyspark.sql import functions as F

from bruteforce import Corpus, qnorm
from trawl.functions.scoring import quantized_norm, tfidf_idf
from trawl.operators import rank
from trawl.operators.index import in_memory_index

DOCS = {
    1: "The quick brown fox jumps over the lazy dog.",
    2: "Quick quick fox; the fox is quick, QUICK!",
    3: "Airbus subsidies and government assistance to Airbus Industrie in 1987",
    4: "the and of",  # stop words only: counts in N, has no postings
    5: "A fox, a dog and a brown bear; subsidies for the dog. " * 3,
}
QUERIES = {
    (1, "title"): "quick fox",
    (1, "desc"): "Quick brown fox fox and an unseenterm",
    (2, "title"): "Airbus Subsidies",
    (2, "desc"): "the",  # only a stop word: no terms, no results
}


@pytest.fixture(scope="module")
def index(spark):
    corpus = spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string")
    return in_memory_index(corpus)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(q, f, t) for (q, f), t in QUERIES.items()],
                                 "query_id int, form string, text string")


def test_quantized_norm_matches_bit_coding(spark):
    import random
    rnd = random.Random(7)
    dls = (list(range(0, 3000)) + [4095, 4096, 4097, 65535, 65536, 1_000_000, 123_456_789]
           + [rnd.randrange(3000, 10**9) for _ in range(20000)])
    df = spark.createDataFrame([(d,) for d in dls], "dl long")
    got = {r["dl"]: r["n"] for r in df.select("dl", quantized_norm(F.col("dl")).alias("n")).collect()}
    assert got[0] is None
    for d in dls[1:]:
        assert got[d] == qnorm(d), d


def test_idf_uses_integer_division(spark):
    df = spark.createDataFrame([(10, 3), (10, 0), (7, 7)], "n long, df long")
    got = [r[0] for r in df.select(tfidf_idf(F.col("n"), F.col("df"))).collect()]
    assert got == [math.log(1 + 3), 0.0, math.log(2)]


def test_every_ranker_matches_brute_force(index, queries):
    brute = Corpus(DOCS)
    got = rank.score(index, queries, rank.ALL_SCORES).collect()
    expect = {(q, f): brute.scores(text) for (q, f), text in QUERIES.items()}
    seen = {(r["query_id"], r["form"], r["doc_id"]) for r in got}
    want = {(q, f, d) for (q, f), s in expect.items() for d in s["tfidf"]}
    assert seen == want
    for r in got:
        for m in rank.ALL_SCORES:
            assert r[m] == pytest.approx(expect[(r["query_id"], r["form"])][m][r["doc_id"]], rel=1e-12), m


def test_runs_rank_best_first_and_tie_on_doc_id(index, queries):
    run = rank.ranked_runs(index, queries, ["tfidf", "bm25"], k=2).collect()
    by_run = {}
    for r in run:
        by_run.setdefault((r["run_id"], r["query_id"]), []).append(r)
    assert {k for k in by_run} == {("myAlgo_short", 1), ("myAlgo_long", 1), ("myAlgo_short", 2),
                                   ("BM25_short", 1), ("BM25_long", 1), ("BM25_short", 2)}
    for rows in by_run.values():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert all(a["score"] >= b["score"] for a, b in zip(rows, rows[1:]))
        assert all(r["q"] == ("Q0" if r["run_id"].endswith("short") else "Q1") for r in rows)


def test_all_documents_listing_keeps_zeros(index):
    rows = rank.tfidf_all_docs(index, "fox").collect()
    assert [r["doc_id"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r["score"] > 0 for r in rows] == [True, True, False, False, True]
    top = rank.tfidf_topk_all_docs(index, "airbus", k=3).collect()
    # lowest score first; zero scores fill the list in doc-id order
    assert [r["doc_id"] for r in top] == [2, 1, 3]
    assert [r["score"] for r in top][:2] == [0.0, 0.0]


def test_candidates_are_documents_with_a_query_term(index, queries):
    got = {(r["query_id"], r["form"], r["doc_id"]) for r in rank.candidate_docs(index, queries).collect()}
    assert got == {(1, "title", 1), (1, "title", 2), (1, "title", 5), (1, "desc", 1), (1, "desc", 2),
                   (1, "desc", 5), (2, "title", 3), (2, "title", 5)}


def test_exact_norm_changes_scores_not_candidates(index, queries):
    exact = rank.score(index, queries, ["tfidf"], rank.S.ModelParams(norm_mode="exact")).collect()
    quant = rank.score(index, queries, ["tfidf"]).collect()
    assert {(r[0], r[1], r[2]) for r in exact} == {(r[0], r[1], r[2]) for r in quant}


def test_bad_k_and_model_rejected(index, queries):
    with pytest.raises(ValueError):
        rank.ranked_runs(index, queries, ["tfidf"], k=0)
    with pytest.raises(ValueError):
        rank.ranked_runs(index, queries, ["nope"], k=5)


def test_excluded_documents_are_not_ranked(spark, index, queries):
    gone = spark.createDataFrame([(2,)], "doc_id long")
    run = rank.ranked_runs(index, queries, ["bm25"], k=10, exclude=gone).collect()
    assert run and all(r["docno"] != "2" for r in run)
    full = rank.ranked_runs(index, queries, ["bm25"], k=10).collect()
    assert any(r["docno"] == "2" for r in full)


def test_vsm_factors_and_avgdl_switches(index, queries):
    base = {(r[0], r[1], r[2]): r[3] for r in rank.score(index, queries, ["vsm"]).collect()}
    bare = {(r[0], r[1], r[2]): r[3] for r in
            rank.score(index, queries, ["vsm"], rank.S.ModelParams(coord=False, query_norm=False)).collect()}
    assert base.keys() == bare.keys()
    assert any(abs(base[k] - bare[k]) > 1e-9 for k in base)
    b1 = rank.score(index, queries, ["bm25"]).collect()
    b2 = rank.score(index, queries, ["bm25"], rank.S.ModelParams(avgdl_over="with_terms")).collect()
    assert len(b1) == len(b2) and {r[3] for r in b1} != {r[3] for r in b2}

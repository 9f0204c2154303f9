"""The plans taken for large query sets give the same runs as the small-set plans.

Thresholds are lowered so the tiny fixture takes the shuffle joins (no
broadcast) and the shuffled docno fetch.
"""

import pytest

from trawl.operators import rank
from trawl.operators.index import in_memory_index
from test_scoring import DOCS, QUERIES


@pytest.fixture(scope="module")
def index(spark):
    corpus = spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string")
    return in_memory_index(corpus)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(q, f, t) for (q, f), t in QUERIES.items()], "query_id int, form string, text string")


def runs(index, queries):
    return sorted(tuple(r) for r in rank.ranked_runs(index, queries, list(rank.ALL_SCORES), k=3).collect())


def test_distributed_query_side_and_shuffle_joins(index, queries, monkeypatch):
    expected = runs(index, queries)
    monkeypatch.setattr(rank, "BROADCAST_QUERY_BYTES", 0)
    monkeypatch.setattr(rank, "BROADCAST_TABLE_BYTES", 0)
    side = rank.QuerySide(index, queries)
    assert not side.broadcast
    assert runs(index, queries) == expected


def test_candidates_and_idf_on_distributed_side(index, queries, monkeypatch):
    expected = sorted(tuple(r) for r in rank.candidate_docs(index, queries).collect())
    monkeypatch.setattr(rank, "BROADCAST_QUERY_BYTES", 0)
    assert sorted(tuple(r) for r in rank.candidate_docs(index, queries).collect()) == expected


def test_salted_join_for_hot_terms(index, queries, monkeypatch):
    expected = runs(index, queries)
    monkeypatch.setattr(rank, "BROADCAST_QUERY_BYTES", 0)
    monkeypatch.setattr(rank, "HOT_MIN_DF", 1)
    monkeypatch.setattr(rank, "HOT_DF_FRACTION", 0.5)   # "fox" (df 3 of 5) counts as hot
    monkeypatch.setattr(rank, "SALT_BUCKETS", 4)
    side = rank.QuerySide(index, queries)
    assert not side.broadcast
    assert "salt" in side.matches()._jdf.queryExecution().optimizedPlan().toString()
    assert runs(index, queries) == expected


def test_negative_ids_and_unknown_forms(spark, index):
    q = spark.createDataFrame([(-1, "title", "fox"), (-2, "desc", "fox"), (0, "adhoc", "fox")], "query_id int, form string, text string")
    got = {(r["query_id"], r["q"]) for r in rank.ranked_runs(index, q, ["bm25"], k=2).collect()}
    assert got == {(-1, "Q0"), (-2, "Q1"), (0, "Q0")}
    bad = spark.createDataFrame([(1, "other", "fox"), (2, None, "fox")], "query_id int, form string, text string")
    with pytest.raises(Exception, match="unknown query form"):
        rank.ranked_runs(index, bad, ["bm25"], k=2).collect()


def _jobs(spark, build):
    """Jobs started while ``build`` runs."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted")
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_building_postings_and_runs_starts_no_job(spark, queries, tmp_path):
    from trawl.operators.index import build_postings, write_index
    corpus = spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string")
    assert _jobs(spark, lambda: build_postings(corpus)) == 0
    stored = write_index(corpus, str(tmp_path / "it's an index"))
    assert _jobs(spark, lambda: rank.ranked_runs(stored, queries, list(rank.ALL_SCORES), k=3)) == 0
    assert runs(stored, queries) == runs(stored, queries)


def test_index_build_moves_the_text_once(spark):
    from trawl.operators.index import build_postings
    corpus = spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string")
    plan = build_postings(corpus.repartition(5, "doc_id"), placed=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_top_k_above_the_limit_threshold_keeps_the_partial_limit(spark):
    from pyspark.sql import functions as F

    from trawl.operators.topk import top_k_per_group
    scored = spark.range(40_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("doc_id"), (F.col("id") % 101).cast("double").alias("score"))
    one = top_k_per_group(scored, 5000, ["g"])
    assert one._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    two = top_k_per_group(scored, 5000, ["g"], parts=7)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.count() == 15_000


def test_reopening_an_index_adds_no_tables(spark, tmp_path):
    from trawl.operators.index import open_index, write_index
    corpus = spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string")
    write_index(corpus, str(tmp_path / "i"))
    before = len(spark.catalog.listTables())
    open_index(spark, str(tmp_path / "i"))
    write_index(corpus, str(tmp_path / "i"))
    assert len(spark.catalog.listTables()) == before

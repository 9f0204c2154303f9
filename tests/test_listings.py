"""Dense numbers in a global order, listings with their positions, depths per query."""

import random

import pytest
from pyspark.sql import functions as F

from trawl.operators import rank, stats
from trawl.operators.index import in_memory_index
from trawl.operators.topk import numbered
from test_scoring import DOCS, QUERIES

RNG = random.Random(8)


@pytest.fixture(scope="module")
def index(spark):
    return in_memory_index(spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string"))


def test_numbers_are_dense_and_in_order(spark):
    # A third of the rows share their first key; the second one orders them.
    rows = [(RNG.choice([None, "hot", f"k{i}"]), i) for i in RNG.sample(range(5000), 5000)]
    frame = spark.createDataFrame(rows, "key string, id long").repartition(13)
    got = sorted((r.n, r.key, r.id) for r in numbered(frame, ["key", "id"], "n", start=5).collect())
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == [(i + 5, *r) for i, r in enumerate(want)]
    down = numbered(frame, [F.desc("id")], "n")
    assert sorted((r.n, r.id) for r in down.collect()) == [(i, 4999 - i) for i in range(5000)]
    # Read twice, the numbers are the same.
    assert {r.n: r.id for r in down.collect()} == {r.n: r.id for r in down.collect()}


def test_numbers_of_ties_and_empty_tables(spark):
    ties = numbered(spark.createDataFrame([("x",)] * 50, "key string"), ["key"], "n")
    assert sorted(r.n for r in ties.collect()) == list(range(50))
    empty = numbered(ties.select("key").where("false"), ["key"], "n")
    assert empty.columns == ["key", "n"] and empty.collect() == []


def test_the_rows_meet_in_no_window(spark, index):
    """Only the partitions' counts are in the window without a key."""
    plan = stats.vocabulary_ids(index)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Window")]
    assert plan.count("Window") == 1 and "Aggregate" in plan[plan.index("Window"):] and "Join" in above


def test_vocabulary_ids(index):
    terms = sorted(r.term for r in index.terms.collect())
    assert sorted((r.term_id, r.term) for r in stats.vocabulary_ids(index).collect()) == list(enumerate(terms))


def test_listings(index):
    word = next(iter(QUERIES.values())).split()[0]
    every = [(r.doc_id, r.score) for r in rank.tfidf_all_docs(index, word).collect()]
    assert sorted((r.position, r.doc_id, r.score) for r in rank.all_docs_listing(index, word).collect()) == [
        (i + 1, *row) for i, row in enumerate(every)]
    best = [(r.doc_id, r.score) for r in rank.tfidf_topk_all_docs(index, word, 3).collect()]
    assert sorted((r.position, r.doc_id, r.score) for r in rank.topk_listing(index, word, 3).collect()) == [
        (i + 1, *row) for i, row in enumerate(best)]


def test_depths(spark, index):
    queries = spark.createDataFrame([(q, f, t) for (q, f), t in QUERIES.items()], "query_id int, form string, text string")
    ids = sorted({q for q, _ in QUERIES})
    depth = dict(zip(ids, [2, 0, None, 1, -3] * len(ids)))
    depths = spark.createDataFrame(list(depth.items()), "query_id int, k long")
    runs, rejected = rank.runs_at_depths(index, queries, depths, ["bm25", "lm_jm"])
    full = rank.ranked_runs(index, queries, ["bm25", "lm_jm"], 50)
    want = sorted(tuple(r) for r in full.collect() if (depth[r.query_id] or 0) >= r["rank"])
    assert sorted(tuple(r) for r in runs.select(*full.columns).collect()) == want
    assert {r.query_id: r.reason for r in rejected.collect()} == {
        q: f"k must be positive, not {'null' if k is None else k}" for q, k in depth.items() if k is None or k <= 0}
    runs, rejected = rank.runs_at_depths(index, queries, depths.where("k < 0"), ["bm25"])
    assert runs.collect() == [] and all("positive" in r.reason for r in rejected.collect())

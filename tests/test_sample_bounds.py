"""Runs whose scores are bounded by a sample of the documents are the runs without it."""

import random

import pytest

from trawl.operators import rank
from trawl.operators.index import delete_documents, write_index


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    r = random.Random(3)
    rows = [(d, " ".join(r.choices([f"w{i}" for i in range(12)], k=r.randrange(0, 9)) + [f"rare{d % 60}"])) for d in range(-200, 200)]
    rows += [(7, "w1 w2 w2"), (None, "w1 w3")]                  # an id that comes twice, and none
    rows += [(1000 + i, "w1 w2") for i in range(60)]            # ties
    return write_index(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path_factory.mktemp("i") / "i"), buckets=4)


def _stored(spark, rows, path):
    """Queries of known size, which are broadcast."""
    spark.createDataFrame(rows, "query_id int, form string, text string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def queries(spark, tmp_path_factory):
    rows = [(q, f, t) for q, t in enumerate(["w1 w2", "w3 rare5 w3", "rare7", "w4 w5 w6 nowhere", "nowhere", ""]) for f in ("title", "desc")]
    return _stored(spark, rows, str(tmp_path_factory.mktemp("q") / "q"))


def _runs(index, queries, models, k, **more):
    return sorted(map(tuple, rank.ranked_runs(index, queries, models, k, **more).collect()), key=str)


@pytest.mark.parametrize(("models", "k"), [(["lm_jm"], 10), (["tfidf", "bm25"], 3)])
def test_same_runs_with_and_without_a_sample(spark, index, queries, monkeypatch, models, k):
    gone = spark.range(0, 150, 3).withColumnRenamed("id", "doc_id")
    assert rank.sample_share(index.stats.n_docs, k) > 1
    got = [_runs(index, queries, models, k), _runs(index, queries, models, k, exclude=gone)]
    monkeypatch.setattr(rank, "SAMPLE_FROM", 1 << 40)
    assert rank.sample_share(index.stats.n_docs, k) == 1
    assert got == [_runs(index, queries, models, k), _runs(index, queries, models, k, exclude=gone)]


def test_only_rows_that_can_win_are_sorted(index, queries, monkeypatch):
    kept = []
    real = rank.top_k_per_group
    monkeypatch.setattr(rank, "top_k_per_group", lambda rows, *a, **b: kept.append(rows.groupBy("qkey").count().collect()) or real(rows, *a, **b))
    run = rank.ranked_runs(index, queries, ["bm25"], 1).collect()
    matched = rank.candidate_docs(index, queries).count()
    assert len(run) < sum(r["count"] for r in kept[0]) < matched / 2


def test_deleted_documents_do_not_bound(spark, tmp_path):
    """Deleted documents would be the best: a bound taken from them would leave no row."""
    rows = [(d, "fox " * 9 if d % 2 else "fox cat dog") for d in range(400)]
    idx = write_index(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "i"), buckets=4)
    idx = delete_documents(idx, spark.range(1, 400, 2).withColumnRenamed("id", "doc_id"))
    run = _runs(idx, _stored(spark, [(1, "title", "fox")], str(tmp_path / "q")), ["bm25"], 5)
    assert sorted(int(r[2]) for r in run) == [0, 2, 4, 6, 8]

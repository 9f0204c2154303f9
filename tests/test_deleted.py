"""Deleted documents beside the postings, and statistics observed while an index is written."""

import random

import pytest
from pyspark.sql import functions as F

from trawl.operators import rank
from trawl.operators.index import build_postings, delete_documents, open_index, stats_frame, term_stats, vocabulary_estimate, write_index


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = [(d, str(d), " ".join(f"w{rng.randrange(5 + d % 90)}" for _ in range(rng.randrange(0, 20)))) for d in range(400)]
    return spark.createDataFrame(rows, "doc_id long, docno string, text string")


@pytest.fixture(scope="module")
def queries(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("queries") / "q")
    spark.createDataFrame([(1, "title", "w1 w2"), (2, "title", "w50"), (3, "desc", "w3 w70 nowhere")],
                          "query_id int, form string, text string").write.parquet(path)
    return spark.read.parquet(path)


def _runs(index, queries, **kw):
    return sorted(tuple(r) for r in rank.ranked_runs(index, queries, list(rank.ALL_SCORES), k=300, **kw).collect())


@pytest.mark.parametrize("layout", ["bucketed", "docpart", "range"])
@pytest.mark.parametrize("limit", [rank.BROADCAST_TABLE_BYTES, 0])
def test_half_of_all_documents_deleted(spark, corpus, queries, tmp_path, monkeypatch, layout, limit):
    path = str(tmp_path / "i")
    index = write_index(corpus, path, layout=layout, buckets=4)
    odd = corpus.where("doc_id % 2 = 1").select("doc_id")
    want = _runs(index, queries, exclude=odd)
    assert want != _runs(index, queries)
    monkeypatch.setattr(rank, "BROADCAST_TABLE_BYTES", limit)
    assert _runs(index, queries, exclude=odd) == want
    index = delete_documents(index, corpus.where("doc_id % 4 = 1").select("doc_id"))
    index = delete_documents(index, odd)
    assert index.deleted.count() == 200
    assert _runs(index, queries) == want and _runs(open_index(spark, path), queries) == want
    assert rank.candidate_docs(index, queries).where("doc_id % 2 = 1").count() == 0
    if layout == "bucketed" and not limit:
        plan = rank._score(index, rank.QuerySide(index, queries), ["bm25"], rank.S.ModelParams())._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Exchange hashpartitioning(qkey" not in plan[:plan.index("Union")]
    assert write_index(corpus, path, layout=layout, buckets=4).deleted is None


@pytest.mark.parametrize("layout", ["bucketed", "docpart", "range"])
def test_observed_statistics(spark, corpus, tmp_path, layout):
    index = write_index(corpus, str(tmp_path / "i"), layout=layout, buckets=4)
    postings = build_postings(corpus)
    assert index.stats_df.collect() == stats_frame(index.docs, postings, term_stats(postings)).collect()
    empty = write_index(corpus.limit(0), str(tmp_path / "e"), layout=layout, buckets=4)
    assert tuple(empty.stats_df.first()) == (0, 0, 0, 0, 0)


def test_merged_vocabulary_sketch(spark, tmp_path):
    def part(low, high, name):
        docs = spark.range(low, high).select(F.col("id").alias("doc_id"), F.concat_ws(
            " ", *[F.concat(F.lit("t"), F.col("id") * 10 + i) for i in range(10)]).alias("text"))
        return write_index(docs, str(tmp_path / name), buckets=4)
    a, b = part(0, 2000, "a"), part(1000, 3000, "b")
    assert vocabulary_estimate([a, b]).first()[0] == pytest.approx(30_000, rel=0.03)
    assert vocabulary_estimate([a]).first()[0] == pytest.approx(20_000, rel=0.03)

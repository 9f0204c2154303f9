"""What a topic run reads and merges: lists of rare terms, and buckets that send their share of k."""

import random

import pytest
from pyspark.sql import functions as F

from trawl.operators import index as index_module
from trawl.operators import rank, stats, topk
from trawl.operators.index import in_memory_index, write_index


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    common = [f"common{i}" for i in range(6)]
    rows = [(d, str(d), " ".join(rng.choices(common, k=rng.randrange(0, 12)) + [f"rare{rng.randrange(400)}" for _ in range(8)])) for d in range(300)]
    return spark.createDataFrame([*rows, (900, "900", ""), (901, "901", None)], "doc_id long, docno string, text string")


@pytest.fixture(scope="module")
def queries(spark, tmp_path_factory):
    rows = [(i, "title", f"common{i % 6} rare{7 * i} rare{7 * i + 1} nowhere") for i in range(12)] + [(50, "desc", "rare3"), (51, "desc", "common1 common2")]
    path = str(tmp_path_factory.mktemp("queries") / "q")       # files, so the planner knows the size
    spark.createDataFrame(rows, "query_id int, form string, text string").write.parquet(path)
    return spark.read.parquet(path)


def _runs(index, queries, k=40, **kw):
    return sorted(tuple(r) for r in rank.ranked_runs(index, queries, list(rank.ALL_SCORES), k=k, **kw).collect())


def _cut(monkeypatch, cut, rows=4096):
    monkeypatch.setattr(index_module, "LIST_DF", cut)
    monkeypatch.setattr(index_module, "LIST_ROWS", rows)


@pytest.mark.parametrize("cut,rows", [(20, 4096), (20, 3), (0, 4096), (10_000, 5)])
def test_lists_and_common_postings_are_all_postings(spark, corpus, queries, tmp_path, monkeypatch, cut, rows):
    plain = in_memory_index(corpus)
    _cut(monkeypatch, cut, rows)
    for layout in ("bucketed", "docpart"):
        idx = write_index(corpus, str(tmp_path / layout), layout=layout, buckets=4)
        assert sorted(map(tuple, idx.postings.select("term", "doc_id", "tf", "dl").collect())) == sorted(
            map(tuple, plain.postings.select("term", "doc_id", "tf", "dl").collect()))
        assert idx.lists.select(F.max(F.size("docs"))).first()[0] in (None, *range(1, cut + 1))
        assert _runs(idx, queries) == _runs(plain, queries)
        assert sorted(map(tuple, stats.term_postings(idx, "rare3").collect())) == sorted(map(tuple, stats.term_postings(plain, "rare3").collect()))
        assert rank.candidate_docs(idx, queries).count() == rank.candidate_docs(plain, queries).count()


def test_the_cut_bounds_the_common_terms(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(index_module, "MAX_COMMON_TERMS", 3)
    idx = write_index(corpus, str(tmp_path / "i"), buckets=4)
    assert idx.common.select("term").distinct().count() <= 3


def test_a_run_moves_no_match_rows(spark, corpus, queries, tmp_path, monkeypatch):
    _cut(monkeypatch, 20)
    idx = write_index(corpus, str(tmp_path / "i"), buckets=4)
    plan = rank._score(idx, rank.QuerySide(idx, queries), ["bm25"], rank.S.ModelParams())._jdf.queryExecution().executedPlan().toString()
    union = plan.index("Union")                        # the aggregate is above the join with it, without an exchange between
    assert "Exchange hashpartitioning(qkey" not in plan[:union] and "Bucketed: true" in plan


def test_rows_read_for_topics(spark, tmp_path):
    """At most twice the postings that match: the common terms' and the lists' of the topics."""
    from trawl.plans.catalog import _queries
    from trawl.sources import tables
    sf = "/root/testdata/sf0.01"
    idx = write_index(tables.corpus(spark, sf), str(tmp_path / "i"))
    side = rank.QuerySide(idx, _queries(spark, sf))
    matched = side.found.agg(F.sum("df")).first()[0]
    read = side.postings().count()
    assert read < 0.75 * idx.stats.postings and read <= 2 * matched


@pytest.mark.parametrize("kind", ["hashed", "one bucket", "ties", "few"])
def test_two_passes_equal_one(spark, kind):
    rng = random.Random(kind)
    n, k, buckets = 3000, 64, 32
    rows = []
    for g in range(3):
        for d in range(30 if kind == "few" else n):
            b = d % buckets if kind != "one bucket" else (5 if d % 7 == 0 else d % buckets)
            s = rng.random() + (10 if b == 5 and kind == "one bucket" else 0) if kind != "ties" else 1.0
            rows.append((g, d, b, s))
    table = spark.createDataFrame(rows, "g int, doc_id long, b int, score double")
    assert topk.worth_two_passes(k * 8, buckets * 8)
    asked = []

    def again(cells):
        asked.extend(cells.collect())
        return table
    got = topk.top_k_of_buckets(table, again, k, ["g"], F.col("b"), buckets)
    want = topk.top_k_per_group(table, k, ["g"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert bool(asked) == (kind == "one bucket")


def test_buckets_send_their_share(spark, corpus, queries, tmp_path, monkeypatch):
    idx = write_index(corpus, str(tmp_path / "i"), buckets=64)
    assert topk.worth_two_passes(120, 64)
    want = _runs(in_memory_index(corpus), queries, k=120)
    sent = []
    read = topk.top_k_per_group
    monkeypatch.setattr(topk, "top_k_per_group", lambda rows, *a, **kw: sent.append(rows.count()) or read(rows, *a, **kw))
    assert _runs(idx, queries, k=120) == want
    assert sent[0] <= 5 * 14 * 64 * topk.bucket_share(120, 64)
    monkeypatch.setattr(topk, "bucket_share", lambda k, n: 1)         # too small a share: nearly every bucket is asked again
    assert _runs(idx, queries, k=120) == want

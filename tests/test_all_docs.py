"""Scores of all documents for whole query sets."""

import pytest

from trawl.operators import rank
from trawl.operators.index import in_memory_index
from test_scoring import DOCS, QUERIES


@pytest.fixture(scope="module")
def index(spark):
    return in_memory_index(spark.createDataFrame([(d, str(d), t) for d, t in DOCS.items()], "doc_id long, docno string, text string"))


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(q, f, t) for (q, f), t in QUERIES.items()] + [(90, "title", ""), (91, "title", "nowhere"), (92, "desc", None)]
    return spark.createDataFrame(rows, "query_id int, form string, text string")


@pytest.mark.parametrize("k", [1, 2, 3, 5, 50])
@pytest.mark.parametrize("model", ["tfidf", "bm25"])
def test_zero_scores_fill_every_query(index, queries, k, model):
    got = {}
    for r in rank.topk_all_docs(index, queries, model, k).collect():
        got.setdefault((r.query_id, r.form), []).append((r["rank"], r.doc_id, r.score))
    scored = {}
    for r in rank.score(index, queries, [model]).collect():
        scored.setdefault((r.query_id, r.form), {})[r.doc_id] = round(r[model], 6)
    want = {}
    for q in queries.collect():
        own = scored.get((q.query_id, q.form), {})
        best = sorted((-own.get(d, 0.0), d) for d in DOCS)[:k]
        want[q.query_id, q.form] = [(i + 1, d, -s) for i, (s, d) in enumerate(best)]
    assert {q: sorted(v) for q, v in got.items()} == {q: [(r, d, pytest.approx(s, abs=1e-6)) for r, d, s in v] for q, v in want.items()}


def test_no_cross_join_in_the_plan(index, queries):
    plan = rank.topk_all_docs(index, queries, "tfidf", 3)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_k_must_be_positive(index, queries):
    for k in (0, -1):
        with pytest.raises(ValueError):
            rank.topk_all_docs(index, queries, "tfidf", k)

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import ann


def test_hilbert_is_a_curve_through_every_cell():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array(v))
    out = []
    for q in sorted(good):
        if q % 10 == 0:
            near = sorted((float(np.sqrt(((good[i] - good[q]) ** 2).sum())), i) for i in good if i != q)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0] + [0.0] * 5) for i in range(120)]                # a vector shared by many
    bad = [None, [0.0] * 6, [1.0, None] + [0.0] * 4, [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [1.0, 2.0], []]
    return rows + [(1000 + 10 * i, b) for i, b in enumerate(bad)] + [(None, [1.0] * 6), rows[5]]


SCHEMA = "vec_id long, embedding array<double>, id int, score string"


def test_exact_with_wide_windows(spark, rows):
    table = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], SCHEMA)
    got = ann.search(table, F.col("vec_id") % 10 == 0, k=10, window=10_000)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    have = sorted(tuple(r) for r in got.collect())
    want = _brute(rows, 10)
    assert [h[:3] for h in have] == [w[:3] for w in want]
    np.testing.assert_allclose([h[3] for h in have], [w[3] for w in want], rtol=1e-12)


def test_fewer_candidates_and_empty(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0], 1, "s"), (1, [2.0, 2.0], 1, "s"), (2, [0.0, 0.0], 1, "s")], SCHEMA)
    got = [tuple(r) for r in ann.search(table, F.col("vec_id") == 0, k=10).collect()]
    assert got == [(0, 1, 1, 1.0)]
    assert ann.search(table.limit(0), F.col("vec_id") == 0).collect() == []
    assert ann.search(table, F.lit(False)).collect() == []


def test_recall(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(3000, 24))
    table = spark.createDataFrame([(i, v.tolist(), 0, "") for i, v in enumerate(vectors)], SCHEMA)
    got = {}
    for r in ann.search(table, F.col("vec_id") % 100 == 0, k=10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 100):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits / 300 >= 0.9


@pytest.mark.parametrize("n,window", [(12, 1000), (40, 41), (300, 290), (300, 3000)])
def test_windows_beyond_a_curve(spark, n, window):
    rng = np.random.default_rng(n)
    some = [(i, rng.normal(size=6).tolist()) for i in range(n)]
    table = spark.createDataFrame([(i, v, 0, "") for i, v in some], SCHEMA)
    have = sorted(tuple(r)[:3] for r in ann.search(table, F.col("vec_id") % 10 == 0, k=10, window=window).collect())
    assert have == [w[:3] for w in _brute(some, 10)]


def test_huge_components_and_repeated_ids(spark):
    big = [(0, [3e200, 0.0]), (1, [3e200, 4e200]), (2, [-1.0, 1e200]), (2, [5.0, 5.0]), (2, [-1.0, 1e200])]
    table = spark.createDataFrame([(i, v, 0, "") for i, v in big], SCHEMA)
    got = [tuple(r) for r in ann.search(table, F.col("vec_id") == 0, k=10).orderBy("rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 2), (0, 2, 1)]
    np.testing.assert_allclose([g[3] for g in got], [10 ** 0.5 * 1e200, 4e200], rtol=1e-12)

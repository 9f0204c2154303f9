import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import quality

SF = "/root/testdata/sf0.01"


def test_tokens_and_features():
    found, counts = quality.tokens(["The cat, the CAT!!", "", "  ", "é%%%", "a a a"])
    assert counts.tolist() == [6, 0, 0, 2, 3]
    assert len(set(found[:6].tolist())) == 6                  # case and punctuation tell tokens apart
    buckets, owner, counts = quality.features(["a a a", "", "b c"])
    assert np.bincount(owner, minlength=3).tolist() == [5, 0, 3]
    assert buckets.min() >= 0 and buckets.max() < quality.BUCKETS


def test_counts_match_brute_force(spark):
    rows = [("a b a", True), ("b", False), ("", True), ("a b a", False)] * 5
    got = {r.bucket: (r.raw, r.target) for r in quality.ngram_counts(
        spark.createDataFrame(rows, "text string, target boolean").repartition(4)).collect()}
    want = {}
    for text, good in rows:
        for b in quality.features([text])[0].tolist():
            raw, target = want.get(b, (0, 0))
            want[b] = (raw + 1, target + good)
    assert got == want


@pytest.mark.parametrize("k", [0, 1, 3, 500, 999, 1000, 2000])
def test_kth_largest(spark, k):
    values = np.random.default_rng(3).gumbel(size=1000).tolist()
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    cut = quality.largest(rows, "v", k)
    assert sum(v >= cut for v in values) == min(k, 1000)


def test_kth_largest_of_keys_in_one_cell(spark, monkeypatch):
    """One extreme key stretches the range until all others share a cell."""
    monkeypatch.setattr(quality, "CELL_ROWS", 10)
    rng = np.random.default_rng(5)
    values = [1e12, -1e13] + rng.gumbel(size=500).tolist() + [0.25] * 200
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 30, 300, 500, 701):
        assert quality.largest(rows, "v", k) == ranked[k - 1]


def test_weights_draw_and_kept_match_brute_force(spark):
    """Another implementation of the tokens, the two models, the noise and the draw; hashes are the module's."""
    import math
    import re
    from collections import Counter
    rng = np.random.default_rng(9)
    words = ["alpha", "Beta", "gamma", "delta!", "e e", "(zeta)"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 25)))) for i in range(120)] + [(200, None), (201, "")]
    good = {i for i in range(0, 120, 3)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(60)], "doc_id long, quality int")
    good &= set(range(60))

    def grams(text):
        toks = re.findall(r"[a-z]+|[^a-z\s]", (text or "").lower())
        return [(t,) for t in toks] + [("=",) if a == b else (a, b) for a, b in zip(toks, toks[1:])]
    raw = Counter(g for _, t in rows for g in grams(t))
    target = Counter(g for i, t in rows if i in good for g in grams(t))
    size = quality.BUCKETS
    s, n = quality.SMOOTHING, sum(target.values())
    temper = n / sum(raw.values())

    def ratio(g):
        return math.log((target[g] + s) / (n + s * size)) - math.log((raw[g] * temper + s) / (n + s * size))
    got = {r.doc_id: r for r in quality.resample(docs, labels, keep_share=0.3).collect()}
    # Buckets of 2 ** 20 or so: no collisions among these few grams.
    for i, t in rows:
        if grams(t):
            assert got[i].log_weight == pytest.approx(sum(ratio(g) for g in grams(t)), abs=1e-6)
        else:
            assert got[i].log_weight is None and not got[i].kept
    noise = {r.doc_id: r.g for r in docs.select("doc_id", quality.gumbel(F.col("doc_id"), 29).alias("g")).collect()}
    keys = sorted((got[i].log_weight + noise[i] for i, t in rows if grams(t)), reverse=True)
    k = round(0.3 * len(rows))
    assert {i for i in got if got[i].kept} == {i for i, t in rows if grams(t) and got[i].log_weight + noise[i] >= keys[k - 1]}


def test_cases(spark):
    rows = [(1, "good text here"), (2, None), (3, ""), (None, "good text"), (4, "%%% !!"), (4, "%%% !!")]
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, log_weight double")
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (3, None), (1, 1)], "doc_id long, quality int")
    got = quality.resample(docs, labels, keep_share=0.5)
    assert got.columns == ["doc_id", "log_weight", "draw_key", "kept"]
    out = got.collect()
    assert len(out) == 6 and all((r.log_weight is None) == (r.doc_id in (2, 3)) for r in out)
    assert not any(r.kept for r in out if r.log_weight is None)
    assert quality.resample(docs.limit(0), labels).collect() == []
    assert {r.log_weight for r in quality.resample(docs, labels.limit(0), 1.0).collect()} == {0.0, None}


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = quality.weigh(docs, labels.where(~held)).join(labels.where(held), "doc_id").toPandas()
    good, bad = got.log_weight[got.quality == 1].to_numpy(), got.log_weight[got.quality == 0].to_numpy()
    assert len(bad) > 5 and (good[:, None] > bad[None, :]).mean() > 0.95

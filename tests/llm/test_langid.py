import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import langid

SF = "/root/testdata/sf0.01"
ROWS = [(i, "en", t) for i, t in enumerate(["the cat and the dog", "a dog sat on the mat", "this is the house"] * 6)] + \
       [(100 + i, "de", t) for i, t in enumerate(["der hund und die katze", "das ist ein haus", "die maus und der mann"] * 6)]
SCHEMA = "doc_id long, lang string, text string"


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.createDataFrame(ROWS, SCHEMA))


def _brute(rows, lang, text):
    """Code length from dictionaries of contexts, byte by byte."""
    def raw(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).encode()
    counts = {}
    for _, own, t in rows:
        if own == lang:
            b = b"\n" * langid.ORDER + raw(t)
            for i in range(langid.ORDER, len(b)):
                for k in range(langid.ORDER + 1):
                    c = counts.setdefault(b[i - k:i], {})
                    c[b[i]] = c.get(b[i], 0) + 1
    b, bits = b"\n" * langid.ORDER + raw(text), 0.0
    for i in range(langid.ORDER, len(b)):
        for k in range(langid.ORDER, -1, -1):
            c = counts.get(b[i - k:i])
            if c is None:
                continue
            total, distinct = sum(c.values()), len(c)
            if b[i] in c:
                bits += math.log2((total + distinct) / c[b[i]])
                break
            bits += math.log2((total + distinct) / distinct)
        else:
            bits += 8
    return bits


def test_code_lengths_match_brute_force(model):
    texts = ["the dog", "der mann", "zebra QUIZ", "", "x", "日本", "the cat " * 300]
    got = model.code_lengths(texts)
    want = [[_brute(ROWS, lang, t) for lang in model.langs] for t in texts]
    assert model.langs == ["de", "en"]
    np.testing.assert_allclose(got, want, rtol=1e-5, atol=1e-4)


def test_long_text_in_pieces(model, monkeypatch):
    whole = model.code_lengths(["the mouse and der hund " * 500, "a"])
    monkeypatch.setattr(langid, "BATCH_BYTES", 1000)
    np.testing.assert_allclose(model.code_lengths(["the mouse and der hund " * 500, "a"]), whole, rtol=1e-6)


def test_cases(spark, model):
    rows = [(1, "the dog is on the mat"), (2, None), (3, ""), (4, "123 !? _"), (None, "die katze"), (5, "the dog"), (5, "the dog")]
    docs = spark.createDataFrame([(d, t, "x", 1.0) for d, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = [tuple(r) for r in langid.predict(docs, model).select("doc_id", "lang_pred", "score").collect()]
    assert [(d, p) for d, p, _ in got] == [(1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "de"), (5, "en"), (5, "en")]
    assert all(0 <= s <= 1 for *_, s in got) and got[1][2] == 0
    kept = langid.keep_identified(spark.createDataFrame([(d, t, None, 7) for d, t in rows],
                                                        "doc_id long, text string, lang string, extra int"), model)
    assert [tuple(r) for r in kept.collect()] == [(1, rows[0][1], "en", 7), (None, "die katze", "de", 7)] + [(5, "the dog", "en", 7)] * 2


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None, "the dog")], SCHEMA)
    assert [r.lang_pred for r in langid.identify(docs).collect()] == ["und"]
    assert langid.identify(docs.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert held[0] >= 0.98 and held[1] > 100


def test_code_lengths_are_those_of_all_grams(spark):
    """More distinct grams than any cut would keep, and null texts that must not thin the sample."""
    rng = np.random.default_rng(3)
    rows = [(i, "xx", "".join(map(chr, rng.integers(0x4E00, 0x9000, 4000)))) for i in range(10)]
    rows += [(1000 + i, "xx", None) for i in range(5000)] + [(2, "en", "the cat")]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    text = rows[3][2][:500] + "abc"
    want = [_brute([r for r in rows if r[2]], lang, text) for lang in model.langs]
    np.testing.assert_allclose(model.code_lengths([text])[0], want, rtol=1e-5)


def test_windows_bound_memory(monkeypatch):
    texts = ["abc" * 100, "", "x", "déf" * 50]
    buf, ends = langid._buffer(texts)
    whole = list(langid._windows(buf, ends))
    monkeypatch.setattr(langid, "BATCH_BYTES", 7)
    parts = list(langid._windows(buf, ends))
    assert max(len(k) for k, _ in parts) <= 7
    assert np.concatenate([k for k, _ in parts]).tolist() == whole[0][0].tolist()
    assert np.concatenate([o for _, o in parts]).tolist() == whole[0][1].tolist()

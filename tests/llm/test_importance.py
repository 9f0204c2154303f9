import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from trawl.llm import importance

SCHEMA = "doc_id long, text string, row int, part string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _buckets(text):
    w = _words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def _brute(rows, items):
    raw, target = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((raw, [t for _, t in rows]), (target, items)):
        for t in texts:
            np.add.at(counts, np.array(_buckets(t), int), 1)
    S, T = float(raw.sum()), float(target.sum())
    gain = [math.floor(1000 * math.log((t + 1) * (S + 10_000) / ((s + 1) * (T + 10_000)))) for s, t in zip(raw.tolist(), target.tolist())]
    out, ready = [], []
    for k, (i, text) in enumerate(rows):
        b = _buckets(text)
        weight = sum(gain[x] for x in b)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(_words(text)) >= 20:
                ready.append((-score, i, k))
        out.append([i, len(b), weight, score, None])
    for r, (_, _, k) in enumerate(sorted(ready)[:5 * len(ready) // 100]):
        out[k][4] = r + 1
    return sorted(map(tuple, out), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    words = ["Alpha", "beta", "γάμμα", "d3lta", "x", "w" * 70, "v" * 5000, "naïve"]
    gaps = [" ", "\n", ", ", "\x00", " - "]
    out = [(i, "".join(str(rng.choice(words[:6])) + str(rng.choice(gaps)) for _ in range(rng.integers(0, 60)))) for i in range(120)]
    out += [(1000 + i, "the same words " * 10) for i in range(60)]               # copies: a third
    return out + [(2000, None), (2001, ""), (None, "word " * 30), (2002, " ".join(words)), (2003, "no"), (3, "repeated id " * 12),
                  (2004, "one two three four " * 2000 + "Z" * 3000)]


ITEMS = ["alpha beta x", "the same words", None, ""]


def _tables(spark, rows, items):
    return (spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA),
            spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string"))


@pytest.mark.parametrize("batch", [2 << 20, 300])
def test_against_brute_force(spark, rows, batch, monkeypatch):
    monkeypatch.setattr(importance, "BATCH_BYTES", batch)          # of the driver only: see the test of pieces
    docs, items = _tables(spark, rows, ITEMS)
    got = importance.resample(docs.repartition(4), items).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(rows, ITEMS)


def test_pieces_of_long_texts(rows, monkeypatch):
    texts = [(t or "").encode() for _, t in rows]
    table = np.random.default_rng(0).integers(-9, 9, importance.BUCKETS)
    want = importance.scan(texts, table), importance.scan(texts, None)
    monkeypatch.setattr(importance, "BATCH_BYTES", 40)
    got = importance.scan(texts, table), importance.scan(texts, None)
    assert all((a == b).all() for a, b in zip(got[0], want[0])) and (got[1] == want[1]).all()


def test_shift_joins_checksums():
    rng = np.random.default_rng(8)
    for n in (0, 1, 63, 64, 65, 128, 1000, 100_000):
        a, b = rng.bytes(50), rng.bytes(n)
        joined = importance._SHIFT(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0] ^ np.uint32(zlib.crc32(b))
        assert joined == zlib.crc32(a + b)


def test_empty_tables(spark, rows):
    docs, items = _tables(spark, rows, ITEMS)
    assert importance.resample(docs.limit(0), items).collect() == []
    got = importance.resample(docs, items.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(rows, [])

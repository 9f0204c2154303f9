import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import linededup

SCHEMA = "doc_id long, text string, shard int, n int"
WS = "\x20\x09\x0a\x0b\x0c\x0d"


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def _brute(rows, min_chars=40, min_docs=5):
    held: dict[str, list] = {}
    for i, text in rows:
        for key in {_key(line) for line in (text or "").split("\n")}:
            if len(key) >= min_chars:
                held.setdefault(key, []).append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(_key(x)) is None or last[_key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    lines = [f"{c} line of enough characters to be looked at, number {i}" for i, c in enumerate("abcdefghijkl")]
    lines += ["é" * 39, "é" * 40, "x" * 39, "x" * 40, "", "short", " " + "n" * 39]
    out = []
    for i in range(150):
        some = [lines[j] for j in rng.integers(0, len(lines), rng.integers(0, 9))] + [f"the line of document {i // 4}, which a few share, no more"]
        out.append((i, "\n".join(str(rng.choice(["", " ", "\t"])) + (s.upper() if rng.random() < .2 else s) + str(rng.choice(["", "\r", " \x0b"])) for s in some)))
    common = lines[0]
    out += [(1000 + i, common + "\n" + common) for i in range(80)] + [(2000, ""), (2001, None), (None, lines[1]), (None, "only rows without an id hold this long line"),
                                                                  *[(None, "only rows without an id hold this long line")] * 5]
    out += [(7, out[7][1]), (3000, "\n" * 5), (3001, "\n".join(lines) * 3000)]
    return out


def _table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("keys", [1 << 20, 5, 0])
def test_against_brute_force(spark, rows, keys, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 4)
    got = linededup.dedup(_table(spark, rows).repartition(5), broadcast_keys=keys)
    got = got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(rows)


def test_empty_and_nothing_common(spark, rows):
    assert linededup.dedup(_table(spark, rows).limit(0)).collect() == []
    got = linededup.dedup(_table(spark, [(1, "a\nb"), (2, "a\nb")]), broadcast_keys=0).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 2, 0, "a\nb"), (2, 2, 0, "a\nb")]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_rejects_others(n):
    rng = np.random.default_rng(n)
    h = rng.integers(0, 1 << 63, (2, n + 5000)).astype(np.uint64)
    h[0, :n // 2] = 12345                                     # one half of the hash alone may repeat
    counts, last = rng.integers(5, 1 << 20, n), rng.integers(0, 1 << 40, n)
    shard = linededup.Shard(linededup.shard_row(0, h[0, :n], h[1, :n], counts, last))
    assert sorted(shard.hash.find(h[0, :n], h[1, :n]).tolist()) == list(range(n))
    found, largest = shard.probe(h[0], h[1])
    assert found[:n].tolist() == counts.tolist() and largest[:n].tolist() == last.tolist() and not found[n:].any()

"""Line dedup: lines that many documents share stay in one of them.

A line's key is the line without white space at both ends, A-Z lower-cased.
A key of at least ``MIN_CHARS`` characters that at least ``MIN_DOCS`` documents hold
loses its lines in all documents but the one with the largest id.

The distinct line hashes (128 bits) with their numbers of documents are counted in
Spark, combined before the shuffle.  Those that reach ``MIN_DOCS`` are dealt by
hash into shards, and one task per shard builds a minimal perfect hash over its
hashes: levels of bit arrays, each of which places the hashes that are alone in
their cell and passes the others on; a hash's number is the rank of its bit.  The
number indexes compact arrays: a fingerprint (64 of the 128 bits), the count and
the largest document id.  Documents probe the arrays; a hash that is not in them ends in no
bit or at another fingerprint.

``probe`` has two ways with one result.  The commonest hashes, as many as fit in
``BROADCAST_BYTES`` of arrays, go to every task, and documents are probed where
they are.  Hashes below that cut are probed in their shards: the documents' line hashes, not
their texts, are sent there, once per document; the hits come back per document.
No hash that takes this way is in more documents than the cut allows, so no shard is hot.

Cases: null or empty text is one empty line.  A document is a row; lines repeated in
one row count once.  Rows of a repeated id are counted each, and all rows of the largest
id keep the line.  Rows with a null id count as documents; their lines go if
another holder has an id, and stay if none has.  Empty tables give an empty result,
other columns are ignored.  A very long text is one row of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm import common

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 18
BROADCAST_KEYS = 1 << 20       # about 22 bytes each
NO_ID = -(1 << 63)             # the id of rows without one
_GAP = 2                       # bits of a level for each hash on it

SHARD = "shard int, keys bigint, levels array<binary>, fingerprint binary, count binary, last binary"


class PerfectHash:
    """Minimal perfect hash of distinct (h1, h2) pairs: pair -> number below their count."""

    def __init__(self, levels: list[np.ndarray]):
        """``levels``: packed bits, 64 a word."""
        self.levels = levels
        ones = [np.bitwise_count(level).astype(np.int64) for level in levels]
        before, self.rank = 0, []
        for n in ones:
            self.rank.append(before + np.cumsum(n) - n)        # ones before each word
            before += int(n.sum())

    @staticmethod
    def _cell(h1: np.ndarray, h2: np.ndarray, level: int, words: int) -> np.ndarray:
        turn = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
        # The upper half of a 64-bit hash scaled to the number of cells.
        return ((common.mix(h1 + common.mix(h2 ^ turn)) >> np.uint64(32)) * np.uint64(64 * words) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(h1):
            words = -(-_GAP * len(h1) // 64)
            cell = cls._cell(h1, h2, len(levels), words)
            alone = np.bincount(cell, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = ~alone[cell]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Number of each pair; -1, or any number, for pairs that were not built in."""
        out = np.full(len(h1), -1, dtype=np.int64)
        left = np.arange(len(h1))
        for k, bits in enumerate(self.levels):
            if not len(left):
                break
            cell = self._cell(h1[left], h2[left], k, len(bits))
            word, bit = bits[cell >> 6], (cell & 63).astype(np.uint64)
            on = (word >> bit & np.uint64(1)) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[on]] = (self.rank[k][cell >> 6] + below)[on]
            left = left[~on]
        return out


class Shard:
    """The arrays of one shard."""

    def __init__(self, row):
        self.hash = PerfectHash([np.frombuffer(b, np.uint64) for b in row["levels"]])
        self.fingerprint = np.frombuffer(row["fingerprint"], np.uint64)
        self.count = np.frombuffer(row["count"], np.uint32)
        self.last = np.frombuffer(row["last"], np.int64)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each hash (0 where it is not in the shard) and the largest id among them."""
        n, last = np.zeros(len(h1), np.uint32), np.full(len(h1), NO_ID)
        at = self.hash.find(h1, h2)
        hit = np.flatnonzero(at >= 0)
        hit = hit[self.fingerprint[at[hit]] == h2[hit]]
        n[hit], last[hit] = self.count[at[hit]], self.last[at[hit]]
        return n, last


def shard_row(shard: int, h1: np.ndarray, h2: np.ndarray, n: np.ndarray, last: np.ndarray) -> dict:
    """A shard of distinct hashes as one row of ``SHARD``."""
    built = PerfectHash.build(h1, h2)
    at = built.find(h1, h2)
    arrays = [np.empty(len(h1), kind) for kind in (np.uint64, np.uint32, np.int64)]
    for into, values in zip(arrays, (h2, np.minimum(n, (1 << 32) - 1), last), strict=True):
        into[at] = values
    return {"shard": shard, "keys": len(h1), "levels": [b.tobytes() for b in built.levels],
            "fingerprint": arrays[0].tobytes(), "count": arrays[1].tobytes(), "last": arrays[2].tobytes()}


def _keys(raw: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, key) of the lines whose key is long enough."""
    for i, line in enumerate(raw.split(b"\n")):
        key = line.strip().lower()           # of bytes: white space and letters of ASCII only
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= min_chars):
            yield i, key


def line_hashes(texts: list[bytes], min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, line, and two 64-bit hashes of every line whose key is long enough."""
    digest, where, line = [], [], []
    for t, raw in enumerate(texts):
        for i, key in _keys(raw, min_chars):
            digest.append(xxhash.xxh3_128_digest(key))
            where.append(t)
            line.append(i)
    pair = np.frombuffer(b"".join(digest), np.uint64).reshape(-1, 2)
    return np.array(where, np.int64), np.array(line, np.int64), pair[:, 0].copy(), pair[:, 1].copy()


def _texts(part: pa.RecordBatch, column: int) -> list[bytes]:
    return part.column(column).cast(pa.large_binary()).to_pylist()


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _distinct(where: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Positions of the first of equal (text, hash) rows."""
    by = np.lexsort((h2, h1, where))
    first = np.ones(len(by), dtype=bool)
    first[1:] = (np.diff(where[by]) != 0) | (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])
    return by[first]


def line_counts(rows: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, n, last: documents and largest id of every distinct line hash."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column(0).to_numpy()
            where, _, h1, h2 = line_hashes(_texts(part, 1), min_chars)
            one = _distinct(where, h1, h2)
            h1, h2, ids = h1[one], h2[one], ids[where[one]]
            by = np.lexsort((ids, h2, h1))
            h1, h2, ids = h1[by], h2[by], ids[by]
            first = np.ones(len(by), dtype=bool)
            first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(first)
            ends = np.append(at[1:], len(by))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (
                h1[at].view(np.int64), h2[at].view(np.int64), ends - at, ids[ends - 1] if len(at) else at)], names=["h1", "h2", "n", "last"])

    found = common.map_arrow(rows, count, "h1 bigint, h2 bigint, n bigint, last bigint")
    return found.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def build_shards(keys: DataFrame, shards: int) -> DataFrame:
    """One row of ``SHARD`` for each shard of (h1, h2, n, last) rows; hashes are distinct."""
    placed = keys.withColumn("shard", _shard(shards)).repartition(max(shards, 1), "shard").sortWithinPartitions("shard")

    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in common.whole_groups(parts, ["shard"]):
            bounds = common.run_bounds(part, ["shard"])
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                own = part.iloc[s:e]
                yield pd.DataFrame([shard_row(int(own["shard"].iloc[0]), own["h1"].to_numpy().view(np.uint64),
                                              own["h2"].to_numpy().view(np.uint64), own["n"].to_numpy(), own["last"].to_numpy())])

    return common.map_pandas(placed, build, SHARD)


def _shard(shards: int):
    return F.pmod("h1", F.lit(shards)).cast("int")


def _shards(keys: int) -> int:
    return max(1, -(-keys // SHARD_KEYS))


def _probe_routed(rows: DataFrame, keys: DataFrame, total: int, min_chars: int) -> DataFrame:
    """id, own, drop: per document (``own``: a hash of its text), the hashes that go, found in the shards."""
    shards = _shards(total)
    tables = common.written(build_shards(keys, shards), "line-shards")

    def hashes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            where, _, h1, h2 = line_hashes(_texts(part, 2), min_chars)
            one = _distinct(where, h1, h2)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(where[one])), part.column(1).take(pa.array(where[one])),
                pa.array(h1[one].view(np.int64)), pa.array(h2[one].view(np.int64))], names=["id", "own", "h1", "h2"])

    asked = common.map_arrow(rows.select("id", "own", "text"), hashes, "id bigint, own bigint, h1 bigint, h2 bigint")
    asked = asked.withColumn("shard", _shard(shards))
    none = {c: F.lit(None) for c in ("keys", "levels", "fingerprint", "count", "last")}
    both = tables.withColumn("first", F.lit(0)).unionByName(
        asked.withColumns(none).withColumn("first", F.lit(1)), allowMissingColumns=True)
    both = both.fillna(0, ["id", "own", "h1", "h2"])        # pandas has no null integers
    both = both.repartition(max(shards, common.partitions(rows.sparkSession)), "shard").sortWithinPartitions("shard", "first")

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, number = None, None                   # a shard's arrays come before its rows
        for part in parts:
            bounds = common.run_bounds(part, ["shard"])
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                own = part.iloc[s:e]
                head = own[own["first"] == 0]
                if len(head):
                    shard, number = Shard(head.iloc[0]), head["shard"].iloc[0]
                own = own[own["first"] == 1]
                if not len(own) or number != own["shard"].iloc[0]:
                    continue                         # a shard without hashes
                ids = own["id"].to_numpy(np.int64)
                n, last = shard.probe(own["h1"].to_numpy(np.int64).view(np.uint64), own["h2"].to_numpy(np.int64).view(np.uint64))
                gone = (n > 0) & (last != ids) & (last != NO_ID)
                yield pd.DataFrame({"id": ids[gone], "own": own["own"].to_numpy(np.int64)[gone], "h1": own["h1"].to_numpy(np.int64)[gone],
                                    "h2": own["h2"].to_numpy(np.int64)[gone]})

    found = common.map_pandas(both, probe, "id bigint, own bigint, h1 bigint, h2 bigint").distinct()
    return found.groupBy("id", "own").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
          min_docs: int = MIN_DOCS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """doc_id, n_lines, n_dropped, text: every document with the lines it keeps."""
    spark = docs.sparkSession
    rows = _docs(docs, id_col, text_col)
    counts = common.written(line_counts(rows, min_chars).where(F.col("n") >= min_docs), "line-counts")
    size = counts.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("held")).first()
    # At most held / cut hashes are in ``cut`` documents or more, so the common ones are bounded.
    cut = 0 if size.keys <= broadcast_keys else -(-size.held // max(1, broadcast_keys)) + 1
    often, seldom = counts.where(F.col("n") >= cut), counts.where(F.col("n") < cut)
    tables = common.written(build_shards(often, _shards(min(size.keys, broadcast_keys))), "line-shards")
    # A bounded number of hashes by the cut; each row is a shard of arrays.
    sent = spark.sparkContext.broadcast([r.asDict() for r in tables.collect()])
    if cut:
        rows = rows.withColumn("own", F.xxhash64("text"))
        drop = _probe_routed(rows, seldom, size.keys, min_chars)
        rows = rows.join(drop, ["id", "own"], "left").select("id", "text", "drop")
    else:
        rows = rows.withColumn("drop", F.lit(None).cast("array<struct<h1:bigint,h2:bigint>>"))
    shards = _shards(min(size.keys, broadcast_keys))

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = {r["shard"]: Shard(r) for r in sent.value}
        for part in parts:
            ids, texts = part.column(0).to_numpy(), _texts(part, 1)
            where, line, h1, h2 = line_hashes(texts, min_chars)
            gone = np.zeros(len(where), dtype=bool)
            shard = h1.view(np.int64) % shards
            for s in np.unique(shard):
                if int(s) in arrays:
                    mine = np.flatnonzero(shard == s)
                    n, last = arrays[int(s)].probe(h1[mine], h2[mine])
                    gone[mine] = (n > 0) & (last != ids[where[mine]]) & (last != NO_ID)
            if part.column(2).null_count < len(texts):
                listed = [None if x is None else {(y["h1"], y["h2"]) for y in x} for x in part.column(2).to_pylist()]
                for i, (t, a, b) in enumerate(zip(where, h1.view(np.int64).tolist(), h2.view(np.int64).tolist(), strict=True)):
                    gone[i] |= listed[t] is not None and (a, b) in listed[t]
            drop: dict[int, set[int]] = {}
            for t, i in zip(where[gone].tolist(), line[gone].tolist(), strict=True):
                drop.setdefault(t, set()).add(i)
            kept, n_lines, n_dropped = [], [], []
            for t, raw in enumerate(texts):
                n_lines.append(raw.count(b"\n") + 1)
                n_dropped.append(len(drop.get(t, ())))
                kept.append(raw if t not in drop else b"\n".join(x for i, x in enumerate(raw.split(b"\n")) if i not in drop[t]))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return common.map_arrow(rows, keep, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

ORACLE_SQL = f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS num FROM documents),
keyed AS (SELECT *, translate(trim(line, {_WS}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {MIN_CHARS}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT k.doc_id, k.line, k.num, c.key IS NOT NULL AND c.last <> k.doc_id AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY num) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

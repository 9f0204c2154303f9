"""Target-distribution importance resampling: documents that look like the target, drawn by Gumbel top-k.

Features are all runs of one to three words of a text, hashed (CRC-32) into
``BUCKETS``.  A bucket's gain is the log ratio of its smoothed shares in the target
and in the raw texts; a document's weight is the sum over its features, and
weight plus seeded Gumbel noise ranks the documents: the highest scores are a sample
without replacement whose chances follow the ratio.

A batch of texts is worked on at once.  Its texts are joined with a separator sentinel and one
regex pass splits it into words and gaps; CRC-32 is linear, so the checksum of a run is
put together from its words' checksums and lengths with table look-ups, a column at a
time.  The documents' offsets, searched in the words' positions, number the document of
every word, which masks runs that would cross into another document; ``bincount`` adds
the rest up.

The ranks come from a range partitioning by score: positions within partitions plus
the sizes of the partitions before, so no task sorts more than a range.

Cases: null or empty text has no features, weight 0.  A document with fewer than ``MIN_WORDS``
words is scored and not drawn.  A row with a null id has no noise, so its score is null
and it is neither counted nor drawn.  Rows of a repeated id are ranked each.  Equal scores go to
the smaller id.  Without features in one of the tables the smoothing alone
decides.  Very long texts are worked on in pieces that overlap by two words.
Empty tables give empty results, other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm import common

BUCKETS = 10_000
LONGEST = 3                    # words of a feature
MIN_WORDS = 20
PERCENT = 5
SEED = 42
BATCH_BYTES = 2 << 20          # text worked on at once

# One pass: gaps and words take turns; a line feed, the sentinel, is in no word.
_WORD = re.compile(rb"([0-9a-z\x80-\xff]+)")
_END = b"\n"


def _zero_byte_table() -> np.ndarray:
    """CRC-32 of one byte, as the shift of the register by it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


class Shift:
    """What appending n zero bytes does to a checksum: ``crc(a + b) = shift(crc(a), len(b)) ^ crc(b)``."""

    STEP = 64

    def __init__(self):
        one = _zero_byte_table()
        byte = np.arange(256, dtype=np.uint32)
        now = np.stack([byte << np.uint32(8 * k) for k in range(4)])        # no byte: the identity
        near = [now]
        for _ in range(self.STEP):
            now = one[now & np.uint32(255)] ^ now >> np.uint32(8)
            near.append(now)
        self.near = np.stack(near[:-1])                                     # (length, byte of the register, its value)
        self.far = [near[-1]]                                               # by STEP * 2 ** j bytes

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        low = length % self.STEP
        out = np.zeros(len(crc), dtype=np.uint32)
        for k in range(4):
            out ^= self.near[low, k, crc >> np.uint32(8 * k) & np.uint32(255)]
        rest, j = length // self.STEP, 0
        while rest.any():
            if j == len(self.far):
                self.far.append(self._on(self.far[-1], self.far[-1]))
            some = np.flatnonzero(rest & 1)
            out[some] = self._on(self.far[j], out[some])
            rest, j = rest >> 1, j + 1
        return out

    @staticmethod
    def _on(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = table[0][crc & np.uint32(255)]
        for k in range(1, 4):
            out = out ^ table[k][crc >> np.uint32(8 * k) & np.uint32(255)]
        return out


_SHIFT = Shift()
_BLANK = np.uint32(zlib.crc32(b" "))


def features(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every feature, and the number of words of each text."""
    joined = _END.join(texts).lower() + _END                  # of bytes: A-Z only
    ends = np.cumsum([len(t) + 1 for t in texts])
    parts = _WORD.split(joined)                               # gap, word, gap, ..., gap
    words = parts[1::2]
    at = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[0::2][:-1]       # where each word begins
    owner = np.searchsorted(ends, at, side="right")
    size = np.fromiter(map(len, words), np.int64, len(words))
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    led = _SHIFT(np.full(len(words), _BLANK), size) ^ crc     # of " " + word
    found, run = [crc], crc
    owners = [owner]
    for n in range(2, LONGEST + 1):
        run = _SHIFT(run[:-1], size[n - 1:] + 1) ^ led[n - 1:] if len(run) > 1 else run[:0]
        own = owner[:len(run)]
        inside = own == owner[n - 1:] if len(run) else np.empty(0, bool)    # not into another document
        found.append(run[inside])
        owners.append(own[inside])
    return (np.concatenate(owners), (np.concatenate(found) % np.uint32(buckets)).astype(np.int64),
            np.bincount(owner, minlength=len(texts)))


def _pieces(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """A text in pieces of about ``BATCH_BYTES``; with each, the last words of the piece before,
    whose own features were counted there."""
    at, tail = 0, b""
    while True:
        to = at + BATCH_BYTES
        if to < len(text):
            gap = re.compile(rb"[^0-9A-Za-z\x80-\xff]").search(text, to)
            to = gap.start() if gap else len(text)
        piece = text[at:to]
        yield piece, tail
        if to >= len(text):
            return
        words = _WORD.findall((tail + b" " + piece).lower())[1 - LONGEST:]
        at, tail = to, b" ".join(words)


def scan(texts: list[bytes], table: np.ndarray | None, buckets: int = BUCKETS):
    """Without ``table``: features in each bucket.  With it: features, words, and the sum of the
    table over the features, of each text."""
    count = np.zeros(buckets, np.int64)
    n, words, total = (np.zeros(len(texts), np.int64) for _ in range(3))

    def add(own: np.ndarray, batch: list[bytes], sign: int) -> None:
        owner, bucket, found = features(batch, buckets)
        if table is None:
            count[:] += sign * np.bincount(bucket, minlength=buckets)
            return
        np.add.at(n, own, sign * np.bincount(owner, minlength=len(batch)))
        np.add.at(words, own, sign * found)
        by = np.argsort(owner, kind="stable")
        sums = np.concatenate(([0], np.cumsum(table[bucket[by]])))
        bounds = np.searchsorted(owner[by], np.arange(len(batch) + 1))
        np.add.at(total, own, sign * np.diff(sums[bounds]))

    short = [i for i, t in enumerate(texts) if len(t) <= BATCH_BYTES]
    for some in common.batches(short, lambda i: len(texts[i]) + 1, BATCH_BYTES):
        add(np.array(some), [texts[i] for i in some], 1)
    for i in np.flatnonzero([len(t) > BATCH_BYTES for t in texts]):
        for piece, tail in _pieces(texts[i]):
            add(np.array([i]), [tail + b" " + piece], 1)
            if tail:
                add(np.array([i]), [tail], -1)
    return count if table is None else (n, words, total)


def bucket_counts(table: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in parts:
            total += scan(part.column(0).cast(pa.large_binary()).to_pylist(), None, buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    texts = table.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = common.map_arrow(texts, count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():                                  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed target share / smoothed raw share)) of each bucket."""
    b = len(raw)
    up = (target + 1.0) * (raw.sum() + float(b))
    down = (raw + 1.0) * (target.sum() + float(b))
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def noise(id_col: Column, seed: int) -> Column:
    """Seeded Gumbel noise in thousandths, from the first 32 bits of a digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("bigint")


def _ranked(rows: DataFrame, draw: int) -> DataFrame:
    """``rank`` of the ``draw`` highest scores, null below them."""
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = common.written(
        rows.repartitionByRange(common.partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("local", local), "importance-order")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))                  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = (F.col("start") + F.col("local") + 1).cast("bigint")
    return rows.join(F.broadcast(starts), "part").withColumn("rank", F.when(at <= draw, at))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score, rank, n_words of every row of ``docs``; rank is null where not drawn."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n, words, weight = scan(part.column(1).cast(pa.large_binary()).to_pylist(), sent.value, len(sent.value))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(words), pa.array(weight)],
                                             names=["doc_id", "n_features", "n_words", "weight"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    weighed = common.map_arrow(texts, weigh, "doc_id bigint, n_features bigint, n_words bigint, weight bigint")
    scored = common.written(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
                            .withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    ready = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    draw = percent * scored.where(ready).count() // 100
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    return _ranked(scored.where(ready), draw).select(*columns).unionByName(
        scored.where(~ready).withColumn("rank", F.lit(None).cast("bigint")).select(*columns))


def _oracle_sql() -> str:
    """Plain SQL: one checksum per distinct feature, byte by byte."""
    table = "[" + ", ".join(str(x) for x in _zero_byte_table().tolist()) + "]::BIGINT[]"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    runs = " UNION ALL ".join(
        f"SELECT side, id, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS f FROM words"
        for n in range(1, LONGEST + 1))
    return f"""WITH texts AS (SELECT 'raw' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'target', item_id, coalesce(text, '') FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(translate(text, '{upper}', '{lower}'), '{word}') AS w FROM texts),
runs AS ({runs}),
n AS (SELECT side, id, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(f)), '..'),
    lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, ({table})[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM n)),
per AS (SELECT side, id, bucket, sum(n) AS n FROM n JOIN hashed USING (f) GROUP BY ALL),
sides AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'raw'), 0) AS s, coalesce(sum(n) FILTER (side = 'target'), 0) AS t FROM per GROUP BY bucket),
total AS (SELECT CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM sides),
gain AS (SELECT bucket, CAST(floor(1000e0 * ln((sides.t + 1e0) * (total.s + {BUCKETS}e0) / ((sides.s + 1e0) * (total.t + {BUCKETS}e0)))) AS BIGINT) AS g
  FROM sides, total),
weight AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM per JOIN gain USING (bucket) WHERE side = 'raw' GROUP BY id),
scored AS (SELECT d.id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(d.w) >= {MIN_WORDS} AS ready,
    coalesce(weight, 0) + CAST(floor(-1000e0 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || d.id), 1, 8) AS BIGINT) + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
  FROM words d LEFT JOIN weight ON weight.id = d.id WHERE side = 'raw'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ready ORDER BY score DESC, doc_id) AS r, {PERCENT} * count(*) FILTER (ready) OVER () // 100 AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN ready AND r <= k THEN r END AS rank FROM ranked"""


ORACLE_SQL = _oracle_sql()

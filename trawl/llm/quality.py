"""Quality by importance resampling.

Two generative models over hashed unigrams and bigrams of words and punctuation (``BUCKETS``
each, smoothed): one of the target text, the documents labelled good, and one of the
raw text, all documents.  A document's log weight is the log of the ratio of
its probabilities under the two, summed over its n-grams.  Adding independent
Gumbel noise to the log weights and keeping the k largest draws k documents without
replacement in proportion to their weights.

Raw counts cover every document; target counts come from at most
about ``TARGET_DOCS`` labelled documents, drawn by a hash of the id (a documented
bound).  Counts leave a task as at most ``BUCKETS`` rows.  ``k`` is a share of the documents,
by default the share of good ones among the labelled (its upper 95 % bound).  The k-th largest key is found
from a histogram of the keys, and only the histogram cell that holds it is
ordered row by row.

Cases: text without a word (or null) has a null log weight and is never kept;
the noise depends on the id alone, so repeated rows share it, and null ids
share one; rows at the cut with equal keys are all kept; without
target documents the weights are 0 and noise alone decides; empty tables give an
empty result; labels with null fields are ignored, as are other columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm import common

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
TARGET_DOCS = 20_000
SMOOTHING = 20.0
CELLS = 4096
CELL_ROWS = 20_000
BATCH_CHARS = 1 << 20


STUTTER = np.uint64(0x5A17)
_KIND = np.full(256, 1, dtype=np.uint8)            # 0 white space, 1 word, 2 punctuation
_KIND[common.PUNCTUATION] = 2
_KIND[common.SPACE] = 0


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of word characters and of punctuation, case kept, and their number per text."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    kind = _KIND[buf]
    edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]))
    run = kind[edge[:-1]] > 0
    starts, ends = edge[:-1][run], edge[1:][run]
    upto = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]))
    found = common.run_hashes(buf, starts, ends) if len(starts) else np.empty(0, np.uint64)
    return found, np.diff(np.concatenate(([0], upto)))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the texts' tokens and token pairs, the text of each, and the tokens per text.

    A pair of equal tokens is one feature whatever the token: stutter is never
    frequent enough word by word.
    """
    words, counts = tokens(texts)
    same = np.append(words[1:] == words[:-1], False)
    pairs, found = common.flat_shingles(words, counts, 2)
    pairs[common.flat_positions(counts, 2, same)] = STUTTER
    owner = np.arange(len(counts))
    buckets = np.concatenate([common.mix(words), pairs]) >> np.uint64(64 - BUCKET_BITS)
    return buckets.astype(np.int64), np.concatenate([np.repeat(owner, counts), np.repeat(owner, found)]), counts


def ngram_counts(docs: DataFrame) -> DataFrame:
    """(bucket, raw, target) over the rows (text, target)."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, BUCKETS))
        for part in parts:
            rows = list(zip(part["text"], part["target"].to_numpy(), strict=True))
            for run in common.batches(rows, lambda r: len(r[0]), BATCH_CHARS):
                buckets, owner, _ = features([t for t, _ in run])
                total[0] += np.bincount(buckets, minlength=BUCKETS)
                good = np.array([g for _, g in run], dtype=bool)
                total[1] += np.bincount(buckets[good[owner]], minlength=BUCKETS)
        some = np.flatnonzero(total[0])
        yield pd.DataFrame({"bucket": some, "raw": total[0][some].astype(np.int64), "target": total[1][some].astype(np.int64)})

    return common.map_pandas(docs, count, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log probability ratio of each bucket; zeros without target text."""
    raw, target = np.zeros((2, BUCKETS))
    for r in counts.collect():                     # at most BUCKETS rows
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.any():
        return np.zeros(BUCKETS)
    share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS))
    # The raw model is tempered to the target's size, so that both are smoothed alike.
    return share(target) - share(raw * (target.sum() / raw.sum()))


def gumbel(id_col: Column, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(seed)), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def good_labels(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))


def weigh(docs: DataFrame, labels: DataFrame, target_docs: int = TARGET_DOCS) -> DataFrame:
    """doc_id, log_weight of every row of ``docs``."""
    spark = docs.sparkSession
    good = good_labels(labels).where("quality = 1").select(F.col("doc_id").alias("id"))
    total = good.count()
    draw = F.pmod(F.xxhash64("id", F.lit(0xD51F)), F.lit(1 << 20)) < min(1.0, target_docs / max(1, total)) * (1 << 20)
    ids = good.where(draw).withColumn("target", F.lit(True))             # about target_docs rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    marked = texts.join(F.broadcast(ids), "id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    sent = spark.sparkContext.broadcast(log_ratios(ngram_counts(marked)))

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for run in common.batches(part["text"].tolist(), len, BATCH_CHARS):
                buckets, owner, counts = features(run)
                sums = np.bincount(owner, weights=sent.value[buckets], minlength=len(run))
                out.append(np.where(counts > 0, sums, np.nan))
            yield pd.DataFrame({"doc_id": part["id"].astype("Int64"), "log_weight": np.concatenate(out or [np.empty(0)])})

    weighed = common.map_pandas(texts, score, "doc_id bigint, log_weight double")
    return weighed.withColumn("log_weight", F.when(~F.isnan("log_weight"), F.col("log_weight")))


def largest(rows: DataFrame, key: str, k: int) -> float:
    """The k-th largest non-null ``key``; minus infinity if there are not more than k.

    The range is cut into cells, and the cell that holds the k-th is cut again, until it has at most
    ``CELL_ROWS`` rows or a single key: however the keys are spread, no task sorts more.
    """
    keys = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    if k <= 0:
        return float("inf")
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if n <= k:
        return float("-inf")
    while low < high and n > CELL_ROWS:
        cell = F.least(F.lit(CELLS - 1), F.floor((F.col("key") - low) / (high - low) * CELLS)).cast("int")
        cells = keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for r in sorted(cells.collect(), key=lambda r: -r["cell"]):          # at most CELLS rows
            if k <= r["n"]:
                break
            k -= r["n"]
        if r["n"] == n:                                                      # neighbouring doubles: no cell parts them
            break
        low, high, n = r["low"], r["high"], r["n"]
        keys = keys.where(F.col("key").between(low, high))
    if low == high:
        return low
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("key"))     # at most CELL_ROWS rows
    for value, many in counts.collect():
        if k <= many:
            return value
        k -= many


def resample(docs: DataFrame, labels: DataFrame, keep_share: float | None = None, seed: int = 29) -> DataFrame:
    """doc_id, log_weight, draw_key, kept for every row of ``docs``."""
    if keep_share is None:
        known = good_labels(labels).agg(F.avg((F.col("quality") == 1).cast("double")), F.count("*")).first()
        share = known[0] or 0.0
        # The upper end of the 95 % interval: the draw should not cost good documents.
        keep_share = min(1.0, share + 2 * math.sqrt(share * (1 - share) / max(1, known[1])))
    keyed = common.written(weigh(docs, labels).withColumn("draw_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "weights")
    cut = largest(keyed, "draw_key", round(keep_share * keyed.count()))
    return keyed.withColumn("kept", F.coalesce(F.col("draw_key") >= cut, F.lit(False)))

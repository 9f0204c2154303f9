"""Language identification by prediction by partial matching.

Per language a variable-order byte context tree of depth ``ORDER`` is learned
and frozen.  A byte's code length in its context is ``-log2(n / (total +
distinct))`` if the byte followed the context in training; otherwise the
escape, ``-log2(distinct / (total + distinct))``, is paid and the next shorter
context decides, down to a uniform byte.  As the statistics are frozen, a byte's
code length depends on its last ``ORDER + 1`` bytes only, so the trees are
unrolled once into tables (gram -> code length in each language) and a
text's exact code lengths are sums of table look-ups, whole batches at a time.
The language with the shortest code wins.

Training reads at most about ``SAMPLE_DOCS`` whole documents and ``SAMPLE_BYTES`` of text per language, drawn
by a hash of the id (a documented bound; counting is a Spark aggregation).  All grams of
the sample are kept, so the code lengths are those of its full statistics, and the sample bounds the model.

Cases: null text, or text without a letter, is ``und`` with score 0; without
any labelled row every text is.  Rows with null ids are predicted and not
learned from.  Equal code lengths go to the first language by name.  Very
long texts are coded in pieces.  Repeated rows, empty tables and extra
columns need nothing special.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm import common

ORDER = 4
SAMPLE_DOCS = 1500
SAMPLE_BYTES = 8 << 20
BATCH_BYTES = 1 << 19
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def grams(buf: np.ndarray, order: int) -> np.ndarray:
    """Key of the last ``order + 1`` bytes at each position (fewer at the start)."""
    key = np.zeros(len(buf), dtype=np.uint64)
    for back in range(order, -1, -1):
        key <<= np.uint64(8)
        key[back:] |= buf[:len(buf) - back] if back else buf
    return key


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 8 * (order + 1)) - 1)


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, each after ``ORDER`` line feeds, and the texts' ends."""
    head = b"\n" * ORDER
    raws = [head + t.encode("utf-8", "surrogatepass") for t in texts]
    return _LOWER[np.frombuffer(b"".join(raws), np.uint8)], np.cumsum([len(r) for r in raws])


def _windows(buf: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of the longest order and the text of each, ``BATCH_BYTES`` positions at a time."""
    starts = ends - np.diff(ends, prepend=0)
    for at in range(0, len(buf), BATCH_BYTES):
        low, to = max(0, at - ORDER), min(len(buf), at + BATCH_BYTES)
        place = np.arange(at, to)
        own = np.searchsorted(ends, place, side="right")
        inside = place - starts[own] >= ORDER               # not the line feeds before a text
        if inside.any():
            yield grams(buf[low:to], ORDER)[at - low:][inside], own[inside]


class Table:
    """Open-addressing map from 64-bit keys to rows of a matrix."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.keys, self.rows = keys, np.ascontiguousarray(rows, dtype=np.float32)
        self.bits = max(4, (4 * max(1, len(keys)) - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]             # the last of equals stays
            put = self.slots[slot] == left
            left, slot = left[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where there is none."""
        slot = self._slot(keys)
        found = self.slots[slot]
        if not len(self.keys):
            return found
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            found[wrong] = self.slots[slot[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[found[wrong]] != keys[wrong])]
        return found


class Model:
    """Frozen context trees of all languages."""

    def __init__(self, langs: list[str], counts: pd.DataFrame):
        """``counts``: lang (position in ``langs``), ord, gram, n."""
        self.langs = langs
        self.codes: list[Table] = []
        self.escapes: list[Table] = []
        for order in range(ORDER + 1):
            part = counts[counts["ord"] == order]
            keys, row = np.unique(part["gram"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
            n = np.zeros((len(keys), len(langs)))
            n[row, part["lang"].to_numpy(np.int64)] = part["n"].to_numpy(np.float64)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((2, len(contexts), len(langs)))
            np.add.at(total, of, n)
            np.add.at(distinct, of, n > 0)
            seen = total > 0
            escape = np.where(seen, np.log2(np.where(seen, total + distinct, 1) / np.where(seen, distinct, 1)), 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                code = np.log2((total + distinct)[of] / n)
            shorter = escape[of] + self.bits(keys & _mask(order - 1), order - 1) if len(keys) else code
            self.escapes.append(Table(contexts, escape))
            self.codes.append(Table(keys, np.where(n > 0, code, shorter)))

    def bits(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Code length of each gram's last byte in each language."""
        out = np.zeros((len(keys), len(self.langs)), dtype=np.float32)
        left = np.arange(len(keys))
        for k in range(order, -1, -1):
            if k < order:
                keys = keys & _mask(k)
            row = self.codes[k].find(keys)
            hit = row >= 0
            if hit.all() and len(left) == len(out):
                return self.codes[k].rows[row]
            out[left[hit]] += self.codes[k].rows[row[hit]]
            left, keys = left[~hit], keys[~hit]
            if not len(left):
                return out
            row = self.escapes[k].find(keys >> np.uint64(8))
            seen = row >= 0
            out[left[seen]] += self.escapes[k].rows[row[seen]]
        out[left] += 8.0
        return out

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each whole text in each language."""
        buf, ends = _buffer(texts)
        total = np.zeros((len(texts), len(self.langs)))
        for keys, own in _windows(buf, ends):
            bits = self.bits(keys, ORDER)
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            total[own[first]] += np.add.reduceat(bits.astype(np.float64), first, axis=0)
        return total

    def predict(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """(language, score, bits per byte); the score is the winner's
        share of ``2 ** -bits`` over the languages."""
        bits = self.code_lengths(texts)
        out = []
        for text, b in zip(texts, bits, strict=True):
            if not len(b) or not _LETTER.search(text):
                out.append((UNKNOWN, 0.0, None))
                continue
            best = int(b.argmin())
            share = 1.0 / np.exp2(np.maximum(b[best] - b, -1000.0)).sum()
            out.append((self.langs[best], float(share), float(b[best] / len(text.encode("utf-8", "surrogatepass")))))
        return out


def train(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the rows of ``docs`` with a language and a text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    sizes = {r.lang: max(r.n / SAMPLE_DOCS, r.bytes / SAMPLE_BYTES) for r in rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], pd.DataFrame({"lang": [], "ord": [], "gram": [], "n": []}))
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, 1 / max(1.0, sizes[lang]))])
    draw = F.pmod(F.xxhash64("id", F.lit(0x5EED)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    sample = rows.where(draw).select(
        number[F.col("lang")].alias("lang"), "text")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for lang, own in part.groupby("lang"):
                for run in common.batches(own["text"].tolist(), len, BATCH_BYTES):
                    for keys, _ in _windows(*_buffer(run)):
                        for order in range(ORDER + 1):
                            gram, n = np.unique(keys & _mask(order), return_counts=True)
                            yield pd.DataFrame({"lang": np.int32(lang), "ord": np.int32(order),
                                                "gram": gram.view(np.int64), "n": n.astype(np.int64)})

    counted = common.map_pandas(sample, count, "lang int, ord int, gram bigint, n bigint").groupBy(
        "lang", "ord", "gram").agg(F.sum("n").alias("n"))
    # The grams of a bounded sample, four numbers each, as Arrow columns.
    return Model(langs, counted.select("lang", "ord", "gram", "n").toArrow().to_pandas())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte for every row; only the text is read."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for run in common.batches(part["text"].tolist(), len, BATCH_BYTES):
                out += sent.value.predict(run)
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "lang_pred": [o[0] for o in out],
                                "score": [o[1] for o in out],
                                "bits_per_byte": np.array([o[2] for o in out], dtype=float)})

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return common.map_pandas(texts, score, "doc_id bigint, lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, model: Model, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is ``und``; ``lang_col`` becomes the language found.

    The rows pass through the tasks as Arrow batches, other columns untouched,
    so nothing is joined or moved.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns, types = docs.columns, dict(docs.dtypes)

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or "" for t in part.column(columns.index(text_col)).to_pylist()]
            found = [o[0] for run in common.batches(texts, len, BATCH_BYTES) for o in sent.value.predict(run)]
            arrays = list(part.columns)
            arrays[columns.index(lang_col)] = pa.array(found, pa.string())
            out = pa.RecordBatch.from_arrays(arrays, names=columns)
            yield out.filter(pa.array([f != UNKNOWN for f in found], pa.bool_()))

    if types[lang_col] != "string":
        raise ValueError(f"{lang_col} must be a string column")
    return common.map_arrow(docs, keep, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte; learned from the documents not held out."""
    model = train(docs.where("doc_id is not null").where(~held_out(F.col("doc_id"))))
    return predict(docs, model).withColumn("held_out", held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte")

"""Benchmark decontamination: which documents hold which test items.

Size-partitioned MinHash containment search.  Items are partitioned by the size
of their shingle set (powers of two); for the partition of sizes up to ``u``
a document is read through windows of ``2u`` shingles, one every ``u``, so an item
inside a document of any length fills at least a quarter of some
window and agrees with it in one of ``COORDS`` minima but for a chance of about
``0.75 ** COORDS``.  Window minima come from block minima, computed once per
document and halved in number from one partition to the next.  Every
(document, item) pair found is verified by exact containment: the share of the
item's distinct shingles that the whole document holds, at least ``percent``.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased, so punctuation, case and line breaks hide nothing.

Spark signs the items: equal shingle sets are one class with 64 minima.  While the
classes are small (their measured size is at most ``INDEX_BYTES``) they go to every task, and one pass over the
documents finds and verifies the pairs; documents never move.  Beyond that the
windows' minima meet the classes' minima in a shuffle join on (shingle length, size
partition, coordinate, value), behind a bitmap of fixed size that takes out values which no
item has; keys are salted, so one value that many documents share is
several tasks' work, and only texts with a candidate are moved and verified.  The benchmark's size then
changes no number of scans.  There, texts are told apart by a 64-bit hash.

Cases: null or empty texts hold nothing and null or empty items are in
nothing; an item with fewer words than a shingle is one shingle of all its
words; repeated documents and items each count for themselves;
rows with null ids take part and keep their null; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm import common

COORDS = 64
INDEX_BYTES = 32 << 20         # of signed classes in every task
BATCH_CHARS = 1 << 20
PIECE = 1 << 15                # shingles hashed at a time
FILTER_BITS = 22               # of a task's own filter
POSTED_BITS = 26               # of the filter in front of the shuffle join
SALTS = 8

_SEEDS = np.random.default_rng(20240521).integers(1, 1 << 31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _slot(coord: np.ndarray, value: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    return ((value ^ coord.astype(np.uint32) * np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def _short(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(32)).astype(np.uint32)


def block_minima(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima per block and coordinate; blocks start at ``starts``."""
    out = np.empty((len(starts), COORDS), dtype=np.uint32)
    s = _short(found)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE)))
        end = starts[to] if to < len(starts) else len(s)
        hashed = s[starts[at]:end, None] * _SEEDS
        out[at:to] = np.minimum.reduceat(hashed, starts[at:to] - starts[at], axis=0)
        at = to
    return out


def _minima(found: np.ndarray) -> np.ndarray:
    return block_minima(found, np.zeros(1, dtype=np.int64))[0] if len(found) <= PIECE else \
        block_minima(found, np.arange(0, len(found), PIECE)).min(axis=0)


def _keys(minima: np.ndarray) -> np.ndarray:
    """Coordinate and value of each minimum as one number."""
    return np.broadcast_to(np.arange(COORDS, dtype=np.uint64), minima.shape) << np.uint64(32) | minima


def windows(found: np.ndarray, sizes: np.ndarray, widths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, text of each window, minima of each window) for every size partition, ascending."""
    firsts = np.cumsum(sizes) - sizes
    width = widths[0]
    blocks = -(-sizes // width)
    doc = np.repeat(np.arange(len(sizes)), blocks)
    local = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    minima = block_minima(found, firsts[doc] + local * width)
    for wanted in widths:
        while width < wanted:
            first = np.flatnonzero(local % 2 == 0)
            minima = np.minimum.reduceat(minima, first, axis=0)
            doc, local, width = doc[first], local[first] // 2, width * 2
        window = minima.copy()
        joined = np.flatnonzero(doc[1:] == doc[:-1])
        window[joined] = np.minimum(minima[joined], minima[joined + 1])
        yield width, doc, window


class Items:
    """Index of item classes (id, shingle length, size partition, sorted shingles)."""

    def __init__(self, classes: list[tuple[int, int, int, np.ndarray]]):
        self.ids = [c for c, *_ in classes]
        self.sets = [found for *_, found in classes]
        members: dict[tuple[int, int], list[int]] = {}
        for i, (_, length, width, _) in enumerate(classes):
            members.setdefault((length, width), []).append(i)
        self.parts = {}
        for key, own in members.items():
            minima = np.array([_minima(self.sets[i]) for i in own])
            keys = _keys(minima).reshape(-1)
            order = np.argsort(keys, kind="stable")
            present = np.zeros(1 << FILTER_BITS, dtype=bool)
            present[_slot(np.arange(COORDS, dtype=np.uint64), minima)] = True
            self.parts[key] = (keys[order], np.repeat(own, COORDS)[order], present)

    def search(self, texts: list[str], percent: int) -> Iterator[tuple[int, int, int]]:
        """(text, class, shared shingles) of every verified pair."""
        words, counts = common.word_hashes(texts, common.PUNCTUATION)
        for length in sorted({k[0] for k in self.parts}):
            found, sizes = common.flat_shingles(words, counts, length)
            if not len(found):
                continue
            firsts = np.cumsum(sizes) - sizes
            pairs = np.unique(np.concatenate([p for p in self._collisions(found, sizes, length)] or [np.empty(0, np.int64)]))
            doc = -1
            for d, i in zip((pairs // len(self.ids)).tolist(), (pairs % len(self.ids)).tolist(), strict=True):
                if d != doc:
                    doc, own = d, np.sort(found[firsts[d]:firsts[d] + sizes[d]])
                shared = _shared(own, self.sets[i])
                if 100 * shared >= percent * len(self.sets[i]):
                    yield d, i, shared

    def _collisions(self, found, sizes, length) -> Iterator[np.ndarray]:
        """Candidate pairs as text * classes + class, partition by partition."""
        for width, doc, window in windows(found, sizes, sorted(w for n, w in self.parts if n == length)):
            keys, items, present = self.parts[length, width]
            coord = np.arange(COORDS, dtype=np.uint64)
            hit = np.flatnonzero(present[_slot(np.broadcast_to(coord, window.shape), window)].reshape(-1))
            wanted = (hit % COORDS).astype(np.uint64) << np.uint64(32) | window.reshape(-1)[hit]
            lo, hi = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            many = hi - lo
            at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            yield np.unique(np.repeat(doc[hit // COORDS], many) * len(self.ids) + items[at])


def _shared(own: np.ndarray, item: np.ndarray) -> int:
    """Number of ``item``'s shingles among the sorted ``own``."""
    if not len(own):
        return 0
    at = np.searchsorted(own, item)
    at[at == len(own)] = 0
    return int((own[at] == item).sum())


_LOADED: dict[str, Items] = {}


def _loaded(name: str, classes: pa.Table) -> Items:
    """The index of a broadcast, built once per Python worker."""
    if name not in _LOADED:
        _LOADED.clear()
        found = classes["found"].combine_chunks()
        flat, at = found.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy())))
        columns = [classes[c].to_pylist() for c in ("class", "length", "width")]
        _LOADED[name] = Items([(*row, flat[at[i]:at[i + 1]]) for i, row in enumerate(zip(*columns, strict=True))])
    return _LOADED[name]


def _text_batches(part: pd.DataFrame) -> Iterator[tuple[slice, list[str]]]:
    start = 0
    for run in common.batches(part["text"].tolist(), len, BATCH_CHARS):
        yield slice(start, start + len(run)), run
        start += len(run)


SIGNED_SCHEMA = "item_id bigint, length int, width bigint, found array<bigint>"
FOUND_SCHEMA = "doc_id bigint, own bigint, class bigint, shared bigint"


def _signed(items: DataFrame, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Classes (class, length, width, found) of equal shingle sets, and the items (class, item_id, item_shingles)."""
    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at, texts in _text_batches(part):
                words, counts = common.word_hashes(texts, common.PUNCTUATION)
                own = np.split(words, np.cumsum(counts)[:-1])
                sets = [np.unique(common.shingles(w, shingle)) for w in own]
                frame = pd.DataFrame({"item_id": part["id"].array[at], "length": np.minimum(counts, shingle).astype(np.int32),
                                      "width": [1 << (len(f) - 1).bit_length() if len(f) else 0 for f in sets],
                                      "found": [f.view(np.int64) for f in sets]})
                yield frame[counts > 0].astype({"item_id": "Int64"})

    rows = items.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    signed = common.written(common.map_pandas(rows, sign, SIGNED_SCHEMA).withColumn("class", F.xxhash64("length", "found")), "items-signed")
    classes = common.written(signed.dropDuplicates(["class"]).drop("item_id"), "item-classes")
    return classes, signed.select("class", "item_id", F.size("found").cast("bigint").alias("item_shingles"))


def _found_in_tasks(texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Verified (doc_id, own, class, shared) with the classes in every task."""
    index, name = texts.sparkSession.sparkContext.broadcast(classes.toArrow()), uuid.uuid4().hex

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _loaded(name, index.value)
        for part in parts:
            ids, hashes, rows = part["id"].array, part["own"].to_numpy(), []
            for at, run in _text_batches(part):
                rows += [(ids[at.start + d], hashes[at.start + d], own.ids[i], n) for d, i, n in own.search(run, percent)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "own", "class", "shared"]).astype({"doc_id": "Int64"})

    return common.map_pandas(texts, search, FOUND_SCHEMA)


def _found_by_shuffle(texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Verified (doc_id, own, class, shared): windows join the classes' minima, candidates join their texts."""
    spark = texts.sparkSession

    def post(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coord = np.arange(COORDS, dtype=np.uint64)
        for part in parts:
            for c, length, width, found in part[["class", "length", "width", "found"]].itertuples(index=False):
                minima = _minima(np.asarray(found, dtype=np.int64).view(np.uint64))
                yield pd.DataFrame({"length": length, "width": width, "key": _keys(minima).view(np.int64), "class": c,
                                    "slot": _slot(coord, minima, POSTED_BITS).astype(np.int64)})

    posts = common.written(common.map_pandas(classes, post, "length int, width bigint, key bigint, class bigint, slot bigint"), "item-posts")
    # The bitmap: one row per 32 slots, so its size does not grow with the items.
    bits = posts.groupBy(F.expr("slot div 32").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits")).toArrow()
    words = np.zeros(1 << (POSTED_BITS - 5), dtype=np.uint32)
    words[bits["word"].to_numpy()] = bits["bits"].to_numpy().astype(np.uint32)
    widths: dict[int, list[int]] = {}
    for r in classes.select("length", "width").distinct().orderBy("length", "width").collect():      # a power of two per size
        widths.setdefault(r.length, []).append(r.width)
    known = spark.sparkContext.broadcast((words, widths))

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        present, sizes_of = known.value
        coord = np.arange(COORDS, dtype=np.uint64)
        for part in parts:
            hashes = part["own"].to_numpy()
            for at, run in _text_batches(part):
                words, counts = common.word_hashes(run, common.PUNCTUATION)
                for length, own_widths in sizes_of.items():
                    found, sizes = common.flat_shingles(words, counts, length)
                    if not len(found):
                        continue
                    for width, doc, window in windows(found, sizes, own_widths):
                        slot = _slot(np.broadcast_to(coord, window.shape), window, POSTED_BITS).reshape(-1)
                        hit = np.flatnonzero(present[slot >> np.uint32(5)] >> (slot & np.uint32(31)) & np.uint32(1))
                        if len(hit):
                            yield pd.DataFrame({"own": hashes[at][doc[hit // COORDS]], "length": np.int32(length), "width": width,
                                                "key": _keys(window).reshape(-1)[hit].view(np.int64)}).drop_duplicates()

    hits = common.map_pandas(texts.select("own", "text"), probe, "own bigint, length int, width bigint, key bigint")
    salt = F.pmod(F.hash("own"), F.lit(SALTS))
    salted = posts.drop("slot").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    candidates = common.written(hits.withColumn("salt", salt).join(salted, ["length", "width", "key", "salt"])
                                .select("own", "class").distinct(), "decontam-candidates")

    def verify(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, words, sets = None, None, {}
        for part in parts:
            rows = []
            for own, text, c, length, found in part[["own", "text", "class", "length", "found"]].itertuples(index=False):
                if own != last:
                    last, (words, _), sets = own, common.word_hashes([text], common.PUNCTUATION), {}
                if length not in sets:
                    sets[length] = np.sort(common.shingles(words, length)) if len(words) >= length else words[:0]
                item = np.asarray(found, dtype=np.int64).view(np.uint64)
                shared = _shared(sets[length], item)
                if 100 * shared >= percent * len(item):
                    rows.append((own, c, shared))
            if rows:
                yield pd.DataFrame(rows, columns=["own", "class", "shared"])

    owns = candidates.select("own").distinct()
    held = common.only(texts.select("own", "text"), owns, "own").dropDuplicates(["own"])
    pairs = (candidates.join(classes, "class").join(held, "own")
             .repartition(common.partitions(spark), "own", F.pmod(F.hash("class"), F.lit(SALTS))).sortWithinPartitions("own"))
    found = common.written(common.map_pandas(pairs.select("own", "text", "class", "length", "found"), verify,
                                             "own bigint, class bigint, shared bigint"), "decontam-pairs")
    return common.only(texts.select(F.col("id").alias("doc_id"), "own"), found.select("own").distinct(), "own").join(found, "own").select(
        "doc_id", "own", "class", "shared")


def _pairs(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80,
           doc_col: str = "doc_id", doc_text: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, own, item_id, shared, item_shingles) of every verified pair; ``own`` is a hash of the document's text."""
    texts = docs.select(F.col(doc_col).cast("bigint").alias("id"), common.text_hash(doc_text).alias("own"),
                        F.col(doc_text).cast("string").alias("text")).where("text is not null")
    classes, members = _signed(items, shingle, item_col, item_text)
    n, total = classes.agg(F.count("*"), F.coalesce(F.sum(F.size("found").cast("bigint")), F.lit(0))).first()
    small = 8 * total + 12 * COORDS * n <= INDEX_BYTES
    found = (_found_in_tasks if small else _found_by_shuffle)(texts, classes, percent)
    return found.join(members, "class").select("doc_id", "own", "item_id", "shared", "item_shingles")


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80, **columns) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of every verified pair; ``columns`` as in :func:`clean`."""
    return _pairs(docs, items, shingle, percent, **columns).drop("own").withColumn(
        "containment", F.col("shared") / F.col("item_shingles"))


def clean(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80, doc_col: str = "doc_id",
          doc_text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item, rows with a null or repeated id decided by their own text."""
    found = _pairs(docs, items, shingle, percent, doc_col, doc_text, item_col, item_text)
    return common.without_texts(docs, found.select(F.col("doc_id").alias("id"), "own"), doc_col, doc_text)


ORACLE_SQL = r"""
WITH item AS (
  SELECT item_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), doc AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), item_shingle AS (
  SELECT DISTINCT item_id, r, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT *, least(5, len(w)) AS m FROM item WHERE len(w) > 0), unnest(range(1, len(w) - m + 2)) AS t(i)
), item_size AS (
  SELECT item_id, r, count(*) AS n FROM item_shingle GROUP BY ALL
), doc_shingle AS (
  SELECT DISTINCT doc_id, r, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT * FROM doc, (SELECT DISTINCT m FROM item_shingle)), unnest(range(1, len(w) - m + 2)) AS t(i)
)
SELECT d.doc_id, i.item_id, count(*) AS shared, n AS item_shingles, count(*) / n AS containment
FROM doc_shingle d JOIN item_shingle i USING (m, s) JOIN item_size z ON z.r = i.r
GROUP BY d.doc_id, d.r, i.item_id, i.r, n HAVING 100 * count(*) >= 80 * n
"""

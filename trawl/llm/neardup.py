"""Near-duplicate groups by a signature-coordinate inverted join.

1. Every text becomes its set of hashed word shingles, a 128-bit key of the
   set and a signature of ``COORDS`` minima.  Equal sets are one class, kept by
   its smallest id, so exact copies cost one row each and no pairs.
2. The signature's coordinates are its ``POSTED`` runs of ``WIDTH`` minima, and every
   class is posted under its (coordinate, value) pairs.  Two sets at the wanted
   similarity s agree in a coordinate with chance ``s ** WIDTH``, so in at least
   ``matches_needed`` coordinates but for a chance of ``MISS``; two that do share a pair
   among the ``POSTED - needed + 1`` rarest of each side, so only those postings
   are kept.  Values seen once never make a posting.
3. In each posting list collisions are counted minimum by minimum over the
   whole signatures, against a threshold missed as rarely, and members found to
   belong to a seen member's group are skipped as partners of it.  Each list gives
   one row per member and group, never its pairs.
4. Each group of candidates is read again as whole texts and all its
   pairs are decided on exact intersections of full shingle sets (a
   blocked matrix product); the links leave as a spanning forest.
5. Connected components over the links.

Lists and groups above a block's size are dealt out as pairs of blocks, so
a task's memory is bounded while every pair is still compared.  Candidate
groups in which few pairs reach the threshold cost their square
in (vectorised) comparisons; that is the price of losing no link.

Cases: a text with fewer words than a shingle is one shingle; a text without
words (or null) has an empty set, links to nothing and is its own component.
Rows with one id are one vertex; rows with a null id come back with a
null component, kept.  An empty table gives an empty result.  Other
columns pass by, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm import common
from trawl.llm.graph import components

COORDS = 64                    # minima of a signature
WIDTH = 2                      # minima of a posted coordinate
POSTED = COORDS // WIDTH
MISS = 1e-6                    # chance that a pair exactly at the threshold is not a candidate
LIST_BLOCK = 4096              # members of a posting list per block
GROUP_BLOCK_DOCS = 1500        # members of a candidate group per block
GROUP_BLOCK_SHINGLES = 1_000_000
BROADCAST_BYTES = 32 << 20
BATCH_CHARS = 1 << 20

_SEEDS = np.random.default_rng(20240917).integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matches_needed(p: float, coords: int, miss: float = MISS) -> int:
    """Largest t with P(Binomial(coords, p) < t) <= miss."""
    below = 0.0
    for t in range(coords + 1):
        below += math.comb(coords, t) * p ** t * (1 - p) ** (coords - t)
        if below > miss:
            return t
    return coords


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for run in common.batches(texts, len, BATCH_CHARS):
        words, counts = common.word_hashes(run)
        for w in np.split(words, np.cumsum(counts)[:-1]):
            yield np.unique(common.shingles(w, size))


def signature(found: np.ndarray) -> np.ndarray:
    best = np.full(COORDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for part in np.array_split(found, max(1, len(found) // 2048)):
        best = np.minimum(best, (part[:, None] * _SEEDS).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """id, n, set_key, sig per row of (id, text)."""
    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for s in shingle_sets(part["text"].tolist(), size):
                key = (int(s.sum(dtype=np.uint64)).to_bytes(8, "little")
                       + int(np.bitwise_xor.reduce(common.mix(s))).to_bytes(8, "little")) if len(s) else None
                out.append((len(s), key, signature(s) if len(s) else None))
            yield pd.DataFrame({"id": part["id"].astype("Int64"), "n": [o[0] for o in out],
                                "set_key": [o[1] for o in out], "sig": [o[2] for o in out]})

    return common.map_pandas(docs, sign, "id bigint, n bigint, set_key binary, sig array<int>")


def _prefixes(classes: DataFrame, needed: int) -> DataFrame:
    """(token, members, id, n, sig): each class under its rarest shared coordinate values."""
    def posting(c):
        return F.xxhash64(c, *[F.get("sig", c * WIDTH + i) for i in range(WIDTH)])

    tokens = classes.select("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(POSTED - 1)), posting)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    own = tokens.join(shared, "token").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("members", "token"))).alias("t"))         # at most POSTED
    kept = own.where(F.size("t") >= needed).select(
        "id", F.explode(F.slice("t", F.lit(1), F.size("t") - (needed - 1))).alias("t"))
    return kept.select("id", "t.*").join(classes.select("id", "n", "sig"), "id")


def _list_groups(sig: np.ndarray, n: np.ndarray, needed: int, percent: int) -> np.ndarray:
    """Leader (a position) of each member's group in one posting list."""
    leader = np.full(len(n), -1)
    left = np.arange(len(n))
    while len(left):
        first, left = left[0], left[1:]
        leader[first] = first
        front = [first]
        while front and len(left):
            x = front.pop()
            like = ((sig[left] == sig[x]).sum(axis=1) >= needed) & _sizes_fit(n[left], n[x], percent)
            found, left = left[like], left[~like]
            leader[found] = first
            front.extend(found.tolist())
    return leader


def _sizes_fit(a, b, percent: int):
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


def _candidates(lists: DataFrame, needed: int, percent: int) -> DataFrame:
    """(a, b): members of one posting list and the leader of their group there."""
    keys = ["token", "bi", "bj"]

    def match(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in common.whole_groups(parts, keys):
            bounds = common.run_bounds(part, keys)
            sizes = np.diff(bounds)
            ids, n = part["id"].to_numpy(), part["n"].to_numpy()
            sig = np.concatenate(part["sig"].to_list()).reshape(-1, COORDS)
            two = bounds[:-1][sizes == 2]
            like = ((sig[two] == sig[two + 1]).sum(axis=1) >= needed) & _sizes_fit(n[two], n[two + 1], percent)
            a, b = [ids[two[like]]], [ids[two[like] + 1]]
            for s, e in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2], strict=True):
                leader = _list_groups(sig[s:e], n[s:e], needed, percent)
                other = leader != np.arange(e - s)
                a.append(ids[s:e][leader[other]])
                b.append(ids[s:e][other])
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    blocks = F.ceil(F.col("members") / LIST_BLOCK)
    return common.map_pandas(common.block_pairs(lists, "token", blocks, "id"), match, "a bigint, b bigint")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all pairwise intersections."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    shared = counts[inverse] > 1
    column, owner = column[inverse[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)     # exact below 2**24
    width = 2048
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        s, e = np.searchsorted(column, (start, start + width))
        x = np.zeros((len(sets), width), dtype=np.float32)
        x[owner[s:e], column[s:e] - start] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric boolean matrix."""
    out, left = [], np.ones(len(link), dtype=bool)
    for start in range(len(link)):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            x = front.pop()
            found = np.flatnonzero(link[x] & left)
            left[found] = False
            out.extend((x, y) for y in found.tolist())
            front.extend(found.tolist())
    return out


def _links(groups: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the exact links inside each candidate group."""
    keys = ["component", "bi", "bj"]

    def confirm(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in common.whole_groups(parts, keys):
            bounds, ids, texts = common.run_bounds(part, keys), part["id"].to_numpy(), part["text"].tolist()
            out = []
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                if e - s < 2:
                    continue
                sets = list(shingle_sets(texts[s:e], size))
                n = np.array([len(x) for x in sets])
                both = _intersections(sets)
                link = 100 * both >= percent * (n[:, None] + n[None, :] - both)
                out.extend((ids[s + i], ids[s + j]) for i, j in _forest(link))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    blocks = F.greatest(F.ceil(F.col("docs") / GROUP_BLOCK_DOCS), F.ceil(F.col("shingles") / GROUP_BLOCK_SHINGLES))
    return common.map_pandas(common.block_pairs(groups, "component", blocks, "id"), confirm, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked when 100 * |intersection| >= percent * |union| of
    their shingle sets; a component's smallest id is kept.
    """
    spark = docs.sparkSession
    share = percent / 100
    needed, posted = matches_needed(share, COORDS), matches_needed(share ** WIDTH, POSTED)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = common.written(_signed(texts, shingle), "signatures")
    classes = common.written(
        signed.where("set_key is not null and id is not null").groupBy("set_key").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")

    coarse = components(_candidates(_prefixes(classes, posted), needed, percent))
    sized = coarse.join(classes.select("id", "n"), "id")
    totals = sized.groupBy("component").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    members = common.written(sized.join(totals, "component").select("id", "component", "docs", "shingles"), "members")
    # A member row is four longs; beyond the bound the join shuffles.
    small = members.count() * 64 <= BROADCAST_BYTES
    groups = texts.join(F.broadcast(members) if small else members, "id")

    linked = components(_links(groups, shingle, percent))
    labels = classes.select("set_key", "id").join(linked, "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component"))
    return (signed.select("id", "n", "set_key").join(labels, "set_key", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id.

    Rows with a null id are decided like others: equal texts among them are one document, whose id
    is above all that are given.  Of rows with one id the one with the smallest text stays.
    """
    name = common.free_name(docs, "own_id")
    # A hash in the upper quarter of the longs stands for a missing id.
    unnamed = F.lit(1 << 62) + F.shiftrightunsigned(common.text_hash(text_col), 2)
    docs = docs.withColumn(name, F.coalesce(F.col(id_col).cast("bigint"), unnamed))
    found = common.written(near_duplicates(docs, shingle, percent, name, text_col), "near-duplicates")
    kept = common.without(docs, found.where("not kept").select("doc_id"), name)
    repeated = common.written(found.where("kept").groupBy("doc_id").agg(
        F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias(name)), "repeated")
    if repeated.isEmpty():
        return kept.drop(name)
    single = common.without(kept, repeated, name)
    one = kept.join(repeated, name).groupBy(name).agg(
        F.min_by(F.struct(*docs.columns), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("row"))
    return single.unionByName(one.select("row.*")).drop(name)

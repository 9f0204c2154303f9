"""Approximate nearest neighbours by shifted space-filling curves.

Equal vectors are one point.  Every point is projected ``CURVES`` times
(random rotation, ``DIMS`` of the rotated axes, random shift), and each projection
is put on a Hilbert curve.  Spark range-partitions and sorts the (curve,
key) pairs, which gives every point one position per curve.  A query's candidates are the
points within a window around each of its positions, clipped to the curve; blocks
of neighbouring positions of one curve, which hold a point once, are scored together, and the
best of all windows are merged, once each, and ranked by the exact distance in double precision.

The window is not guessed: for ``CALIBRATION`` query points the true
neighbours are found by brute force (a bounded set against all rows, in one
pass), and the window is the distance in positions that holds
``TARGET_RECALL`` of them on their best curve.  Centre and scale of the projections
come from at most about ``FIT_ROWS`` rows.  Every row is indexed.

Cases: vectors that are null, zero, hold a null or a non-finite component,
or differ in length from the most frequent one take no part, nor do rows with a
null id.  Of equal vectors the smallest ids come first (k + 1 of them are enough
for any answer, which is why a vector shared by a third of all rows costs
nothing).  Fewer than k candidates give fewer rows.  Repeated ids keep one row.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm import common

CURVES = 8
DIMS, BITS = 12, 5             # one key has DIMS * BITS bits
BLOCK = 4096                   # positions scored together
CALIBRATION = 64
TARGET_RECALL = 0.96
FIT_ROWS = 5000
SLACK = 16                     # more than k are kept before the exact distance decides
HUGE = 2.0 ** 480              # squares of components up to here can be summed


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, dims) below ``2 ** bits``.

    Axes are turned level by level into the curve's transposed index, whose bits
    are then interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(dims):
            on = (x[i] & bit) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << one | x[i] >> np.uint64(level) & one
    return key


class Curves:
    """The projections, fitted on a sample of points (n, d)."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.centre = (sample / len(sample)).sum(axis=0)
        self.axes, self.low, self.width = [], [], []
        for _ in range(CURVES):
            turned = np.linalg.qr(rng.normal(size=(d, d)))[0][:, :min(DIMS, d)]
            on = np.clip(sample - self.centre, -HUGE, HUGE) @ turned
            scale = np.maximum(on.std(axis=0), 1e-12) * 8
            self.axes.append(turned)
            self.low.append(-scale / 2 * (1 + 0.2 * (rng.random(len(scale)) - 0.5)))     # the shift
            self.width.append(scale)

    def keys(self, points: np.ndarray) -> np.ndarray:
        """(n, CURVES) keys."""
        out = np.empty((len(points), CURVES), dtype=np.int64)
        for c in range(CURVES):
            with np.errstate(over="ignore", invalid="ignore"):
                at = ((points - self.centre) @ self.axes[c] - self.low[c]) / self.width[c]
                cells = np.nan_to_num(np.clip(at * (1 << BITS), 0, (1 << BITS) - 1))
            out[:, c] = hilbert_keys(cells, BITS).astype(np.int64)
        return out


def _matrix(column) -> np.ndarray:
    rows = column.tolist()
    return np.concatenate(rows).astype(np.float64).reshape(len(rows), -1)


def nearest(points: np.ndarray, queries: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """(query, point, distance) of the k nearest allowed points of each query, by exact distance."""
    if not len(points) or not len(queries):
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    # Components too large to be squared are brought down by a power of two, which is exact.
    largest = max(np.abs(points).max(), np.abs(queries).max())
    scale = 2.0 ** max(0, int(np.frexp(largest)[1]) - 480)
    points, queries = points / scale, queries / scale
    near = (queries ** 2).sum(axis=1)[:, None] + (points ** 2).sum(axis=1) - 2 * queries @ points.T
    if allowed is not None:
        near[~allowed] = np.inf
    m = min(k + SLACK, len(points))
    some = np.argpartition(near, m - 1, axis=1)[:, :m]
    barred = np.isinf(np.take_along_axis(near, some, axis=1))
    exact = np.sqrt(((points[some] - queries[:, None]) ** 2).sum(axis=2))
    exact[barred] = np.inf
    best = np.argsort(exact, axis=1, kind="stable")[:, :k]
    q = np.repeat(np.arange(len(queries)), best.shape[1])
    p, dist = np.take_along_axis(some, best, axis=1).ravel(), np.take_along_axis(exact, best, axis=1).ravel()
    keep = np.isfinite(dist)
    with np.errstate(over="ignore"):
        return q[keep], p[keep], dist[keep] * scale


def usable(vector: Column) -> Column:
    """No null or non-finite component, and not all zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def _points(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Points (u, v) and the k + 1 smallest ids of each (u, id).  ``u`` is the smallest id."""
    same = ["h1", "h2"]
    first = Window.partitionBy(*same).orderBy("id")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    few = few.withColumn("u", F.min("id").over(Window.partitionBy(*same)))
    few = common.written(few, "points")
    return few.where("r = 1").select("u", "v", *same), few.select("u", "id")


def _positions(points: DataFrame, curves: Curves, total: int) -> DataFrame:
    """(u, curve, at): the position of each point on each curve, from 0 on every curve."""
    spark = points.sparkSession
    sent = spark.sparkContext.broadcast(curves)

    def keys(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                found = sent.value.keys(_matrix(part["v"]))
                yield pd.DataFrame({"u": np.repeat(part["u"].to_numpy(), CURVES),
                                    "curve": np.tile(np.arange(CURVES, dtype=np.int32), len(part)), "key": found.ravel()})

    keyed = common.written(common.map_pandas(points.select("u", "v"), keys, "u bigint, curve int, key bigint"), "curve-keys")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = common.written(
        keyed.repartitionByRange(common.partitions(spark), "curve", "key", "u").sortWithinPartitions("curve", "key", "u")
        .select("u", "curve", F.spark_partition_id().alias("part"), local.alias("local")), "curve-order")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))           # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # Each curve holds all points, so it begins at a multiple of their number.
    at = F.col("start") + F.col("local") - F.col("curve") * F.lit(total)
    return ordered.join(F.broadcast(starts), "part").select("u", "curve", at.alias("at"))


def _window(points: DataFrame, positions: DataFrame, queries: DataFrame, k: int) -> int:
    """Positions on either side that hold the wanted share of true neighbours."""
    spark = points.sparkSession
    some = queries.orderBy(F.xxhash64("u", F.lit(3)), "u").limit(CALIBRATION).select("u", "v").collect()
    if not some:
        return 1
    ids = np.array([r.u for r in some])
    sent = spark.sparkContext.broadcast((ids, np.array([r.v for r in some], dtype=np.float64)))

    def brute(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors = sent.value
        for part in parts:
            own = part["u"].to_numpy()
            if len(own):
                q, p, dist = nearest(_matrix(part["v"]), vectors, k, own[None, :] != ids[:, None])
                yield pd.DataFrame({"q": ids[q], "u": own[p], "dist": dist})

    rank = F.row_number().over(Window.partitionBy("q").orderBy("dist", "u"))
    true = common.map_pandas(points.select("u", "v"), brute, "q bigint, u bigint, dist double").withColumn(
        "r", rank).where(F.col("r") <= k).select("q", "u")                 # at most CALIBRATION * k rows
    mine = positions.join(F.broadcast(spark.createDataFrame([(int(i),) for i in ids], "q bigint")), F.col("u") == F.col("q")).select(
        "q", "curve", F.col("at").alias("own"))
    apart = positions.join(F.broadcast(true), "u").join(F.broadcast(mine), ["q", "curve"])
    need = sorted(r.need for r in apart.groupBy("q", "u").agg(F.min(F.abs(F.col("at") - F.col("own"))).alias("need")).collect())
    return max(1, need[min(len(need) - 1, int(TARGET_RECALL * len(need)))]) if need else 1


def search(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           window: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``is_query`` picks."""
    rows = table.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.xxhash64(vector_col).alias("h1"), F.xxhash64(F.lit(1), vector_col).alias("h2"))
    length = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if length is None:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    one = Window.partitionBy("id").orderBy("v", F.desc("asks"))
    rows = rows.where(F.size("v") == length["size"]).withColumn("r", F.row_number().over(one)).where("r = 1").drop("r")
    points, members = _points(rows.drop("asks"), k)
    total = points.count()
    sample = points.where(F.pmod(F.xxhash64("u", F.lit(7)), F.lit(1 << 20)) <= FIT_ROWS / total * (1 << 20)).select("v")
    curves = Curves(np.array([r.v for r in sample.collect()] or [points.first().v], dtype=np.float64))
    positions = common.written(_positions(points, curves, total), "positions")
    asking = common.written(rows.where("asks").select("id", "h1", "h2").join(points, ["h1", "h2"]).select("id", "u", "v"), "queries")
    queries = asking.dropDuplicates(["u"]).select("u", "v")
    w = window or _window(points, positions, queries, k)

    placed = positions.join(points.select("u", "v"), "u")
    block = F.floor(F.col("at") / BLOCK)
    stay = placed.select("curve", block.alias("block"), F.lit(False).alias("asks"), "at", "u", "v")
    first = F.greatest(F.floor((F.col("at") - w) / BLOCK), F.lit(0).cast("bigint"))
    last = F.least(F.floor((F.col("at") + w) / BLOCK), F.lit((total - 1) // BLOCK).cast("bigint"))
    visit = positions.join(queries, "u").select("curve", F.explode(F.sequence(first, last)).alias("block"), F.lit(True).alias("asks"), "at", "u", "v")
    cell = ["curve", "block"]
    dealt = stay.unionAll(visit).repartition(common.partitions(table.sparkSession), *cell).sortWithinPartitions(*cell)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in common.whole_groups(parts, cell):
            bounds = common.run_bounds(part, cell)
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                asks = part["asks"].to_numpy()[s:e]
                at, u = part["at"].to_numpy()[s:e], part["u"].to_numpy()[s:e]
                vectors = _matrix(part["v"].iloc[s:e])
                ids, points_, where = u[~asks], vectors[~asks], at[~asks]
                for some in np.array_split(np.flatnonzero(asks), -(-int(asks.sum()) // 256) or 1):
                    close = np.abs(where[None, :] - at[some][:, None]) <= w
                    q, p, dist = nearest(points_, vectors[some], k + 1, close)
                    yield pd.DataFrame({"q": u[some][q], "u": ids[p], "score": dist})

    found = common.map_pandas(dealt, score, "q bigint, u bigint, score double").dropDuplicates(["q", "u"])
    best = Window.partitionBy("q").orderBy("score", "u")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    # A query's own point is among them, with distance 0 and its other ids.
    pairs = found.join(members, "u").select("q", "id", "score").join(
        asking.select(F.col("id").alias("query_id"), F.col("u").alias("q")), "q").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))

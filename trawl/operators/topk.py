"""Top-k per group and ordered listings.

Per-group top-k is ``row_number() <= k`` over a window; Spark plans it as
a partial ``WindowGroupLimit`` before the shuffle and a final one after,
so at most k rows per group leave each map task, however large a group.
Spark leaves the partial limit out for k above a session setting
(``spark.sql.optimizer.windowGroupLimitThreshold``), so the setting is raised to k
where it is lower.  With ``parts`` above 1 a group is first cut to its best k in
that many parts, and only their winners meet in one task.
Ties: score descending, then doc id ascending, on the score rounded to
``digits`` places (float sums have no fixed order, so unrounded ties may
swap between engines).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.session import scratch_dir

SCORE_DIGITS = 6


def rounded(score: str = "score", digits: int | None = SCORE_DIGITS):
    return F.round(F.col(score), digits) if digits is not None else F.col(score)


GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k_per_group(scored: DataFrame, k: int, group: Sequence[str], score: str = "score",
                    tie: str = "doc_id", digits: int | None = SCORE_DIGITS, parts: int = 1) -> DataFrame:
    """Keep the best ``k`` rows of every group, numbered 1…k in ``rank``."""
    if k <= 0:
        raise ValueError("k must be positive")
    spark = scored.sparkSession
    if 0 <= int(spark.conf.get(GROUP_LIMIT)) < k:
        spark.conf.set(GROUP_LIMIT, str(k))
    s = scored.withColumn(score, rounded(score, digits))
    best = [F.col(score).desc(), F.col(tie).asc()]
    if parts > 1:
        s = s.withColumn("_part", F.pmod(F.xxhash64(tie), F.lit(parts)))
        first = Window.partitionBy(*group, "_part").orderBy(*best)
        s = s.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).drop("_part", "rank")
    w = Window.partitionBy(*group).orderBy(*best)
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def bucket_share(k: int, buckets: int) -> int:
    """Rows a bucket sends at first: its share of k and five standard deviations, as rows are dealt by a hash."""
    mean = k / buckets
    return min(k, math.ceil(mean + 5 * math.sqrt(mean) + 5))


def worth_two_passes(k: int, buckets: int) -> bool:
    return bucket_share(k, buckets) * 8 <= k


def top_k_of_buckets(scored: DataFrame, again: Callable[[DataFrame], DataFrame], k: int, group: Sequence[str], bucket: Column,
                     buckets: int, score: str = "score", tie: str = "doc_id", digits: int | None = SCORE_DIGITS,
                     parts: int = 1) -> DataFrame:
    """The best ``k`` rows of every group, as :func:`top_k_per_group` gives them, in two passes over hash buckets.

    First every bucket sends its share of k instead of k rows; they are written to the scratch
    folder (a job).  If the last row a bucket sent is not among the winners, no row behind it
    can be.  Otherwise the bucket may hold more winners: ``again`` gives the rows of such (group,
    ``_bucket``) pairs, more being harmless, and those behind the sent ones that beat the group's last
    winner join the merge.  With rows dealt by a hash that is rare; the result is exact
    however they lie.  A merge gets about k rows and a few from each bucket, not k from each.
    """
    spark, share = scored.sparkSession, bucket_share(k, buckets)
    best = [F.col(score).desc(), F.col(tie).asc()]
    cell = [*group, "_bucket"]

    def numbered(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn(score, rounded(score, digits)).withColumn("_bucket", bucket)
        return rows.withColumn("_sent", F.row_number().over(Window.partitionBy(*cell).orderBy(*best)))

    path = scratch_dir(spark, "top-k")
    numbered(scored).filter(F.col("_sent") <= share).write.parquet(path)
    few = spark.read.parquet(path)
    first = top_k_per_group(few, k, group, score, tie, None, parts)
    full = first.filter(F.col("_sent") == share).select(*cell)            # one for every ``share`` winners at most
    path = scratch_dir(spark, "top-k-again")
    full.write.parquet(path)
    full = spark.read.schema(full.schema).parquet(path)
    if full.isEmpty():
        return first.drop("_bucket", "_sent")
    # A group's k-th winner so far bounds what can still win.
    last = first.groupBy(*group).agg(F.count("*").alias("_n"), F.min(score).alias("_least"))
    more = numbered(again(full)).filter(F.col("_sent").between(share + 1, k)).join(full, cell, "left_semi")
    more = more.join(last, list(group)).filter((F.col("_n") < k) | (F.col(score) >= F.col("_least"))).select(*few.columns)
    return top_k_per_group(few.unionByName(more), k, group, score, tie, None, parts).drop("_bucket", "_sent")


def top_k(scored: DataFrame, k: int, score: str = "score", tie: str = "doc_id",
          digits: int | None = SCORE_DIGITS) -> DataFrame:
    """Global top-k (planned as TakeOrderedAndProject: k rows per task)."""
    if k <= 0:
        raise ValueError("k must be positive")
    s = scored.withColumn(score, rounded(score, digits))
    return s.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(k)


_ROW_BITS = (1 << 33) - 1                 # of monotonically_increasing_id, the row in its partition


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 0) -> DataFrame:
    """``df`` with ``name``: dense numbers from ``start`` in the global order of ``order``.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the rows of the partitions
    before, of which there is one figure each, so no task sees more than its partition.  The sorted rows are
    written once, as range bounds are sampled anew by every run.  Rows that tie get different numbers in
    no stated order, and meet in one partition: end ``order`` with a key.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "numbered")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row"))
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)                # one row per partition
    offsets = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + F.lit(start)).cast("long").alias(name))

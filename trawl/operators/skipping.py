"""Top-k without the documents that cannot win.

A query's score of a document is a sum over the query's terms, and no term adds more than its
limit: the model's value at the term's largest tf and its shortest or longest document, which the
term table holds.  That gives, for all queries at once:

1. the ``seeds``: the terms with the highest limits, until ``SEED_DEPTH`` times k postings;
   scores by these alone are a lower bound, and their k-th best is a query's threshold;
2. the ``essential`` terms: ordered by limit, the terms at the low end whose limits together
   stay below the threshold are not; a document that holds none of the essential
   terms cannot win;
3. the ``survivors``: documents whose score by the essential terms and the limits
   of the others together reach the threshold.

Only survivors are scored by all terms.  The terms left out are the common ones, whose match rows are
most of all.  Each step is exact: no winner, tied or not, is left out.  With several models a
term is essential, and a document survives, if so for any of them.

Queries that the seeds match in fewer than k documents have no threshold: all their terms are essential.
Term weights are not negative (k1 >= 0, 0 <= b <= 1, 0 < lam < 1, mu > 0).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.topk import top_k_per_group

# Postings of the seeds, as a multiple of k.
SEED_DEPTH = 4
# Scores are ranked by six places, so a score this far below a threshold cannot tie with it.
MARGIN = 2e-6


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def seeds(limits: DataFrame, models: Sequence[str], k: int) -> DataFrame:
    """(qkey, term): the terms of highest limit, until the postings before them are ``SEED_DEPTH`` times k."""
    def early(m: str) -> Column:
        before = Window.partitionBy("qkey").orderBy(F.desc(m), "term").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("df").over(before), F.lit(0)) < SEED_DEPTH * k

    flags = limits.select("qkey", "term", *[early(m).alias(f"s_{m}") for m in models])
    return flags.filter(_any([F.col(f"s_{m}") for m in models])).select("qkey", "term")


def thresholds(partial: DataFrame, models: Sequence[str], k: int) -> DataFrame:
    """(qkey, t_<models>): the k-th best of scores by some of the terms; null where there are fewer."""
    pairs = ", ".join(f"{i}, `{m}`" for i, m in enumerate(models))
    each = partial.selectExpr("qkey", "doc_id", f"stack({len(models)}, {pairs}) as (model, score)")
    last = top_k_per_group(each, k, ["model", "qkey"]).filter(F.col("rank") == k)
    return last.groupBy("qkey").agg(*[F.max(F.when(F.col("model") == i, F.col("score"))).alias(f"t_{m}") for i, m in enumerate(models)])


def essential(limits: DataFrame, known: DataFrame, models: Sequence[str]) -> DataFrame:
    """``limits`` with the thresholds and ``essential``: whether a document may win by this term and those of lower limit."""
    def needed(m: str) -> Column:
        upto = Window.partitionBy("qkey").orderBy(m, "term").rowsBetween(Window.unboundedPreceding, 0)
        return F.coalesce(F.sum(m).over(upto) >= F.col(f"t_{m}") - MARGIN, F.lit(True))

    flags = limits.join(known, "qkey", "left").select("*", *[needed(m).alias(f"e_{m}") for m in models])
    return flags.withColumn("essential", _any([F.col(f"e_{m}") for m in models])).drop(*[f"e_{m}" for m in models])


def rests(marked: DataFrame, models: Sequence[str]) -> DataFrame:
    """(qkey, t_<models>, r_<models>): thresholds, and what the terms that are not essential add at most."""
    return marked.groupBy("qkey").agg(
        *[F.max(f"t_{m}").alias(f"t_{m}") for m in models],
        *[F.sum(F.when(F.col("essential"), 0.0).otherwise(F.col(m))).alias(f"r_{m}") for m in models])


def survivors(part: DataFrame, rest: DataFrame, models: Sequence[str]) -> DataFrame:
    """(doc_id, qkeys) of the documents whose scores by the essential terms can still reach a threshold."""
    reach = [F.coalesce(F.col(m) + F.col(f"r_{m}") >= F.col(f"t_{m}") - MARGIN, F.lit(True)) for m in models]
    return part.join(rest, "qkey").filter(_any(reach)).groupBy("doc_id").agg(F.collect_list("qkey").alias("qkeys"))

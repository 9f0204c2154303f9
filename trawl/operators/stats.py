"""Corpus statistics of an index and the side-by-side analyzer report.

All numbers are exact integers.  Each figure is one aggregate over a
stored table; the analyzer comparison tokenises the corpus once for all
analyzers and needs one shuffle (distinct terms per analyzer, combined
map-side) plus a four-row final aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.analyzers import ENGLISH_STOP_WORDS, analyze
from trawl.operators.index import Index, spread
from trawl.operators.topk import numbered

# Analyzers of the comparison report, in report order.
COMPARED_ANALYZERS = ("standard", "keyword", "simple", "stop")


def num_docs(index: Index) -> DataFrame:
    return index.docs.agg(F.count(F.lit(1)).alias("n_docs"))


def vocabulary_size(index: Index, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct terms: the row count of the term table, or a HyperLogLog
    estimate over the postings (no term table needed) when ``approx``."""
    if approx:
        return index.postings.agg(F.approx_count_distinct("term", rsd).alias("vocabulary"))
    return index.terms.agg(F.count(F.lit(1)).alias("vocabulary"))


def docs_with_terms(index: Index) -> DataFrame:
    """Documents holding at least one term: a narrow count over the docs
    table (dl > 0 exactly when a document has postings) instead of a
    distinct over the far larger postings table."""
    return index.docs.agg(F.count(F.when(F.col("dl") > 0, 1)).alias("docs_with_terms"))


def token_count(index: Index) -> DataFrame:
    """Sum of document lengths (= sum of tf over postings, on a far smaller table)."""
    return index.docs.agg(F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("tokens"))


def posting_count(index: Index) -> DataFrame:
    """Sum of document frequencies (= rows of the postings, on a far smaller table)."""
    return index.terms.agg(F.coalesce(F.sum("df"), F.lit(0)).cast("long").alias("postings"))


def term_df(index: Index) -> DataFrame:
    return index.terms.select("term", "df")


def term_cf(index: Index) -> DataFrame:
    return index.terms.select("term", "cf")


def vocabulary(index: Index) -> DataFrame:
    """The sorted term list (a range-partitioned global sort)."""
    return index.terms.select("term").orderBy("term")


def vocabulary_ids(index: Index) -> DataFrame:
    """The vocabulary as a dictionary: (term, term_id), ids dense from 0 in the order of the terms."""
    return numbered(index.terms.select("term"), ["term"], "term_id")


def term_postings(index: Index, term: str) -> DataFrame:
    """Postings of one term: an equality filter pushed into the parquet scan."""
    return index.postings.filter(F.col("term") == term).select("term", "doc_id", "tf")


def index_stats(index: Index, term: str) -> DataFrame:
    """The seven figures of the index report in one row (``term`` is the probe)."""
    t = index.terms.filter(F.col("term") == term).agg(
        F.coalesce(F.max("df"), F.lit(0)).cast("long").alias("df_term"),
        F.coalesce(F.max("cf"), F.lit(0)).cast("long").alias("cf_term"))
    figures = index.stats_df.select("n_docs", "vocabulary", "docs_with_terms", "tokens", "postings")
    stacked = figures.unionByName(t, allowMissingColumns=True)
    cols = ["n_docs", "df_term", "cf_term", "vocabulary", "docs_with_terms", "tokens", "postings"]
    return stacked.agg(*[F.max(c).cast("long").alias(c) for c in cols]).select(
        F.lit(term).alias("term"), *cols)


def compare_analyzers(corpus: DataFrame, term: str,
                      analyzers: Sequence[str] = COMPARED_ANALYZERS,
                      approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row per analyzer: analyzer, n_docs, df_term, cf_term, vocabulary,
    docs_with_terms, tokens, postings — one read of the corpus for all.

    ``approx``: vocabulary as a HyperLogLog estimate (relative error
    ``rsd``); the report is then a single aggregate whose shuffle carries
    per-partition sketches only.  All other figures stay exact.
    """
    # Simple and Stop share one letter-run pass; Stop only filters its output.
    base = spread(corpus).select("text", analyze("text", "simple").alias("letters"))

    def tokens_of(a: str):
        if a == "simple":
            return F.col("letters")
        if a == "stop":
            return F.filter("letters", lambda t: ~t.isin(*ENGLISH_STOP_WORDS))
        return analyze("text", a)

    per_doc = base.select(F.explode_outer(F.array(*[
        F.struct(F.lit(a).alias("analyzer"), tokens_of(a).alias("toks")) for a in analyzers
    ])).alias("a")).select("a.analyzer", "a.toks")
    # Per-document figures are computed *before* the explode: an expression
    # over the token array in the same select as the generator would be
    # evaluated once per exploded row.
    doc = per_doc.select(
        "analyzer",
        F.size("toks").cast("long").alias("dl"),
        F.array_contains("toks", term).cast("long").alias("has"),
        F.size(F.filter("toks", lambda t: t == term)).cast("long").alias("cft"),
        F.array_distinct("toks").alias("dt")).withColumn("nd", F.size("dt").cast("long"))
    # Every document emits its distinct terms; its own figures ride on the
    # first of them (or on a null term when it has none).
    rows = doc.select("analyzer", "dl", "has", "cft", "nd",
                      F.posexplode_outer("dt").alias("pos", "term"))
    # Only distinctness counts from here on, and a keyword analyzer emits whole
    # documents, so every term is shuffled as two 64-bit hashes.
    rows = rows.withColumn("term", F.when(F.col("term").isNotNull(), F.struct(
        F.xxhash64("term").alias("a"), F.xxhash64(F.lit(1), F.col("term")).alias("b"))))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0

    def on_first(c):
        return F.sum(F.when(first, c).otherwise(0))

    if approx:
        return rows.groupBy("analyzer").agg(
            on_first(F.lit(1)).cast("long").alias("n_docs"),
            on_first(F.col("has")).cast("long").alias("df_term"),
            on_first(F.col("cft")).cast("long").alias("cf_term"),
            F.approx_count_distinct("term", rsd).alias("vocabulary"),
            on_first(F.when(F.col("dl") > 0, 1).otherwise(0)).cast("long").alias("docs_with_terms"),
            on_first(F.col("dl")).cast("long").alias("tokens"),
            on_first(F.col("nd")).cast("long").alias("postings"),
        ).withColumn("term", F.lit(term))

    per_term = rows.groupBy("analyzer", "term").agg(
        on_first(F.lit(1)).alias("docs"),
        on_first(F.when(F.col("dl") > 0, 1).otherwise(0)).alias("dwt"),
        on_first(F.col("dl")).alias("tok"),
        on_first(F.col("nd")).alias("post"),
        on_first(F.col("has")).alias("dft"),
        on_first(F.col("cft")).alias("cft"))
    return per_term.groupBy("analyzer").agg(
        F.sum("docs").cast("long").alias("n_docs"),
        F.sum("dft").cast("long").alias("df_term"),
        F.sum("cft").cast("long").alias("cf_term"),
        F.count("term").alias("vocabulary"),
        F.sum("dwt").cast("long").alias("docs_with_terms"),
        F.sum("tok").cast("long").alias("tokens"),
        F.sum("post").cast("long").alias("postings"),
    ).withColumn("term", F.lit(term))

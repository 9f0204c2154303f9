"""Map the driver's parquet tables onto the retrieval data model.

corpus  <- documents  (docno = doc_id as text, head = source, byline = lang,
                       dateline = n_chars as text, text = text)
topics  <- benchmark  (query_id = item_id, desc = whole text; title = the
           + pages      <title> of the page whose page_id is the item_id)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.text import extract_tag


_READ: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table, resolved once per session (file listing and
    footer schema are read once; the frame stays a lazy scan)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)  # the cached frame keeps its session alive
    if key not in _READ:
        _READ[key] = spark.read.parquet(path)
    return _READ[key]


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id LONG, docno, head, byline, dateline, text (all STRING)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("doc_id").cast("string").alias("docno"),
        F.col("source").alias("head"),
        F.col("lang").alias("byline"),
        F.col("n_chars").cast("string").alias("dateline"),
        F.col("text"),
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id INT, title STRING, desc STRING."""
    b = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    p = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("item_id"), "html")
    return b.join(p, "item_id", "left").select(
        F.col("item_id").cast("int").alias("query_id"),
        F.coalesce(extract_tag(F.col("html"), "title"), F.lit("")).alias("title"),
        F.col("text").alias("desc"),
    )

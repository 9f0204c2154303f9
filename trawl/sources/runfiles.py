"""Run files: ranked results as delimited text, one ordered file (in parts) per run id.

Run table schema: query_id INT, q STRING, docno STRING, rank INT,
score DOUBLE, run_id STRING.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "query_id int, q string, docno string, rank int, score double, run_id string"
RUN_COLUMNS = ("query_id", "q", "docno", "rank", "score", "run_id")

# Header lines of the two run-file layouts.
TFIDF_HEADER = ("QueryId", "Q", "DocID", "Rank", "Score", "RunID")
MODELS_HEADER_LINE = "QueryId\tQ\t\tDocID\t\tRank\t\tScore\t\t\tRunID"
MODELS_SEP = "\t\t"


def _write_run(run: DataFrame, path: str, sep: str, header: str) -> str:
    """One folder per run id whose part files, in name order, are the run
    file: the header line once, then the rows by query and rank."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in RUN_COLUMNS])
    rows = run.select(F.col("run_id").alias("_run"), "query_id", "rank", line.alias("value"))
    heads = run.select(F.col("run_id").alias("_run")).distinct().select(
        "_run", F.lit(None).cast("int").alias("query_id"), F.lit(0).alias("rank"), F.lit(header).alias("value"))
    order = ["_run", "query_id", "rank"]                   # nulls, the headers, come first
    (rows.unionByName(heads).repartitionByRange(*order).sortWithinPartitions(*order).select("_run", "value")
     .write.mode("overwrite").partitionBy("_run").text(path))
    return path


def write_tfidf_run(run: DataFrame, path: str) -> str:
    """Tab-separated."""
    return _write_run(run, path, "\t", "\t".join(TFIDF_HEADER))


def write_models_run(run: DataFrame, path: str) -> str:
    """Two tabs between columns; the header keeps its uneven tabs."""
    return _write_run(run, path, MODELS_SEP, MODELS_HEADER_LINE)


def _read_run(spark: SparkSession, path: str, sep: str, header: str) -> DataFrame:
    kinds = [f.split(" ") for f in RUN_SCHEMA.split(", ")]
    parts = F.split("value", sep)
    lines = spark.read.text(path).select("value").where(F.col("value") != header)
    return lines.select(*[F.get(parts, F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)])


def read_tfidf_run(spark: SparkSession, path: str) -> DataFrame:
    return _read_run(spark, path, "\t", "\t".join(TFIDF_HEADER))


def read_models_run(spark: SparkSession, path: str) -> DataFrame:
    return _read_run(spark, path, MODELS_SEP, MODELS_HEADER_LINE)

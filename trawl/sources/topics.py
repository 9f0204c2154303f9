"""Topic files: ``<top>…</top>`` blocks with ``<num> <title> <desc>`` fields.

Blocks end at a line starting with ``</top>``; blank lines are skipped,
the other lines are joined with a space, and an unfinished last block is
dropped without a message.  A number that does not parse goes to the
reject table instead of stopping the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.text import extract_labelled, java_trim, split_lines
from trawl.sources.trectext import _cut, _read_whole, _reader

# Field delimiters of a topic block (start tag, label, next tag).
NUM_FIELD = ("<num>", "Number:", "<dom>")
TITLE_FIELD = ("<title>", "Topic:", "<desc>")
DESC_FIELD = ("<desc>", "Description:", "<smry>")

_TOP_CLOSE_LINE = r"(?<![^\r\n])</top>[^\r\n]*(?:\r\n|\r|\n)?"


def topic_blocks(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """path, rec_pos, block (non-blank lines, each followed by one space)."""
    chunks = _cut(_read_whole(_reader(spark, "fail"), path, encoding), _TOP_CLOSE_LINE).filter(~F.col("is_tail"))
    lines = F.filter(split_lines(F.col("chunk")), lambda l: F.length(java_trim(l)) > 0)
    block = F.concat(F.array_join(lines, " "), F.when(F.size(lines) > 0, F.lit(" ")).otherwise(F.lit("")))
    return chunks.select("path", "rec_pos", block.alias("block"))


def parse_topic_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(topics, rejected)``: query_id INT, title, desc."""
    b = F.col("block")
    num = extract_labelled(b, *NUM_FIELD)
    parsed = blocks.select(
        "path", "rec_pos", "block",
        num.alias("num_text"),
        num.try_cast("int").alias("query_id"),
        extract_labelled(b, *TITLE_FIELD).alias("title"),
        extract_labelled(b, *DESC_FIELD).alias("desc"),
    )
    good = parsed.filter(F.col("query_id").isNotNull()).select("query_id", "title", "desc")
    bad = parsed.filter(F.col("query_id").isNull()).select(
        "path", F.col("block").alias("raw"),
        F.concat(F.lit("topic number is not an integer: '"), F.col("num_text"), F.lit("'")).alias("reason"))
    return good, bad


def read_topics(spark: SparkSession, path: str, encoding: str = "utf-8") -> tuple[DataFrame, DataFrame]:
    return parse_topic_blocks(topic_blocks(spark, path, encoding))


def to_topic_blocks(topics: DataFrame, domain: str = "Retrieval", keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``<top>`` block per row of (query_id, title, desc)."""
    return topics.select(*keep, F.concat(
        F.lit("<top>\n\n<head> Tipster Topic Description\n<num> Number: "),
        F.lpad(F.col("query_id").cast("string"), 3, "0"),
        F.lit(f"\n<dom> Domain: {domain}\n\n<title> Topic: "), F.coalesce("title", F.lit("")),
        F.lit("\n\n<desc> Description:\n"), F.coalesce("desc", F.lit("")),
        F.lit("\n\n<smry> Summary:\n\n</top>\n"),
    ).alias("value"))


def write_topics(topics: DataFrame, path: str) -> str:
    to_topic_blocks(topics).write.mode("overwrite").text(path)
    return path

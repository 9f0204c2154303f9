"""TREC-text corpora: ``<DOC>…</DOC>`` records in a folder of text files.

Record rules (line based, as a line reader sees the file):

* a record ends at a line that *starts with* ``</DOC>``; the rest of that
  line is dropped;
* lines that start with ``<DOC>`` are dropped whole;
* the other lines are joined with ``line_join`` ('' glues the last word
  of a line to the first word of the next, as the reference does);
* a non-blank tail after the last ``</DOC>`` line is an unfinished record:
  it goes to the reject table and the file's earlier records are kept.

``mode="split"`` (default) reads files of any size in splits, cut on the bytes of
a line end and ``</DOC>``, and decodes each piece on its own; one row per split (its records and bytes) is
summed to give every record its position in its file, and the bytes against the file's size tell
whether the last record is closed.  Files whose only line ends are carriage returns are read
with ``line_end="\\r"``.  ``mode="whole"`` reads a file as one row: for files that mix line
ends, that begin with a ``</DOC>`` line or whose charset has no fixed byte order; files must then fit in
a task.  Both give the same records, rejects and positions.

A file that cannot be read (damaged, say, in its compressed form) fails nothing: what was
read of it before the damage is kept, and a file of which nothing could be read is a
row of the reject table without text.  ``unreadable="fail"`` turns that off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.functions.text import extract_tag, java_trim, split_lines
from trawl.operators.index import estimated_bytes, spread

# The record tags and the five document fields.
DOC_OPEN = "<DOC>"
DOC_CLOSE = "</DOC>"
FIELDS = ("DOCNO", "HEAD", "BYLINE", "DATELINE", "TEXT")

# A line starting with </DOC>, with the rest of the line and its break.
_CLOSE_LINE = r"(?<![^\r\n])</DOC>[^\r\n]*(?:\r\n|\r|\n)?"


def _records_from_chunks(chunks: DataFrame, line_join: str, drop_prefix: str,
                         keep_blank: bool) -> DataFrame:
    lines = split_lines(F.col("chunk"))
    kept = F.filter(lines, lambda l: ~l.startswith(drop_prefix))
    if not keep_blank:
        kept = F.filter(kept, lambda l: F.length(java_trim(l)) > 0)
    return chunks.select("path", "rec_pos", F.array_join(kept, line_join).alias("record"))


def _cut(raw: DataFrame, close_line: str) -> DataFrame:
    """(path, value) -> (path, rec_pos, chunk, is_tail)."""
    parts = raw.select("path", F.split("value", close_line).alias("parts"))
    # The last index is taken before the explode (see build_postings).
    parts = parts.select("path", (F.size("parts") - 1).alias("_last"), "parts")
    return parts.select("path", "_last", F.posexplode("parts").alias("rec_pos", "chunk")) \
        .select("path", "rec_pos", "chunk", (F.col("rec_pos") == F.col("_last")).alias("is_tail"))


def _reader(spark: SparkSession, unreadable: str):
    if unreadable not in ("reject", "fail"):
        raise ValueError(f"unreadable must be 'reject' or 'fail', not {unreadable!r}")
    skip = str(unreadable == "reject").lower()
    return spark.read.option("ignoreCorruptFiles", skip).option("ignoreMissingFiles", skip)


def _is_utf8(encoding: str) -> bool:
    return encoding.lower().replace("-", "") == "utf8"


def _decoded(encoding: str):
    """The text source hands on a file's bytes as they are; other charsets than UTF-8 are decoded here."""
    return F.col("value") if _is_utf8(encoding) else F.decode(F.col("value").cast("binary"), encoding)


def _read_whole(reader, path: str, encoding: str = "utf-8") -> DataFrame:
    """(path, value): one row per file."""
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), _decoded(encoding).alias("value"))


# One-row-per-split and one-row-per-file tables are broadcast up to this many rows.
BROADCAST_ROWS = 250_000


def _most_splits(df: DataFrame) -> int:
    """No scan of ``df``'s files has more splits than this; from the listing, without a job."""
    spark = df.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    size = estimated_bytes(df)
    per = min(conf.filesMaxPartitionBytes(), max(conf.filesOpenCostInBytes(), size // spark.sparkContext.defaultParallelism))
    return len(df.inputFiles()) + size // max(1, per)


def _read_split(reader, path: str, encoding: str = "utf-8", line_end: str = "\n") -> tuple[DataFrame, DataFrame]:
    """(path, rec_pos, chunk, is_tail) from splittable pieces, and the paths of which something was read."""
    meta = F.col("_metadata")
    separator = line_end + DOC_CLOSE
    pieces = (reader.option("lineSep", separator).option("encoding", encoding).text(path)
              .select(meta["file_path"].alias("path"), meta["file_block_start"].alias("block"),
                      meta["file_size"].alias("size"), "value", F.monotonically_increasing_id().alias("at")))
    few = _most_splits(pieces) <= BROADCAST_ROWS
    # A split's pieces are numbered in a row, whichever task reads it.  One
    # row per split: at 128 MB a split, a million rows for 128 TB.
    splits = pieces.groupBy("path", "block").agg(
        F.min("at").alias("first"), F.count("*").alias("n"), F.max("size").alias("size"),
        F.sum(F.octet_length("value") + len(separator.encode(encoding))).alias("bytes"))
    in_file = Window.partitionBy("path")
    before = in_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("bytes").over(in_file)
    # All pieces are closed when their bytes and separators make up the file
    # (but for the reader's skipped byte order mark).
    closed = (total == F.col("size")) | (total == F.col("size") - 3)
    splits = splits.select("path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                           F.sum("n").over(in_file).alias("pieces"), closed.alias("closed"))
    read = splits.select("path").distinct()
    placed = pieces.drop("size").join(F.broadcast(splits) if few else splits.hint("merge"), ["path", "block"])
    pos = F.col("base") + F.col("at") - F.col("first")
    placed = placed.select("path", pos.alias("pos"), (~F.col("closed") & (pos == F.col("pieces") - 1)).alias("is_tail"),
                           _decoded(encoding).alias("value"))
    # Every piece but a file's first starts with the rest of a </DOC> line.
    rest = F.regexp_replace("value", r"^[^\r\n]*(?:\r\n|\r|\n)?", "")
    chunk = F.when(F.col("pos") > 0, rest).otherwise(F.col("value"))
    chunk = F.concat(chunk, F.when(F.col("is_tail"), F.lit("")).otherwise(F.lit(line_end)))
    return placed.select("path", F.col("pos").alias("rec_pos"), chunk.alias("chunk"), "is_tail"), read


def read_records(spark: SparkSession, path: str, line_join: str = "",
                 mode: str = "split", encoding: str = "utf-8", line_end: str = "\n",
                 unreadable: str = "reject") -> tuple[DataFrame, DataFrame]:
    """Return ``(records, rejected)``.

    records:  path, rec_pos, record (the joined lines of one ``<DOC>``)
    rejected: path, raw, reason
    """
    reader = _reader(spark, unreadable)
    if line_end not in ("\n", "\r"):
        raise ValueError("line_end must be a line feed (also for pairs of both) or a carriage return")
    if mode == "whole":
        raw = _read_whole(reader, path, encoding)
        chunks, read = _cut(raw, _CLOSE_LINE), raw.select("path")
    elif mode == "split":
        if encoding.lower().replace("-", "") in ("utf16", "utf32"):
            raise ValueError("without a fixed byte order (UTF-16LE, UTF-16BE) a file cannot be split; use mode='whole'")
        chunks, read = _read_split(reader, path, encoding, line_end)
    else:
        raise ValueError(f"mode must be 'whole' or 'split', not {mode!r}")
    complete = chunks.filter(~F.col("is_tail"))
    tail = chunks.filter(F.col("is_tail") & (F.length(java_trim(F.col("chunk"))) > 0))
    records = _records_from_chunks(complete, line_join, DOC_OPEN, keep_blank=True)
    rejected = tail.select("path", F.col("chunk").alias("raw"),
                           F.lit("record not closed by </DOC> before end of file").alias("reason"))
    if unreadable == "reject":
        # The listing against the files of which a row came; contents are not read for it.
        listed = reader.format("binaryFile").load(path).where(F.col("length") > 0).select(F.col("_metadata.file_path").alias("path"))
        lost = listed.join(read, "path", "left_anti").select(
            "path", F.lit(None).cast("string").alias("raw"), F.lit("nothing could be read of the file").alias("reason"))
        rejected = rejected.unionByName(lost)
    return records, rejected


def documents_from_records(records: DataFrame, text_only: bool = False) -> DataFrame:
    """Five tagged fields per record; a missing tag gives ''."""
    if text_only:
        return records.select("path", "rec_pos", extract_tag(F.col("record"), "TEXT").alias("text"))
    return records.select(
        "path", "rec_pos",
        *[extract_tag(F.col("record"), tag).alias(tag.lower()) for tag in FIELDS])


def read_trectext(spark: SparkSession, path: str, line_join: str = "",
                  mode: str = "split", text_only: bool = False, encoding: str = "utf-8", line_end: str = "\n",
                  unreadable: str = "reject") -> tuple[DataFrame, DataFrame]:
    """``(documents, rejected)`` of a TREC-text folder."""
    records, rejected = read_records(spark, path, line_join, mode, encoding, line_end, unreadable)
    return documents_from_records(records, text_only), rejected


def to_records(corpus: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``<DOC>`` record string per row of (docno, head, byline, dateline, text)."""
    parts = [F.lit(DOC_OPEN + "\n")]
    for tag in FIELDS[:-1]:
        parts += [F.lit(f"<{tag}> "), F.coalesce(F.col(tag.lower()), F.lit("")), F.lit(f" </{tag}>\n")]
    parts += [F.lit("<TEXT>\n"), F.coalesce(F.col("text"), F.lit("")), F.lit("\n</TEXT>\n" + DOC_CLOSE)]
    return corpus.select(*keep, F.concat(*parts).alias("value"))


def write_trectext(corpus: DataFrame, path: str) -> str:
    """Write records as text files, one per task."""
    to_records(spread(corpus)).write.mode("overwrite").text(path)
    return path


def number_documents(docs: DataFrame) -> DataFrame:
    """Give documents a dense, stable ``doc_id`` in (file path, record position) order.

    Only the per-file record counts (one row per file) are ordered to get
    each file's offset; the documents themselves are never sorted or moved.
    """
    if not {"path", "rec_pos"} <= set(docs.columns):
        raise ValueError("needs path and rec_pos, as the readers give them")
    counts = docs.groupBy("path").agg((F.max("rec_pos") + 1).cast("long").alias("n"))
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # One short row per file; while the files are few, documents stay in their splits.
    few = len(docs.inputFiles()) <= BROADCAST_ROWS
    return docs.join(F.broadcast(offsets) if few else offsets.hint("merge"), "path").withColumn(
        "doc_id", (F.col("offset") + F.col("rec_pos")).cast("long")).drop("offset")

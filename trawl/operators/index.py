"""Inverted index as five parquet tables.

postings  term STRING, doc_id LONG, tf LONG, dl LONG
          of the common terms, bucketed by doc_id and sorted by term inside each bucket
          (see write_index); the document length rides along so ranking needs
          no join with the documents table.
lists     part INT, term STRING, docs ARRAY<STRUCT<doc_id, tf, dl>>
          of all other terms, in folders by a hash of the term: a query reads the lists
          of its own terms, and the postings of rare terms that no query
          has (most terms are rare) are not read as rows
docs      doc_id LONG, docno STRING, dl LONG  (every document, dl may be 0)
terms     term STRING, df LONG, cf LONG, max_tf LONG, min_dl LONG, max_dl LONG
stats     one row: n_docs, docs_with_terms, tokens, postings, vocabulary, and a
          sketch of the vocabulary that merges with those of other indexes
deleted   doc_id LONG, bucketed like the postings, where documents were deleted

Build cost (bucketed layout): the text is read and shuffled once into doc-id
buckets, then tokenised and counted inside each bucket (no exchange) and
written to the scratch folder, one file per bucket; document lengths are a per-bucket aggregate
over these postings, and term statistics one aggregate over them.  The
postings of the common terms, a set of bounded size, are then copied inside their buckets, and
only those of the other terms are shuffled, into lists.  The statistics are observed while the
tables are written: nothing is read again to count it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trawl.functions.analyzers import analyze
from trawl.operators.topk import numbered
from trawl.session import scratch_dir

STATS_COLUMNS = ("n_docs", "docs_with_terms", "tokens", "postings", "vocabulary")


@dataclass
class CollectionStats:
    n_docs: int
    docs_with_terms: int
    tokens: int
    postings: int
    vocabulary: int

    @property
    def avgdl(self) -> float:
        # Average over *all* documents, as the library's BM25 does.
        return self.tokens / self.n_docs if self.n_docs and self.tokens > 0 else 1.0

    def avgdl_over(self, over: str = "all") -> float:
        if over == "all":
            return self.avgdl
        if over == "with_terms":
            return self.tokens / self.docs_with_terms if self.docs_with_terms else 1.0
        raise ValueError(f"avgdl_over must be 'all' or 'with_terms', not {over!r}")


@dataclass
class Index:
    postings: DataFrame
    docs: DataFrame
    terms: DataFrame
    stats_df: DataFrame
    analyzer: str = "standard"
    path: str | None = None
    buckets: int = 1
    # Where the index is split: the postings of terms in more than ``cut`` documents,
    # and the lists of the others.  ``postings`` is all of them in either case.
    common: DataFrame | None = None
    lists: DataFrame | None = None
    cut: int = 0
    list_parts: int = 1
    deleted: DataFrame | None = None
    _stats: CollectionStats | None = field(default=None, repr=False)

    @property
    def stats(self) -> CollectionStats:
        """The one-row statistics table, read once (five integers)."""
        if self._stats is None:
            row = self.stats_df.first()
            self._stats = CollectionStats(*[int(row[c] or 0) for c in STATS_COLUMNS])
        return self._stats


UNKNOWN_BYTES = 1 << 60
# Estimated corpus bytes (files, compressed) of a task that tokenises.
SPREAD_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of a plan's inputs as the optimizer knows it (file sizes for
    scans), at least ``UNKNOWN_BYTES`` where it does not; runs nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread(corpus: DataFrame) -> DataFrame:
    """Deal a corpus out for tokenising, the costly step: to every core, and ``SPREAD_BYTES`` a task.

    Rows go round-robin, as files may hold any size of text in one row group, which is one
    task however many splits there are; moving text costs little beside breaking it into
    terms.  A corpus of unknown size is not moved.  Where the rows are has no effect on
    results, and the decision starts no job.
    """
    size = estimated_bytes(corpus)
    if size >= UNKNOWN_BYTES:
        return corpus
    return corpus.repartition(max(corpus.sparkSession.sparkContext.defaultParallelism, math.ceil(size / SPREAD_BYTES)))


def doc_lengths(corpus: DataFrame, analyzer: str = "standard") -> DataFrame:
    """doc_id, docno, dl — narrow (a small input is only spread over the cores)."""
    corpus = spread(corpus)
    docno = F.col("docno") if "docno" in corpus.columns else F.col("doc_id").cast("string")
    return corpus.select("doc_id", docno.alias("docno"),
                         F.size(analyze("text", analyzer)).cast("long").alias("dl"))


def build_postings(corpus: DataFrame, analyzer: str = "standard", placed: bool = False) -> DataFrame:
    """term, doc_id, tf, dl — one row per (term, document).

    ``placed``: the rows are already hash-partitioned by doc_id; otherwise the texts are moved
    so, as they are several times smaller than their token rows.

    On such a corpus the count needs no exchange at
    all (the partitioning already clusters every (term, doc) key), and its
    output stays laid out as doc-id buckets.
    """
    # The length is taken in its own select: an array expression next to
    # the generator would carry (and copy) the whole array into every
    # exploded row, quadratic in document length.
    # explode_outer: an inner explode makes the optimizer add a
    # ``size(tokens) > 0`` filter with the whole tokenizer copied into it,
    # which would run the regex twice per document.
    corpus = corpus if placed else corpus.repartition(default_buckets(corpus), "doc_id")
    tokens = corpus.select("doc_id", analyze("text", analyzer).alias("toks"))
    sized = tokens.select("doc_id", F.size("toks").cast("long").alias("dl"), "toks")
    exploded = sized.select("doc_id", "dl", F.explode_outer("toks").alias("term")) \
        .filter(F.col("term").isNotNull())
    return exploded.groupBy("term", "doc_id", "dl").agg(F.count(F.lit(1)).alias("tf")) \
        .select("term", "doc_id", "tf", "dl")


def term_stats(postings: DataFrame) -> DataFrame:
    """term, df, cf, and between what its postings lie: max_tf, min_dl, max_dl."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"), F.max("tf").alias("max_tf"),
                                        F.min("dl").alias("min_dl"), F.max("dl").alias("max_dl"))


def stats_frame(docs: DataFrame, postings: DataFrame, terms: DataFrame) -> DataFrame:
    """One row of corpus statistics, from three independent aggregates."""
    d = docs.agg(F.count(F.lit(1)).alias("n_docs"),
                 F.count(F.when(F.col("dl") > 0, 1)).alias("docs_with_terms"),
                 F.coalesce(F.sum("dl"), F.lit(0)).alias("tokens"))
    p = postings.agg(F.count(F.lit(1)).alias("postings"))
    t = terms.agg(F.count(F.lit(1)).alias("vocabulary"))
    # Three one-row aggregates stacked and folded into one row.
    stacked = d.unionByName(p, allowMissingColumns=True).unionByName(t, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).cast("long").alias(c) for c in STATS_COLUMNS])


def in_memory_index(corpus: DataFrame, analyzer: str = "standard") -> Index:
    """Lazy index over a corpus, nothing written (small inputs, tests)."""
    postings = build_postings(corpus, analyzer)
    docs = doc_lengths(corpus, analyzer)
    terms = term_stats(postings)
    return Index(postings, docs, terms, stats_frame(docs, postings, terms), analyzer)


# Estimated corpus bytes (files, compressed) per doc-id bucket of a written index: a task counts and sorts
# the postings of a bucket, some 50 bytes for each of the corpus, in memory.
BUCKET_BYTES = 32 << 20

# Terms in at most this many documents are stored as lists.
LIST_DF = 64
# The most terms that are not lists: the cut is raised until no more can be above it,
# as a set of them is broadcast.
MAX_COMMON_TERMS = 500_000
# Documents of one row of a list, and bytes of a folder of lists, about.
LIST_ROWS = 4096
LIST_PART_BYTES = 64 << 20
_POSTING_BYTES = 24

_LISTS_COLS = "term STRING, docs ARRAY<STRUCT<doc_id: BIGINT, tf: BIGINT, dl: BIGINT>>, part INT"
_POSTINGS_COLS = "term STRING, doc_id BIGINT, tf BIGINT, dl BIGINT"
_DOCS_COLS = "doc_id BIGINT, docno STRING, dl BIGINT"


def default_buckets(corpus: DataFrame) -> int:
    """As many buckets as the corpus has ``BUCKET_BYTES``, at least one per
    shuffle partition; from the optimizer's estimate, so without a job."""
    shuffle = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(corpus)
    return max(1, shuffle, math.ceil(size / BUCKET_BYTES) if size < UNKNOWN_BYTES else 0)


def _table_name(path: str) -> str:
    """One catalog name per path, so reopening replaces and never adds."""
    return "trawl_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _drop_table(spark: SparkSession, path: str) -> None:
    """Forget the external table of ``path``; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")


def has_table_catalog(spark: SparkSession) -> bool:
    """Whether bucketed tables can be registered: the session catalog is Spark's own."""
    return spark.conf.get("spark.sql.catalog.spark_catalog", "builtin") == "builtin"


# A bucketed table is read bucket by bucket, and a task's rows, all of one bucket, are written as they
# come: without the second setting Spark sorts them by their bucket first.
_BUCKET_BY_BUCKET = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
                     "spark.sql.maxConcurrentOutputFileWriters": "4"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings, which are put back afterwards."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _save_bucketed(df: DataFrame, path: str, buckets: int, sort_cols: list[str]) -> None:
    """Write ``df``, hash-partitioned on doc_id into ``buckets`` partitions, one
    file per bucket, as an external table at ``path``.  Errors are the caller's.
    Without ``sort_cols`` the rows of a bucket stay in their order."""
    _drop_table(df.sparkSession, path)
    writer = df.write.mode("overwrite").bucketBy(buckets, "doc_id")
    with _settings(df.sparkSession, _BUCKET_BY_BUCKET):
        (writer.sortBy(*sort_cols) if sort_cols else writer).option("path", path).saveAsTable(_table_name(path))


def _register_bucketed(spark: SparkSession, path: str, cols: str, buckets: int, sort_cols: list[str]) -> DataFrame:
    """Attach the bucket spec of files written by :func:`_save_bucketed`."""
    _drop_table(spark, path)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_table_name(path)} ({cols}) USING parquet CLUSTERED BY (doc_id) "
              f"SORTED BY ({', '.join(sort_cols)}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(_table_name(path))


def _save(df: DataFrame, path: str, buckets: int, sort_cols: list[str], layout: str) -> None:
    if layout == "bucketed":
        _save_bucketed(df, path, buckets, sort_cols)
    else:
        (df.sortWithinPartitions(*sort_cols) if sort_cols else df).write.mode("overwrite").parquet(path)


# What is observed while the tables are written.  The sketch is a few kilobytes.
def _seen_in_postings() -> tuple:
    return F.count(F.lit(1)).alias("postings"), F.sum("tf").alias("tokens"), F.hll_sketch_agg("term", F.lit(14)).alias("sketch")


def _seen_in_docs() -> tuple:
    return F.count(F.lit(1)).alias("n_docs"), F.count(F.when(F.col("dl") > 0, 1)).alias("docs_with_terms")


def list_part(term: str, parts: int):
    """Folder of a term's list."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def list_rows(lists: DataFrame) -> DataFrame:
    """term, doc_id, tf, dl of lists."""
    return lists.select("term", F.explode("docs").alias("d")).select("term", "d.doc_id", "d.tf", "d.dl")


def _split_postings(stored: DataFrame, terms: DataFrame, total: int, path: str, buckets: int, layout: str) -> tuple[int, int]:
    """Write the postings of common terms, in their buckets, and the lists of the others; the cut and the folders.

    Fewer than postings / cut terms are above the cut, so their set can be broadcast at
    any size of the corpus.  The buckets are not moved; they are sorted by the numbers of the terms
    in term order, as one integer is sorted by its digits and a string by comparisons.
    The other terms' postings are shuffled once.
    """
    spark = stored.sparkSession
    cut = max(LIST_DF, total // MAX_COMMON_TERMS)
    above = F.broadcast(numbered(terms.where(F.col("df") > cut).select("term"), ["term"], "number"))
    common = stored.join(above, "term").sortWithinPartitions("number").select("term", "doc_id", "tf", "dl")
    _save(common, f"{path}/postings", buckets, [], layout)
    tail = int(terms.where(F.col("df") <= cut).agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"])
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tail * _POSTING_BYTES // LIST_PART_BYTES)
    piece = F.pmod(F.xxhash64("doc_id"), F.lit(-(-cut // LIST_ROWS)))         # a long list is several rows
    lists = (stored.join(above, "term", "left_anti").withColumn("part", list_part("term", parts)).repartition(parts, "part")
             .groupBy("part", "term", piece.alias("piece")).agg(F.collect_list(F.struct("doc_id", "tf", "dl")).alias("docs")))
    (lists.select("part", "term", "docs").sortWithinPartitions("part", "term").write.mode("overwrite")
     .partitionBy("part").parquet(f"{path}/lists"))
    return cut, parts


def _write_deleted(ids: DataFrame, path: str, buckets: int, layout: str) -> None:
    _save(ids.select("doc_id").repartition(buckets, "doc_id"), f"{path}/deleted", buckets, ["doc_id"], layout if layout != "range" else "docpart")


def delete_documents(index: Index, ids: DataFrame) -> Index:
    """The index with the documents of ``ids`` (a doc_id column) deleted, besides those that were before.

    They are no longer ranked; statistics stay as they are, as with deletions not yet merged away.
    Their ids are written beside the postings in the same buckets, so runs meet them without a shuffle,
    however many they are.
    """
    spark, path = index.docs.sparkSession, index.path
    stats = spark.read.parquet(f"{path}/stats")
    meta = stats.first()
    gone = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    if index.deleted is not None:
        gone = gone.unionByName(index.deleted)
    held = scratch_dir(spark, "deleted")                       # the table that is replaced is read for this
    gone.distinct().write.parquet(held)
    gone = spark.read.parquet(held)
    _write_deleted(gone, path, meta["buckets"], meta["layout"])
    # The one row of the statistics says that there is such a table; a rebuilt index has none.
    row = meta.asDict() | {"deletions": gone.count()}
    spark.createDataFrame([tuple(row[c] for c in stats.columns)], stats.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")
    return open_index(spark, path)


def vocabulary_estimate(indexes: list[Index]) -> DataFrame:
    """Distinct terms of several indexes together, from their stored sketches (about 1 % off)."""
    spark = indexes[0].docs.sparkSession
    sketches = spark.read.parquet(*[f"{i.path}/stats" for i in indexes]).select("sketch")
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("vocabulary"))


def write_index(corpus: DataFrame, path: str, analyzer: str = "standard",
                layout: str = "bucketed", buckets: int | None = None) -> Index:
    """Build and write the tables under ``path`` (overwrite), then open.

    layout="bucketed" (default): a document-partitioned index with lists of the
    rare terms.  postings and docs are bucketed by doc_id (postings sorted by term inside each bucket,
    so term filters still skip row groups).  A ranking scan then reports
    hash partitioning on doc_id: the per-(query, doc) aggregate needs no
    shuffle, each bucket yields its own top-k per query, and only those
    partial top-k rows are shuffled.
    layout="range": postings range-partitioned and sorted on (term, doc_id)
    (a term-partitioned index: narrower scans for single-term look-ups,
    but ranking shuffles every partial (query, doc) score).
    """
    spark = corpus.sparkSession
    n = buckets or default_buckets(corpus)
    if layout == "bucketed" and not has_table_catalog(spark):
        layout = "docpart"  # the same files, without bucket metadata
    if layout in ("bucketed", "docpart"):
        # The text is the cheapest form to move into doc-id buckets (token
        # rows are several times larger); tokenising and counting then run
        # inside each bucket with no further exchange.
        postings = build_postings(corpus.repartition(n, "doc_id"), analyzer, placed=True)
        raw = scratch_dir(spark, "postings")
        seen = Observation()
        _save(postings.observe(seen, *_seen_in_postings()), raw, n, [], layout)
        # Document lengths without a second pass over the text: every
        # posting carries dl, so a per-bucket aggregate over the written
        # postings gives it; documents without terms come from the id and
        # docno columns (dl = 0).
        stored = spark.table(_table_name(raw)) if layout == "bucketed" else spark.read.parquet(raw)
        lengths = stored.groupBy("doc_id").agg(F.max("dl").alias("dl"))
        docno = F.col("docno") if "docno" in corpus.columns else F.col("doc_id").cast("string")
        ids = corpus.select("doc_id", docno.alias("docno")).repartition(n, "doc_id")
        docs_df = ids.join(lengths, "doc_id", "left").select(
            "doc_id", "docno", F.coalesce(F.col("dl"), F.lit(0)).cast("long").alias("dl"))
        docs_seen = Observation()
        docs_df = (docs_df if layout == "bucketed" else docs_df.repartition(n, "doc_id")).observe(docs_seen, *_seen_in_docs())
        _save(docs_df, f"{path}/docs", n, ["doc_id"], layout)
    elif layout == "range":
        docs_df = doc_lengths(corpus, analyzer)
        postings = build_postings(corpus, analyzer)
        seen, docs_seen = Observation(), Observation()
        (postings.repartitionByRange(n, "term", "doc_id").sortWithinPartitions("term", "doc_id").observe(seen, *_seen_in_postings())
         .write.mode("overwrite").parquet(f"{path}/postings"))
        docs_df.observe(docs_seen, *_seen_in_docs()).write.mode("overwrite").parquet(f"{path}/docs")
        stored = spark.read.parquet(f"{path}/postings")
    else:
        raise ValueError(f"layout must be 'bucketed' or 'range', not {layout!r}")
    terms_seen = Observation()
    term_stats(stored).observe(terms_seen, F.count(F.lit(1)).alias("vocabulary")).write.mode("overwrite").parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    counts = {**docs_seen.get, **seen.get, **terms_seen.get}
    cut, parts = 0, 1
    if layout != "range":
        cut, parts = _split_postings(stored, terms, int(counts["postings"]), path, n, layout)
    # One row, from the observed figures.
    figures = [F.lit(int(counts[c] or 0)).cast("long").alias(c) for c in STATS_COLUMNS]
    sketch = F.lit(bytes(counts["sketch"]) if counts["sketch"] is not None else None).cast("binary")
    (spark.range(1).select(*figures, F.lit(analyzer).alias("analyzer"), F.lit(layout).alias("layout"), F.lit(n).alias("buckets"),
                           F.lit(cut).cast("long").alias("cut"), F.lit(parts).alias("list_parts"), sketch.alias("sketch"), F.lit(0).cast("long").alias("deletions"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/stats"))
    if layout == "bucketed":
        _drop_table(spark, raw)
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    stats_df = spark.read.parquet(f"{path}/stats")
    meta = stats_df.first()                         # one row
    if meta["layout"] == "bucketed":
        postings = _register_bucketed(spark, f"{path}/postings", _POSTINGS_COLS, meta["buckets"], ["term"])
        docs = _register_bucketed(spark, f"{path}/docs", _DOCS_COLS, meta["buckets"], ["doc_id"])
    else:
        postings = spark.read.parquet(f"{path}/postings")
        docs = spark.read.parquet(f"{path}/docs")
    deleted = spark.read.schema("doc_id BIGINT").parquet(f"{path}/deleted") if meta["deletions"] else None
    if meta["deletions"] and meta["layout"] == "bucketed":
        deleted = _register_bucketed(spark, f"{path}/deleted", "doc_id BIGINT", meta["buckets"], ["doc_id"])
    common, lists = postings, None
    if meta["layout"] != "range":
        # No list, no file: the schema is stated.
        lists = spark.read.schema(_LISTS_COLS).parquet(f"{path}/lists")
        postings = common.unionByName(list_rows(lists))
    return Index(
        postings=postings,
        common=common,
        lists=lists,
        deleted=deleted,
        cut=int(meta["cut"]),
        list_parts=int(meta["list_parts"]),
        docs=docs,
        terms=spark.read.parquet(f"{path}/terms"),
        stats_df=stats_df.select(*STATS_COLUMNS),
        analyzer=meta["analyzer"],
        path=path,
        buckets=int(meta["buckets"]),
        _stats=CollectionStats(*[int(meta[c] or 0) for c in STATS_COLUMNS]),
    )


_OPENED: dict[tuple, tuple[tuple, Index]] = {}


def index_for(spark: SparkSession, corpus, key: str, analyzer: str = "standard") -> Index:
    """Index of ``corpus`` built once per session and kept in the scratch folder.

    ``corpus`` is a DataFrame or a function returning one.  ``key`` names the corpus (for the driver
    tables: the folder they were read from); later calls reuse the written
    index while the corpus has the same files, sizes and modification times.
    """
    df = corpus() if callable(corpus) else corpus
    cache_key = (spark.sparkContext.applicationId, key, analyzer)
    state = _file_state(spark, df)
    if _OPENED.get(cache_key, (None,))[0] != state:
        _OPENED[cache_key] = (state, write_index(df, scratch_dir(spark, f"index-{analyzer}"), analyzer))
    return _OPENED[cache_key][1]


def _file_state(spark: SparkSession, df: DataFrame) -> tuple:
    """Input files with length and modification time (a listing, no job)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for file in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(file)
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((file, status.getLen(), status.getModificationTime()))
    return tuple(out)

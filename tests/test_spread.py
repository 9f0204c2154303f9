"""The costly steps get tasks of bounded size, whatever files the corpus lies in."""

import random

from pyspark.sql import functions as F

from trawl.functions import analyzers as A
from trawl.operators import index as I
from trawl.operators import rank
from trawl.plans.catalog import QUERIES

WORDS = "the fish don't 3.5 x_y über 漢字 カタ ไทย".split()


def _documents(spark, folder, n=200):
    """One file with one row group."""
    rows = [(i, " ".join(WORDS[(i * 7 + j) % len(WORDS)] for j in range(20)), "en", "s", 1) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_one_row_group_is_tokenised_by_several_tasks(spark, tmp_path):
    _documents(spark, tmp_path)
    for name in ("analyze_standard", "analyze_scripts"):
        found = QUERIES[name](spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
        assert found > 1, name


def test_a_large_corpus_is_dealt_out_by_bytes(spark, tmp_path, monkeypatch):
    docs = _documents(spark, tmp_path)
    monkeypatch.setattr(I, "estimated_bytes", lambda df: 1 << 30)
    assert I.spread(docs).rdd.getNumPartitions() == (1 << 30) // I.SPREAD_BYTES
    assert I.default_buckets(docs) >= 32
    monkeypatch.setattr(I, "estimated_bytes", lambda df: I.UNKNOWN_BYTES)
    assert I.spread(docs) is docs


def test_postings_are_counted_where_their_text_is(spark, tmp_path):
    docs = _documents(spark, tmp_path)
    postings = I.build_postings(docs)
    assert postings._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    want = {}
    for r in docs.select("doc_id", A.analyze("text").alias("t")).collect():
        for t in r["t"]:
            key = (t, r["doc_id"], len(r["t"]))
            want[key] = want.get(key, 0) + 1
    assert {(r["term"], r["doc_id"], r["dl"]): r["tf"] for r in postings.collect()} == want


def test_the_best_of_all_documents_reads_the_lists_of_its_terms(spark, tmp_path):
    index = I.write_index(_documents(spark, tmp_path), str(tmp_path / "index"))
    best = rank.tfidf_topk_all_docs(index, "fish", 5)
    assert "In(term, [fish])" in best._jdf.queryExecution().toString() or "EqualTo(term,fish)" in best._jdf.queryExecution().toString()
    all_scores = rank.tfidf_all_docs(index, "fish").orderBy(F.desc("score"), "doc_id").limit(5).collect()
    assert sorted((r["doc_id"], r["score"]) for r in best.collect()) == sorted((r["doc_id"], r["score"]) for r in all_scores)


def test_short_cuts_of_the_pattern_change_no_token(spark):
    """The pattern with its first alternative and look-ahead finds what the plain one finds."""
    chars = list("azAZ09_ '\":.,;-\n") + list("éµאײب٠漢あカｦกั๐한́­‍​‿’·，Ⅰ") + ["\U00020001", "\U0001f600"]
    r = random.Random(5)
    rows = [("".join(r.choice(chars) for _ in range(r.randint(0, 14))),) for _ in range(20000)]
    df = spark.createDataFrame(rows, "t string")

    def found(pattern):
        return F.regexp_extract_all("t", F.lit(pattern), 0)

    assert df.where(found(A.STANDARD_TOKEN) != found(A.ANY_TOKEN)).count() == 0

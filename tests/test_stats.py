"""Index statistics: invariants and the analyzer comparison by brute force."""

import pytest
from collections import Counter

import regex

from trawl.functions.analyzers import ENGLISH_STOP_WORDS, LETTER_TOKEN
from trawl.operators import stats
from trawl.operators.index import in_memory_index, open_index, write_index

DOCS = {1: "The fox and the dog.", 2: "A dog, a dog: THE dog!", 3: "of the and", 4: "Zebra"}


def corpus(spark):
    return spark.createDataFrame([(d, f"D{d}", t) for d, t in DOCS.items()], "doc_id long, docno string, text string")


def test_invariants_and_report(spark, tmp_path):
    idx = write_index(corpus(spark), str(tmp_path / "idx"))
    again = open_index(spark, str(tmp_path / "idx"))
    assert again.analyzer == "standard"
    terms = {r["term"]: (r["df"], r["cf"]) for r in idx.terms.collect()}
    assert terms == {"fox": (1, 1), "dog": (2, 4), "zebra": (1, 1)}
    st = idx.stats
    assert (st.n_docs, st.docs_with_terms, st.tokens, st.postings, st.vocabulary) == (4, 3, 6, 4, 3)
    assert sum(df for df, _ in terms.values()) == st.postings
    assert sum(cf for _, cf in terms.values()) == st.tokens
    row = stats.index_stats(again, "dog").first().asDict()
    assert row == {"term": "dog", "n_docs": 4, "df_term": 2, "cf_term": 4, "vocabulary": 3,
                   "docs_with_terms": 3, "tokens": 6, "postings": 4}
    docs = {r["doc_id"]: (r["docno"], r["dl"]) for r in idx.docs.collect()}
    assert docs == {1: ("D1", 2), 2: ("D2", 3), 3: ("D3", 0), 4: ("D4", 1)}
    assert [r["term"] for r in stats.vocabulary(idx).collect()] == ["dog", "fox", "zebra"]
    assert [tuple(r) for r in stats.term_postings(idx, "dog").orderBy("doc_id").collect()] == [
        ("dog", 1, 1), ("dog", 2, 3)]


def test_single_figures(spark):
    idx = in_memory_index(corpus(spark))
    assert stats.num_docs(idx).first()[0] == 4
    assert stats.docs_with_terms(idx).first()[0] == 3
    assert stats.token_count(idx).first()[0] == 6
    assert stats.posting_count(idx).first()[0] == 4
    assert stats.vocabulary_size(idx).first()[0] == 3


def test_compare_analyzers_brute_force(spark):
    got = {r["analyzer"]: r.asDict() for r in stats.compare_analyzers(corpus(spark), "the").collect()}

    def brute(name):
        toks = {}
        for d, t in DOCS.items():
            if name == "keyword":
                toks[d] = [t]
            else:
                words = regex.findall(LETTER_TOKEN, t.lower())
                toks[d] = [w for w in words if name == "simple" or w not in ENGLISH_STOP_WORDS]
        if name == "standard":
            from bruteforce import tokens
            toks = {d: tokens(t) for d, t in DOCS.items()}
        vocab = set(w for ts in toks.values() for w in ts)
        return {"analyzer": name, "term": "the", "n_docs": len(DOCS),
                "df_term": sum("the" in ts for ts in toks.values()),
                "cf_term": sum(Counter(ts)["the"] for ts in toks.values()),
                "vocabulary": len(vocab), "docs_with_terms": sum(bool(ts) for ts in toks.values()),
                "tokens": sum(len(ts) for ts in toks.values()),
                "postings": sum(len(set(ts)) for ts in toks.values())}

    for name in ("standard", "keyword", "simple", "stop"):
        assert got[name] == brute(name), name


def test_approximate_vocabulary(spark):
    idx = in_memory_index(corpus(spark))
    assert stats.vocabulary_size(idx, approx=True).first()[0] == 3


def test_write_errors_are_not_hidden(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    def refuse(self, *a, **k):
        raise RuntimeError("disk full")

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", refuse)
    with pytest.raises(RuntimeError, match="disk full"):
        write_index(corpus(spark), str(tmp_path / "broken"))


def test_index_without_table_catalog_is_plain_files(spark, tmp_path, monkeypatch):
    from trawl.operators import index
    monkeypatch.setattr(index, "has_table_catalog", lambda spark: False)
    idx = write_index(corpus(spark), str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain" / "stats")).first()["layout"] == "docpart"
    assert {r["term"]: r["df"] for r in idx.terms.collect()} == {"fox": 1, "dog": 2, "zebra": 1}
    assert sorted(tuple(r) for r in stats.term_postings(idx, "dog").collect()) == [("dog", 1, 1), ("dog", 2, 3)]


def test_range_layout(spark, tmp_path):
    idx = write_index(corpus(spark), str(tmp_path / "range"), layout="range")
    assert idx.stats.postings == 4
    assert sorted(tuple(r) for r in stats.term_postings(idx, "dog").collect()) == [("dog", 1, 1), ("dog", 2, 3)]


def test_compare_analyzers_approximate_vocabulary(spark):
    exact = {r["analyzer"]: r.asDict() for r in stats.compare_analyzers(corpus(spark), "the").collect()}
    approx = {r["analyzer"]: r.asDict() for r in stats.compare_analyzers(corpus(spark), "the", approx=True).collect()}
    assert exact == approx  # HyperLogLog is exact on a handful of terms

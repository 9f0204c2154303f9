"""Buckets of the index are sorted by term without comparing rows."""

import glob
import random
import re

import pyarrow.parquet as pq
import pytest

from trawl.operators import index as I


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["é", "漢", "z" * 12 + "1", "z" * 12 + "0"]
    rows = [(d, " ".join(r.choices(words, k=r.randrange(0, 25)))) for d in range(-150, 150)]
    return spark.createDataFrame([*rows, (3, "w1 w2 w2"), (None, "w1 w3")], "doc_id long, text string")


@pytest.fixture
def written_plans(spark, monkeypatch):
    """The plans of the tables that are saved, and the settings they are saved with."""
    seen = {}
    real = I._save

    def save(df, path, buckets, sort_cols, layout):
        with I._settings(spark, I._BUCKET_BY_BUCKET):
            seen[path.rsplit("/", 1)[1]] = (sort_cols, df._jdf.queryExecution().executedPlan().toString())
        real(df, path, buckets, sort_cols, layout)

    monkeypatch.setattr(I, "_save", save)
    return seen


@pytest.mark.parametrize("layout", ["bucketed", "docpart"])
def test_common_postings_are_sorted_by_one_number(spark, corpus, tmp_path, monkeypatch, written_plans, layout):
    monkeypatch.setattr(I, "LIST_DF", 5)
    idx = I.write_index(corpus, str(tmp_path / "i"), layout=layout, buckets=4)
    sort_cols, plan = written_plans["postings"]
    assert sort_cols == []                                     # else the writer sorts by bucket, term and doc_id
    keys = re.findall(r"Sort \[(.*?)\], false", plan)
    assert re.fullmatch(r"number#\d+L ASC NULLS FIRST", keys[0]), keys
    files = glob.glob(str(tmp_path / "i" / "postings" / "part-*.parquet"))
    assert len(files) == 4
    for f in files:
        terms = [t.encode() for t in pq.ParquetFile(f).read(columns=["term"])["term"].to_pylist()]
        assert terms == sorted(terms)
    want = sorted(map(tuple, I.build_postings(corpus).select("term", "doc_id", "tf", "dl").collect()), key=str)
    assert sorted(map(tuple, idx.postings.select("term", "doc_id", "tf", "dl").collect()), key=str) == want


def test_settings_of_a_write_are_put_back(spark, corpus, tmp_path):
    before = {k: spark.conf.get(k) for k in I._BUCKET_BY_BUCKET}
    I.write_index(corpus, str(tmp_path / "i"), buckets=3)
    assert {k: spark.conf.get(k) for k in I._BUCKET_BY_BUCKET} == before

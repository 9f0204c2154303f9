import importlib.util

import pytest
from pyspark.sql import functions as F

from trawl.llm import decontam, neardup
from trawl.llm.queries import tokenizer_file

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("no pipeline here", allow_module_level=True)

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        kept[name] = docs
        if name != "tokenize":
            assert docs.columns == columns and docs.dtypes == before.dtypes
    first = kept["language_id"]
    assert first.where(~F.col("text").rlike(r"\p{L}")).count() == 0
    assert first.count() == spark.read.parquet(f"{SF}/documents.parquet").where(F.col("text").rlike(r"\p{L}")).count()
    groups = neardup.near_duplicates(first, 5, 80)
    assert sorted(r.doc_id for r in kept["near_dedup"].collect()) == sorted(r.doc_id for r in groups.where("kept").collect())
    leaks = decontam.contaminated(kept["near_dedup"], spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").distinct()
    assert leaks.count() > 0
    assert kept["decontaminate"].count() == kept["near_dedup"].count() - leaks.count()
    assert kept["mix"].select("doc_id").distinct().join(kept["decontaminate"], "doc_id", "left_anti").count() == 0

    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    texts = [r.text for r in kept["mix"].orderBy("doc_id", "text").collect()]
    sizes = [len(t.encode(x, add_special_tokens=False).ids) + 1 for x in texts]
    got = kept["tokenize"].orderBy("start").collect()
    assert [r.n_tokens for r in got] == sizes
    assert [r.start for r in got] == [sum(sizes[:i]) for i in range(len(sizes))]


def test_awkward_rows(spark):
    rows = [(1, "the cat and the dog sat here", "en", "src1", 5), (1, "the cat and the dog sat here", "en", "src1", 5),
            (2, None, None, None, None), (3, "", "en", None, 0), (None, "words without an id for the test", None, "src2", 1), (4, "123", "en", "x", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name in ("near_dedup", "decontaminate"):
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    assert docs.count() > 0


def test_null_ids_are_decided_like_others(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(None, f"before {item} after", "en", "a", 1), (None, words, "en", "a", 1), (None, words, "en", "b", 2), (7, words + " more", "en", "a", 1),
            (8, "quite another text of eight words it is", "en", "a", 1), (9, "first of id nine", "en", "z", 1), (9, "another one of id nine", "en", "y", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = pipeline.near_dedup(spark, docs, SF)
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted(
        [("None", rows[0][1]), ("7", rows[3][1]), ("8", rows[4][1]), ("9", rows[6][1])])
    clean = pipeline.decontaminate(spark, docs, SF)
    assert sorted((str(r.doc_id), r.text) for r in clean.collect()) == sorted((str(r[0]), r[1]) for r in rows[1:])


def test_clashing_columns_come_through(spark):
    docs = spark.createDataFrame([(i, f"some text number {i}", "en", "s", 1, 5, 6, 7) for i in range(4)],
                                 SCHEMA + ", tokens int, copies int, own_id int")
    for name, stage in pipeline.STAGES[1:4]:
        docs = stage(spark, docs, SF)
        assert {tuple(r)[5:] for r in docs.collect()} == {(5, 6, 7)} and docs.columns[5:] == ["tokens", "copies", "own_id"]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0

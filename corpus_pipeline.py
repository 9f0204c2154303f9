"""Corpus pipeline: raw documents to a token file.

Each stage works on all that its predecessor kept and calls one operator of
``trawl.llm``; between stages the documents are written as Parquet in
the shared folder and read back.  All stages but the last return the
columns of ``documents``.

1. language_id: learn byte context trees from the labelled documents that are
   not held out; documents without a language (no text, no letter) go, and
   ``lang`` becomes the language found.
2. near_dedup: one document of each group of near copies (five-word shingles,
   similarity at least 0.8) stays, the one with the smallest id.
3. decontaminate: documents that hold a benchmark item go.
4. mix: documents are drawn for the target weights; one drawn in
   two epochs comes twice.
5. tokenize: token ids with Elias-Fano bounds, digests read back.

Empty inputs give empty results at every stage.  Rows with a null id are decided like others, by
their text; repeated rows of one id are one document of the near-dedup stage and one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import decontam, langid, mixing, neardup, tokens
from trawl.llm.common import free_name, table, written
from trawl.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = docs.where("doc_id is not null").where(~langid.held_out(F.col("doc_id")))
    return langid.keep_identified(docs, langid.train(known))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), shingle=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The operator's own columns must not replace a user's of the same name.
    names = {c: free_name(docs, f"_{c}") if c in ("tokens", "copies") else c for c in docs.columns}
    mixed = mixing.mix(docs.withColumnsRenamed(names), mixing.document_levels(), {"lang": mixing.LANG_TARGETS}, seed=17)
    each = mixed.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return each.select(*[F.col(names[c]).alias(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(docs, tokenizer_file(), end_id=2)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokenize", tokenize),
]

ORACLE_SQL = None      # the tokenizer, the language model and the 64-bit hashes have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

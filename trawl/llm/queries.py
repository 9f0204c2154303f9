"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import ann, chat, decontam, divergence, html, importance, langid, linededup, mixing, neardup, pii, quality, tokens
from trawl.llm.common import table, written


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn for the target weights, with the number of epochs of each."""
    return mixing.draw(table(spark, sf_dir, "documents"), mixing.document_levels(),
                       {"domain": mixing.DOMAIN_TARGETS, "lang": mixing.LANG_TARGETS}, seed=17)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that consists of control strings, read back from the written output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"))
    return chat.conversation_digests(written(chat.format_conversations(turns), "chat"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=2)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight and whether the draw keeps it."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                 shingle=5, percent=80)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_mixing": op2_mixing,
    "op3_personal_data": op3_personal_data,
    "op4_chat_format": op4_chat_format,
    "op5_token_file": op5_token_file,
    "op6_quality": op6_quality,
    "op7_main_text": op7_main_text,
    "op8_neighbours": op8_neighbours,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_decontaminate": op10_decontaminate,
    "op11_divergence": op11_divergence,
    "op12_line_dedup": op12_line_dedup,
    "op13_importance": op13_importance,
}

ORACLES: dict[str, str] = {
    "op2_mixing": mixing.ORACLE_SQL,
    "op4_chat_format": chat.ORACLE_SQL,
    "op10_decontaminate": decontam.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
    "op12_line_dedup": linededup.ORACLE_SQL,
    "op13_importance": importance.ORACLE_SQL,
}

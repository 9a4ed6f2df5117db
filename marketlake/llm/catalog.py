"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm.bpe import round_trip
from marketlake.llm.chat import format_chats
from marketlake.llm.common import table
from marketlake.llm.embedding_dedup import near_vectors
from marketlake.llm.exact_dedup import exact_groups
from marketlake.llm.line_dedup import delete_repeated_runs
from marketlake.llm.minhash import near_groups
from marketlake.llm.mixing import mix
from marketlake.llm.prefix_trie import rebuilt_trie
from marketlake.llm.quality import quality_scores
from marketlake.llm.quality_rules import quality_rules
from marketlake.llm.sharding import shard_documents
from marketlake.llm.structure_repair import damaged, repair_conversations
from marketlake.llm.url_filters import url_verdicts

SHARDS = 16
TOKENIZER = "word_bpe_49k.json"

#: The rule table of the registered URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_repeated_runs(table(spark, sf_dir, "documents"), run=3)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join("('{}', '{}', '{}')".format(*rule) for rule in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), entropy_share=0.95, repetition_limit=2.0)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), size=4, percent=80)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(conversations), conversations)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_sharding": op2_sharding,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_bpe": op4_bpe,
    "op5_url_filters": op5_url_filters,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_minhash": op9_minhash,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_structure_repair": op12_structure_repair,
    "op13_prefix_trie": op13_prefix_trie,
}

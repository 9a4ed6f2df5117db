"""Corpus pipeline: five of the training-data operators, one after another.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet
and read again as the next stage's docs. All stages but the last return the columns
of ``documents``:

1. quality classifier: documents scored under the threshold go;
2. exact dedup: one document of each group of equal texts stays;
3. MinHash near-dedup: one document of each group of near copies stays (five-word
   shingles, similarity 0.8);
4. mixing: under-represented sources are repeated, up to twice, until the sources
   reach 95 % of the entropy of an even mixture; no document is left out;
5. BPE: the documents with their token ids and the number of tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.bpe import encode
from marketlake.llm.catalog import tokenizer_path
from marketlake.llm.common import stored, table
from marketlake.llm.exact_dedup import drop_exact_copies
from marketlake.llm.minhash import keep_one_of_each
from marketlake.llm.mixing import mixed_documents
from marketlake.llm.quality import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, size=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, entropy_share=0.95, repetition_limit=2.0)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode(docs, tokenizer_path(), out="token_ids")
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("minhash_dedup", minhash_dedup),
    ("mixing", mixing),
    ("bpe_encoding", bpe_encoding),
]

#: The classifier, near-dedup and BPE stages are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Every stage's result is a Parquet table under
    the shared checkpoint folder, so a lost executor repeats tasks of one stage only."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

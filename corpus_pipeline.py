"""From raw documents to token ids: quality rules, quality classifier, near duplicates,
benchmark decontamination, byte-level BPE.

A stage takes (spark, docs, sf_dir) and gets all that its predecessor kept, read again
from the table it was written to, so a lost executor costs a re-read. All but the last
return the columns of ``docs``. Null texts fail the quality rules; null ids pass the
stages that compare ids. See the operators for the rest."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odotrack.llm.byte_bpe import encode_and_decode, load_ranks
from odotrack.llm.decontaminate import decontaminate
from odotrack.llm.kneser_ney import keep_good
from odotrack.llm.near_dedup import drop_near_duplicates
from odotrack.llm.quality_rules import keep_by_rules
from odotrack.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return keep_by_rules(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like the trusted ones of their language."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids instead of texts, and whether they decode to the text's bytes."""
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        *(c for c in docs.columns if c not in ("text", "ids", "n_tokens", "exact")),
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("exact"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokenization),
]

#: Perplexities and sketches are not for SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs

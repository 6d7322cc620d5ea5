"""The corpus pipeline: each stage applies one operator of ``wardlens.llm`` to all documents its predecessor
kept, is written as Parquet and read back as the next stage's documents.

Null ids, null texts, empty texts and repeated rows behave as the operators state; columns beside doc_id and text
are carried along, so extra ones stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import co_training, dart_minhash, decontaminate, secret_grammar, trie_bpe
from wardlens.llm.common import mark, release, stored, table
from wardlens.llm.registry import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return co_training.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return dart_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; a stored length follows its text."""
    out = secret_grammar.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    size = F.char_length("text").cast(dict(docs.dtypes)["n_chars"])
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(size, F.col("n_chars"))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return trie_bpe.bpe_rows(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# The classifier, the signatures and the trained automata cannot be stated in SQL; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole documents table. What a stage stored on its way, and its
    predecessor's documents, are deleted once its own documents are written."""
    docs, since = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, since, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)

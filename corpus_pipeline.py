"""The corpus pipeline: five stages over ``documents``, each an operator of
``affinity.llm``.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns the columns of ``documents``; the last returns the packed
pieces. ``run`` writes each result as Parquet into the shared checkpoint
folder and reads it again, so a lost executor costs one stage at most.

Rows with nulls: a null text is rejected by the first stage; null ids, labels
and sources pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import decontaminate, language_id, line_dedup, packing, simhash
from affinity.llm.common import shared_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language could be told; a null text or one
    without letters goes."""
    told = language_id.identify(docs)
    return told.filter("lang_pred <> 'und'").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their recurring lines; ``n_chars`` follows."""
    kept = line_dedup.dedup_lines(docs, min_chars=20, min_docs=3)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id."""
    return simhash.keep_one_of_each(docs, size=3, max_bits=3).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items, size=10).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of 2048 tokens."""
    from public_tokenizers import path

    return packing.pack(docs, path("byte_bpe_50k.json"), capacity=2048, separator=0, ranks=path("byte_bpe_50k.tiktoken"))


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("simhash_near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("best_fit_packing", pack_sequences)]

# Suffix automata, XXH64 and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

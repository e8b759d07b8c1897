"""The corpus pipeline: from raw documents to packed training batches, one operator a stage.

Every stage takes the rows that its predecessor kept and returns them with the same columns, but for
the last, which returns where each document is packed. Texts that a stage changes get their number of
code points anew, where there is such a column.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import ngram_join, packing, pii, substrings, toxicity
from kerbside.llm.common import small_batches
from kerbside.session import new_folder


def _counted(documents: DataFrame) -> DataFrame:
    if "n_chars" not in documents.columns:
        return documents
    kind = documents.schema["n_chars"].dataType
    return documents.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a toxicity of 0.7 or more, as learnt from labelled rows outside a held-out third."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fitted = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return toxicity.clean(docs, toxicity.fit(docs, fitted, "toxic"), 0.7)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a Jaccard similarity of 0.8 on five-word shingles, the one with
    the smallest doc_id stays."""
    small_batches(spark)
    return ngram_join.without_copies(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut byte strings of 100 or more that stand earlier in the corpus; all documents stay."""
    small_batches(spark)
    return _counted(substrings.without_repeats(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace e-mail and IP addresses, card and phone numbers, and what else stands in their contexts."""
    small_batches(spark)
    return _counted(pii.masked(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal documents to length buckets and batches of 32,768 tokens of the 50k vocabulary."""
    small_batches(spark)
    return packing.pack(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", drop_near_copies),
    ("substrings", cut_repeats),
    ("pii", mask_personal_data),
    ("packing", pack),
]

# Models and whole-corpus graphs are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again, on the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

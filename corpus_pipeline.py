"""A corpus cleaned, de-duplicated, mixed and tokenized. Each stage's result is written as Parquet and read as the next one's ``docs``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria.llm import bpe, exact, mixing, rules, simhash
from chondria.llm.common import importable, new_path, row_of, stored, unpacked


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.judged(docs).where("kept").select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact.exact_duplicates(docs).where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints, the row with the smallest id.

    Rows are told apart by id and text, so one whose id is that of a dropped row isn't lost with it. A NULL id is larger than any; rows of one id follow the
    digests of their texts. Of rows alike in id and text the smallest one stays. NULL text counts as empty.
    """
    # no id but the row's own: a smallest one is that of one row
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    found = stored(simhash.near_duplicates(docs.select(key.alias("key"), "text"), "key"), "near")
    gone = found.where("key <> component_id").select("key").distinct()
    again = found.where("key = component_id").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    rows = docs.select(row_of(docs, docs.columns), key.alias("key")).join(gone, "key", "left_anti")
    one = rows.join(again, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row"))
    return rows.join(again, "key", "left_anti").unionByName(one).select(unpacked(docs.columns))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mix = mixing.mixed(docs).where("copies > 0")
    return mix.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents, repeats included."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing to target weights", mixing_to_weights), ("byte-level BPE", tokens)]

#: The SimHash and robust-estimate stages have no SQL form; tests/llm hold the whole run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs

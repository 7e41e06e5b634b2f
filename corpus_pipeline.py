"""From raw documents to token ids: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm import bpe, decontaminate, quality, repeats, simhash
from larkspur.llm.common import lean
from larkspur.session import scratch_path

REPEAT_BYTES = 240  # a passage of over 50 words: a word and its blank take five bytes or so

ORACLE_SQL = None  # no stage can be put in SQL


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (score below 0.7)."""
    lean(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(model.column(F.col("text")) >= 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (4-word shingles, 4 bits) the document of smallest id stays. Rows without an id
    stay, as no group can name them; of equal rows one stays."""
    lean(spark)
    groups = simhash.near_duplicates(docs, words=4, max_bits=4)
    first = groups.where("doc_id = component_id").select("doc_id", F.lit(True).alias("_first")).distinct()
    kept = docs.join(first, "doc_id", "left").where(F.col("_first") | F.col("doc_id").isNull()).select(docs.columns)
    return kept.dropDuplicates(["doc_id", "text"])


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every string of `REPEAT_BYTES` bytes that occurs twice out of the texts; a character cut in two goes as a
    whole. Every row stays, even with an empty text."""
    lean(spark)
    out = repeats.with_kept(docs, size=REPEAT_BYTES).select("row", repeats.readable(F.col("kept")).alias("text"))
    return out.select(*[F.col("text") if c == "text" else F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"row.{c}") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window of 10 words."""
    lean(spark)
    keyed = docs.withColumn("_digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    found = decontaminate.contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, id_col="_digest")
    bad = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_digest")).distinct()
    return keyed.join(bad, "_digest", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of each document left."""
    lean(spark)
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))).drop("decoded")


STAGES = [
    ("quality", keep_quality),
    ("simhash", drop_near_duplicates),
    ("repeats", remove_repeats),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

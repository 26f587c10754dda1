"""One query per operator, over its whole table with the parameters of production."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listrata.llm import (
    alignment, decontamination, embeddings, language, line_dedup, manifest, near_duplicates, packing,
    personal_data, sharding, token_counts, toxicity, warc,
)
from listrata.llm.registry import query


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary lies, on the driver and on each executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer())


@query("op2_near_duplicates")
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.groups(read(spark, folder, "documents"), width=4)


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the lines that go and a digest of the text that stays."""
    cleaned = line_dedup.remove(read(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("removed"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"), tokenizer())


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return decontamination.report(decontamination.scan(docs.select("doc_id", "text"), benchmark))


@query("op5_warc")
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(read(spark, folder, "pages")).drop("archive", "offset", "length")


def fold(folds: int) -> Column:
    """CRC-32 of the document's number as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.spans(read(spark, folder, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(read(spark, folder, "documents"), read(spark, folder, "labels"), fold(5) != 0)


@query("op9_embeddings")
def op9_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.groups(read(spark, folder, "embeddings"))


@query("op10_language")
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "documents"), fold(4) != 2)


@query("op11_sharding")
def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read(spark, folder, "documents"))


@query("op12_manifest")
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.audit(read(spark, folder, "documents"), fold(2) == 0, F.replace("text", F.lit("\n"), F.lit("")))


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(read(spark, folder, "documents"), tokenizer(), tokenizer("piece_bpe_32k.model"))

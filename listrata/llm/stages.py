"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and calls one operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listrata.llm import decontamination, line_dedup, near_duplicates, packing
from listrata.llm import toxicity as toxic
from listrata.llm.queries import fold, read, tokenizer
from listrata.llm.registry import importable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(run: Stage) -> Stage:
    """Decorator: let the stage's Python workers find this package."""

    @wraps(run)
    def prepared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, docs, sf_dir)

    return prepared


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` whose ``n_chars``, where there is one, fits the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the scores are learnt from the labels that are not held out.

    Calls ``toxicity.without_toxic``. A null or empty text is scored as a text without words; repeated rows and
    ids are scored each and go together, as equal texts score alike; rows with a null id are no examples,
    but are scored. Other columns pass as they are. An empty table stays empty.
    """
    return toxic.without_toxic(docs, read(spark, sf_dir, "labels"), fold(5) != 0)


@stage
def line_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go from the texts; every document stays.

    Calls ``line_dedup.remove``. Rows with a null id or text stay as they are; rows that repeat an id and text
    are one document; equal ids are ordered by a hash of the text. Other columns pass, ``n_chars`` follows the
    text. An empty table stays empty.
    """
    cleaned = line_dedup.remove(docs)
    return counted(cleaned.select(*(f"`{c}`" for c in docs.columns)))


@stage
def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Calls ``near_duplicates.deduplicate``: five words, a similarity of 0.8. Of a group the row with the
    smallest id stays; texts that are null or without words are like no other and stay. Other columns pass as
    they are. An empty table stays empty.
    """
    return near_duplicates.deduplicate(docs)


@stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go from the texts; every document stays.

    Calls ``decontamination.decontaminate``. A null text stays null, repeated rows are cleaned each, an empty
    benchmark changes nothing. Other columns pass, ``n_chars`` follows the text. An empty table stays empty.
    """
    return counted(decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark")))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens.

    Calls ``packing.pack``. Null and empty texts are one piece of the end mark, repeated rows and ids are
    packed each. Other columns are not looked at. An empty table gives an empty one.
    """
    return packing.pack(docs, tokenizer())

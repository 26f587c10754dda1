"""Frame-level text operators over word tables: sentiment, adjectives, polarity, counts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listrata.functions import lexicon
from listrata.functions.extraction import split_list

_FOUND, _WORDS, _FILTER = "_found", "_words", "_filter"

# Bytes of a word table that tasks look words up in where the text is read; a larger one is joined.
MOST_BYTES = 8 * 1024 * 1024

# Bits of a word filter: how many a word gets, how many of them are set, and the most of a filter (8 MB).
BITS_PER_WORD, BITS_SET, MOST_BITS = 12, 2, 1 << 26


def _bit_places(word: Column, slots: int) -> list[tuple[Column, Column]]:
    """For each bit of a word the 64-bit number that holds it and the place there."""
    places = [F.pmod(F.xxhash64(word, F.lit(k)), F.lit(64 * slots)) for k in range(BITS_SET)]
    return [(F.shiftright(p, 6).cast("int"), F.pmod(p, F.lit(64)).cast("int")) for p in places]


def _slots(words: int) -> int:
    return max(1, min(BITS_PER_WORD * words, MOST_BITS) // 64)


def word_filter(table: DataFrame, slots: int) -> DataFrame:
    """A Bloom filter of the words ``w`` as one row: 64-bit numbers in an array ``bits`` of ``slots``."""
    set_bits = [
        F.struct(slot.alias("slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), place).alias("bits"))
        for slot, place in _bit_places(F.col("w"), slots)
    ]
    none = table.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("bits"))
    numbers = table.select(F.explode(F.array(*set_bits)).alias("s")).select("s.*").union(none)
    numbers = numbers.groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "bits")))
    return numbers.agg(F.transform(ordered, lambda s: s["bits"]).alias("bits"))


def _may_hold(bits: Column, word: Column, slots: int) -> Column:
    return reduce(and_, [F.getbit(F.get(bits, slot), place) == 1 for slot, place in _bit_places(word, slots)])


def hit_words(df: DataFrame, text: Column, items: Column, table: DataFrame, words: int) -> DataFrame:
    """(_key, w): of each distinct text the distinct words that may be in a table of so many ``words``.

    The filter of the table meets the words in the task that reads the text: what it rules out is not shuffled.
    The words are rows there, as compiled code tests these much faster than the items of an array. ``_key`` is a
    hash of the text.
    """
    slots = _slots(words)
    lowered = F.array_distinct(F.transform(items, F.lower))
    each = df.select(F.sha2(text.cast("string"), 256).alias("_key"), F.explode(lowered).alias("w"))
    found = each.withColumn(_FILTER, word_filter(table, slots).scalar()).where(_may_hold(F.col(_FILTER), F.col("w"), slots))
    return found.select("_key", "w").distinct()


def with_lookup(
    df: DataFrame, text: Column, items: Column, words: DataFrame, value: str, *, most_bytes: int = MOST_BYTES,
) -> tuple[DataFrame, lexicon.Lookup]:
    """The frame to go on with, and how to look up the words of ``items`` (a function of ``text``) in it.

    The word table is measured. If it is small, it comes in as a one-row subquery: words by their
    first letters, a constant to the tasks, and no text is moved. Otherwise a Bloom filter of it does,
    and only the words of each distinct text that pass are joined to the table; what is found comes
    back to the rows by the text's hash. Both ways find the same; ``most_bytes`` only chooses between them.
    """
    table = lexicon.word_table(words, "word", value)
    size = table.agg(F.sum(F.octet_length("w")).alias("bytes"), F.count(F.lit(1)).alias("words")).first()
    if (size["bytes"] or 0) <= most_bytes:
        return df.withColumn(_WORDS, lexicon.nested_words(table).scalar()), lexicon.nested_lookup(F.col(_WORDS))
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = hit_words(df, text, items, table, size["words"]).withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(salts)).cast("int"))
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = lexicon.nested_words(hits.join(salted, ["w", "_salt"]).repartition("_key"), "_key")
    found = found.withColumnRenamed("words", _FOUND)
    matched = df.join(found, F.sha2(text.cast("string"), 256) == found["_key"], "left").drop("_key")
    return matched, lexicon.nested_lookup(F.col(_FOUND))


def add_sentiment(
    df: DataFrame, text_column: str, valences: DataFrame, new_column: str = "sentiment", **lookup,
) -> DataFrame:
    """Add Positive, Neutral or Negative. ``valences`` is a table (word, valence)."""
    text, idioms = F.col(text_column), lookup.pop("idioms", lexicon.IDIOMS)
    frame, find = with_lookup(df, text, lexicon.tokens(text), valences, "valence", **lookup)
    return frame.withColumn(new_column, lexicon.sentiment(lexicon.compound(text, find, idioms))).drop(_FOUND, _WORDS)


def add_adjectives(
    df: DataFrame, text_column: str, tags: DataFrame, new_column: str = "adjectives", **lookup,
) -> DataFrame:
    """Add the adjectives of a text as a comma list. ``tags`` is a table (word, tag)."""
    text = F.col(text_column)
    adjectives = tags.filter(F.col("tag").startswith("JJ"))
    frame, find = with_lookup(df, text, lexicon.plain_words(text), adjectives, "tag", **lookup)
    return frame.withColumn(new_column, lexicon.adjectives(text, find)).drop(_FOUND, _WORDS)


def add_polarity(
    df: DataFrame, list_column: str, valences: DataFrame, new_column: str = "polarity", **lookup,
) -> DataFrame:
    """Add the mean polarity of a comma list."""
    items = F.col(list_column)
    frame, find = with_lookup(df, items, lexicon.list_words(items), valences, "valence", **lookup)
    return frame.withColumn(new_column, lexicon.polarity(items, find)).drop(_FOUND, _WORDS)


def count_items(df: DataFrame, list_column: str, item: str = "adjective", limit: int | None = None) -> DataFrame:
    """Frequency of the trimmed items of a comma list, most frequent first; null lists count nothing."""
    items = df.select(F.explode(split_list(F.col(list_column))).alias(item))
    items = items.select(F.trim(item, F.lit(" \t\n\x0b\x0c\r")).alias(item))
    counted = items.groupBy(item).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), item)
    return counted.limit(limit) if limit is not None else counted

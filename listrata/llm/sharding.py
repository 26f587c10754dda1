"""Sharding by Karmarkar-Karp differencing: groups that must stay whole, shards of nearly equal bytes.

Equal texts are one group. Every group starts as a partial partition: its bytes in one subset, nothing in
the others. The two partial partitions with the largest spread are combined, the largest subset of one
with the smallest of the other, until one is left.

Differencing is sequential, so the number of items it sees is bounded, whatever the corpus: the groups of
at least a ``own``-th of all bytes (at most ``own``) and about as many others chosen by hash are items of
their own; what is left is pooled by hash into ``pools`` items of about equal bytes. A group is never
split. Large groups meet pools and single groups in one partition, so pools fill up what large groups
leave, and single groups, down to the shortest text, settle the last bytes.

Texts are read once. Groups are summed in the map side before they are shuffled; shards reach the rows by
joins with the two bounded lists of items, and each row's slot is counted within the part of the input
that it comes from, so neither a frequent text nor a large shard gathers rows in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listrata.llm.frames import free_name, stored

#: Groups that are items of their own because of their size, at most; about as many more are chosen by hash.
OWN = 4096
#: Items that the other groups are pooled into.
POOLS = 4096
#: Bytes that a row counts besides its text.
ROW_BYTES = 8


def differencing(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size, by Karmarkar-Karp differencing; ties are broken by place.

    Shards are numbered by falling sums. No sizes give no shards.
    """
    if not sizes:
        return []
    n = len(sizes)
    # Node i < n is a size, others a combination of two. Subset j of a node holds subset j of its first
    # part and subset shards-1-j of its second; subsets fall.
    sums: dict[int, np.ndarray] = {}
    for i, size in enumerate(sizes):
        sums[i] = np.zeros(shards, np.int64)
        sums[i][0] = size
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapify(heap)
    parts: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heappop(heap)
        _, b = heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        parts.append((a, b, order))
        node, both = n + len(parts) - 1, both[order]
        sums[node] = both
        heappush(heap, (int(both[-1] - both[0]), node))
    places = {n + len(parts) - 1: np.arange(shards)}  # shard of each subset of a node
    for node in range(n + len(parts) - 1, n - 1, -1):
        a, b, order = parts[node - n]
        mine, of_first = places.pop(node), np.empty(shards, np.int64)
        of_first[order] = mine
        places[a], places[b] = of_first, of_first[::-1]
    return [int(places[i][0]) for i in range(n)]


def _pool(digest: Column, pools: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(pools)).cast("int")


def items(groups: DataFrame, own: int = OWN, pools: int = POOLS) -> DataFrame:
    """(digest, pool, size): groups (digest, size) that are items of their own, and pools of the others."""
    total, count = groups.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not count:
        return groups.select("digest", F.lit(None).cast("int").alias("pool"), "size")
    chosen = min(1.0, own / count)
    # Compared as hash(digest, 1) below a share of all 64-bit numbers.
    below = min((1 << 63) - 1, int(chosen * (1 << 64)) - (1 << 63))
    single = (F.col("size") * own >= total) | (F.xxhash64("digest", F.lit(1)) <= F.lit(below).cast("bigint"))
    own_item = F.when(single, F.col("digest")).alias("digest")
    pool = F.when(~single, _pool(F.col("digest"), pools)).alias("pool")
    return groups.select(own_item, pool, "size").groupBy("digest", "pool").agg(F.sum("size").alias("size"))


def _differenced(listed: DataFrame, shards: int) -> DataFrame:
    """(digest, pool, shard) of the items. Their number is bounded, so one task holds them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = [f for f in frames if len(f)]
        if not read:
            return
        frame = pd.concat(read, ignore_index=True)
        frame = frame.sort_values(["size", "hash"], ascending=[False, True], kind="stable")
        frame["shard"] = np.array(differencing(frame["size"].tolist(), shards), np.int32)
        yield frame[["digest", "pool", "shard"]]

    keyed = listed.withColumn("hash", F.xxhash64("digest", "pool")).repartition(1)
    return keyed.mapInPandas(run, "digest binary, pool int, shard int")


def _body(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")


def _size(body: Column) -> Column:
    return (F.octet_length(body) + F.lit(ROW_BYTES)).cast("bigint")


def _digest(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


class Placement:
    """The shard of every text: that of its group, or of the pool of its group."""

    def __init__(self, facts: DataFrame, shards: int, own: int, pools: int):
        """``facts``: (digest, size) of every row."""
        self.pools = pools
        groups = stored(facts.groupBy("digest").agg(F.sum("size").alias("size")), "groups")
        self.items = stored(_differenced(items(groups, own, pools), shards), "items")

    def add(self, rows: DataFrame, digest: str, name: str) -> DataFrame:
        """``rows`` with the shard of the text of each digest as column ``name``; no shuffle.

        Both lists are bounded by ``own`` and ``pools``, some 45 bytes an entry, so they are broadcast.
        """
        single, pool, mine, pooled = (free_name(rows, n) for n in ("_single", "_pool", "_mine", "_pooled"))
        own = self.items.where("digest is not null").select(F.col("digest").alias(single), F.col("shard").alias(mine))
        others = self.items.where("pool is not null").select(F.col("pool").alias(pool), F.col("shard").alias(pooled))
        found = rows.join(F.broadcast(own), F.col(f"`{digest}`") == F.col(single), "left")
        found = found.join(F.broadcast(others), _pool(F.col(f"`{digest}`"), self.pools) == F.col(pool), "left")
        kept = [F.col(f"`{c}`") for c in rows.columns if c != name]
        return found.select(*kept, F.coalesce(mine, pooled).alias(name))


def shard(
    docs: DataFrame, shards: int = 24, id: str = "doc_id", text: str = "text", own: int = OWN, pools: int = POOLS,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law, shard, slot and grown_shard.

    ``size`` is the text's UTF-8 bytes plus 8; a null text has none and is grouped with the empty one.
    Rows of equal text are in the same shard, also if they are more than a shard's part: that shard then
    gets as little else as possible. ``slot`` numbers a shard's rows from 0 without gaps, by part of the
    input and there by id, null first. The law is ``bytes``, so ``grown_shard`` is null: one more shard
    would move rows between all shards. Repeated rows and ids, null ids included, are rows of their own;
    other columns are not looked at. With fewer groups than shards some shards are empty; an empty table
    gives an empty table.
    """
    body = _body(text)
    facts = stored(docs.select(
        F.col(f"`{id}`").alias("id"), _size(body).alias("size"), F.crc32(body).alias("text_crc32"),
        _digest(body).alias("digest"), F.spark_partition_id().alias("part"),
    ), "facts")
    placed = stored(Placement(facts, shards, own, pools).add(facts, "digest", "shard").drop("digest"), "placed")
    counts = placed.groupBy("shard", "part").count()
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(earlier), F.lit(0))  # over a row per part and shard
    offsets = counts.select("shard", "part", before.alias("before"))
    here = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    ranked = placed.withColumn("rank", F.row_number().over(here) - 1)
    return ranked.join(offsets, ["shard", "part"]).select(
        F.col("id").alias(id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("rank")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, folder: str, shards: int = 24, text: str = "text", own: int = OWN, pools: int = POOLS,
) -> str:
    """Write the rows of ``docs``, all columns, below ``folder`` as Parquet by shard; returns the name of the
    partition column, which is ``shard`` unless ``docs`` has such a column.

    Each task writes what it has read, so rows are not shuffled.
    """
    name, key = free_name(docs, "shard"), free_name(docs, "digest")
    facts = docs.select(_digest(_body(text)).alias("digest"), _size(_body(text)).alias("size"))
    placement = Placement(facts, shards, own, pools)
    rows = placement.add(docs.withColumn(key, _digest(_body(text))), key, name).drop(key)
    rows.write.mode("overwrite").partitionBy(name).parquet(folder)
    return name

"""Best-fit decreasing packing of token sequences.

Documents become tokens and an end mark. Overlong ones are first cut into full windows; what is left
of each document is one piece. Pieces are dealt over shards by hash, and each shard is packed on its
own: longest piece first, each into the tightest open window, found in a segment tree indexed by
remaining capacity. A shard holds piece sizes only, not tokens, and leaves at most a few windows
unfilled, so the number of shards hardly changes the padding.
"""

from __future__ import annotations

import math
import os
import sys
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import map_batches, stored
from listrata.llm.token_counts import PATTERN, REMEMBERED, Merges, pre_tokens

#: Pieces a shard holds on average; bounds the memory of a packing task.
SHARD_PIECES = 16_384


def numbers(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Known(dict):
    """Ids of pre-tokens, encoded when they are first asked for."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self.encode = encode

    def __missing__(self, token: str) -> bytes:
        self[token] = value = numbers(self.encode(token))
        return value


def ranked_encoder(path: str) -> Callable[[str], list[int]] | None:
    """Ids of a text by the faster library, special strings as plain text; none if ids don't follow the merges."""
    merges = Merges(path)
    if not merges.in_order:
        return None
    from tiktoken import Encoding

    return Encoding("ranked", pat_str=PATTERN, mergeable_ranks=merges.token_bytes(), special_tokens={}).encode_ordinary


class Encoder:
    """Token ids of texts as the vocabulary's own library gives them; remembers pre-tokens.

    A pre-token's ids come from a library that merges short texts faster, with the same vocabulary, if
    that numbers its tokens in the order of their merges; then both give the same ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known = Known(ranked_encoder(path) or self._plain)

    def _plain(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        known, out = self.known, []
        for text in texts:
            if text and any(s in text for s in self.special):
                out.append(numbers(self._plain(text)))
            else:
                out.append(b"".join(map(known.__getitem__, pre_tokens(text or ""))))
            if len(known) > REMEMBERED:
                known.clear()
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(
    docs: DataFrame, path: str, window: int = 2048, end: int = 1, id: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of each row of ``docs``: id, start, length, ids_crc32, doc_tokens (and ids).

    A document is its ids followed by ``end``; null and empty texts are the end mark alone. Rows with
    the same id are documents of their own, told apart by ``row``. No shuffle.
    """
    kind = dict(docs.dtypes)[id]
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    mark = np.array([end], "<u4").tobytes()

    def cut(columns: dict[str, list]) -> dict[str, list]:
        out = {n: [] for n in ("id", "row", "start", "length", "ids_crc32", "doc_tokens", "ids")}
        for key, row, ids in zip(columns["id"], columns["row"], encoder(path).encode(columns["text"])):
            ids += mark
            total = len(ids) // 4
            for start in range(0, total, window):
                part = ids[4 * start:4 * (start + window)]
                values = (key, row, start, len(part) // 4, zlib.crc32(part), total, part if with_ids else None)
                for name, value in zip(out, values):
                    out[name].append(value)
        return out

    schema = f"id {kind}, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
    out = map_batches(rows, cut, schema)
    return (out if with_ids else out.drop("ids")).withColumnRenamed("id", id)


class OpenWindows:
    """Open windows in a segment tree whose leaves are remaining capacities."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = np.zeros(2 * self.leaves, bool).tolist()
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, capacity: int, number: int) -> None:
        self.windows[capacity].append(number)
        node = capacity + self.leaves
        while node and not self.filled[node]:
            self.filled[node] = True
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out a window with the least capacity of at least ``length``: (capacity, number)."""
        node = length + self.leaves
        while not self.filled[node]:  # climb until a subtree to the right holds a window
            while node & 1:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        number = self.windows[capacity].pop()
        while node and not (self.windows[capacity] if node >= self.leaves else
                            self.filled[2 * node] or self.filled[2 * node + 1]):
            self.filled[node] = False
            node >>= 1
        return capacity, number


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; ``lengths`` must fall and be at most ``window``."""
    open_windows, numbers, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        found = open_windows.tightest(length)
        if found is None:
            capacity, number, used = window, used, used + 1
        else:
            capacity, number = found
        numbers.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            open_windows.add(capacity - length, number)
    return numbers, offsets


def pack(
    docs: DataFrame, path: str, window: int = 2048, end: int = 1, id: str = "doc_id", text: str = "text",
    with_ids: bool = False, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Pack all rows of ``docs``; one row per piece with its sequence_id, offset and padded_length.

    Each id lies in exactly one piece and each piece in one sequence, gapless from offset 0. Sequences
    are padded to ``window`` (``padded_length``), or not at all if their fill is a power of two. Null
    and empty texts are one piece of the end mark. Ties are broken by id and start, repeated rows are
    packed each. Other columns are not looked at. An empty table gives an empty table.

    Pieces are written once, then dealt by hash over ceil(pieces / ``shard_pieces``) shards.
    """
    cut = stored(pieces(docs, path, window, end, id, text, with_ids), "pieces")
    shards = max(1, math.ceil(cut.count() / shard_pieces))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(f"`{id}`", "start", "row"), F.lit(shards)))

    def pack_shard(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", id, "start", "row"], ascending=[False, True, True, True])
        numbers, offsets = best_fit(frame["length"].tolist(), window)
        frame["sequence_id"] = (frame["shard"].to_numpy() << 32) + np.array(numbers, np.int64)
        frame["offset"] = np.array(offsets, np.int64)
        fill = frame.groupby("sequence_id")["length"].transform("sum").to_numpy()
        frame["padded_length"] = np.where(fill & (fill - 1) == 0, fill, window)
        return frame[names]

    names = [c for c in cut.columns] + ["sequence_id", "offset", "padded_length"]
    kinds = dict(cut.dtypes) | {n: "bigint" for n in names[-3:]}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    return dealt.groupBy("shard").applyInPandas(pack_shard, schema).drop("row")


def sequences(packed: DataFrame, window: int = 2048, padding: int = 0) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id and input_ids."""

    def join(columns: dict[str, list]) -> dict[str, list]:
        out = []
        for parts, length in zip(columns["parts"], columns["padded_length"]):
            ids = np.frombuffer(b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["offset"])), "<u4")
            out.append(np.concatenate([ids, np.full(length - len(ids), padding)]).astype(np.int64).tolist())
        return {"sequence_id": columns["sequence_id"], "input_ids": out}

    grouped = packed.groupBy("sequence_id", "padded_length").agg(
        F.collect_list(F.struct("offset", "ids")).alias("parts")  # at most ``window`` pieces
    )
    return map_batches(grouped, join, "sequence_id bigint, input_ids array<bigint>")

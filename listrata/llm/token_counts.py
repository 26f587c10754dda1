"""Token counts by rank-synchronous merging of ragged arrays.

A batch's distinct pre-tokens lie one after another in one array of symbols. Each round finds the
lowest-ranked pair of every sequence and merges all its places at once, in all sequences together;
sequences without a pair leave with the number of their surviving symbols.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import map_batches

#: Fixed value: the published pre-token pattern of byte-level pair merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in which ``\w`` and ``\s`` mean the same letters, digits and spaces.
_PLAIN = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNUSUAL = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]")
_FULL = regex.compile(PATTERN)
#: Pre-tokens whose counts a task remembers; a speed setting without effect on results.
REMEMBERED = 200_000
_NONE = np.iinfo(np.int64).max


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, in order; joined they are the text."""
    return (_FULL if _UNUSUAL.search(text) else _PLAIN).findall(text)


def byte_symbols() -> dict[int, str]:
    """The published printable stand-in of each byte: printable bytes stand for themselves, the
    others follow from U+0100 on in their order."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


class Merges:
    """A byte-level vocabulary as sorted arrays: pair of ids -> rank and merged id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.special = [t["content"] for t in content["added_tokens"] if t["content"]]
        self.width = max(vocabulary.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        keys = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in pairs], np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        symbols = byte_symbols()
        self.bytes = np.array([vocabulary[symbols[b]] for b in range(256)], np.int64)
        #: Whether ids follow the merges.
        single = sorted(self.bytes.tolist())
        self.in_order = single == list(range(256)) and merged.tolist() == list(range(256, 256 + len(merged)))
        self.vocabulary = vocabulary

    def token_bytes(self) -> dict[bytes, int]:
        """The bytes of each token that merges can make, and its id."""
        values, special = {c: b for b, c in byte_symbols().items()}, set(self.special)
        return {bytes(values[c] for c in t): number for t, number in self.vocabulary.items() if t not in special}

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Number of symbols that survive in each sequence."""
        out = np.zeros(len(sequences), np.int64)
        lengths = np.array([len(s) for s in sequences], np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            ranks = np.full(len(symbols), _NONE)
            places = np.zeros(len(symbols), np.int64)
            if len(symbols) > 1:
                keys = symbols[:-1] * self.width + symbols[1:]
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                found = (self.keys[at] == keys) & (owner[1:] == owner[:-1])
                ranks[:-1][found] = self.ranks[at[found]]
                places[:-1] = at
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.repeat(lowest, sizes)
            done = lowest == _NONE
            out[owner[starts[done]]] = sizes[done]
            chosen = (ranks == least) & (ranks != _NONE)
            where = np.flatnonzero(chosen)
            if len(where):  # in a run of overlapping places every second one merges, from the left
                heads = np.append(True, np.diff(where) > 1)
                run = np.flatnonzero(heads)[np.cumsum(heads) - 1]
                where = where[(np.arange(len(where)) - run) % 2 == 0]
                symbols[where] = self.merged[places[where]]
            stay = least != _NONE
            stay[where + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return out


@lru_cache(maxsize=4)
def load(path: str) -> Merges:
    merges = Merges(path)
    del merges.vocabulary
    return merges


class Counter:
    """Counts tokens of texts; remembers the pre-tokens it has seen."""

    def __init__(self, path: str):
        self.merges = load(path)
        self.known: dict[str, int] = {}
        special = self.merges.special
        self.split = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def counts(self, texts: list[str | None]) -> list[int]:
        parts = []
        for text in texts:
            text = text or ""
            pieces = self.split.split(text) if self.split else [text]
            parts.append((len(pieces) - 1, [t for p in pieces for t in pre_tokens(p)]))
        known = self.known
        new = list({t for _, tokens in parts for t in tokens if t not in known})
        known.update(zip(new, self.merges.counts([t.encode("utf-8", "surrogatepass") for t in new]).tolist()))
        out = [extra + sum(map(known.__getitem__, tokens)) for extra, tokens in parts]
        if len(known) > REMEMBERED:
            known.clear()
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, bytes, tokens and whether they exceed ``limit``.

    Null and empty texts have 0 tokens. Rows with the same id are counted each. Special strings in a
    text are one token each, as the vocabulary's library has it by default. Other columns are not
    looked at. An empty table gives an empty table. No shuffle; one pass.
    """
    kind = dict(docs.dtypes)[id]

    def count(columns: dict[str, list]) -> dict[str, list]:
        texts = columns["text"]
        tokens = counter(path).counts(texts)
        return {
            "id": columns["id"], "n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in texts],
            "n_tokens": tokens, "over_limit": [n > limit for n in tokens],
        }

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = map_batches(rows, count, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id)

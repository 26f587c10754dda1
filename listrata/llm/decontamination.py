"""Benchmark decontamination: find the word windows of benchmark items in documents, take them out.

The windows of a block of benchmark items are a hash set that every task holds; documents are scanned
where they are read, hits of the set are verified word by word. The benchmark is measured first: if
its texts exceed ``most_bytes``, its items are dealt over blocks below that size, and the documents
are scanned once per block.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listrata.llm.frames import free_name, map_batches, stored
from listrata.llm.words import ALNUM, encoded, windows, word_hashes

#: Bytes of benchmark text that a task holds at once, as arrays of about four times that size.
MOST_BYTES = 16 << 20
_BYTES = bytes(max(int(v) - 1, 0) if v else 0x20 for v in ALNUM)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: chr(c + 32) for c in range(0x41, 0x5B)})


def lowered(text: str) -> str:
    """A-Z in lower case, as many code points as before."""
    return text.translate(_LOWER)


def words(text: str | None) -> list[bytes]:
    return encoded(text).translate(_BYTES).split()


class Windows:
    """The windows of some items in flat arrays: sorted hashes to find them, the items' words to verify them.

    ``buffer`` holds the words of all items, one space after each; word k begins at ``starts[k]`` and item i
    at word ``first[i]``. ``known`` has, per window size, the sorted hashes and the first word of each window.
    All this takes about four bytes for each byte of the items, on the driver and in each Python worker.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.names = [name for name, _ in items]
        buffers, lengths, counts, found = [], [], [], {}
        done = 0
        for texts in _batches([text for _, text in items]):
            hashes, offsets = word_hashes(texts, ALNUM)
            rows = windows(hashes, width)
            for text, begin, end in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
                parts = words(text)
                buffers.append(b"".join(part + b" " for part in parts))
                lengths.append(np.array([len(part) + 1 for part in parts], np.int64))
                size = min(width, len(parts))
                if size:
                    of_item = rows[begin:end - width + 1] if size == width else windows(hashes[begin:end], size)
                    once, at = np.unique(of_item, return_index=True)
                    found.setdefault(size, []).append((once, (done + at).astype(np.uint32)))
                counts.append(len(parts))
                done += len(parts)
        self.buffer = b"".join(buffers)
        self.starts = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths])).astype(np.uint32)
        self.first = np.cumsum([0, *counts])
        self.known = {}
        for size, parts in found.items():
            hashes, places = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            self.known[size] = hashes[order], places[order]

    def items(self, size: int, low: int, high: int, window: bytes) -> list[int]:
        """Items of the entries ``low`` to ``high`` of this size whose window is this one, word by word."""
        out = []
        for word in self.known[size][1][low:high].tolist():
            if self.buffer[self.starts[word]:self.starts[word + size]] == window:
                out.append(int(np.searchsorted(self.first, word, side="right")) - 1)
        return out

    def find(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set]]:
        """Per text: number of words, (first word, size) of each occurrence, names of its items."""
        hashes, offsets = word_hashes(texts, ALNUM)
        hits: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        for size, (known, _) in self.known.items():
            rows = windows(hashes, size)
            low = np.searchsorted(known, rows)
            places = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == rows)
            owners = np.searchsorted(offsets, places, side="right") - 1
            high = np.searchsorted(known, rows[places], side="right")
            for place, owner, a, b in zip(places.tolist(), owners.tolist(), low[places].tolist(), high.tolist()):
                if place + size <= offsets[owner + 1]:
                    hits[owner].append((place - int(offsets[owner]), size, a, b))
        out = []
        for i, places in enumerate(hits):
            names: set = set()
            real = []
            if places:
                found = words(texts[i])
                for place, size, a, b in places:
                    items = self.items(size, a, b, b"".join(w + b" " for w in found[place:place + size]))
                    if items:
                        real.append((place, size))
                        names.update(self.names[j] for j in items)
            out.append((int(offsets[i + 1] - offsets[i]), real, names))
        return out


def _batches(texts: list[str | None], most: int = 1 << 18) -> Iterator[list[str | None]]:
    """The texts in runs of about ``most`` signs, as hashing takes many times their size."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _blocks(benchmark: DataFrame, item_id: str, text: str, most_bytes: int) -> Iterator[tuple[int, list[tuple]]]:
    """Number of blocks and each block's items, about ``most_bytes``; one block is on the driver at a time."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("name"),
                            F.col(f"`{text}`").cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / most_bytes))
    for i in range(count):
        block = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == i)
        yield count, [(r["name"], r["text"]) for r in block.collect()]


def scan(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``docs`` with one more column ``found``: n_words, hits (first word, words) and items.

    Words are lower-cased (A-Z) runs of digits, ASCII letters and characters beyond ASCII. A window is
    ``width`` consecutive words of an item, or all words of a shorter one; an item without words, and a
    null text, has none. Items with a null id hit as well but have no name to report. Repeated items
    count once, repeated documents each. Other columns pass; if one is called ``found`` already, the
    new one gets underscores. Empty tables are fine on both sides.
    """
    name = free_name(docs, "found")
    kind = "struct<n_words: bigint, hits: array<struct<at: bigint, size: bigint>>, items: array<string>>"
    done = None
    for count, items in _blocks(benchmark, item_id, item_text, most_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Windows(items, width))

        def find(columns: dict[str, list], shared=shared) -> dict[str, list]:
            out = []
            before = columns.get(name) or [None] * len(columns[text])
            for (n, places, names), old in zip(shared.value.find(columns[text]), before):
                hits = [{"at": at, "size": size} for at, size in places] + (old["hits"] if old else [])
                out.append({"n_words": n, "hits": hits,
                            "items": sorted({x for x in names if x is not None} | set(old["items"] if old else []))})
            return columns | {name: out}

        frame = docs if done is None else done
        done = map_batches(frame, find, T.StructType([*docs.schema.fields, *T.StructType.fromDDL(f"`{name}` {kind}")]))
        if count > 1:
            done = stored(done, "scan")
    return done


def hit_words(found: dict) -> np.ndarray:
    """For each word of a document whether it lies in an occurrence."""
    edges = np.zeros(found["n_words"] + 1, np.int64)
    for hit in found["hits"]:
        edges[hit["at"]] += 1
        edges[hit["at"] + hit["size"]] -= 1
    return np.cumsum(edges[:-1]) > 0


def report(scanned: DataFrame, id: str = "doc_id", found: str = "found") -> DataFrame:
    """Per document the number of words, hit words and items, and a digest of the items."""
    kind = dict(scanned.dtypes)[id]

    def count(columns: dict[str, list]) -> dict[str, list]:
        hits = [int(hit_words(f).sum()) for f in columns["found"]]
        return {
            "id": columns["id"], "n_words": [f["n_words"] for f in columns["found"]], "n_hit": hits,
            "n_items": [len(f["items"]) for f in columns["found"]],
            "items_sha256": [hashlib.sha256(",".join(f["items"]).encode()).hexdigest() for f in columns["found"]],
            "contaminated": [n > 0 for n in hits],
        }

    rows = scanned.select(F.col(f"`{id}`").alias("id"), F.col(f"`{found}`").alias("found"))
    schema = f"id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return map_batches(rows, count, schema).withColumnRenamed("id", id)


def without_hits(text: str, found: dict) -> str:
    """The text without its hit words and what stands between neighbouring ones."""
    hit = hit_words(found)
    spans = [m.span() for m in _WORD.finditer(lowered(text))]
    out, done = [], 0
    for i in np.flatnonzero(hit & ~np.append(False, hit[:-1])):
        last = i
        while last + 1 < len(hit) and hit[last + 1]:
            last += 1
        out.append(text[done:spans[i][0]])
        done = spans[last][1]
    return "".join(out) + text[done:]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, action: str = "spans", width: int = 10, id: str = "doc_id",
    text: str = "text", item_id: str = "item_id", item_text: str = "text", most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``docs`` without benchmark passages: with ``action="spans"`` the hit words go from the texts,
    with ``"documents"`` the documents that hold any. Columns and other rows stay as they are; see
    ``scan`` for nulls, ties, repeats and empty tables.
    """
    if action not in ("spans", "documents"):
        raise ValueError(f"unknown action: {action}")
    name = free_name(docs, "found")
    scanned = scan(docs, benchmark, width, id, text, item_id, item_text, most_bytes)
    if action == "documents":
        return scanned.where(F.size(f"`{name}`.hits") == 0).drop(name)

    def clean(columns: dict[str, list]) -> dict[str, list]:
        texts = [without_hits(t, f) if f["hits"] else t for t, f in zip(columns[text], columns.pop(name))]
        return columns | {text: texts}

    return map_batches(scanned, clean, docs.schema)

"""Repeated passages: overlapping documents are aligned, aligned blocks go from the later one.

Every line is known by a hash, and so is every run: the fewest lines in a row, from a line forward or
backward, that hold enough words. A passage is repeated where runs are, and its runs cover it. Of the
documents that hold a run the earliest stands for all others, so a run of any frequency gives each
document one partner, and no cap is needed. (Single rare lines, the usual key, miss passages whose lines
have different earliest holders, so they cannot give whole results here.)

Each pair's lines are aligned by patience diff: lines that are rare, that is unique in both documents, are
matched in their longest common order, then what lies between is aligned in the same way. A match stands
for the block around it; blocks of enough words are deleted from the later document. Passages in another
order are aligned in further rounds. Only lines that alignment cannot decide, those of ranges without a
unique line and those that the earlier document holds several times, are looked up by the runs they are in.

Documents are ordered by id and then by a hash of the text. What is deleted from a document lies in an
earlier one; the earliest holder of a passage keeps it.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import free_name, map_batches, stored

#: Words that a deleted block holds at least.
LEAST_WORDS = 25
#: Alignments of a pair after which crossing passages are left to their runs; without effect on results.
ROUNDS = 32


def lines(text: str | None) -> list[str]:
    """The lines that are not blank, without white space around them."""
    return [line for line in map(str.strip, (text or "").split("\n")) if line]


def line_hash(line: str) -> int:
    digest = hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def runs(words: list[int], least: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of lines with at least ``least`` words, from each line forward and backward."""
    total, found = [0, *accumulate(words)], set()
    for i in range(len(words)):
        end = bisect_left(total, total[i] + least)
        if end < len(total):
            found.add((i, end))
        start = bisect_right(total, total[i + 1] - least) - 1
        if start >= 0:
            found.add((start, i + 1))
    return sorted(found)


def run_hashes(hashes: list[int], words: list[int], least: int) -> list[int]:
    """The distinct hashes of the runs."""
    packed = memoryview(array("q", hashes).tobytes())
    digests = {hashlib.blake2b(packed[8 * a:8 * b], digest_size=8).digest() for a, b in runs(words, least)}
    return [int.from_bytes(d, "little", signed=True) for d in digests]


def _rising(places: list[int]) -> list[int]:
    """Positions of a longest rising subsequence."""
    tails, last, before = [], [], []
    for i, place in enumerate(places):
        at = bisect_left(tails, place)
        before.append(last[at - 1] if at else -1)
        if at == len(tails):
            tails.append(place)
            last.append(i)
        else:
            tails[at], last[at] = place, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _unique(values: list[int], start: int, end: int) -> dict[int, int]:
    found: dict[int, int] = {}
    for i in range(start, end):
        found[values[i]] = -1 if values[i] in found else i
    return {v: i for v, i in found.items() if i >= 0}


def align(first: list[int], second: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Matched positions of two sequences by patience diff, rising in both, and the ranges (start, end) of
    ``first`` that share lines with the range of ``second`` against which they stand, but none that is unique
    on either side."""
    out, barren, open_parts = [], [], [(0, len(first), 0, len(second))]
    while open_parts:
        a, b, c, d = open_parts.pop()
        while a < b and c < d and first[a] == second[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and first[b - 1] == second[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        there = _unique(second, c, d)
        rare = sorted((i, there[v]) for v, i in _unique(first, a, b).items() if v in there)
        chosen = [rare[k] for k in _rising([j for _, j in rare])]
        for (i, j), (k, m) in zip([(a, c), *chosen], [*chosen, (b, d)]):
            if chosen:
                open_parts.append((i, k, j, m))
        if not chosen and not set(second[c:d]).isdisjoint(first[a:b]):
            barren.append((a, b))
    return sorted(out), sorted(barren)


def common_blocks(later: list[int], words: list[int], earlier: list[int], least: int) -> list[int]:
    """Positions of the lines of ``later`` in blocks of at least ``least`` words that ``earlier`` holds too.

    Each round aligns the lines that are open and extends every match to the whole block around it, which
    goes if it has enough words. A line that ``earlier`` holds once is decided by its match. What crosses a
    match is aligned in the next round. Lines that alignment cannot decide, as it finds them in a range
    without a unique line or as ``earlier`` holds them elsewhere too, are left to their runs.
    """
    times = Counter(earlier)
    total = [0, *accumulate(words)]
    gone: set[int] = set()
    undecided: set[int] = set()
    left = [i for i, line in enumerate(later) if line in times]
    last: dict[int, range] = {}  # per diagonal, the block that was last extended
    for _ in range(ROUNDS):
        matched, barren = align([later[k] for k in left], earlier)
        if not matched and not barren:
            break
        done = {left[i] for start, end in barren for i in range(start, end)}
        undecided |= done
        for i, j in matched:
            k = left[i]
            done.add(k)
            if times[later[k]] > 1:
                undecided.add(k)
            if k in last.get(k - j, ()):
                continue
            start = end = 0
            while k - start > 0 and j - start > 0 and later[k - start - 1] == earlier[j - start - 1]:
                start += 1
            while k + end < len(later) and j + end < len(earlier) and later[k + end] == earlier[j + end]:
                end += 1
            block = last[k - j] = range(k - start, k + end)
            if total[block.stop] - total[block.start] >= least:
                gone.update(block)
        left = [k for k in left if k not in done and k not in gone]
    else:
        undecided |= set(left)  # very many passages that cross: their runs find the same
    undecided -= gone
    if undecided:
        gone |= held_runs(later, words, earlier, least, undecided)
    return sorted(gone)


def held_runs(later: list[int], words: list[int], earlier: list[int], least: int, wanted: set[int]) -> set[int]:
    """Positions of the lines of ``later`` in runs with a ``wanted`` line that ``earlier`` holds at any place."""
    known = dict(zip(later, words))
    counted = [known.get(line, least) for line in earlier]  # a run with a line that ``later`` lacks matches nothing
    held = {tuple(earlier[a:b]) for a, b in runs(counted, least)}
    found = ((a, b) for a, b in runs(words, least) if not wanted.isdisjoint(range(a, b)))
    return {i for a, b in found if tuple(later[a:b]) in held for i in range(a, b)}


def repeated(docs: DataFrame, least: int, id: str, text: str) -> DataFrame:
    """For each document (id, key) with repeated passages the positions of their lines among its lines."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("id is not null")
    rows = rows.withColumn("key", F.xxhash64("text"))
    kind = dict(rows.dtypes)["id"]

    def describe(columns: dict[str, list]) -> dict[str, list]:
        found = [lines(t) for t in columns["text"]]
        hashes, words = [list(map(line_hash, f)) for f in found], [[len(x.split()) for x in f] for f in found]
        return {"id": columns["id"], "key": columns["key"], "hashes": hashes, "words": words,
                "runs": [run_hashes(h, w, least) for h, w in zip(hashes, words)]}

    schema = f"id {kind}, key bigint, hashes array<bigint>, words array<int>, runs array<bigint>"
    described = stored(map_batches(rows.where("text is not null"), describe, schema), "lines")
    place = F.struct("id", "key")
    single = described.select(place.alias("doc"), F.explode("runs").alias("hash"))
    holders = single.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    holders = stored(holders.where("first <> last").drop("last"), "holders")
    pairs = stored(single.join(holders, "hash").where("doc <> first").select("doc", "first").distinct(), "pairs")
    described = described.dropDuplicates(["id", "key"])
    whole = stored(described.select(place.alias("doc"), "hashes", "words"), "lines")
    both = pairs.join(whole, "doc").join(whole.select(F.col("doc").alias("first"), F.col("hashes").alias("earlier")), "first")

    def compare(columns: dict[str, list]) -> dict[str, list]:
        gone = [common_blocks(a, w, b, least) for a, w, b in zip(columns["hashes"], columns["words"], columns["earlier"])]
        return {"id": [d["id"] for d in columns["doc"]], "key": [d["key"] for d in columns["doc"]], "gone": gone}

    compared = map_batches(both.select("doc", "hashes", "words", "earlier"), compare, f"id {kind}, key bigint, gone array<int>")
    found = compared.where(F.size("gone") > 0).groupBy("id", "key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone")  # a document has at most a partner per run
    )
    return stored(found, "gone")


def without(text: str, gone: list[int]) -> str:
    """The text without its lines at these positions among those that are not blank."""
    drop, place, out = set(gone), 0, []
    for line in text.split("\n"):
        if line.strip():
            if place not in drop:
                out.append(line)
            place += 1
        else:
            out.append(line)
    return "\n".join(out)


def remove(docs: DataFrame, least: int = LEAST_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated passages, and one more column ``gone`` with the positions of deleted lines.

    A passage goes if it spans at least ``least`` words of whole lines that an earlier document holds in a
    row. Every row stays, if need be with an empty text. Rows with a null id or text stay as they are.
    Rows that repeat an id and text are one document. Other columns stay; if one is called ``gone``
    already, the new one gets underscores. An empty table gives an empty table.
    """
    name = free_name(docs, "gone")
    found = repeated(docs, least, id, text).hint("merge").alias("right")  # grows with the corpus: never broadcast
    same = F.xxhash64(F.col(f"left.`{text}`").cast("string")) == F.col("right.key")
    joined = docs.alias("left").join(found, (F.col(f"left.`{id}`") == F.col("right.id")) & same, "left")
    joined = joined.select("left.*", F.col("right.gone").alias(name))

    def clean(columns: dict[str, list]) -> dict[str, list]:
        return columns | {text: [without(t, g) if g else t for t, g in zip(columns[text], columns[name])]}

    return map_batches(joined, clean, joined.schema)

"""Alignment of two tokenizers over the same texts, through the ends of their tokens.

Both tokenizers spell the same bytes, so a token is the range of bytes up to its end. Per document a
dictionary leads from each end to the number of tokens up to it, for either side; the ends that both
dictionaries have, sorted, cut both lists of ids into groups. Within a group, tokens whose ranges overlap
are linked. Texts are cut into units at spaces, where both sides end a token, so that a word that has been
seen is not encoded and aligned again.

How often two ids are linked in the whole corpus is counted in two steps. Tasks gather documents in
chunks of bounded size and write, for each chunk, its distinct pairs and how often they occur, and for
each document the places of its pairs among them. Counts are summed over the chunks' pairs, not over
links, and come back to each chunk by its pairs, so nothing is broadcast and no pair, however frequent,
has more than one row per chunk.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from listrata.llm.frames import map_batches, slices, stored
from listrata.llm.packing import ranked_encoder
from listrata.llm.token_counts import byte_symbols

#: Links of a chunk at most, unless a single document has more; bounds what a task holds.
CHUNK_LINKS = 4_000_000
#: Pairs of ids as one number: first id times this, plus second id.
WIDTH = 1 << 31


#: Units whose alignment a task remembers, and the longest such unit; speed settings without effect on results.
KNOWN_UNITS, LONGEST_KNOWN = 250_000, 64
#: From a space after a sign that is no white space up to the next such space. No token of either side
#: reaches over the beginning of a unit.
_UNITS = re.compile(r" \s*[^ ]*(?:(?<=\s) \s*[^ ]*)*")


class ByteLevel:
    """A byte-level vocabulary: ids of texts with special strings as plain text, and the bytes of each id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        self.encode = ranked_encoder(path) or (lambda t: library.encode(t, add_special_tokens=False).ids)
        bytes_of = {symbol: byte for byte, symbol in byte_symbols().items()}
        vocabulary = library.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(bytes_of[c] for c in token) if all(c in bytes_of for c in token) else token.encode()


class Pieces:
    """A vocabulary of pieces with byte fallback; the library itself puts a space before a text.

    ``in_units``: spaces stand only at the beginning of pieces, so that a text's ids are those of its units.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        pieces = list(map(self.library.id_to_piece, range(self.library.get_piece_size())))
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.in_units = not any("▁" in p.lstrip("▁") for p in pieces)
        self.space = [self.library.piece_to_id("▁")]

    def encode(self, spaced: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the space that the library would put there."""
        ids = self.library.encode([t[1:] for t in spaced], num_threads=1)
        return [self.space if t == " " else i for t, i in zip(spaced, ids)]  # the library puts none before an empty text


def common_ends(first: dict[int, int], second: dict[int, int]) -> list[int]:
    """The ends that both have, sorted."""
    return sorted(first.keys() & second.keys())


def slices_of(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int]]:
    """Number of tokens of either side up to each common end; both lists rise."""
    first = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    second = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    return [(first[end], second[end]) for end in common_ends(first, second)]


def links_of(ends_a: list[int], ends_b: list[int], cuts: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Places of the tokens of all overlapping pairs, slice by slice."""
    i = j = 0
    for stop_i, stop_j in cuts:
        yield i, j
        while ends_a[i] != ends_b[j]:
            if ends_a[i] < ends_b[j]:
                i += 1
            else:
                j += 1
            yield i, j
        i, j = stop_i, stop_j


def spelt(cuts: list[tuple[int, int]], a: list[str], b: list[str]) -> str:
    """The groups as ``a1,a2|b1;a3|b2,b3``."""
    out, i, j = [], 0, 0
    for stop_i, stop_j in cuts:
        if stop_i - i == 1 and stop_j - j == 1:
            out.append(f"{a[i]}|{b[j]}")
        else:
            out.append(f"{','.join(a[i:stop_i])}|{','.join(b[j:stop_j])}")
        i, j = stop_i, stop_j
    return ";".join(out)


#: The alignment of a unit: its groups as text, the pairs of its links as bytes of 64-bit numbers, and how
#: many ids of either side and groups it has. Plain tuples of plain values cost the garbage collector nothing.
Unit = tuple[str, bytes, int, int, int]


class Aligner:
    """Aligns texts by two vocabularies, unit by unit; remembers short units."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.names = [str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))]
        self.known: dict[str, Unit | None] = {}

    def units(self, text: str) -> list[str]:
        return _UNITS.findall(f" {text}") if self.b.in_units else [f" {text}"]

    def aligned(self, unit: str, b: list[int]) -> Unit | None:
        """None if either side does not spell the unit."""
        a, data = self.a.encode(unit), unit.encode("utf-8", "surrogatepass")
        parts_a, parts_b = list(map(self.a.bytes.__getitem__, a)), list(map(self.b.bytes.__getitem__, b))
        if b"".join(parts_b) != data or b"".join(parts_a) != data:
            return None
        ends_a, ends_b = list(accumulate(map(len, parts_a))), list(accumulate(map(len, parts_b)))
        cuts = slices_of(ends_a, ends_b)
        pairs = array("q", [a[i] * WIDTH + b[j] for i, j in links_of(ends_a, ends_b, cuts)])
        name = self.names.__getitem__
        return spelt(cuts, list(map(name, a)), list(map(name, b))), pairs.tobytes(), len(a), len(b), len(cuts)

    def align(self, texts: list[str | None]) -> Iterator[list[Unit] | None]:
        """The units of each text; None for one that is null, empty or not spelt alike by both sides."""
        split = [self.units(t) if t else [] for t in texts]
        new = list({u for units in split for u in units if u not in self.known})
        self.known.update((u, self.aligned(u, b)) for u, b in zip(new, self.b.encode(new)))
        for units in split:
            found = [self.known[u] for u in units]
            yield found if found and None not in found else None
        for unit in new:
            if len(unit) > LONGEST_KNOWN:
                del self.known[unit]
        if len(self.known) > KNOWN_UNITS:
            self.known.clear()


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def groups(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The groups themselves: id and ``groups``, an array of (a: ids, b: ids); empty for texts without tokens."""

    def run(columns: dict[str, list]) -> dict[str, list]:
        out = []
        for units in aligner(path_a, path_b).align(columns["text"]):
            sides = [g.split("|") for u in units or () for g in u[0].split(";")]
            out.append([{"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in sides])
        return {"id": columns["id"], "groups": out}

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = dict(docs.dtypes)[id]
    return map_batches(rows, run, f"id {kind}, groups array<struct<a:array<int>,b:array<int>>>").withColumnRenamed("id", id)


def _chunked(rows: DataFrame, kind: str, path_a: str, path_b: str, chunk_links: int) -> DataFrame:
    """A row per document, and one per chunk with its distinct pairs (``keys``) and their counts."""
    schema = T.StructType.fromDDL(
        f"chunk bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "steps array<int>, times array<int>, keys array<bigint>, counts array<bigint>"
    )
    arrow = to_arrow_schema(schema)

    def lists(arrays: list[np.ndarray], type: pa.DataType) -> pa.Array:
        offsets = np.cumsum([0, *map(len, arrays)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]), type))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        ids, facts, keys, times, links = [], [], [], [], 0

        def closed() -> list[pa.RecordBatch]:
            distinct, places = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
            counts = np.bincount(places, np.concatenate([*times, np.zeros(0, np.int64)]), len(distinct)).astype(np.int64)
            starts = np.cumsum([0, *map(len, keys)])
            steps = [np.diff(places[s:e], prepend=0) for s, e in zip(starts[:-1], starts[1:])]
            n = len(ids)
            columns = {"chunk": [number] * n, "id": ids} | {f: [x[i] for x in facts] for i, f in enumerate(arrow.names[2:7])}
            columns |= {"steps": lists(steps, pa.int32()), "times": lists(times, pa.int32())}
            of_chunk = {"chunk": [number], "keys": lists([distinct], pa.int64()), "counts": lists([counts], pa.int64())}
            return [
                pa.RecordBatch.from_arrays([
                    v if isinstance(v := c.get(f.name, [None] * m), pa.Array) else pa.array(v, f.type) for f in arrow
                ], schema=arrow) for c, m in ((columns, n), (of_chunk, 1))
            ]

        for batch in batches:
            for piece in slices(batch):
                ids += piece.column(0).to_pylist()
                for units in tools.align(piece.column(1).to_pylist()):
                    texts, pairs, *numbers = zip(*units) if units else ((), (), (), (), ())
                    distinct, often = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)
                    sha = hashlib.sha256(";".join(texts).encode()).hexdigest() if units else ""
                    facts.append((*map(sum, numbers), int(often.sum()), sha))
                    keys.append(distinct)
                    times.append(often)
                    links += len(distinct)
                if links >= chunk_links:
                    yield from closed()
                    ids, facts, keys, times, links, number = [], [], [], [], 0, number + 1
        if ids:
            yield from closed()

    return stored(rows.mapInArrow(run, schema), "chunks")


def align(
    docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text", chunk_links: int = CHUNK_LINKS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``path_a`` is a byte-level vocabulary that sees a space and the text, ``path_b`` one of pieces that puts
    the space there itself; special strings are plain text for both. ``count_sum`` sums, over a document's
    links, how often their ids are linked in all of ``docs``; ``n_best`` counts the links for which no
    other first id is linked more often to the second one, ties included. Texts that are null, empty or
    not spelt alike by both have no tokens: zeros and an empty digest. Repeated rows and ids count each;
    other columns are not looked at; an empty table gives an empty table.
    """
    kind = dict(docs.dtypes)[id]
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    chunks = _chunked(rows, kind, path_a, path_b, chunk_links)
    pairs = chunks.where("keys is not null").select("chunk", F.posexplode(F.arrays_zip("keys", "counts")).alias("place", "pair"))
    pairs = pairs.select("chunk", "place", F.col("pair.keys").alias("key"), F.col("pair.counts").alias("n"))
    totals = pairs.groupBy("key").agg(F.sum("n").alias("total"))
    most = F.max("total").over(Window.partitionBy(F.col("key") % F.lit(WIDTH)))  # at most a row per id of the first vocabulary
    totals = stored(totals.withColumn("best", F.col("total") == most), "totals")
    marked = pairs.join(totals, "key").select(F.col("chunk").alias("of"), "place", "total", "best")

    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType.fromDDL(f"id {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string")
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["place"].to_numpy())
        total = right["total"].to_numpy()[order]
        best = right["best"].to_numpy().astype(np.int64)[order]
        steps, times = (left[c].combine_chunks() for c in ("steps", "times"))
        starts = steps.offsets.to_numpy().astype(np.int64)
        moved = np.cumsum(np.append(0, steps.values.to_numpy()[:starts[-1]]))
        places = moved[1 + starts[0]:] - np.repeat(moved[starts[:-1]], np.diff(starts))
        often = times.flatten().to_numpy().astype(np.int64)

        def summed(values: np.ndarray) -> np.ndarray:
            run = np.append(0, np.cumsum(values * often))
            return run[starts[1:] - starts[0]] - run[starts[:-1] - starts[0]]

        columns = {c: left[c] for c in ("id", *names[:4], "groups_sha256")}
        columns |= {"n_best": summed(best[places]), "count_sum": summed(total[places])}
        return pa.table([columns[f.name] for f in arrow], schema=arrow)

    documents = chunks.where("keys is null").drop("keys", "counts")
    out = documents.groupBy("chunk").cogroup(marked.groupBy("of")).applyInArrow(run, schema)
    return out.withColumnRenamed("id", id)

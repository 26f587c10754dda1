"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

Documents with equal shingle sets are one class, so copies are compared once. Classes that share a band
of their signatures are candidates. Only their connected groups matter for the result, so each band's
members are tied to its smallest one instead of to each other, and the groups of this sparse graph are
verified one by one: inside a group every pair that shares a band has its signatures compared a batch at
a time, until its posterior chance of reaching the threshold falls below ``MISS``; what survives is
confirmed on the full sets, unless it is connected already. Large groups are verified in blocks of their
members, so no task holds an unbounded group; where many blocks meet, signatures travel and texts follow
only for the members of pairs that survive.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.llm.components import components
from listrata.llm.frames import free_name, map_batches, stored
from listrata.llm.words import mix, shingle_sets

#: Rows of a band and bands: a pair at 0.8 shares none with a chance of 1e-6.
ROWS, BANDS = 5, 35
#: Signature values compared before each decision, and the chance of reaching the threshold below which
#: a pair is given up.
BATCH, MISS = 25, 1e-6
#: Members of a group that are compared by one task with as many others.
BLOCK = 64
#: Rows that a task of the verification aims at: its work is computing, so Spark's sizes by bytes are too large.
TASK_ROWS = 1024


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and shifts of the signature's hash functions, by rule."""
    numbers = mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64)) >> np.uint64(32)
    return numbers[::2].astype(np.uint32)[:, None] | np.uint32(1), numbers[1::2].astype(np.uint32)[:, None]


def signature(shingles: np.ndarray, width: int = 1024) -> np.ndarray:
    """Smallest value of each hash function over a set of shingles."""
    factor, shift = _permutations()
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(values), width):
        hashed = values[start:start + width] * factor
        hashed += shift
        np.minimum(out, hashed.min(axis=1), out=out)
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """One key per band, for each row of ``signatures``; keys of different bands differ."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return out.view(np.int64)


def set_key(shingles: np.ndarray) -> str | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest() if len(shingles) else None


def features(docs: DataFrame, width: int, id: str, text: str) -> DataFrame:
    """Per row: id, size of the shingle set, a key of the set (null: linked with nothing) and its bands."""

    def describe(columns: dict[str, list]) -> dict[str, list]:
        sets = shingle_sets(columns["text"], width)
        keys = [set_key(s) if i is not None else None for i, s in zip(columns["id"], sets)]
        rows = bands(np.stack([signature(s) for s in sets]))
        return {"id": columns["id"], "n": [len(s) for s in sets], "key": keys,
                "bands": [row.tolist() if key else [] for key, row in zip(keys, rows)]}

    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return map_batches(rows, describe, "id bigint, n bigint, key string, bands array<bigint>")


@lru_cache(maxsize=8)
def least_matches(share: float, miss: float) -> tuple[int, ...]:
    """For 0, BATCH, ... compared values: the fewest equal ones at which a pair may still reach ``share``.

    With a uniform prior, the posterior of the similarity after m of n equal values is Beta(m + 1, n - m + 1);
    its part above ``share`` is the chance of at most m successes in n + 1 trials of chance ``share``.
    """
    out = []
    for n in range(0, ROWS * BANDS + 1, BATCH):
        chance, m = 0.0, 0
        while m <= n:
            chance += comb(n + 1, m) * share**m * (1 - share) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def _sharing(keys: np.ndarray) -> np.ndarray:
    """Pairs of rows (as first * rows + second) that share a band, each once."""
    count, found = len(keys), []
    for column in keys.T:
        order = np.argsort(column, kind="stable")
        ends = np.flatnonzero(np.append(column[order][1:] != column[order][:-1], True)) + 1
        for start, end in zip(np.append(0, ends[:-1]), ends):
            if end - start > 1:
                members = np.sort(order[start:end])
                first, second = np.triu_indices(len(members), 1)
                found.append(members[first] * count + members[second])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def survivors(
    signatures: np.ndarray, sizes: np.ndarray, own: np.ndarray, known: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (first, second) that share a band and may reach ``percent``, and how many of their values are equal.

    Pairs with equal ``known`` labels are left out. ``own`` names the block of each row; where there are two,
    pairs within a block are left out as well.
    """
    pairs = _sharing(bands(signatures))
    first, second = pairs // len(sizes), pairs % len(sizes)
    wanted = known[first] != known[second]
    if len(np.unique(own)) > 1:
        wanted &= own[first] != own[second]
    first, second = first[wanted], second[wanted]
    small, large = np.minimum(sizes[first], sizes[second]), np.maximum(sizes[first], sizes[second])
    first, second = first[100 * small >= percent * large], second[100 * small >= percent * large]
    equal = np.zeros(len(first), np.int64)
    for step, least in enumerate(least_matches(percent / 100, MISS)[1:]):
        columns = slice(step * BATCH, (step + 1) * BATCH)
        equal += (signatures[first, columns] == signatures[second, columns]).sum(axis=1)
        stay = equal >= least
        first, second, equal = first[stay], second[stay], equal[stay]
    return first, second, equal


def linked(sets: list[np.ndarray], own: np.ndarray, known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Confirmed pairs that connect all that surviving pairs connect, beyond what is ``known`` by equal labels."""
    sizes = np.array([len(s) for s in sets])
    first, second, equal = survivors(np.stack([signature(s) for s in sets]), sizes, own, known, percent)
    roots, out = np.unique(known, return_index=True)[1][np.unique(known, return_inverse=True)[1]].tolist(), []

    def root(i: int) -> int:
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return i

    for place in np.argsort(-equal, kind="stable"):
        a, b = int(first[place]), int(second[place])
        if root(a) != root(b):
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                roots[root(a)] = root(b)
                out.append((a, b))
    return out


def links(docs: DataFrame, classes: DataFrame, width: int, percent: int, id: str, text: str) -> DataFrame:
    """Confirmed links (a, b) between classes, enough to connect every pair that is similar and shares a band.

    A group of one block is compared as a whole. Members of a larger one are first compared within two
    random blocks each, which is linear in the group and connects most of it. Then only those that its
    largest component still lacks are compared with all others: the larger that component, the fewer
    pairs of blocks are left, and pairs inside it are never looked at. The blocks of this last step hold
    signatures; texts go only to blocks in which they are in a surviving pair.
    """
    members = stored(_members(docs, classes, id, text), "members")
    seeds = F.when(F.col("blocks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    first = members.withColumn("i", F.explode(seeds)).withColumn("j", F.pmod(F.xxhash64("id", "i"), "blocks"))
    first = first.withColumn("own", F.lit(0)).withColumn("label", F.col("id"))
    large = members.where("blocks > 1")
    doubled = large.count()
    first = stored(_verified(first, members.count() + doubled, width, percent), "links")
    if not doubled:
        return first
    joined = components(first)
    found = joined.select(F.col("node").alias("id"), F.col("component").alias("label"))
    labels = large.select("id", "component").join(found, "id", "left")
    labels = stored(labels.select("id", "component", F.coalesce("label", "id").alias("label")).distinct(), "labels")
    counts = labels.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("component").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("total"))
    counts = stored(counts.where("total > most.n").select(
        "component", F.col("most.label").alias("giant"), F.ceil(F.col("most.n") / BLOCK).cast("int").alias("inner"),
        F.ceil((F.col("total") - F.col("most.n")) / BLOCK).cast("int").alias("outer"),
    ), "sizes")
    inside = F.col("label") == F.col("giant")
    last = F.col("inner") + F.col("outer") - 1
    own = F.when(inside, F.pmod(F.xxhash64("id"), "inner")).otherwise(F.col("inner") + F.pmod(F.xxhash64("id"), "outer"))
    open_ = large.join(labels.drop("component"), "id").join(counts, "component").withColumn("own", own)
    signed = stored(_signed(open_, width), "signed")
    rest = (
        signed
        .withColumn("other", F.explode(F.when(inside, F.sequence("inner", last)).otherwise(F.sequence(F.lit(0), last))))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    )
    asked = stored(_surviving(rest, percent), "asked")
    texts = large.select("id", "text", "key").join(asked.select("id").distinct(), "id", "left_semi")
    rest = _verified(texts.join(asked, ["id", "key"]), asked.count(), width, percent)
    return joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)


def _signed(members: DataFrame, width: int) -> DataFrame:
    """Members with the size and the signature of their set instead of their text; each class once."""
    kept = ["id", "key", "component", "label", "giant", "own", "inner", "outer"]

    def sign(columns: dict[str, list]) -> dict[str, list]:
        sets = shingle_sets(columns["text"], width)
        same = [i for i, (shingles, key) in enumerate(zip(sets, columns["key"])) if set_key(shingles) == key]
        return {name: [columns[name][i] for i in same] for name in kept} | {
            "n": [len(sets[i]) for i in same], "signature": [signature(sets[i]).tobytes() for i in same],
        }

    types = dict(members.dtypes)
    schema = ", ".join(f"{name} {types[name]}" for name in kept) + ", n bigint, signature binary"
    return map_batches(members.select(*kept, "text"), sign, schema).dropDuplicates(["id", "key"])


def _surviving(dealt: DataFrame, percent: int) -> DataFrame:
    """Of each block (component, i, j) of signatures the members that are in a pair which may be similar."""

    def look(frame: pd.DataFrame) -> pd.DataFrame:
        signatures = np.stack([np.frombuffer(s, np.uint32) for s in frame["signature"]])
        sizes, own, label = (frame[name].to_numpy() for name in ("n", "own", "label"))
        first, second, _ = survivors(signatures, sizes, own, label, percent)
        return frame.iloc[np.unique(np.concatenate([first, second]))][["id", "key", "component", "i", "j", "own", "label"]]

    wanted = dealt.select("id", "key", "n", "signature", "own", "label", "component", "i", "j")
    types = dict(wanted.dtypes)
    schema = ", ".join(f"{name} {types[name]}" for name in ("id", "key", "component", "i", "j", "own", "label"))
    return wanted.groupBy("component", "i", "j").applyInPandas(look, schema)


def _members(docs: DataFrame, classes: DataFrame, id: str, text: str) -> DataFrame:
    """The classes that share a band with another: id, text, key, group (component) and its number of blocks."""
    keys = classes.select("rep", F.explode("bands").alias("band"))
    hubs = keys.groupBy("band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ties = keys.join(stored(hubs, "hubs"), "band").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    tied = components(ties)
    roots = tied.select(F.col("component").alias("rep"), "component").distinct()
    members = stored(tied.withColumnRenamed("node", "rep").union(roots), "tied")
    sizes = stored(members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "sizes")
    members = members.join(sizes, "component").join(classes.select("rep", "key"), "rep").withColumnRenamed("rep", "id")
    texts = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return texts.join(stored(members, "tied"), "id")


def _verified(dealt: DataFrame, rows: int, width: int, percent: int) -> DataFrame:
    """The links that each block (component, i, j) of ``dealt``, some ``rows`` rows, confirms."""

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(frame["text"].tolist(), width)
        rows = {}  # of repeated rows of a document those whose set is its class's, once
        for i, (shingles, number, key) in enumerate(zip(sets, frame["id"], frame["key"])):
            if set_key(shingles) == key:
                rows.setdefault((number, key), i)
        rows = sorted(rows.values())
        ids, own, label = (frame[name].to_numpy()[rows] for name in ("id", "own", "label"))
        found = linked([sets[i] for i in rows], own, label, percent) if len(rows) > 1 else []
        return pd.DataFrame({"a": ids[[a for a, _ in found]], "b": ids[[b for _, b in found]]}, dtype="int64")

    wanted = dealt.select("id", "text", "key", "own", "label", "component", "i", "j")
    wanted = wanted.repartition(max(1, -(-rows // TASK_ROWS)), "component", "i", "j")
    return wanted.groupBy("component", "i", "j").applyInPandas(verify, "a bigint, b bigint")


def groups(docs: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id and kept.

    Words stand between white space, A-Z in lower case; a document's set holds its distinct runs of
    ``width`` words, or all its words if they are fewer. Documents are linked if the intersection of their
    sets is at least ``percent`` hundredths of the union; ``component_id`` is the smallest id reachable by
    links, and ``kept`` is true where it is the row's own. Documents without words, null texts, and rows
    with a null id are linked with nothing and kept. Rows that repeat an id share its component if their
    texts are equal. Other columns are not looked at. An empty table gives an empty table.
    """
    described = stored(features(docs, width, id, text), "features")
    classes = described.where("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    joined = components(links(docs, classes, width, percent, id, text))
    found = classes.select("key", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    found = stored(found.select("key", F.coalesce("component", "rep").alias("component_id")), "found")
    out = described.drop("bands").join(found, "key", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component of ``groups``; columns stay as they are."""
    name = free_name(docs, "gone")
    gone = groups(docs, width, percent, id, text).where("not kept").select(F.col(f"`{id}`").alias(name)).distinct()
    return docs.join(stored(gone, "gone"), F.col(f"`{id}`") == F.col(name), "left_anti")

"""Merkle manifest of a table: leaves per row, one tree per group, one tree over the groups.

A parent is the SHA-256 of its children's digests. While it is hashed, a copy of the hash state is retained
before each child's slot. To fold a replaced leaf into the root, each level resumes the state of its slot
with the replacement and hashes the siblings to its right; what lies to its left is not hashed again.

The trees grow in rounds. Rows are ranked within their group by a range partitioning that orders whole
rows, so that neither a large group nor a frequent row meets in one task. In a round, every block of
``FAN ** HEIGHT`` consecutive nodes of a tree becomes one node, so the table shrinks by that factor, and a
block is all that a task holds. On the way back each node gets its path, the siblings on every level up to
the root, from the block above it. A block of leaves then rebuilds its states once and folds its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listrata.llm.frames import stored

#: Children of a node, and levels of a block: a block of 6,561 nodes is about a megabyte.
FAN, HEIGHT = 3, 8

#: A node of a level: its tree, its place there, how many nodes the tree has on that level, its digest.
NODE = "tree string, place bigint, n bigint, digest string"
#: From the node up to the root: the digests left and right of it on each level.
STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: str) -> str:
    """Lower-case hex SHA-256 of texts, one after another."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Block:
    """Consecutive nodes of a tree and the levels above them, as far as the block reaches.

    ``levels[k]`` has the digests of level k; ``states[k][i]`` the hash states of node i of level k + 1,
    copied before each of its slots.
    """

    def __init__(self, digests: list[str], alone: bool, height: int, fan: int):
        """``alone``: the block is its whole tree, which ends where one node is left."""
        self.fan, self.levels, self.states = fan, [digests], []
        while len(self.levels) <= height and not (alone and len(self.levels[-1]) == 1):
            below, above, retained = self.levels[-1], [], []
            for start in range(0, len(below), fan):
                state, copies = hashlib.sha256(), []
                for child in below[start:start + fan]:
                    copies.append(state.copy())
                    state.update(child.encode())
                retained.append(copies)
                above.append(state.hexdigest())
            self.levels.append(above)
            self.states.append(retained)

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, place: int) -> list[tuple[str, str]]:
        """The siblings before and after the node's ancestors, level by level."""
        out = []
        for digests in self.levels[:-1]:
            start = place - place % self.fan
            out.append(("".join(digests[start:place]), "".join(digests[place + 1:start + self.fan])))
            place //= self.fan
        return out

    def fold(self, place: int, replacement: str) -> str:
        """The block's top with another digest at ``place``."""
        for digests, retained in zip(self.levels, self.states):
            slot = place % self.fan
            state = retained[place // self.fan][slot].copy()
            state.update(replacement.encode())
            state.update("".join(digests[place + 1:place - slot + self.fan]).encode())
            replacement, place = state.hexdigest(), place // self.fan
        return replacement


class Above:
    """The way from a block's top to the root, with the states that its folds resume."""

    def __init__(self, steps: list[tuple[str, str]]):
        self.steps = [(hashlib.sha256(before.encode()), after.encode()) for before, after in steps]
        self.siblings = "".join(before + after for before, after in steps)

    def fold(self, replacement: str) -> str:
        for before, after in self.steps:
            state = before.copy()
            state.update(replacement.encode())
            state.update(after)
            replacement = state.hexdigest()
        return replacement


def leaf(*columns: Column) -> Column:
    """Digest of a row: ``-`` for a null, else the byte count of the value as text, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]).cast("binary"), 256)


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` (stored, as they are read several times) with ``place`` and ``n``: where each stands in its
    tree, from 0, and how many rows that has. Ties on all of ``order`` stand in any order.

    Rows are ranged over by tree and order; each range counts its rows per tree, and the sums of the ranges
    before it are added.
    """
    keys = [F.col(tree), *(F.col(c).asc_nulls_first() for c in order), F.col("_row")]
    with_row = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "unranked")
    ranged = with_row.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    ranged = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged, "ranged")
    counts = ranged.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(tree)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        tree, "_part", (F.coalesce(F.sum("_count").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(whole).alias("n"),
    )  # a row per range and tree
    placed = ranged.join(offsets, [tree, "_part"]).withColumn("place", F.col("_at") + F.col("_shift"))
    return placed.drop("_part", "_at", "_shift")


def _block(size: int) -> Column:
    return F.floor(F.col("place") / F.lit(size)).cast("bigint").alias("block")


def raised(nodes: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """The next table of nodes: one for each block of ``fan ** height`` consecutive ones of a tree."""
    size = fan ** height

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        tree, place, n = frame.iloc[0][["tree", "place", "n"]]
        top = Block(frame["digest"].tolist(), n <= size, height, fan).top
        return pd.DataFrame({"tree": [tree], "place": [place // size], "n": [-(-n // size)], "digest": [top]})

    return stored(nodes.groupBy("tree", _block(size)).applyInPandas(run, NODE), "nodes")


def towers(nodes: DataFrame, fan: int = FAN, height: int = HEIGHT) -> list[DataFrame]:
    """The tables of nodes from ``nodes`` up to the one with one node for each tree."""
    levels, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(raised(levels[-1], fan, height))
        most = -(-most // fan ** height)
    return levels


def _joined(nodes: DataFrame, above: DataFrame, run, schema: str, size: int) -> DataFrame:
    """Each block of ``nodes`` with the row of ``above`` (tree, place, ...) that it became."""
    left, right = nodes.groupBy("tree", _block(size)), above.groupBy("tree", F.col("place").alias("block"))
    return left.cogroup(right).applyInPandas(run, schema)


def lowered(nodes: DataFrame, above: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """The steps of ``nodes`` to the root (tree, place, subroot, steps), from those of the table above."""
    size = fan ** height

    def run(frame: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        block = Block(frame["digest"].tolist(), int(frame["n"].iloc[0]) <= size, height, fan)
        rest = [(s["before"], s["after"]) for s in up["steps"].iloc[0]]
        steps = [[{"before": b, "after": a} for b, a in (*block.path(i), *rest)] for i in range(len(frame))]
        return pd.DataFrame({"tree": frame["tree"], "place": frame["place"], "subroot": up["subroot"].iloc[0], "steps": steps})

    return stored(_joined(nodes, above, run, f"tree string, place bigint, subroot string, steps {STEPS}", size), "steps")


class Manifest:
    """The trees over the rows of a table: ``leaves`` (ranked rows with tree, place, n, digest and what else
    they had), ``subroots`` (tree, digest) and ``root``, which is null for an empty table."""

    def __init__(self, leaves: DataFrame, fan: int = FAN, height: int = HEIGHT):
        """``leaves``: rows with ``tree`` (text, not null; trees ascend by their UTF-8 bytes), ``digest``,
        ``place`` and ``n``."""
        self.leaves, self.fan, self.height = leaves, fan, height
        self.levels = towers(leaves.select("tree", "place", "n", "digest"), fan, height)
        self.subroots = self.levels[-1].select("tree", "digest")
        groups = self.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
        self.groups = stored(ranked(groups, "tree", "group"), "groups")
        self.upper = towers(self.groups.select("tree", "place", "n", "digest"), fan, height)
        top = self.upper[-1].first()
        self.root = top["digest"] if top else None

    def _block_steps(self) -> DataFrame:
        """Steps to the root of the nodes above the blocks of leaves."""
        steps = self.upper[-1].select("tree", "place", F.lit(None).cast("string").alias("subroot"), F.array().cast(STEPS).alias("steps"))
        for nodes in self.upper[-2::-1]:
            steps = lowered(nodes, steps, self.fan, self.height)
        of_groups = self.groups.join(steps.select("place", "steps"), "place")
        steps = of_groups.select(F.col("group").alias("tree"), F.lit(0).cast("bigint").alias("place"), F.col("digest").alias("subroot"), "steps")
        for nodes in self.levels[-2:0:-1]:
            steps = lowered(nodes, steps, self.fan, self.height)
        return steps

    def fold(self, replacement: str) -> DataFrame:
        """Every row of ``leaves`` with ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

        ``replacement`` names the column with the digest to fold in place of the row's own; where it is null
        the row's own is folded. The proof's digest is that of all siblings, level by level up to the
        root, from left to right.
        """
        fan, height, root, leaves = self.fan, self.height, self.root, self.leaves
        size = fan ** height
        added = ("subroot", "root", "proof_sha256", "folded_root")

        def run(frame: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("place").reset_index(drop=True)
            own = frame["digest"].tolist()
            block = Block(own, int(frame["n"].iloc[0]) <= size, height, fan)
            above = Above([(s["before"], s["after"]) for s in up["steps"].iloc[0]])
            proofs, folded = [], []
            for i, new in enumerate(frame[replacement].tolist()):
                proofs.append(digest(*(b + a for b, a in block.path(i)), above.siblings))
                folded.append(above.fold(block.fold(i, new or own[i])))
            frame["subroot"], frame["root"], frame["proof_sha256"], frame["folded_root"] = up["subroot"].iloc[0], root, proofs, folded
            return frame[names]

        names = [*leaves.columns, *added]
        schema = ", ".join([*(f"`{n}` {k}" for n, k in leaves.dtypes), *(f"{n} string" for n in added)])
        out = _joined(leaves, self._block_steps(), run, schema, size)
        return out.withColumn("verified", F.col("folded_root") == F.col("root"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def build(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id: str = "doc_id", group: str = "source",
    replaced: dict[str, Column] | None = None, fan: int = FAN, height: int = HEIGHT,
) -> Manifest:
    """The manifest of all rows of ``docs``: a tree per value of ``group``, rows ascending by ``id``.

    Leaves are digests of ``fields``, in that order. ``replaced`` (column to expression) describes altered
    rows, whose digests become the column ``altered`` of the leaves, to be folded. A null group is a tree of
    its own and the first one, a null id comes first, rows that repeat an id follow one another by their
    digests; repeated rows are leaves each. Other columns are not looked at. An empty table has no root.
    """
    own = [F.col(f"`{f}`") for f in fields]
    other = [(replaced or {}).get(f, F.col(f"`{f}`")) for f in fields]
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = docs.select(
        tree.alias("tree"), F.col(f"`{id}`").alias("id"), leaf(*own).alias("digest"), leaf(*other).alias("altered"),
    )
    return Manifest(stored(ranked(rows, "tree", "id", "digest"), "leaves"), fan, height)


def audit(
    docs: DataFrame, altered: Column, text: Column | None = None, fields: tuple[str, ...] = FIELDS,
    id: str = "doc_id", group: str = "source", fan: int = FAN, height: int = HEIGHT,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    Where ``altered`` is true the row is folded with its ``text`` (the last of ``fields``) replaced by the
    expression ``text``, elsewhere as it is, into the manifest of all untouched rows. See ``build`` for
    nulls, ties and repeated rows.
    """
    body = F.col(f"`{fields[-1]}`")
    replaced = {fields[-1]: F.when(altered, body if text is None else text).otherwise(body)}
    found = build(docs, fields, id, group, replaced, fan, height).fold("altered")
    names = ("subroot", "root", "proof_sha256", "folded_root", "verified")
    return found.select(F.col("id").alias(id), F.col("digest").alias("leaf"), *names)

"""Connected components of an edge list, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import stored

#: Edges that a task contracts at a time.
CHUNK = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that the edges (a, b) tie to a smaller one, and the smallest node it reaches by them."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    roots = np.arange(len(nodes))
    first, second = ends[:len(a)], ends[len(a):]
    while True:  # every root takes the smallest root next to it, then paths are halved
        p, q = roots[first], roots[second]
        low = np.minimum(p, q)
        before = roots.copy()
        np.minimum.at(roots, np.maximum(p, q), low)
        while (roots[roots] != roots).any():
            roots = roots[roots]
        if (roots == before).all():
            break
    tied = roots != np.arange(len(nodes))
    return nodes[tied], nodes[roots[tied]]


def _contracted(edges: DataFrame) -> DataFrame:
    """As few edges (big, small) as connect what each task's edges connect; nothing is moved."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []

        def out() -> pa.RecordBatch:
            big, small = forest(np.concatenate(a), np.concatenate(b))
            return pa.RecordBatch.from_pydict({"big": big, "small": small})

        for batch in batches:
            a.append(batch.column(0).to_numpy())
            b.append(batch.column(1).to_numpy())
            if sum(map(len, a)) >= CHUNK:
                yield out()
                a, b = [], []
        if a:
            yield out()

    wanted = edges.where("a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    return wanted.mapInArrow(run, "big bigint, small bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) that is not the smallest of its component.

    Each task first contracts the edges it reads. Then each round hangs every node's larger neighbours
    below its smallest one, and its smaller neighbours below the smallest of them; after a number of
    rounds that grows with the logarithm of the longest path, every component is a star around its
    smallest node. Rounds are written to the shared folder. The first join of a round has two plain sides
    that Spark may split where a node has very many edges; by the second, a node has few smaller
    neighbours. Loops and nulls are left out, repeats do not matter.
    """
    pairs = stored(_contracted(edges).distinct(), "edges")
    while True:
        least = stored(pairs.groupBy("big").agg(F.min("small").alias("up"), F.count(F.lit(1)).alias("n")), "least")
        above = least.select(F.col("big").alias("small"), "up")
        hung = stored(pairs.join(above, "small", "left").select("big", "small", "up"), "hung")
        open_ = hung.select(F.col("up").isNotNull().alias("open")).union(least.select((F.col("n") > 1).alias("open")))
        if not open_.agg(F.max("open")).first()[0]:
            return pairs.select(F.col("big").alias("node"), F.col("small").alias("component"))
        hung = hung.select("big", F.coalesce("up", "small").alias("small")).distinct()
        joined = hung.join(hung.groupBy("big").agg(F.min("small").alias("least")), "big")
        below = F.when(F.col("small") > F.col("least"), F.struct(F.col("small").alias("big"), F.col("least").alias("small")))
        both = F.array(F.struct("big", F.col("least").alias("small")), below)
        pairs = joined.select(F.explode(both).alias("pair")).where("pair is not null").select("pair.*")
        pairs = stored(pairs.distinct(), "edges")

"""Language identification by nearest centroid.

A text is the normalised TF-IDF vector of its hashed letter pairs and triples. Document frequencies
come from all training rows; each language's centroids are clusters of a bounded sample of its rows.
A text belongs to the language of the centroid with the highest cosine and is marked as rejected if
it lies farther from it than nearly all of the centroid's own texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import free_name, map_batches, slices, stored

#: Hashed dimensions of a vector.
DIMENSIONS = 4096
#: Training texts per language from which centroids are clustered, on average; bounds a clustering task.
SAMPLE = 600
#: Share of a centroid's own texts that lie farther away than its radius.
OUTSIDE = 0.005
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the counts of its hashed letter pairs and triples, and whether it has a letter.

    Capitals do not matter; a run of other characters counts as one space.
    """
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    any_letter = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        if not text:
            continue
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letters()[points]
        any_letter[i] = letter.any()
        kept = letter.copy()  # letters, and the first of other characters after one or at the beginning
        kept[1:] |= letter[:-1]
        kept[0] = True
        points = np.where(letter, points, 32)[kept].astype(np.uint32)
        pairs = points[:-1] * np.uint32(0x9E3779B1) + points[1:] * np.uint32(0x85EBCA77)
        triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F)
        grams = np.concatenate([pairs, triples])
        grams ^= grams >> np.uint32(15)
        grams *= np.uint32(0x2C1B3C6D)
        out[i] = np.bincount(grams >> np.uint32(20), minlength=DIMENSIONS)
    return out, any_letter


def vectors(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Counts as normalised TF-IDF."""
    out = np.log1p(found) * weights
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def frequencies(rows: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all texts of ``rows``: each task sends one row per dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for piece in slices(batch):
                total[:-1] += (counts(piece.column("text").to_pylist())[0] > 0).sum(axis=0)
                total[-1] += piece.num_rows
        yield pa.RecordBatch.from_pydict({"dimension": np.arange(DIMENSIONS + 1), "texts": total})

    summed = rows.select("text").mapInArrow(run, "dimension bigint, texts bigint").groupBy("dimension").agg(F.sum("texts"))
    total = np.zeros(DIMENSIONS + 1, np.int64)
    for dimension, texts in summed.collect():  # one row per dimension, whatever the input
        total[dimension] = texts
    return (np.log((1 + total[-1]) / (1 + total[:-1])) + 1).astype(np.float32)


def clusters(rows: np.ndarray, count: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart first centroids; returns centroids and their radii (cosines)."""
    centroids = [rows[0]]
    nearest = rows @ rows[0]
    while len(centroids) < min(count, len(rows)):
        centroids.append(rows[int(nearest.argmin())])
        nearest = np.maximum(nearest, rows @ centroids[-1])
    centroids = np.stack(centroids)
    for _ in range(rounds):
        owner = (rows @ centroids.T).argmax(axis=1)
        sums = np.stack([rows[owner == i].sum(axis=0) if (owner == i).any() else c for i, c in enumerate(centroids)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    similar = rows @ centroids.T
    owner = similar.argmax(axis=1)
    radii = [np.quantile(similar[owner == i, i], OUTSIDE) if (owner == i).any() else 1 for i in range(len(centroids))]
    return centroids.astype(np.float32), np.array(radii, np.float32)


class Model:
    """Names, centroids and radii, and the weights of the dimensions."""

    def __init__(self, weights: np.ndarray, rows: list[tuple[str, bytes, float]]):
        self.weights = weights
        rows = sorted(rows)
        self.names = [name for name, _, _ in rows]
        self.centroids = np.stack([np.frombuffer(c, np.float32) for _, c, _ in rows]) if rows else None
        self.radii = np.array([r for _, _, r in rows])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        found, known = counts(texts)
        if self.centroids is None:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        similar = vectors(found, self.weights) @ self.centroids.T
        best = similar.argmax(axis=1)
        out = []
        for i, (b, letter) in enumerate(zip(best.tolist(), known.tolist())):
            score = float(np.clip(similar[i, b], 0, 1))
            out.append((self.names[b], score, bool(score < self.radii[b])) if letter else (UNKNOWN, 0.0, True))
        return out


def train(rows: DataFrame, centroids: int = 4, sample: int = SAMPLE) -> Model:
    """A model of ``rows`` (text, lang): ``lang`` null and texts null or without letters are left out.

    Weights are counted over all rows, centroids over about ``sample`` distinct rows of each language,
    chosen by hash.
    """
    rows = rows.where("lang is not null and text is not null")
    weights = frequencies(rows)
    distinct = rows.select("lang", F.xxhash64("text").alias("hash")).distinct()  # copies of a text count once, as they are chosen once
    share = distinct.groupBy("lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("share"))
    chosen = (
        rows.join(stored(share, "languages"), "lang")  # one row per language, so Spark broadcasts it unless they are very many
        .where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
        .groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.first("text").alias("text"))
    )

    def vector(columns: dict[str, list]) -> dict[str, list]:
        found, known = counts(columns["text"])
        rows = vectors(found, weights)
        return {"lang": columns["lang"], "vector": [r.tobytes() if k else None for r, k in zip(rows, known)]}

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.dropna().sort_values("vector")
        if not len(frame):
            return pd.DataFrame({"lang": [], "centroid": [], "radius": []})
        found, radii = clusters(np.stack([np.frombuffer(v, np.float32) for v in frame["vector"]]), centroids)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": [c.tobytes() for c in found], "radius": radii})

    grouped = map_batches(chosen.select("lang", "text"), vector, "lang string, vector binary").groupBy("lang")
    found = grouped.applyInPandas(cluster, "lang string, centroid binary, radius double")
    return Model(weights, [tuple(r) for r in found.collect()])  # ``centroids`` rows per language


def predict(rows: DataFrame, model: Model, kept: list[Column], text: str = "text") -> DataFrame:
    """The ``kept`` columns and lang_pred, score and rejected of each row.

    Null texts and texts without a letter are ``und`` with score 0. Ties go to the first language by
    name. Repeated rows are judged each; an empty table gives an empty table. No shuffle.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    body = free_name(rows, "body")
    rows = rows.select(*kept, F.col(f"`{text}`").cast("string").alias(body))

    def judge(columns: dict[str, list]) -> dict[str, list]:
        found = shared.value.predict(columns.pop(body))
        return columns | dict(zip(("lang_pred", "score", "rejected"), map(list, zip(*found))))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, judge, f"{fields}, lang_pred string, score double, rejected boolean")


def identify(
    docs: DataFrame, training: Column, id: str = "doc_id", text: str = "text", lang: str = "lang", centroids: int = 4,
    sample: int = SAMPLE,
) -> DataFrame:
    """Learn from the rows where ``training`` holds, predict all: id, held_out, lang_pred, score, rejected."""
    wanted = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
                         F.coalesce(training, F.lit(False)).alias("training"))
    model = train(wanted.where("training").drop("training"), centroids, sample)
    kept = [F.col(f"`{id}`"), (~F.coalesce(training, F.lit(False))).alias("held_out")]
    return predict(docs, model, kept, text)

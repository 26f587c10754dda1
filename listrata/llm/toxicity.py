"""Toxicity by multiple-instance learning.

Only documents carry labels. Each sentence has a logistic score over its words and word beginnings;
a document's score is their noisy-or, one minus the product of one minus each. The weights are fitted
to the labels of documents through that noisy-or, so the sentences that make a document toxic can be
named afterwards.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listrata.llm.frames import free_name, map_batches, stored
from listrata.llm.words import ALNUM, Words

#: Hashed features; one more stands for "none" and has no weight.
FEATURES = 1 << 22
#: Word beginnings that count as features, in bytes of UTF-8; whole words count too.
PREFIXES = (4, 5, 6)
#: Toxic documents that a model is fitted on, on average, and twice as many others; bounds the fitting task.
SAMPLE = 2500
#: Features that take part at most.
CHOSEN = 4096
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")


def sentences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each word (one row per word), the first word of each sentence, and each sentence's text.

    Sentences end at ``.``, ``!``, ``?`` and line breaks; those without words are none.
    """
    words = Words(texts, ALNUM)
    kinds = [words.hashes(), *(words.prefixes(n) for n in PREFIXES)]
    features = np.stack([np.where(h != 0, (h >> np.uint64(42)).astype(np.int32), FEATURES) for h in kinds], axis=1)
    place = np.cumsum(_ENDS[words.buffer])[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
    return features, first, np.searchsorted(words.offsets, first, side="right") - 1


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p) - np.log1p(-p)


def calibrate(scores: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the scores' log odds, by logistic regression with a small penalty."""
    rows = np.stack([_logit(scores), np.ones(len(scores))], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ line, -30, 30)))
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(2)
        line += np.clip(np.linalg.solve(curve, rows.T @ (labels - p) - 1e-2 * (line - [1.0, 0.0])), -1, 1)
    return (float(line[0]), float(line[1])) if line[0] > 0 else (1.0, 0.0)


def fit(
    texts: list[str], labels: np.ndarray, rounds: int = 300, rate: float = 0.3, least: int = 4
) -> tuple[np.ndarray, float, float, float]:
    """Weights, bias, slope and shift: by Adam on the noisy-or likelihood with a small penalty on the
    weights, then by logistic regression on the documents' scores.

    The texts are gone through twice, a few at a time: once to choose the features, once to keep where
    the chosen ones occur.
    """
    weights = np.zeros(FEATURES + 1, np.float32)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        return weights, 40.0 if share == 1 else -40.0, 1.0, 0.0
    chosen = _choose(texts, labels, least)
    number = np.full(FEATURES + 1, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    columns, rows, owners, total = [], [], [], 0
    for start, features, first, owner in _parts(texts):
        sentence = np.repeat(np.arange(total, total + len(first)), np.diff(np.append(first, len(features))))
        kept = number[features]
        where, kind = np.nonzero(kept >= 0)
        columns.append(kept[where, kind])
        rows.append(sentence[where])
        owners.append(owner + start)
        total += len(first)
    column, row, owner = np.concatenate(columns), np.concatenate(rows), np.concatenate(owners)
    w, bias = np.zeros(len(chosen)), -4.0
    first_moment, second_moment = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        z = np.clip(bias + np.bincount(row, w[column], total), -30, 30)
        p = 1 / (1 + np.exp(-z))
        miss = np.exp(np.bincount(owner, np.log1p(-p), len(labels)))
        hit = np.maximum(1 - miss, 1e-9)
        slope = p * (1 - (labels / hit)[owner])
        gradient = np.append(np.bincount(column, slope[row], len(w)), slope.sum()) / len(labels)
        gradient[:-1] += 1e-5 * w
        first_moment = 0.9 * first_moment + 0.1 * gradient
        second_moment = 0.99 * second_moment + 0.01 * gradient**2
        change = rate * (first_moment / (1 - 0.9**step)) / (np.sqrt(second_moment / (1 - 0.99**step)) + 1e-8)
        w, bias = w - change[:-1], bias - change[-1]
    weights[chosen] = w
    p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, w[column], total), -30, 30)))
    return weights, float(bias), *calibrate(1 - np.exp(np.bincount(owner, np.log1p(-p), len(labels))), labels)


def _parts(texts: list[str], step: int = 256):
    """Start, features, first words and owners of the sentences of some texts at a time."""
    for start in range(0, len(texts), step):
        yield start, *sentences(texts[start:start + step])


def _choose(texts: list[str], labels: np.ndarray, least: int) -> np.ndarray:
    """The features that speak for toxic documents more clearly than chance among all features would.

    Their likelihood ratio against "as frequent in both classes" must exceed what one in all features
    reaches by chance; rarer words and those that toxic documents lack would only be learnt by heart.
    """
    counts = np.zeros((2, FEATURES + 1), np.int32)
    for start, features, first, owner in _parts(texts):
        document = np.repeat(owner, np.diff(np.append(first, len(features))))
        pairs = np.unique((features + document[:, None] * (FEATURES + 1)).ravel())
        toxic = labels[start + pairs // (FEATURES + 1)] == 1
        found = pairs % (FEATURES + 1)
        for label in (0, 1):
            places, n = np.unique(found[toxic == bool(label)], return_counts=True)
            counts[label, places] += n.astype(np.int32)
    counts[:, FEATURES] = 0
    some = np.flatnonzero(counts.sum(axis=0) >= least)
    zeros, ones = counts[:, some].astype(float)
    total, share = ones + zeros, labels.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(ones, ones * np.log(ones / (total * share)), 0)
                     + np.where(zeros, zeros * np.log(zeros / (total * (1 - share))), 0))
    ratio[ones <= share * total] = 0
    best = np.argsort(-ratio, kind="stable")[:CHOSEN]
    return some[np.sort(best[ratio[best] > 2 * np.log(FEATURES)])]


class Model:
    """Scores of sentences and documents."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.slope, self.shift = weights.astype(np.float32), bias, slope, shift

    def __getstate__(self) -> dict:
        """Nearly all weights are 0; only the others travel."""
        places = np.flatnonzero(self.weights)
        return self.__dict__ | {"weights": (places, self.weights[places])}

    def __setstate__(self, state: dict) -> None:
        places, values = state["weights"]
        self.__dict__ |= state | {"weights": np.zeros(FEATURES + 1, np.float32)}
        self.weights[places] = values

    def calibrated(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _logit(scores) + self.shift, -40, 40)))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[float]]]:
        """Score of each text and of its sentences."""
        features, first, owner = sentences(texts)
        out: list[list[float]] = [[] for _ in texts]
        if not len(first):
            return self.calibrated(np.zeros(len(texts))), out
        z = self.bias + np.add.reduceat(self.weights[features].sum(axis=1, dtype=np.float64), first)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        scores = 1 - np.exp(np.bincount(owner, np.log1p(-p), len(texts)))
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        return self.calibrated(scores), [self.calibrated(p[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def train(docs: DataFrame, labels: DataFrame, training: Column, id: str, text: str, label: str, sample: int = SAMPLE) -> Model:
    """A model of the labelled documents for which ``training`` holds, about ``sample`` toxic ones and
    twice as many others.

    The sample is chosen among the labels, by hash of the id; documents with several labels count as
    toxic if one says so, and so do equal texts, which are taken once.
    """
    known = (
        labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    known = stored(known.withColumnRenamed("id", id).where(training).withColumnRenamed(id, "id"), "labels")
    share = {r["label"]: sample / r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(2 * share.get(0, 0.0)) * (1 << 30)
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < limit)
    texts = (
        docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")  # three times ``sample`` ids on average
        .groupBy(F.sha2("text", 256).alias("hash")).agg(F.max("text").alias("text"), F.max("label").alias("label"))
        .where("text is not null")
    )

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("hash")
        weights, *numbers = fit(frame["text"].tolist(), frame["label"].to_numpy())
        places = np.flatnonzero(weights)
        row = [places.astype(np.int64).tobytes(), weights[places].astype(np.float64).tobytes(), *numbers]
        return pd.DataFrame([row], columns=["places", "weights", "bias", "slope", "shift"])

    one = texts.withColumn("model", F.lit(0)).groupBy("model")
    rows = one.applyInPandas(fitted, "places binary, weights binary, bias double, slope double, shift double").collect()  # one row
    if not rows:
        return Model(np.zeros(FEATURES + 1), -40.0)
    weights = np.zeros(FEATURES + 1)
    weights[np.frombuffer(rows[0]["places"], np.int64)] = np.frombuffer(rows[0]["weights"])
    return Model(weights, *rows[0][2:])


def predict(docs: DataFrame, model: Model, kept: list[Column], text: str = "text", name: str = "found") -> DataFrame:
    """The ``kept`` columns and a struct ``name``: score, predicted and the offending sentences.

    A sentence is offending if its own score is 0.5 or more; its span is in code points, the end not
    included. Null and empty texts, and those without words, score next to 0. Repeated rows are scored each.
    No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = free_name(docs, "body")
    rows = docs.select(*kept, F.col(f"`{text}`").cast("string").alias(body))

    def judge(columns: dict[str, list]) -> dict[str, list]:
        texts, out = columns.pop(body), []
        for whole, score, parts in zip(texts, *shared.value.score(texts)):
            spans = []
            if len(parts) and max(parts) >= 0.5:
                found = [m.span() for m in _SENTENCE.finditer(whole) if _WORD.search(m[0])]
                spans = [{"start": a, "end": b, "score": float(p)} for (a, b), p in zip(found, parts) if p >= 0.5]
            out.append({"score": float(score), "predicted": int(score >= 0.5), "offending": spans})
        return columns | {name: out}

    kind = "struct<score: double, predicted: int, offending: array<struct<start: bigint, `end`: bigint, score: double>>>"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, judge, f"{fields}, `{name}` {kind}")


def score(
    docs: DataFrame, labels: DataFrame, training: Column, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """Learn from labelled rows where ``training`` (of the id) holds, score all: id, held_out, score, predicted, offending."""
    model = train(docs, labels, training, id, text, label, sample)
    kept = [F.col(f"`{id}`"), (~F.coalesce(training, F.lit(False))).alias("held_out")]
    return predict(docs, model, kept, text).select(f"`{id}`", "held_out", "found.*")


def without_toxic(
    docs: DataFrame, labels: DataFrame, training: Column, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` without the documents that are predicted toxic; columns stay as they are."""
    model, name = train(docs, labels, training, id, text, label, sample), free_name(docs, "found")
    judged = predict(docs, model, [F.col(f"`{c}`") for c in docs.columns], text, name)
    return judged.where(F.col(f"`{name}`.predicted") == 0).drop(name)

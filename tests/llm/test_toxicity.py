import math
import random
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import listrata.llm.queries  # noqa: F401
from listrata.llm import toxicity
from listrata.llm.registry import QUERIES


def sample(count, seed):
    """Prose in which a toxic document has one sentence with a bad word, or with one of a family of words."""
    random.seed(seed)
    words = [f"w{i}ab" for i in range(800)]
    rows = []
    for i in range(count):
        parts = [" ".join(random.choices(words, k=8)) for _ in range(random.randint(1, 12))]
        label = int(random.random() < 0.3)
        if label:
            at = random.randrange(len(parts))
            parts[at] += random.choice([" Idiot", f" badstem{random.choice('abcdefgh')}{random.choice('klmnop')}"])
        rows.append((i, random.choice([". ", "!\n", "? "]).join(parts), label))
    return rows


def test_held_out_and_located(spark, documents):
    rows = sample(1500, 1)
    docs, labels = documents([(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    found = toxicity.score(docs, labels, F.col("doc_id") % 5 != 0).collect()
    truth = {i: (t, y) for i, t, y in rows}
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] % 5 for r in held} == {0}
    assert np.mean([r["predicted"] == truth[r["doc_id"]][1] for r in held]) > 0.97
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        text = truth[r["doc_id"]][0]
        if r["predicted"] and truth[r["doc_id"]][1]:
            assert any("diot" in s or "badstem" in s for s in (text[o["start"]:o["end"]] for o in r["offending"]))
    kept = toxicity.without_toxic(docs, labels, F.col("doc_id") % 5 != 0)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found if not r["predicted"]}


def test_edge_rows(spark, documents):
    texts = [None, "", "...", "é 日本", "one. two! three?", "x " * 20_000]
    docs = documents([*enumerate(texts), (0, None), (None, "y")])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7), (4, 0), (4, 0)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        rows = toxicity.score(docs, labels, F.lit(True)).collect()
        assert len(rows) == 8 and all(r["predicted"] == 0 and r["score"] < 0.5 for r in rows)
    assert toxicity.score(documents([]), odd, F.lit(True)).count() == 0


def test_sentences():
    features, first, owner = toxicity.sentences(["One two. Three!\n\n...four", None, "five"])
    assert len(features) == 5 and first.tolist() == [0, 2, 3, 4] and owner.tolist() == [0, 0, 0, 2]


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_toxicity"](spark, folder).toPandas()
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    assert len(rows) == 1000
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(rows.doc_id, rows.held_out))
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.9


def test_query_against_a_plain_scorer(spark):
    """Sentence by sentence and word by word, a sum of weights, one minus the product of one minus each."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = toxicity.train(docs, labels, training, "doc_id", "text", "toxic")
    weight = {}

    def sigmoid(z, bound):
        return 1 / (1 + math.exp(-min(max(z, -bound), bound)))

    def plain(text):
        clean = 1.0
        for sentence in re.split(r"[.!?\n]+", text or ""):
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), sentence))
            for word in words:
                if word not in weight:
                    parts = [(0, word.encode())] + [(n, word.encode()[:n]) for n in (4, 5, 6) if len(word.encode()) > n]
                    weight[word] = sum(float(model.weights[feature(n, part)]) for n, part in parts)
            if words:
                clean *= 1 - sigmoid(model.bias + sum(weight[w] for w in words), 30)
        score = min(max(1 - clean, 1e-9), 1 - 1e-9)
        return sigmoid(model.slope * math.log(score / (1 - score)) + model.shift, 40)

    def feature(size, data):
        """Polynomial over the bytes modulo 2^64, the length or the kind of beginning added, mixed; its upper 22 bits."""
        value = sum((byte + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, byte in enumerate(data))
        value = (value + (len(data) if not size else (1 << 32) + size)) % (1 << 64)
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            value = (value ^ value >> 33) * factor % (1 << 64)
        return (value ^ value >> 33) >> 42

    rows = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert rows.keys() == texts.keys() and np.flatnonzero(model.weights).size
    for i, text in texts.items():
        assert abs(rows[i]["score"] - plain(text)) < 1e-4, (i, rows[i]["score"], plain(text))
        assert rows[i]["predicted"] == (rows[i]["score"] >= 0.5)
    assert len({round(r["score"], 3) for r in rows.values()}) > 2

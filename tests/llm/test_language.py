import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import listrata.llm.queries  # noqa: F401
from listrata.llm import language
from listrata.llm.registry import QUERIES

SYLLABLES = {"aa": "ka to mi ru shi ne".split(), "bb": "ström gen lich ver auf zig".split(), "cc": "дом кот лес мир".split()}


def prose(lang, words, seed):
    random.seed(seed)
    return " ".join("".join(random.choices(SYLLABLES[lang], k=random.randint(1, 3))) for _ in range(words))


def test_languages_and_edge_rows(spark):
    rows = [(i, prose(lang, 30 + i % 50, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !?", "bb"), (1003, prose("aa", 20_000, 5), None), (1003, prose("bb", 5, 6), None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, lang string, body int, score int")
    found = language.identify(docs, F.col("doc_id") % 4 != 2).collect()
    assert len(found) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    for r in found:
        assert r["held_out"] == (r["doc_id"] % 4 == 2) and 0 <= r["score"] <= 1
        if r["doc_id"] in (1000, 1001, 1002):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["doc_id"] < 1000:
            assert r["lang_pred"] == truth[r["doc_id"]]
    assert sorted(r["lang_pred"] for r in found if r["doc_id"] == 1003) == ["aa", "bb"]


def test_foreign_texts_are_rejected(spark):
    rows = [(i, prose("aa", 60, i), "aa") for i in range(200)] + [(900 + i, prose("cc", 60, i), None) for i in range(20)]
    found = language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True)).collect()
    assert all(r["rejected"] for r in found if r["doc_id"] >= 900)
    assert np.mean([r["rejected"] for r in found if r["doc_id"] < 900]) < 0.05


def test_copies_do_not_shrink_the_sample(spark):
    """A language of few texts with many copies is learnt from all of these texts."""
    rows = [(prose(lang, 40, i % 3), f"{lang}{k}") for lang in SYLLABLES for k in range(4) for i in range(300)]
    rows += [(prose("aa", 40, i), "many") for i in range(400)]
    model = language.train(spark.createDataFrame(rows, "text string, lang string"), centroids=1, sample=5)
    assert sorted(set(model.names)) == sorted({lang for _, lang in rows})


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    row, = language.identify(docs, F.lit(True)).collect()
    assert (row["lang_pred"], row["score"], row["held_out"]) == ("und", 0.0, False)
    assert language.identify(docs.limit(0), F.lit(True)).count() == 0


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op10_language"](spark, folder).toPandas()
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    assert len(rows) == len(docs)
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(rows.doc_id, rows.held_out))
    held = rows[rows.held_out].merge(docs, on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_query_against_plain_cosines(spark):
    """Letter pairs and triples counted one by one; weights from all training texts; cosines with each centroid as sums."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    training = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None and r["text"] is not None]

    def plain(text):
        body = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
        found = Counter()
        for size in (2, 3):
            for at in range(len(body) - size + 1):
                a, b = ord(body[at]), ord(body[at + 1])
                value = (a * 0x9E3779B1 + b * 0x85EBCA77) % (1 << 32)
                if size == 3:
                    value = (value * 0xC2B2AE3D + ord(body[at + 2]) * 0x27D4EB2F) % (1 << 32)
                found[((value ^ value >> 15) * 0x2C1B3C6D) % (1 << 32) >> 20] += 1
        return found

    held = Counter(d for r in training for d in plain(r["text"]))
    weights = {d: math.log((1 + len(training)) / (1 + held[d])) + 1 for d in range(language.DIMENSIONS)}
    model = language.train(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).select("text", "lang"))
    np.testing.assert_allclose(model.weights, [weights[d] for d in range(language.DIMENSIONS)], rtol=1e-6)
    found = {r["doc_id"]: r for r in QUERIES["op10_language"](spark, folder).collect()}
    assert len(found) == len(rows)
    for r in rows:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (found[r["doc_id"]]["lang_pred"], found[r["doc_id"]]["score"]) == ("und", 0)
            continue
        vector = {d: math.log1p(n) * weights[d] for d, n in plain(r["text"]).items()}
        length = math.sqrt(sum(x * x for x in vector.values()))
        cosines = [sum(x * float(c[d]) for d, x in vector.items()) / length for c in model.centroids]
        best = max(cosines)
        assert abs(found[r["doc_id"]]["score"] - best) < 1e-4
        near = {model.names[i] for i, c in enumerate(cosines) if c > best - 1e-5}
        assert found[r["doc_id"]]["lang_pred"] in near

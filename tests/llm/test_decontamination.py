import hashlib
import re

import pandas as pd
import pytest

from listrata.llm import decontamination
import listrata.llm.queries  # noqa: F401
from listrata.llm.registry import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    known = {}
    for name, text in items:
        found = words(text)
        size = min(width, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            known.setdefault(tuple(found[i:i + size]), set()).add(name)
    out = {}
    for key, text in docs:
        found, hit, names = words(text), set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(found) - size + 1):
                if tuple(found[i:i + size]) in known:
                    hit.update(range(i, i + size))
                    names |= known[tuple(found[i:i + size])]
        listed = ",".join(sorted(str(n) for n in names))
        out[key] = (len(found), len(hit), len(names), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    return out


def rows_of(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in df.collect()}


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short ITEM"), (3, None), (4, "..."), (10, "short item"),
         (2, "Short ITEM")]
DOCS = [
    (1, "x One, two THREE four\nfive six seven eight nine ten!"), (2, None), (3, ""), (4, "a short\x00item é"), (5, "shortitem"),
    (6, "two three four five six seven eight nine ten eleven one two three"), (7, "short item short item"), (8, "ébo no"),
]


@pytest.mark.parametrize("most", [1 << 20, 20])
def test_against_brute_force(spark, documents, most):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    scanned = decontamination.scan(documents(DOCS), items, most_bytes=most)
    assert rows_of(decontamination.report(scanned, found="found_")) == brute(DOCS, ITEMS)


def test_removal(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents(DOCS)
    cleaned = decontamination.decontaminate(docs, items)
    assert cleaned.schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert texts[1] == "x !" and texts[2] is None and texts[4] == "a  é" and texts[6] == " one two three" and texts[7] == ""
    kept = decontamination.decontaminate(docs, items, action="documents")
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 5, 8}
    with pytest.raises(ValueError):
        decontamination.decontaminate(docs, items, action="other")


def test_empty_tables(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.scan(documents([]), items).count() == 0
    assert all(not r[4] for r in rows_of(decontamination.report(decontamination.scan(documents(DOCS), none), found="found_")).values())


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    items = pd.read_parquet(f"{folder}/benchmark.parquet")
    expected = brute(list(zip(docs.doc_id, docs.text)), list(zip(items.item_id, items.text)))
    assert rows_of(QUERIES["op6_decontamination"](spark, folder)) == expected


def test_flat_arrays():
    """What tasks hold is a small multiple of the benchmark's text, and finds the same as brute force."""
    import pickle
    import random

    random.seed(2)
    vocabulary = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(5000)]
    items = [(str(i), " ".join(random.choices(vocabulary, k=random.randint(0, 400)))) for i in range(1500)]
    items += [("copy", items[7][1]), (None, items[8][1]), ("short", "only these four words")]
    found = decontamination.Windows(items, 10)
    text = sum(len(t) for _, t in items)
    assert len(pickle.dumps(found)) < 5 * text
    docs = [(k, " ".join(random.choices(vocabulary, k=30) + items[k][1].split()[:12] + ["only", "These", "four", "words"])) for k in range(5, 60)]
    expected = brute(docs, items)
    for (key, _), (n, hits, names) in zip(docs, found.find([t for _, t in docs])):
        assert (n, bool(hits), len(names)) == (expected[key][0], expected[key][4], expected[key][2])

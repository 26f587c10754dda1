import random

import numpy as np
import pytest

from listrata.llm import near_duplicates
from listrata.llm.components import components
from listrata.llm.words import shingle_sets

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in SPACE[1:]:
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def shingles(text, width):
    found = split(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + width]) for i in range(max(1, len(found) - width + 1)))


def brute(docs, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in docs]
    roots = {i: i for i, _ in docs}

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                roots[max(p, q)] = min(p, q)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets}


def rows_of(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def corpus(seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Émile", "naïve", "x\x00y"]
    docs = [(0, None), (1, ""), (2, " \n\t"), (3, "One two"), (4, "one  TWO"), (5, "one two three"), (6, "É"), (7, "é")]
    base = [random.choices(vocabulary, k=120) for _ in range(6)]
    for i in range(150):  # a large group of near copies of the first, smaller ones of the others
        words = list(base[0] if i < 100 else random.choice(base[1:]))
        for _ in range(random.randint(0, 4)):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        docs.append((10 + i, random.choice([" ", "\n", "  "]).join(words)))
    docs.append((500, " ".join(random.choices(vocabulary, k=6000))))
    docs.append((501, docs[-1][1].upper()))
    return docs


@pytest.mark.parametrize("width,seed", [(4, 1), (5, 2)])
def test_against_brute_force(documents, width, seed):
    docs = corpus(seed)
    assert rows_of(near_duplicates.groups(documents(docs), width)) == brute(docs, width)


def test_blocks_of_large_groups(documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    docs = corpus(3)
    assert rows_of(near_duplicates.groups(documents(docs), 4)) == brute(docs, 4)


def test_deduplicate(documents):
    docs = documents([(None, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f"), (9, None), (2, "A b c d e f"), (8, "z")])
    kept = near_duplicates.deduplicate(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "2", "8", "9", "None"]
    assert near_duplicates.deduplicate(documents([])).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 63, 1000).astype(np.uint64)])
    same = (near_duplicates.signature(np.unique(a)) == near_duplicates.signature(np.unique(b))).mean()
    assert abs(same - 0.6) < 0.12


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    bounds = near_duplicates.least_matches(0.8, near_duplicates.MISS)
    equal = (rng.random((100_000, near_duplicates.ROWS * near_duplicates.BANDS)) < 0.8).cumsum(axis=1)
    lost = sum((equal[:, near_duplicates.BATCH * (i + 1) - 1] < least).sum() for i, least in enumerate(bounds[1:]))
    assert lost <= 20
    assert bounds[-1] > 0.5 * near_duplicates.ROWS * near_duplicates.BANDS


def test_sets_of_short_texts():
    sizes = [len(s) for s in shingle_sets([None, "", "a", "a b", "a b c d", "a b c d e", "a a a a a a a"], 4)]
    assert sizes == [0, 0, 1, 1, 1, 2, 1]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 4), (260, 259), (260, 259)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 261)}


def chain(seed):
    """A group tied by bands whose members are similar to their neighbours only, and others beside it."""
    random.seed(seed)
    words = [f"w{i}" for i in range(1000)]
    random.shuffle(words)
    docs = []
    for i in range(120):  # a window of 100 words slides by 5: neighbours are similar, others tied through them
        start = 5 * (i + 4 * (i // 10))  # and by 25 at every tenth
        docs.append((1000 - i, " ".join(words[start:start + 100])))
    return docs + [(5, docs[3][1]), (6, None), (7, docs[9][1].upper()), (5, docs[3][1])]


def test_large_group_that_is_not_connected(documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    docs = chain(5)
    found = near_duplicates.groups(documents(docs), 4)
    assert rows_of(found) == brute(sorted(set(docs), key=str), 4)


def test_texts_follow_survivors_only(documents, monkeypatch):
    """Blocks hold signatures, and a text goes to no block in which it is in no surviving pair."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    seen = {}
    verified, surviving = near_duplicates._verified, near_duplicates._surviving

    def count(name, function, checked):
        def counted(dealt, *rest):
            seen.setdefault(name, []).append(dealt.count())
            assert ("text" in dealt.columns) == checked
            return function(dealt, *rest)
        return counted

    monkeypatch.setattr(near_duplicates, "_verified", count("texts", verified, True))
    monkeypatch.setattr(near_duplicates, "_surviving", count("signatures", surviving, False))
    near_duplicates.groups(documents(chain(6)), 4).count()
    first, rest = seen["texts"]
    assert len(seen["signatures"]) == 1 and rest < seen["signatures"][0] / 2
    assert first <= 2 * 121

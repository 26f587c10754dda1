import hashlib
import random
import zlib

import pytest

from listrata.llm import manifest, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    texts = [None if v is None else str(v) for v in row]
    return H(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def grown(nodes):
    """The root over nodes, and per node its siblings before and after, level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i:i + 3]) for i in range(0, len(below), 3)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = i - i % 3
            path.append(("".join(level[run:i]), "".join(level[i + 1:run + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text); what the query returns, by brute force."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        trees[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    below = {s: grown([leaf(r) for r in trees[s]]) for s in order}
    root, above = grown([below[s][0] for s in order])
    out = []
    for s, upper in zip(order, above):
        for row, path in zip(trees[s], below[s][1]):
            steps = [*path, *upper]
            altered = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                altered = (*row[:4], row[4].replace("\n", ""))
            node = leaf(altered)
            for before, after in steps:
                node = H(before, node, after)
            out.append((row[0], leaf(row), below[s][0], root, H(*(b + a for b, a in steps)), node, node == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def audited(spark, rows, **how):
    frame = spark.createDataFrame(
        [(*r, "x", "y") for r in rows],
        "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, root string",
    )
    from pyspark.sql import functions as F
    from listrata.llm.queries import fold

    return manifest.audit(frame, fold(2) == 0, F.replace("text", F.lit("\n"), F.lit("")), **how)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_against_brute_force(spark, height):
    """Trees of many sizes, one of which holds a third of all rows, in blocks of 3, 9 and 6,561."""
    random.seed(height)
    sizes = {None: 2, "": 1, "a": 3, "b": 4, "é": 9, "z": 10, "Z": 28, "hot": 90, "k": 81, "l": 27}
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            at += 1
            rows.append((at, source, random.choice(["en", None]), at % 7, random.choice(["a\nb", "x", "", None, "é\n\n"])))
    random.shuffle(rows)
    assert found(audited(spark, rows, height=height)) == expected(rows)


def test_edge_rows(spark):
    rows = [
        (1, "a", "en", 3, "x\ny"), (1, "a", "en", 3, "x\ny"), (1, "a", "en", 3, "other"), (None, "a", None, None, None),
        (None, None, None, None, "\n"), (5, None, "", 0, ""), (4, "b", "de", 200_000, "é\n" * 100_000), (-7, "a", "en", 1, "1:x"),
    ]
    assert found(audited(spark, rows)) == expected(rows)
    assert found(audited(spark, rows[:1])) == expected(rows[:1])
    assert audited(spark, []).count() == 0


def test_a_range_for_each_row(spark):
    """Rows that are all alike are ranked in several ranges, without gaps."""
    rows = spark.range(3000, numPartitions=5).selectExpr("'t' as tree", "1 as id", "'d' as digest")
    ranked = manifest.ranked(rows, "tree", "id", "digest").collect()
    assert sorted(r.place for r in ranked) == list(range(3000)) and {r.n for r in ranked} == {3000}


def test_states_are_resumed():
    """A fold hashes the replacement and its right siblings only."""
    block = manifest.Block([H(str(i)) for i in range(11)], True, 8, 3)
    assert block.top == grown([H(str(i)) for i in range(11)])[0]
    assert block.fold(10, H("10")) == block.top != block.fold(10, H("new"))
    assert [len(s) for s in block.states[0]] == [3, 3, 3, 2] and block.path(10)[0] == (H("9"), "")


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*manifest.FIELDS).collect()]
    assert found(queries.op12_manifest(spark, folder)) == expected(rows)

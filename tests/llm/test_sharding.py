import itertools
import random
import zlib

import pytest

from listrata.llm import queries, sharding


def spread(sizes, shards):
    sums = [0] * shards
    for size, place in zip(sizes, sharding.differencing(sizes, shards)):
        sums[place] += size
    return max(sums) - min(sums)


def plain_spread(sizes, shards):
    """Differencing on tuples, as it is written in papers: the spread that it reaches."""
    parts = [sorted([s] + [0] * (shards - 1)) for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted(x + y for x, y in zip(a, reversed(b))))
    return parts[0][-1] - parts[0][0]


@pytest.mark.parametrize("seed", range(4))
def test_differencing(seed):
    random.seed(seed)
    sizes = random.sample(range(1, 10_000_000), 60)  # distinct, so ties are rare
    for shards in (2, 3, 7, 24):
        assert spread(sizes, shards) == plain_spread(sizes, shards)


def test_known_and_small_cases():
    assert spread([8, 7, 6, 5, 4], 2) == 2  # the published example
    assert sharding.differencing([], 3) == []
    assert sharding.differencing([5], 3) == [0]
    assert sorted(sharding.differencing([5, 5, 5], 3)) == [0, 1, 2]
    best = min(abs(sum(s * f for s, f in zip([9, 7, 5, 3], signs))) for signs in itertools.product([1, -1], repeat=4))
    assert spread([9, 7, 5, 3], 2) == best == 0


def check(rows, out, shards=24, id="doc_id"):
    """Every row once, groups whole, slots gapless; returns the bytes of each shard."""
    def facts(i, t):
        body = (t or "").encode()
        return i, len(body) + 8, zlib.crc32(body)

    found = [r.asDict() for r in out.collect()]
    assert sorted(map(str, (facts(i, t) for i, t in rows))) == sorted(str((r[id], r["size"], r["text_crc32"])) for r in found)
    groups, slots, sums = {}, {}, [0] * shards
    for r in found:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        assert groups.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        sums[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sums


def test_edge_rows(documents):
    rows = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "b"), (None, None), (4, "é" * 100_000), (5, "a"), (6, "c")]
    sums = check(rows, sharding.shard(documents(rows), 3), 3)
    assert max(sums) == 200_008
    assert sharding.shard(documents([])).count() == 0
    assert check([(1, "x")], sharding.shard(documents([(1, "x")]))) == [9] + [0] * 23


@pytest.mark.parametrize("own, pools", [(10_000, 4), (500, 500)])
def test_balance_with_a_group_of_a_third(documents, own, pools):
    """A group of a third of all rows has its shard alone; the others are equal to a few bytes."""
    random.seed(1)
    rows = [(i, "hot " * 100) for i in range(1500)]
    rows += [(i, "".join(random.choices("abcdé ", k=random.randint(0, 900)))) for i in range(1500, 4500)]
    sums = sorted(check(rows, sharding.shard(documents(rows).repartition(7), own=own, pools=pools)))
    assert sums[-1] == 1500 * 408
    assert sums[-2] - sums[0] <= (16 if own > len(rows) else sums[0] // 50)


def test_query_and_files(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, queries.op11_sharding(spark, folder))
    name = sharding.write_shards(docs.withColumnRenamed("source", "shard"), f"{tmp_path}/s", 5)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert name == "shard_" and back.count() == len(rows) and set(docs.columns) - {"source"} <= set(back.columns)
    assert back.groupBy("text").agg({"shard_": "count"}).count() == back.select("text", "shard_").distinct().count()

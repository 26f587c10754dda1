import random
import zlib

import numpy as np
import pytest

from listrata.llm import packing


def lengths_of(rows):
    return {k: sum(r["length"] for r in rows if r["sequence_id"] == k) for k in {r["sequence_id"] for r in rows}}


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_open_window(seed):
    random.seed(seed)
    window = 40
    lengths = sorted((random.randint(1, window) for _ in range(200)), reverse=True)
    numbers, offsets = packing.best_fit(lengths, window)
    room = {}
    for length, number, offset in zip(lengths, numbers, offsets):
        fitting = [c for c in room.values() if c >= length]
        if fitting:
            assert room[number] == min(fitting)
        else:
            assert number not in room
        assert offset == window - room.get(number, window)
        room[number] = room.get(number, window) - length
    assert all(c >= 0 for c in room.values())


def test_edge_texts(documents, tokenizer):
    from tokenizers import Tokenizer

    texts = [None, "", "a", "a", "word " * 5000, "x  y\n\n z\t", "<|endoftext|>b", "²½ \x1c\x1dq", "日本語テキスト ѣ"]
    rows = packing.pack(documents(list(enumerate(texts))), tokenizer, window=128, shard_pieces=4).collect()
    library = Tokenizer.from_file(tokenizer)
    expected = [[*library.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    for number, ids in enumerate(expected):
        own = sorted((r for r in rows if r["doc_id"] == number), key=lambda r: r["start"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 128))
        assert sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
    for key, fill in lengths_of(rows).items():
        padded = next(r["padded_length"] for r in rows if r["sequence_id"] == key)
        assert padded == (fill if fill & (fill - 1) == 0 else 128)


def test_repeated_ids_and_empty_table(documents, tokenizer):
    rows = packing.pack(documents([(1, "a b"), (1, "a b"), (1, "c"), (None, "d")]), tokenizer).collect()
    assert sorted(r["length"] for r in rows) == [2, 2, 3, 3]
    assert packing.pack(documents([]), tokenizer).count() == 0


def test_sequences_hold_the_tokens(documents, tokenizer):
    packed = packing.pack(documents([(1, "one two three"), (2, "four")]), tokenizer, with_ids=True)
    rows = packing.sequences(packed).collect()
    assert len(rows) == 1
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    one, two = ([*library.encode(t).ids, 1] for t in ("one two three", "four"))
    fill = len(one) + len(two)
    assert rows[0]["input_ids"][:fill] in (one + two, two + one)
    assert set(rows[0]["input_ids"][fill:]) <= {0}

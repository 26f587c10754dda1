import hashlib
import random
from collections import Counter, defaultdict

import pytest

from listrata.llm import alignment, queries


@pytest.fixture(scope="module")
def libraries(tokenizer):
    """Both libraries as such: (id, bytes) of each token of a text."""
    import json

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    values = {chr(b): b for b in printable}
    values |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def tokens(text):
        a = [(i, bytes(values[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") else piece.replace("▁", " ").encode()))
        return a, b

    return tokens


def ranges(tokens):
    out, at = [], 0
    for number, data in tokens:
        out.append((number, at, at + len(data)))
        at += len(data)
    return out


def expected(rows, tokens):
    """By comparing every token of one side with every one of the other."""
    counts, documents = Counter(), []
    for i, text in rows:
        links, a, b = [], [], []
        if text:
            a, b = tokens(text)
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a, b = [], []
        a, b = ranges(a), ranges(b)
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [
            "|".join(",".join(str(x) for x, s, e in side if s >= start and e <= end) for side in (a, b))
            for start, end in zip([0, *cuts], cuts)
        ]
        counts.update(links)
        documents.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted((
        (i, na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for i, na, nb, ng, links, sha in documents
    ), key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


ROWS = [
    (1, "A plain sentence, twice. A plain sentence, twice."), (1, "A plain sentence, twice. A plain sentence, twice."), (2, None), (3, ""),
    (None, "x"), (4, " "), (5, "  two  spaces\t\n and <|endoftext|> or <s> and </s> <unk> <0x41>"), (6, "naïve café — 日本語 🙂 ▁ é"),
    (7, "퟿\x00\r\n"), (8, "½ ﬁ ｆｕｌｌ \xa0 no-break"), (9, "don't you'll it's 12345 67890"), (10, "\n\n\n   end   "),
]


@pytest.mark.parametrize("chunk", [1, 20, 4_000_000])
def test_edge_rows(documents, tokenizer, libraries, chunk):
    docs = documents(ROWS).repartition(3)
    out = alignment.align(docs, tokenizer, queries.tokenizer("piece_bpe_32k.model"), chunk_links=chunk)
    assert found(out) == expected(ROWS, libraries)
    assert alignment.align(documents([]), tokenizer, queries.tokenizer("piece_bpe_32k.model")).count() == 0


def test_long_and_random_texts(documents, tokenizer, libraries):
    random.seed(5)
    rows = [(i, "".join(random.choices("abc éß\n<>|'s1日 ", k=random.randint(1, 60)))) for i in range(150)]
    rows.append((200, "word " * 400 + "x" * 400 + " " * 300))
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # copies of one text
    out = alignment.align(documents(rows), tokenizer, queries.tokenizer("piece_bpe_32k.model"), chunk_links=500)
    assert found(out) == expected(rows, libraries)


def test_groups(documents, tokenizer, libraries):
    rows = [r.asDict(True) for r in alignment.groups(documents(ROWS), tokenizer, queries.tokenizer("piece_bpe_32k.model")).collect()]
    texts = Counter(";".join(f"{','.join(map(str, g['a']))}|{','.join(map(str, g['b']))}" for g in r["groups"]) for r in rows)
    digests = Counter(r[-1] for r in expected(ROWS, libraries))
    assert Counter({hashlib.sha256(t.encode()).hexdigest() if t else "": n for t, n in texts.items()}) == digests


def test_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    short = [(i, t if t and len(t) < 3000 else None) for i, t in rows]
    from listrata.llm.alignment import align

    frame = spark.createDataFrame(short, "doc_id bigint, text string")
    assert found(align(frame, queries.tokenizer(), queries.tokenizer("piece_bpe_32k.model"))) == expected(short, libraries)
    whole = queries.op13_alignment(spark, folder).collect()  # long texts too: a link for each token that begins or ends
    assert len(whole) == len(rows) and all(r.n_links == r.n_a + r.n_b - r.n_groups for r in whole) and any(r.n_a > 3000 for r in whole)

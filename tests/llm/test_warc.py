import gzip
import hashlib
import random

import pytest

from listrata.llm import warc


def pages(spark, rows):
    rows = [(i, u, h, "x", "y") for i, u, h in rows]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, archive string")


def expected(rows, least=100):
    first = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= least and i is not None:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        revisit = i is not None and body in first and first[body] != i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[body] if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def sample():
    random.seed(4)
    big = "".join(random.choice("abc<>é日\n\r\0 ") for _ in range(200_000))
    return [
        (1, "http://a", "x" * 99), (2, "http://a", "x" * 99), (5, "u", "é" * 50), (4, "u", "é" * 50), (9, None, None), (8, "", ""),
        (7, "bad\r\nurl: x", big), (6, "v", big), (10, "w", "WARC/1.1\r\n\r\n" * 20), (11, "w", "WARC/1.1\r\n\r\n" * 20 + "z"),
        (5, "u", "é" * 50), (13, "k", "\r\n\r\n"), (3, "m", big),
    ]


@pytest.mark.parametrize("size", [1000, 32 << 20])
def test_round_trip(spark, tmp_path, size):
    rows = sample()
    index = warc.archive_pages(pages(spark, rows), f"file://{tmp_path}/w", archive_bytes=size)
    assert rows_of(index) == expected(rows)
    bodies = {(h or "").encode() for _, _, h in rows}
    for r in index.collect():  # the sidecar leads to each record, which is a gzip member of its own
        path, = (tmp_path / "w" / "normal" / "kind=archives" / f"archive={r['archive']}").glob("part-*")
        member = path.read_bytes()[r["offset"]:r["offset"] + r["length"]]
        (headers, block, _), = warc.records(member)
        assert gzip.decompress(member).startswith(b"WARC/1.1\r\n")
        assert headers["warc-type"] == r["record_type"]
        payload = block.partition(b"\r\n\r\n")[2]
        assert payload in bodies if r["record_type"] == "response" else payload == b""
    for path in (tmp_path / "w" / "streams").glob("archive=*/part-*"):
        content = path.read_bytes()
        assert len(list(warc.members(content))) == 1


def test_null_id_and_empty_table(spark):
    rows = [(None, "u", "y" * 200), (2, "u", "y" * 200), (3, "u", "y" * 200)]
    assert rows_of(warc.archive_pages(pages(spark, rows))) == expected(rows)
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_broken_archives():
    def described(content):
        (headers, block, _), = warc.records(content)
        return warc.described(headers, block)

    good = warc.member(warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, False))
    assert described(good)["page_id"] == 1
    with pytest.raises(ValueError):
        list(warc.records(good[:-12]))
    with pytest.raises(ValueError):
        described(warc.member(warc.record(1, "u", b"abc", "0" * 64, None, False)))


def test_sidecar(spark, tmp_path):
    """What is written while an archive is rewritten is what the archive says when it is read back."""
    index = warc.archive_pages(pages(spark, sample()), f"file://{tmp_path}/w", archive_bytes=1000)
    beside = warc.sidecar(spark, f"file://{tmp_path}/w/normal").select(*index.columns)
    assert index.count() == len(sample()) and index.exceptAll(beside).count() == 0

"""WARC archives: written as one gzip stream each, normalised to one member per record, indexed.

Archives pass through Spark's own readers and writers as whole files, so they may lie in any store
that Spark reaches and only finished tasks leave files. A file is one binary value, written as a
line that ends in a zero byte: zero bytes after a gzip stream are padding by its format.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listrata.llm.frames import slices, stored
from listrata.sources.files import path_exists
from listrata.sources.workspace import new_folder

#: Uncompressed bytes after which an archive is closed; bounds what a task holds.
ARCHIVE_BYTES = 32 << 20
#: Payloads below this size are never revisits.
LEAST_REVISIT = 100
#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_GZIP = 31


def _uri(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, original: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _uri(page)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _uri(original))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def _inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed bytes of all members, a step at a time; zero padding is skipped."""
    while content:
        stream = zlib.decompressobj(_GZIP)
        while not stream.eof:
            part = stream.decompress(content, step)
            content = stream.unconsumed_tail
            if part:
                yield part
            elif not content and not stream.eof:
                raise ValueError("an archive ends inside a gzip stream")
        content = stream.unused_data.lstrip(b"\0")


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, block and raw bytes of each record of an archive, streamed."""
    return parsed(_inflated(content))


def parsed(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """The same of records whose inflated bytes come part by part."""
    buffer, parts = bytearray(), iter(parts)

    def more() -> bool:
        part = next(parts, None)
        buffer.extend(part or b"")
        return part is not None

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer:
                    raise ValueError("an archive ends inside a record")
                return
        lines = buffer[:end].decode("utf-8", "surrogatepass").split("\r\n")
        if lines[0] != VERSION.decode().strip():
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        total = end + 4 + int(headers["content-length"]) + 4
        while len(buffer) < total:
            if not more():
                raise ValueError("an archive ends inside a record")
        raw = bytes(buffer[:total])
        del buffer[:total]
        yield headers, raw[end + 4:-4], raw


def member(raw: bytes, level: int = 6) -> bytes:
    """One record as a gzip member of its own."""
    stream = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
    return stream.compress(raw) + stream.flush()


def decide(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """The pages with payload, digest and the page that each revisits, if any.

    Digests are counted without the pages; only those that occur twice are joined back, by a join that
    Spark may split where one payload is very frequent.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        rows.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    )
    joined = rows.join(stored(repeated, "digests"), "digest", "left")
    revisit = F.coalesce(F.col("original") != F.col("page_id"), F.lit(False))
    return joined.withColumn("original", F.when(revisit, F.col("original"))).withColumn("revisit", revisit)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records of ``decide`` below ``folder``, each archive one gzip stream over all its records."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        stream, parts, size = zlib.compressobj(6, zlib.DEFLATED, _GZIP), [], 0

        def closed() -> pa.RecordBatch:
            parts.append(stream.flush())
            return pa.RecordBatch.from_pydict(
                {"archive": [f"{task:07d}-{number:05d}"], "content": pa.array([b"".join(parts)], pa.binary())}
            )

        for batch in batches:
            for piece in slices(batch):
                for row in piece.to_pylist():
                    raw = record(row["page_id"], row["url"], row["payload"], row["digest"], row["original"], row["revisit"])
                    parts.append(stream.compress(raw))
                    size += len(raw)
                    if size >= archive_bytes:
                        yield closed()
                        stream, parts, size, number = zlib.compressobj(6, zlib.DEFLATED, _GZIP), [], 0, number + 1
        if size:
            yield closed()

    _write_files(pages.mapInArrow(run, "archive string, content binary"), folder)


def _write_files(files: DataFrame, folder: str, *by: str) -> None:
    lines = files.select(*by, "archive", F.col("content").cast("string").alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\0").partitionBy(*by, "archive").text(folder)


def _read_files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile")
    if "archive" not in files.load(folder).columns:  # no archive at all
        return spark.createDataFrame([], "archive string, content binary")
    schema = "path string, modificationTime timestamp, length bigint, content binary, archive string"
    return files.schema(schema).load(folder).select("archive", "content")


INDEX = (
    "archive string, offset bigint, length bigint, page_id bigint, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint"
)
#: Where the archives and the sidecar lie below a normalised folder.
ARCHIVES, SIDECAR = "kind=archives", "kind=index"


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives below ``source`` with every record as a gzip member of its own.

    Each archive is inflated once, as a stream; archives are independent of one another. While it is
    rewritten, each record's offset, length and description go to the archive's sidecar, one JSON object
    per record, ended by a zero byte.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind: str, name: str, contents: list[bytes]) -> pa.RecordBatch:
            n = len(contents)
            return pa.RecordBatch.from_pydict({"kind": [kind] * n, "archive": [name] * n, "content": pa.array(contents, pa.binary())})

        for batch in batches:
            for i in range(batch.num_rows):
                name, members, entries, offset = batch.column("archive")[i].as_py(), [], [], 0
                for headers, block, raw in records(batch.column("content")[i].as_py()):
                    members.append(member(raw))
                    entry = {"offset": offset, "length": len(members[-1]), **described(headers, block)}
                    entries.append(json.dumps(entry).encode())
                    offset += entry["length"]
                yield rows("archives", name, [b"".join(members)])
                yield rows("index", name, entries)

    files = _read_files(spark, source).mapInArrow(run, "kind string, archive string, content binary")
    _write_files(files, target, "kind")


def sidecar(spark: SparkSession, folder: str) -> DataFrame:
    """The index (``INDEX``) that ``normalise`` wrote beside the archives of ``folder``."""
    at = f"{folder}/{SIDECAR}"
    if not path_exists(spark, at):
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).option("lineSep", "\0").json(at)


def described(headers: dict[str, str], block: bytes) -> dict:
    """What one record says of itself; the payload of a response is checked against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = dict(line.lower().split(": ", 1) for line in head.decode("latin-1").split("\r\n")[1:])
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload and digest differ: {headers['warc-record-id']}")
    return {
        "page_id": _page(headers["warc-record-id"]), "payload_bytes": int(lines["content-length"]),
        "payload_digest": digest, "record_type": headers["warc-type"], "refers_to": _page(headers.get("warc-refers-to")),
    }


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and inflated bytes of each gzip member."""
    offset, view = 0, memoryview(content)
    while offset < len(content) and content[offset]:
        stream, at, step, parts = zlib.decompressobj(_GZIP), offset, 1 << 16, []
        while not stream.eof:
            part = view[at:at + step]
            if not part:
                raise ValueError("an archive ends inside a gzip stream")
            parts.append(stream.decompress(part))
            at += len(part)
        at -= len(stream.unused_data)
        yield offset, at - offset, b"".join(parts)
        offset = at


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of normalised archives, from the archives alone: where its member lies and what it says (``INDEX``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column("archive")[i].as_py(), batch.column("content")[i].as_py()
                rows = []
                for at, length, raw in members(content):
                    (headers, block, _), = parsed([raw])
                    rows.append({"archive": name, "offset": at, "length": length, **described(headers, block)})
                yield pa.RecordBatch.from_pylist(rows, schema=index)

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    index = to_arrow_schema(T.StructType.fromDDL(INDEX))
    return _read_files(spark, f"{folder}/{ARCHIVES}").mapInArrow(run, INDEX)


def _sum(index: DataFrame) -> tuple:
    """Count and sum of hashes of an index: equal for equal rows in any order."""
    names = index.columns
    return tuple(index.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*names).cast("decimal(38,0)"))).first())


def archive_pages(
    pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES, least: int = LEAST_REVISIT,
) -> DataFrame:
    """Write a WARC record per page, normalise the archives, read them back and return their index.

    Below ``folder`` (a fresh one below ``spark.checkpoint.dir`` by default) lie ``streams`` (archives as
    single gzip streams), ``normal`` (archives with a member per record and, beside them, the sidecar) and
    ``index`` (Parquet, ``INDEX``), which is what the archives say when they are read back; it raises
    ``ValueError`` if the sidecar says anything else. Of pages with equal payloads of at least ``least``
    bytes the one with the smallest id is a response, others revisit it; rows that repeat this id are
    responses too. A null html is an empty payload, a null url is left out. A page with a null id is
    written with an empty one; it is a response and never referred to. Other columns are not looked at. An
    empty table gives empty folders and an empty index.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "llm-warc")
    write_archives(decide(pages, page_id, url, html, least), f"{folder}/streams", archive_bytes)
    normalise(spark, f"{folder}/streams", f"{folder}/normal")
    if path_exists(spark, f"{folder}/normal/{ARCHIVES}"):
        read_back(spark, f"{folder}/normal").write.mode("overwrite").parquet(f"{folder}/index")
    else:
        spark.createDataFrame([], INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    if _sum(index) != _sum(sidecar(spark, f"{folder}/normal").select(*index.columns)):
        raise ValueError(f"sidecar and archives differ below {folder}")
    return index

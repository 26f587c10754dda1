"""CSV and Parquet tables, and replacing a table that is being read."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listrata.functions.cleaning import FALSE_TEXTS, NUMBER, TRUE_TEXTS
from listrata.sources import records

ROW_ORDER = "_row_order"

# The texts a pandas CSV reader takes for a missing value.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Bytes of files whose rows are shuffled together where files are read in rounds; more on many cores.
ROUND_BYTES = 2 << 30


def round_bytes(spark: SparkSession) -> int:
    return max(ROUND_BYTES, ROUND_BYTES // 16 * spark.sparkContext.defaultParallelism)


def _layouts(text: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """Header line to column names, for the different headers of several files."""
    found = text.withColumn("id", F.monotonically_increasing_id()).where("block = 0 AND value NOT IN ('', '\r')")
    places = F.broadcast(found.groupBy("file").agg(F.min("id").alias("id")).select("id"))  # no line goes through the aggregate
    firsts = found.join(places, "id", "left_semi").select(F.col("value").alias("head")).distinct().collect()
    if len(firsts) == 1:
        return {firsts[0]["head"]: names}
    layouts = {}
    for head, in firsts:
        rows = list(csv.reader([head.lstrip("\ufeff").rstrip("\r")], strict=True))
        layouts[head] = rows[0]
    return layouts


def _format(spark: SparkSession, paths: list[str], names: list[str], escape: str | None) -> tuple[str, bool, dict[str, list[str]]]:
    """How quotes are written, whether all lines write them so, and the layouts of headers: what all files together tell."""
    text = records.lines(spark, paths)
    layouts = {"": names} if len(text.inputFiles()) == 1 else _layouts(text, names)
    return escape or records.style(text), escape is not None, layouts


def _assembled(
    spark: SparkSession, paths: list[str], names: list[str], default: str, fixed: bool, layouts: dict[str, list[str]],
) -> DataFrame:
    """All values as text, by the header of each file, and ``_row_order``. ``paths`` may be some of the files of the layouts."""
    found = records.records(records.lines(spark, paths), default, fixed)
    wide = max(map(len, layouts.values()))
    row = found.where("NOT first").select(records.values(F.col("record"), F.col("backslash"), wide).alias("v"), records.place().alias(ROW_ORDER))
    if len(layouts) == 1:
        return row.select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)], ROW_ORDER)
    heads = found.where("first").select(F.col("file").alias("of"), F.col("record").alias("head"))
    row = row.join(heads, F.col(f"{ROW_ORDER}.file") == F.col("of"))
    every = list(dict.fromkeys(n for layout in layouts.values() for n in layout))
    cells = {n: F.lit(None).cast("string") for n in every}
    for head, layout in layouts.items():
        for i, name in enumerate(layout):
            cells[name] = F.when(F.col("head") == head.rstrip("\r"), F.col("v")[i]).otherwise(cells[name])
    return row.select(*[cell.alias(n) for n, cell in cells.items()], ROW_ORDER)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    escape: str | None = '"',
    multi_line: bool = True,
    na_texts: Sequence[str] = NA_TEXTS,
    row_order: bool = False,
    infer: bool = False,
    **options: str | bool,
) -> DataFrame:
    """Every column of a headed CSV as text, missing-value words as null.

    Columns are taken by header name, each file's own, so their order in a file does not matter; a column
    that some files lack is null there. ``escape`` is the sign before a quote inside a quoted field: the
    quote itself (``""``), a backslash, or ``None`` where each record tells by itself (see
    :mod:`listrata.sources.records`). Files with line breaks inside quotes are read by many tasks each.
    ``multi_line=False``, for files known to hold none, spares a shuffle. ``row_order`` adds
    ``_row_order``, which grows along a file, and from file to file by path. ``infer`` types the columns by
    :func:`infer_types`. Reader ``options`` of Spark's (a separator, an encoding) call for a fixed ``escape``;
    with them a file with line breaks is read by one task.
    """
    paths, raw, by_lines = _opened(spark, path, escape, multi_line, options)
    if by_lines:
        rows = _assembled(spark, paths, raw.columns, *_format(spark, paths, raw.columns, escape))
    else:
        rows = raw.select("*", place_in_files(*files_of_rows())) if row_order else raw
    rows = _without_missing(rows, na_texts, row_order)
    return infer_types(rows) if infer else rows


def csv_rounds(
    spark: SparkSession, path: str | Sequence[str], *, escape: str | None = '"', multi_line: bool = True,
    na_texts: Sequence[str] = NA_TEXTS, row_order: bool = False, **options: str | bool,
) -> list[Callable[[], DataFrame]]:
    """What makes the rows of :func:`read_csv`, of some files each, of about ``ROUND_BYTES`` together.

    All have the same columns, and files are read by what all of them tell. If the files are small, or their
    lines are not shuffled, there is one frame of all rows.
    """
    paths, raw, by_lines = _opened(spark, path, escape, multi_line, options)
    groups = _groups_of_files(spark, paths) if by_lines else []
    if len(groups) < 2:
        how = {"escape": escape, "multi_line": multi_line, "na_texts": na_texts, "row_order": row_order} | options
        return [partial(read_csv, spark, path, **how)]
    told = _format(spark, paths, raw.columns, escape)
    return [lambda g=g: _without_missing(_assembled(spark, g, raw.columns, *told), na_texts, row_order) for g in groups]


def _groups_of_files(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files below the paths, in order, in groups of about ``ROUND_BYTES`` or of one file."""
    groups, size, most = [], 0, round_bytes(spark)
    for uri in sorted(spark.read.text(paths).inputFiles()):
        file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri)).toString()
        fs, target = _hadoop(spark, file)
        length = fs.getFileStatus(target).getLen()
        if not groups or size + length > most:
            groups, size = [*groups, []], 0
        groups[-1].append(file)
        size += length
    return groups


def _opened(
    spark: SparkSession, path: str | Sequence[str], escape: str | None, multi_line: bool, options: dict,
) -> tuple[list[str], DataFrame, bool]:
    """The paths, Spark's own reading of them, and whether they are read by lines instead."""
    paths = [path] if isinstance(path, str) else list(path)
    if options and escape is None:
        raise ValueError("with reader options, say how quotes are written")
    sign = escape or '"'
    raw = spark.read.options(header=True, escape=sign, multiLine=multi_line, inferSchema=False).options(**options).csv(paths)
    return paths, raw, bool(not options and raw.columns and (multi_line or escape is None))


def _without_missing(rows: DataFrame, na_texts: Sequence[str], row_order: bool) -> DataFrame:
    """Words for a missing value become null."""
    data = [c for c in rows.columns if c != ROW_ORDER]
    missing = list(na_texts)
    cleaned = [
        F.when(~F.col(f"`{c}`").isin(missing), F.col(f"`{c}`")).alias(c) if missing else F.col(f"`{c}`")
        for c in data
    ]
    return rows.select(*cleaned, *([ROW_ORDER] if row_order else []))


def files_of_rows() -> tuple[Column, Column]:
    """``file`` and ``block``, where a row was read."""
    return F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")


def place_in_files(file: Column, block: Column) -> Column:
    """``_row_order``: file, block of the file and row of the block, in an order that does not depend on sizes."""
    return F.struct(file.alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("row")).alias(ROW_ORDER)


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns by what all their values are: whole, floating, truth value, or text.

    One aggregate tests all columns, after missing-value words have become null. A column
    without any value is floating.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    kinds = {
        "bigint": lambda c: c.rlike(r"^\s*[+-]?\d{1,18}\s*$"),
        "double": lambda c: c.rlike(NUMBER),
        "boolean": lambda c: c.isin(*TRUE_TEXTS, *FALSE_TEXTS),
    }
    if not texts:
        return df
    tests = {(c, kind): test for c in texts for kind, test in kinds.items()}
    found = df.agg(*[F.bool_and(test(F.col(f"`{c}`"))) for (c, _), test in tests.items()]).first()
    fits = dict(zip(tests, found))

    def typed(c: str) -> Column:
        if fits[c, "double"] is None:
            return F.lit(None).cast("double").alias(c)
        kind = next((k for k in kinds if fits[c, k]), "string")
        return F.trim(f"`{c}`").cast(kind).alias(c) if kind != "string" else F.col(f"`{c}`")

    return df.select(*[typed(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def write_csv(df: DataFrame, path: str, **options: str | bool) -> None:
    """Replace ``path`` by a headed CSV with doubled quotes."""
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **keep_spaces).options(**options).csv(path)


def _suffix(path: str) -> str:
    for suffix in (".csv", ".parquet"):
        if path.rstrip("/").endswith(suffix):
            return suffix
    raise ValueError(f"unsupported file format: {path}")


def lake_path(root: str, path: str) -> str:
    """``path`` below the lake ``root``; a path that names its own scheme is left alone."""
    return path if "://" in path else f"{root.rstrip('/')}/{path.lstrip('/')}"


def read_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read by suffix: ``.csv`` or ``.parquet``."""
    if _suffix(path) == ".csv":
        return read_csv(spark, path, **options)
    return spark.read.options(**options).parquet(path)


def write_table(df: DataFrame, path: str, **options) -> None:
    """Replace by suffix: ``.csv`` or ``.parquet``."""
    if _suffix(path) == ".csv":
        write_csv(df, path, **options)
    else:
        df.write.mode("overwrite").options(**options).parquet(path)


def load(spark: SparkSession, source: str | DataFrame, **options) -> DataFrame:
    """A CSV path or a frame that exists already; anything else raises ``TypeError``."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str):
        return read_csv(spark, source, **options)
    raise TypeError(f"cannot load data from {type(source).__name__}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; an absent one becomes a typed null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path."""
    fs, target = _hadoop(spark, path)
    return fs.getContentSummary(target).getLength()


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _hadoop(spark, source)
    _, dst = _hadoop(spark, target)
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or ``None`` if there is none.

    Only a missing path means "no table"; any other failure is raised, so that a
    broken read can never lead to a table being overwritten. A replacement that
    was cut off between its two renames is rolled back first.
    """
    if not path_exists(spark, path):
        if not path_exists(spark, f"{path}__previous"):
            return None
        _rename(spark, f"{path}__previous", path)
    return spark.read.parquet(path)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path``, which ``df`` itself may read.

    The result is written beside the table and swapped in by renaming, so a
    failed write leaves the old table as it was.
    """
    spark = df.sparkSession
    staging, previous = f"{path}__staging", f"{path}__previous"
    df.write.mode("overwrite").parquet(staging)
    if path_exists(spark, path):
        if path_exists(spark, previous):
            remove(spark, previous)
        _rename(spark, path, previous)
    else:
        parent = _hadoop(spark, path)[1].getParent().toString()
        _hadoop(spark, parent)[0].mkdirs(_hadoop(spark, parent)[1])
    _rename(spark, staging, path)
    if path_exists(spark, previous):
        remove(spark, previous)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)

"""Small helpers that the operators share: names, batches, intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from listrata.sources.workspace import materialize, new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Cuts the plan and survives the loss of executors.
    """
    return materialize(df, new_folder(df.sparkSession, f"llm-{label}"))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def table(df: DataFrame, **types: str) -> DataFrame:
    """The named columns alone, cast; columns that clash or are not needed go."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()))


def map_batches(
    df: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: str | T.StructType
) -> DataFrame:
    """Apply ``function`` (columns as lists in, columns as lists out) to runs of rows, within each partition."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                out = function({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most_bytes``, so that what a row grows to stays bounded."""
    rows = batch.num_rows
    if rows:
        step = max(1, min(rows, int(rows * most_bytes / max(batch.nbytes, 1))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)

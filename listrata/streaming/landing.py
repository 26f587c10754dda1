"""Landing newly arrived CSV files, each exactly once.

The daily job takes whatever lies in the incoming folder and puts it aside as processed. Here the
checkpoint of a file stream remembers what was processed; the stream ends when it has caught up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listrata.sources import records
from listrata.sources.files import NA_TEXTS, ROW_ORDER, files_of_rows
from listrata.sources.landing import land, read_landed
from listrata.sources.workspace import materialize, new_folder


def _named(column: str) -> Column:
    """The value that stands where the header names ``column``; missing-value words are null."""
    at = F.array_position("heads.header", F.lit(column)).cast("int")
    lacking = F.raise_error(F.concat(F.lit(f"no column {column} in "), F.col("heads.file")))
    value = F.when(at > 0, F.get("rows.values", at - 1)).otherwise(lacking)
    return F.when(~value.isin(list(NA_TEXTS)), value).alias(column)


def land_new_files(
    spark: SparkSession, incoming: str, bronze: str, checkpoint: str, columns: list[str], run: str, *,
    escape: str | None = '"', after: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Land the files that arrived since the last call, as partitions ``<run>-<batch>`` of ``bronze``.

    ``columns`` names columns that every file has; each file's own header, which is read first, says how many
    there are and in which order. Columns that are not named are left out. A file whose header lacks one
    fails the batch. A batch that is repeated after a failure replaces its
    own partition. ``after`` gets the landed rows and the partition's name.
    """
    arriving = spark.readStream.option("lineSep", "\n").text(incoming).select("value", *files_of_rows())

    def put(batch: DataFrame, number: int) -> None:
        name = f"{run}-{number}"
        found = records.records(batch, escape or records.style(batch), escape is not None)
        heads = materialize(found.where("first").drop("first"), new_folder(spark, "headers"))
        wide = heads.agg(F.max(F.size(F.split("record", ",")))).first()[0] or 1  # no header has more columns

        def parsed() -> Column:
            return records.values(F.regexp_replace("record", "^\ufeff", ""), F.col("backslash"), wide)

        heads = heads.select("file", parsed().alias("header"))
        rows = found.where("NOT first").select(parsed().alias("values"), records.place().alias(ROW_ORDER))
        named = rows.alias("rows").join(heads.alias("heads"), F.expr(f"rows.{ROW_ORDER}.file = heads.file"))
        landed = named.select(*[_named(c) for c in columns], F.col(f"rows.{ROW_ORDER}").alias(ROW_ORDER))
        land(landed, bronze, name)
        if after is not None:
            after(read_landed(batch.sparkSession, bronze, name), name)

    query = (
        arriving.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

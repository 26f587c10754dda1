"""Union by name and merging a batch into a table by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listrata.sources import versioned
from listrata.sources.files import ROW_ORDER, read_if_exists, replace_table

BY_ID = "by_id"
BY_ID_AND_MODIFICATION = "by_id_and_modification"
STRATEGIES = (BY_ID, BY_ID_AND_MODIFICATION)

# Keys of a batch are sent to every executor only when counted and measured below these bounds.
BROADCAST_KEYS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_BATCH = "_batch"


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _as_list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def check(
    existing: DataFrame | None, new: DataFrame, strategy: str, id_columns: str | Sequence[str],
    modification_column: str | None = None,
) -> list[str]:
    """Raise ``ValueError`` unless both frames have the key (and modification) columns."""
    ids = _as_list(id_columns)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy {strategy!r} is not one of {STRATEGIES}")
    needed = list(ids)
    if strategy == BY_ID_AND_MODIFICATION:
        if not modification_column:
            raise ValueError("this strategy needs a modification column")
        needed.append(modification_column)
    for label, frame in (("existing", existing), ("new", new)):
        lacking = [c for c in needed if frame is not None and c not in frame.columns]
        if lacking:
            raise ValueError(f"the {label} frame lacks {lacking}")
    return ids


def _keep_one(df: DataFrame, ids: list[str], modification: str | None, order_column: str | None) -> DataFrame:
    """One row per key: newest modification, then newest batch, then last in order.

    Null keys are equal. Spark drops the losers of a key on the map side before the
    shuffle, so a key that holds a large part of the rows sends one row per task. The last
    sort column, a hash of the row, only makes repeated runs agree.
    """
    sort = [F.col(modification).desc_nulls_last()] if modification else []
    if _BATCH in df.columns:
        sort.append(F.col(_BATCH).desc())
    if order_column and order_column in df.columns:
        sort.append(F.col(order_column).desc_nulls_last())
    hashed = [name for name, kind in df.dtypes if name != _BATCH and "map<" not in kind]
    sort.append(F.xxhash64(*hashed).desc())
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*ids).orderBy(*sort)))
    return ranked.filter("_rank = 1").drop("_rank", _BATCH)


def _without_row_order(df: DataFrame) -> DataFrame:
    return df.drop(ROW_ORDER)


def deduplicate(
    df: DataFrame, id_columns: str | Sequence[str], *, modification_column: str | None = None,
    order_column: str | None = None,
) -> DataFrame:
    """One row per key: the newest modification if given, else the last in order."""
    return _without_row_order(_keep_one(df, _as_list(id_columns), modification_column, order_column))


def upsert(
    existing: DataFrame, new: DataFrame, strategy: str, id_columns: str | Sequence[str],
    modification_column: str | None = None, *, order_column: str | None = None,
) -> DataFrame:
    """Merge ``new`` into ``existing``, one row per key.

    ``by_id``: the new row replaces the old one, the last of the batch wins.
    ``by_id_and_modification``: the newest modification wins, a missing one loses, the new
    batch wins ties. Spark rows have no order, so "last" needs an ``order_column`` in the
    batch, such as the CSV reader's ``_row_order``, which the result does not carry.
    """
    ids = check(existing, new, strategy, id_columns, modification_column)
    modification = modification_column if strategy == BY_ID_AND_MODIFICATION else None
    both = union_by_name(existing.withColumn(_BATCH, F.lit(0)), new.withColumn(_BATCH, F.lit(1)))
    return _without_row_order(_keep_one(both, ids, modification, order_column))


def same_key(left: DataFrame, right: DataFrame, ids: list[str]):
    return reduce(and_, [left[c].eqNullSafe(right[f"_new_{c}"]) for c in ids])


def batch_keys(new: DataFrame, ids: list[str]) -> DataFrame:
    """The batch's keys, marked for broadcast if their measured size is within the bounds."""
    return _measured_keys(new, ids)[0]


def _measured_keys(new: DataFrame, ids: list[str]) -> tuple[DataFrame, bool]:
    """The batch's keys, and whether they are marked for broadcast."""
    keys = new.select(*[F.col(c).alias(f"_new_{c}") for c in ids]).distinct()
    widths = [F.coalesce(F.octet_length(F.col(f"_new_{c}").cast("string")), F.lit(0)) for c in ids]
    measured = keys.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(widths, F.lit(0)).cast("bigint")).alias("b")).first()
    small = measured["n"] <= BROADCAST_KEYS and (measured["b"] or 0) <= BROADCAST_BYTES
    return F.broadcast(keys) if small else keys, small


# Deals out rows for a write.
Deal = Callable[[DataFrame], DataFrame]


def _put_together(untouched: DataFrame, changed: DataFrame, small: bool, deal: Deal | None) -> DataFrame:
    """All rows. Untouched ones stay in the tasks that read them unless a join has shuffled them."""
    if deal is None:
        return union_by_name(untouched, changed)
    return union_by_name(untouched, deal(changed)) if small else deal(union_by_name(untouched, changed))


def upsert_increment(
    existing: DataFrame, new: DataFrame, strategy: str, id_columns: str | Sequence[str],
    modification_column: str | None = None, *, order_column: str | None = None, deal: Deal | None = None,
) -> DataFrame:
    """Merge a batch: rows whose key is not in it stay exactly as they are, the others are merged.

    For an ``existing`` table with unique keys this is the result of :func:`upsert`. The batch's keys are
    measured (one job over the batch, so give it materialised). If they are few they are broadcast and
    untouched rows are not shuffled; otherwise the same joins shuffle both sides. The result is the same.
    ``deal`` is applied to the rows that are shuffled anyway.
    """
    ids = check(existing, new, strategy, id_columns, modification_column)
    keys, small = _measured_keys(new, ids)
    untouched = existing.join(keys, same_key(existing, keys, ids), "left_anti")
    if strategy == BY_ID:
        changed = deduplicate(new, ids, order_column=order_column)
    else:
        touched = existing.join(keys, same_key(existing, keys, ids), "left_semi")
        changed = upsert(touched, new, strategy, ids, modification_column, order_column=order_column)
    return _put_together(untouched, changed, small, deal)


def replace_by_id(
    existing: DataFrame, new: DataFrame, id_columns: str | Sequence[str], *, deal: Deal | None = None,
) -> DataFrame:
    """The result of ``by_id`` if keys are unique in each frame.

    ``new`` is not shuffled, but by ``deal``; ``existing`` is, unless the measured keys of ``new`` are small
    enough to be broadcast.
    """
    ids = check(existing, new, BY_ID, id_columns)
    keys, small = _measured_keys(new, ids)
    return _put_together(existing.join(keys, same_key(existing, keys, ids), "left_anti"), new, small, deal)


def upsert_table(
    spark: SparkSession, new: DataFrame, path: str, strategy: str, id_columns: str | Sequence[str],
    modification_column: str | None = None, *, order_column: str | None = None, unique: bool = False,
    new_unique: bool = False,
) -> DataFrame:
    """Merge a batch into the Parquet table at ``path`` and return the table.

    Without a table the batch, one row per key, becomes the table. ``unique`` states that the
    table's keys are unique, as they are when only this function writes it; a small batch then
    costs no shuffle of the table. ``new_unique`` states the same of the batch, which then is
    not shuffled itself when it replaces by key.
    """
    existing = read_if_exists(spark, path)
    ids = check(existing, new, strategy, id_columns, modification_column)
    if existing is None and new_unique:
        merged = _without_row_order(new)
    elif existing is None:
        modification = modification_column if strategy == BY_ID_AND_MODIFICATION else None
        merged = deduplicate(new, ids, modification_column=modification, order_column=order_column)
    elif unique and new_unique and strategy == BY_ID:
        merged = replace_by_id(existing, _without_row_order(new), ids)
    else:
        merge = upsert_increment if unique else upsert
        merged = merge(existing, new, strategy, ids, modification_column, order_column=order_column)
    return replace_table(merged, path)


def upsert_buckets(
    spark: SparkSession, new: DataFrame, path: str, strategy: str, id_columns: str | Sequence[str],
    modification_column: str | None = None, *, order_column: str | None = None, new_unique: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Merge a batch into the versioned table at ``path`` (see :mod:`listrata.sources.versioned`) and return it.

    Only the buckets that the batch's keys fall into are read and written; with keys that are small enough
    to be broadcast, rows of the table are not shuffled either. Rows of the batch are dealt out by bucket, so a
    merge adds one file to a bucket, not one of each task. Many buckets are merged in rounds, one after another. Give the batch materialised, as several jobs read it. Keys of the table are unique, as only this function writes it; ``new_unique`` states that of the
    batch. The first batch, one row per key, becomes the table; rows of a plain Parquet table that stands at
    ``path`` are taken over. ``buckets`` is the number of buckets of a new table, by default as many as the
    batch calls for.
    """
    ids = _as_list(id_columns)
    modification = modification_column if strategy == BY_ID_AND_MODIFICATION else None

    def merged_into(existing: DataFrame, new: DataFrame = new, deal: Deal | None = None) -> DataFrame:
        check(existing, new, strategy, ids, modification_column)
        if new_unique and strategy == BY_ID:
            return replace_by_id(existing, _without_row_order(new), ids, deal=deal)
        return upsert_increment(existing, new, strategy, ids, modification_column, order_column=order_column, deal=deal)

    at = versioned.version(spark, path)
    if at is None:
        plain = read_if_exists(spark, path)
        check(plain, new, strategy, ids, modification_column)
        if plain is not None:
            first = merged_into(plain)
        elif new_unique:
            first = _without_row_order(new)
        else:
            first = deduplicate(new, ids, modification_column=modification, order_column=order_column)
        if buckets is None and plain is None:
            buckets = versioned.buckets_for(_without_row_order(new))
        return versioned.replace(first, path, ids, buckets)
    if at.keys != tuple(ids):
        raise ValueError(f"{path} has the key {at.keys}, not {tuple(ids)}")
    at, hit = versioned.touched(spark, path, new)
    groups = versioned.rounds(spark, hit)
    merged = [
        merged_into(
            versioned.read(spark, path, at.number, group), versioned.in_round(new, ids, at.buckets, group, len(groups)),
            lambda rows: versioned.dealt(rows, ids, at.buckets),
        )
        for group in groups
    ]
    if versioned.same_types(merged[0].schema, at.schema):
        return versioned.rewrite(merged, path, at, hit)
    return versioned.replace(merged_into(versioned.read(spark, path, at.number)), path, ids)

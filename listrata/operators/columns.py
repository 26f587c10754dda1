"""Projections, filters and derived columns. All are lazy ``DataFrame -> DataFrame`` functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listrata.functions import cleaning, times
from listrata.sources.files import conform

# Names of the array types used in cast maps; the plain lower-case
# whole types take no missing value.
ARRAY_TYPES = {
    "int32": ("int", True), "int64": ("bigint", True), "Int32": ("int", False), "Int64": ("bigint", False),
    "float32": ("float", False), "float64": ("double", False), "float": ("double", False),
    "str": ("string", False), "bool": ("boolean", False),
}


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of ``columns`` that the frame has."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def project(df: DataFrame, columns: Sequence[str] | T.StructType) -> DataFrame:
    """A fixed list of columns; an absent one becomes null, typed when a schema is given."""
    if isinstance(columns, T.StructType):
        return conform(df, columns)
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without these columns; names it does not have are ignored."""
    return df.drop(*columns)


def filter_rows(df: DataFrame, condition: Column | str | Callable[[DataFrame], Column]) -> DataFrame:
    """Rows for which a column, SQL text or function of the frame is true; null drops the row."""
    return df.filter(condition(df) if callable(condition) else condition)


def where_in(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows that match every given column: a list by membership, a scalar by equality, ``None`` always."""
    for name, value in wanted.items():
        if value is None:
            continue
        many = isinstance(value, (list, tuple, set, frozenset))
        df = df.filter(F.col(name).isin(list(value)) if many else F.col(name) == value)
    return df


def where_in_any_case(df: DataFrame, **wanted: object) -> DataFrame:
    """Like :func:`where_in` for text, regardless of capitals on either side."""
    for name, value in wanted.items():
        if value is None:
            continue
        values = [value] if isinstance(value, str) else list(value)
        df = df.filter(F.upper(name).isin([v.upper() for v in values]))
    return df


def where_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose columns are neither null nor NaN."""
    for c in columns:
        df = df.filter(cleaning.is_present(F.col(c), df.schema[c].dataType))
    return df


def add_column(df: DataFrame, name: str, value: Column | str | Callable[[DataFrame], Column]) -> DataFrame:
    """Add or replace a column given as a column, SQL text or function of the frame."""
    if callable(value):
        value = value(df)
    return df.withColumn(name, F.expr(value) if isinstance(value, str) else value)


def apply(df: DataFrame, func: Callable[..., DataFrame], **options) -> DataFrame:
    """Run a function of the whole frame."""
    return df.transform(func, **options)


def stamp(df: DataFrame, moment: datetime) -> DataFrame:
    """Put the run's moment in front, as a literal so that repeated tasks agree."""
    return df.select(F.lit(moment).cast("timestamp").alias("process_timestamp"), "*")


def _replace(df: DataFrame, columns: Iterable[str], rule: Callable[[Column, T.DataType], Column]) -> DataFrame:
    names = present(df, columns)
    return df.withColumns({c: rule(F.col(c), df.schema[c].dataType) for c in names}) if names else df


def fill_missing(df: DataFrame, columns: Iterable[str], fill: object = None) -> DataFrame:
    """Null and NaN as ``fill``, in the column's own type; ``None`` fills nothing."""
    if fill is None:
        return df
    return _replace(df, columns, lambda c, t: cleaning.fill_missing(c, t, fill))


def to_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text as numbers, null where it is none."""
    return _replace(df, columns, cleaning.number_or_null)


def to_id_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _replace(df, columns, cleaning.id_text)


def raw_ids(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _replace(df, columns, lambda c, _: cleaning.raw_id(c))


def to_flags(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _replace(df, columns, cleaning.flag_number)


def to_flag_texts(
    df: DataFrame, columns: Iterable[str], true_text: str, false_text: str, null_text: str = "",
) -> DataFrame:
    return _replace(df, columns, lambda c, t: cleaning.flag_text(c, t, true_text, false_text, null_text))


def cast_columns(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Strict casts by column: bad text raises, and so does a missing column.

    Types are Spark names or array type names; ``int64`` and ``int32`` raise on missing values.
    """
    absent = sorted(set(targets) - set(df.columns))
    if absent:
        raise KeyError(f"no such columns: {absent}")
    casts = {}
    for name, target in targets.items():
        spark_type, required = ARRAY_TYPES.get(target, (target, False))
        casts[name] = cleaning.strict_cast(F.col(name), df.schema[name].dataType, spark_type, required=required)
    return df.withColumns(casts) if casts else df


def to_timestamps(df: DataFrame, columns: Iterable[str], **how) -> DataFrame:
    """Parse columns as timestamps; see :func:`listrata.functions.times.parse_time`."""
    parsed = {c: times.parse_time(F.col(c), **how) for c in columns}
    return df.withColumns(parsed) if parsed else df

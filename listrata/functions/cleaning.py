"""Column expressions that clean single values. ``data_type`` is the type of the column given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Texts that stand for the two truth values.
TRUE_TEXTS = ("True", "true", "TRUE")
FALSE_TEXTS = ("False", "false", "FALSE")

# A decimal number, blanks allowed around it; no type suffix, thousands sign or hexadecimal.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def missing_as_null(col: Column, data_type: T.DataType) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(col), col) if isinstance(data_type, FLOATING) else col


def is_present(col: Column, data_type: T.DataType) -> Column:
    """Neither null nor NaN."""
    return col.isNotNull() & ~F.isnan(col) if isinstance(data_type, FLOATING) else col.isNotNull()


def fill_missing(col: Column, data_type: T.DataType, fill: object) -> Column:
    return F.coalesce(missing_as_null(col, data_type), F.lit(fill).cast(data_type))


def number_or_null(col: Column, data_type: T.DataType) -> Column:
    """Text that is a number as a double, other text as null; numbers stay as they are."""
    if isinstance(data_type, T.StringType):
        return F.when(col.rlike(NUMBER), col.try_cast("double"))
    return missing_as_null(col, data_type)


def id_text(col: Column, data_type: T.DataType) -> Column:
    """An identifier as text: floats lose decimals and exponent, text stays untouched."""
    if isinstance(data_type, FLOATING):
        whole = F.bround(missing_as_null(col, data_type).cast("double"), 0)
        return whole.try_cast("decimal(38,0)").cast("string")
    return col.cast("string")


def raw_id(col: Column) -> Column:
    """Raw text of an identifier; a number written as a float (``123.0``) becomes its digits."""
    return F.regexp_replace(col, r"^([+-]?\d+)\.0*$", "$1")


def _or_raise(result: Column, value: Column, complaint: str) -> Column:
    """The result of a lenient cast, raising where it lost a value; the same with and without ANSI mode."""
    message = F.concat(F.lit(f"{complaint}: "), value.cast("string"))
    return F.coalesce(result, F.when(value.isNotNull(), F.raise_error(message)))


def strict_cast(col: Column, data_type: T.DataType, target: str, *, required: bool = False) -> Column:
    """Cast that raises on text which is no number; fractions are cut off for whole targets.

    ``required`` raises on a missing value as well.
    """
    whole = target in ("tinyint", "smallint", "int", "bigint")
    present = missing_as_null(col, data_type)
    number = present.try_cast("decimal(38,10)") if whole and isinstance(data_type, T.StringType) else present
    result = _or_raise(number.try_cast(target), present, f"not of type {target}")
    return F.coalesce(result, F.raise_error(F.lit("missing value in a required number"))) if required else result


def flag_number(col: Column, data_type: T.DataType) -> Column:
    """Truth value, or text of one, as 1 or 0; missing is 0; numbers stay; other text raises."""
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(col, F.lit(False)).cast("int")
    if isinstance(data_type, T.StringType):
        number = F.when(col.isin(*TRUE_TEXTS), "1").when(col.isin(*FALSE_TEXTS), "0").otherwise(col)
        filled = F.coalesce(number, F.lit("0"))
        return _or_raise(filled.try_cast("decimal(38,10)").try_cast("int"), filled, "neither truth value nor number")
    filled = fill_missing(col, data_type, 0)
    return _or_raise(filled.try_cast("int"), filled, "too large for a flag")


def flag_text(
    col: Column, data_type: T.DataType, true_text: str, false_text: str, null_text: str = "",
) -> Column:
    """Truth value, or text of one, as a label; missing is ``null_text``; others are kept as text."""
    if isinstance(data_type, T.BooleanType):
        label = F.when(col, true_text).when(~col, false_text)
    else:
        text = missing_as_null(col, data_type).cast("string")
        label = F.when(text.isin(*TRUE_TEXTS), true_text).when(text.isin(*FALSE_TEXTS), false_text).otherwise(text)
    return F.coalesce(label, F.lit(null_text))

"""Helpers that build `Column` expressions from names and types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Back-quote a column name, so that dots and spaces in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Top-level column of exactly this name."""
    return F.col(quoted(name))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the top-level numeric columns, in schema order."""
    left_out = set(exclude)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in left_out
    ]


# Columns unpivoted together. Whole-stage codegen stops at 100 fields, so wide
# tables are unpivoted in groups; each column is still read from the files once.
_COLUMNS_TOGETHER = 64


def unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (number, value): each of the columns' values, as doubles, by column number.

    Statistics of many columns grouped by `number` have a plan of fixed size,
    where one aggregate expression per column would outgrow compiled code.
    """
    groups = []
    for start in range(0, len(columns), _COLUMNS_TOGETHER):
        names = columns[start : start + _COLUMNS_TOGETHER]
        values = F.array(*[column(name).cast("double") for name in names])
        rows = df.select(F.posexplode(values).alias("number", "value"))
        groups.append(rows.withColumn("number", F.col("number") + start) if start else rows)
    return reduce(DataFrame.unionAll, groups)


def plain_number(value: Column) -> Column:
    """Text of a float in plain decimal notation, also where a cast gives 1.0E7.

    A cast is plain by itself between 0.001 and 10 million. A good way beyond,
    the shortest digits (17 at most) fit a decimal, whose zeros are cut off; only
    what is left is put together from its digits, by a function of the text, so
    that the compiled code of many columns stays small.
    """
    text = value.cast("string")
    size = F.abs(value)
    large, small = (
        F.regexp_replace(text.try_cast(f"decimal(38,{scale})").cast("string"), "(?<!\\.)0+$", "")
        for scale in (12, 24)
    )
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0), text)
        .when((size >= 1e7) & (size < 1e19), large)
        .when((size >= 1e-6) & (size < 1e-3), small)
        .otherwise(F.get(F.transform(F.array(text), _from_digits), F.lit(0)))
    )


def _from_digits(text: Column) -> Column:
    """Plain form of a number's text, with an exponent or without."""
    parts = F.split(text, "E")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(parts[0], "[-.]", ""), "(?<=.)0+$", "")
    power = F.try_element_at(parts, F.lit(2)).cast("int")
    # The mantissa has one digit before its point.
    behind = F.length(digits) - 1 - power  # digits behind the point
    large = F.when(
        behind > 0, F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.right(digits, behind))
    ).otherwise(F.concat(digits, F.repeat(F.lit("0"), -behind), F.lit(".0")))
    tiny = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    plain = F.concat(sign, F.when(power < 0, tiny).otherwise(large))
    return F.when(power.isNull(), text).otherwise(plain)


def as_text(field: T.StructField) -> Column:
    """Text form of a column: null is '', floats are plain decimals, nested values JSON."""
    value = column(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(value)
    elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        value = plain_number(value)
    return F.coalesce(value.cast("string"), F.lit("")).alias(field.name)


def row_rank(columns: Sequence[str], seed: int) -> Column:
    """Pseudo-random rank of a row in [0, 1), a function of its values only.

    Equal rows get equal ranks, whatever file or partition they are in. The
    null flags are hashed too, because `xxhash64` skips nulls and (null, 1)
    would otherwise meet (1, null). 53 bits fit a double exactly.
    """
    values = [column(name) for name in columns]
    flags = [value.isNull() for value in values]
    bits = F.xxhash64(F.lit(seed).cast("long"), *flags, *values)
    return F.shiftrightunsigned(bits, 11) / F.lit(float(2**53))


def md5_rank(columns: Sequence[str], seed: int, null_marker: str = "~") -> Column:
    """Rank like `row_rank` that other SQL engines can compute as well.

    Slower (text and md5 instead of one 64-bit hash): use it where a sample
    has to be reproduced outside Spark. 0.0 and -0.0 rank alike, as they are
    equal to a distinct. 52 bits are taken from the md5.
    """
    texts = [F.coalesce(_unsigned_zero(name), F.lit(null_marker)) for name in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _unsigned_zero(name: str) -> Column:
    """Text of a column's values, in which a float's -0.0 is 0.0."""
    text = column(name).cast("string")
    is_float = F.typeof(column(name)).isin("float", "double")
    return F.when(is_float & (text == "-0.0"), F.lit("0.0")).otherwise(text)

"""Canonical JSON and content hashes: sorted keys, no white space, nulls left out of objects, UTF-8 as it is.

The text is what Python's json.dumps(sort_keys=True, separators=(",", ":"), ensure_ascii=False) writes, down to the
case of escapes and the form of floats, so hashes that Python has stored stay valid.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(column: Column) -> Column:
    """A UTC timestamp as ISO text with Z, with microseconds only if there are any."""
    whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(column, "SSSSSS")
    return F.when(micros == "000000", F.concat(whole, F.lit("Z"))).otherwise(F.concat(whole, F.lit("."), micros, F.lit("Z")))


def normalize_float(column: Column, places: int = 6) -> Column:
    """Rounds as Python's round() does, by the double's exact value; to be called before hashing, which doesn't round.

    The product with 10 ** places is taken in two parts, the rounded one and its exact error (Dekker), so ties are told
    from near ties. Values too large to have that many places are left to Spark.
    """
    scale, half = float(10**places), 134217729.0
    x = F.abs(column.cast("double"))
    whole = x * scale
    high = x * half - (x * half - x)
    low = x - high
    scale_high = scale * half - (scale * half - scale)
    scale_low = scale - scale_high
    error = ((high * scale_high - whole) + high * scale_low + low * scale_high) + low * scale_low
    floor = F.floor(whole).cast("double")
    rest = whole - floor
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (floor % 2 == 1))))
    rounded = F.when(up, floor + 1).otherwise(floor) / scale
    return F.when(whole < 2.0**52, F.when(column < 0, -rounded).otherwise(rounded)).otherwise(F.bround(column, places))


def python_float(column: Column) -> Column:
    """A double as Python's repr writes it: the shortest digits, an exponent from 1e+16 on and below 1e-04.

    The JVM's own text isn't always the shortest, so the first number of digits is taken that reads back the same.
    """

    def shortest(*digits: int) -> Column:
        tries = [F.format_string(f"%.{n - 1}e", column) for n in digits]
        return F.coalesce(*(F.when(t.try_cast("double") == column, t) for t in tries))

    text = F.when(F.abs(column) < 2.3e-308, shortest(*range(1, 18))).otherwise(shortest(15, 16, 17))
    digits, power = F.split_part(text, F.lit("e"), F.lit(1)), F.split_part(text, F.lit("e"), F.lit(2)).try_cast("int")
    plain = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
    short = F.concat(F.regexp_replace(digits, r"\.?0*$", ""), F.regexp_extract(text, "e.*$", 0))
    named = F.when(F.isnan(column), "NaN").when(column == float("inf"), "Infinity").when(column == float("-inf"), "-Infinity")
    zero = F.when(column == 0, F.when(column.cast("string").startswith("-"), "-0.0").otherwise("0.0"))
    return F.coalesce(named, zero, F.when((power >= -4) & (power < 16), plain).otherwise(short))


#: Control characters whose escapes have a letter; Spark writes it in upper case, Python in lower.
_LETTERED = [f"{c:02X}" for c in (0x0B, 0x0E, 0x0F, 0x1A, 0x1B, 0x1C, 0x1D, 0x1E, 0x1F)]


def _lower_escapes(written: Column) -> Column:
    """Only real escapes are touched: those behind an even number of backslashes."""
    out = written
    for code in _LETTERED:
        out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")
    return F.when(written.rlike(r"\\u00[01][A-F]"), out).otherwise(written)


def _settled(type_: T.DataType) -> bool:
    """Whether Spark's writer gives the canonical form of such values as they are: keys in order and no times."""
    if isinstance(type_, T.StructType):
        names = [f.name for f in type_.fields]
        return names == sorted(names) and all(_settled(f.dataType) for f in type_.fields)
    return _settled(type_.elementType) if isinstance(type_, T.ArrayType) else not isinstance(type_, T.TimestampType | T.TimestampNTZType)


def _sorted(column: Column, type_: T.DataType) -> Column:
    if _settled(type_):
        return column
    if isinstance(type_, T.StructType):
        fields = [_sorted(column.getField(f.name), f.dataType).alias(f.name) for f in sorted(type_.fields, key=lambda f: f.name)]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(type_, T.ArrayType):
        return F.transform(column, lambda x: _sorted(x, type_.elementType))
    if isinstance(type_, T.TimestampType | T.TimestampNTZType):
        return instant(column)
    return column


def _has_float(type_: T.DataType) -> bool:
    if isinstance(type_, T.StructType):
        return any(_has_float(f.dataType) for f in type_.fields)
    return _has_float(type_.elementType) if isinstance(type_, T.ArrayType) else isinstance(type_, T.FloatType | T.DoubleType)


def _written(column: Column, type_: T.DataType) -> Column:
    """A value as JSON text, put together piece by piece; null if the value is."""
    if isinstance(type_, T.StructType):
        fields = sorted(type_.fields, key=lambda f: f.name)
        members = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), _written(column.getField(f.name), f.dataType)) for f in fields]
        return F.when(column.isNotNull(), F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}")))
    if isinstance(type_, T.ArrayType):
        each = F.transform(column, lambda x: F.coalesce(_written(x, type_.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))
    if isinstance(type_, T.FloatType | T.DoubleType):
        return python_float(column.cast("double"))
    one = F.to_json(F.array(_sorted(column, type_)))
    return F.when(column.isNotNull(), F.substring(one, F.lit(2), F.length(one) - 2))


def canonical_json(df: DataFrame, columns: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> Column:
    """The rows' canonical JSON over ``columns`` (all by default) without ``exclude``; the rest stays in the row.

    Spark's own writer is used unless there are floats, whose form it can't be told.
    """
    names = sorted(set(columns or df.columns) - set(exclude))
    row = F.struct(*(F.col(c) for c in names))
    kind = T.StructType([df.schema[c] for c in names])
    return _lower_escapes(_written(row, kind) if _has_float(kind) else F.to_json(_sorted(row, kind)))


def content_hash(df: DataFrame, columns: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> Column:
    return F.sha2(canonical_json(df, columns, exclude), 256)

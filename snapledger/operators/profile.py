"""Profiles of a table: null rates, distributions, cadence, gaps, coverage, array shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent, weekday


def null_rates(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """One row with a per cent of nulls for each column, from one pass."""
    return df.agg(F.count("*").alias("rows"), *(percent(F.count_if(F.col(c).isNull()), F.count("*"), digits).alias(f"{c}_null_pct") for c in columns))


def kinds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls, blanks, rows): null and empty counts unpivoted, from one pass."""
    one = df.agg(F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns), *(F.count_if(F.col(c).cast("string") == "").alias(f"b_{c}") for c in columns))
    stack = ", ".join(f"'{c}', n_{c}, b_{c}" for c in columns)
    return one.select("rows", F.expr(f"stack({len(columns)}, {stack}) AS (column, nulls, blanks)"))


def distribution(df: DataFrame, *by: Column | str) -> DataFrame:
    """Counts by value with each value's per cent of all rows; the total is a scalar of its own, so values needn't meet in one task."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), counts.agg(F.sum("n")).scalar()))


def top_values(df: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; equal ones in order."""
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(by)).limit(n)


def cadence(df: DataFrame, at: str, unit: str, *extra: Column) -> DataFrame:
    """(period, n, ...) by month, week (from Monday) or day."""
    return df.groupBy(F.date_trunc(unit, at).cast("date").alias("period")).agg(F.count("*").alias("n"), *extra)


def extent(df: DataFrame, at: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"), F.countDistinct(F.to_date(at)).alias("days"))


def spikes(df: DataFrame, at: str, n: int) -> DataFrame:
    """The ``n`` days with most rows."""
    return cadence(df, at, "day").orderBy(F.desc("n"), "period").limit(n)


def gaps(df: DataFrame, at: str, weekdays_only: bool = True) -> DataFrame:
    """Days between the first and the last without rows. The calendar is made from two numbers, not from the rows."""
    days = df.select(F.to_date(at).alias("day")).distinct()
    series = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("day"))
    if weekdays_only:
        series = series.where(~weekday(F.col("day")).isin(0, 6))
    return series.join(days, "day", "left_anti").select("day", F.date_format("day", "EEEE").alias("weekday"))


def coverage(left: DataFrame, key: Column, right: DataFrame, right_key: Column) -> DataFrame:
    """One row: how many rows of ``left`` find a partner; keys on the right are made distinct first."""
    partners = right.select(right_key.alias("_key")).where("_key IS NOT NULL").distinct().withColumn("_hit", F.lit(True))
    rows = left.select(key.alias("_key")).join(partners, "_key", "left")
    return rows.agg(F.count("*").alias("rows"), F.count("_hit").alias("matched"), percent(F.count("_hit"), F.count("*")).alias("pct"))


def unmatched(left: DataFrame, key: Column, right: DataFrame, right_key: Column) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key.alias("key")).where("key IS NOT NULL").distinct().join(right.select(right_key.alias("key")).distinct(), "key", "left_anti")


def array_shape(df: DataFrame, column: str) -> DataFrame:
    """One row: nulls, empty ones, shortest, longest and mean length."""
    size = F.size(column)
    some = F.when(F.col(column).isNotNull(), size)
    return df.agg(F.count_if(F.col(column).isNull()).alias("nulls"), F.count_if(some == 0).alias("empty"), F.min(some).alias("shortest"), F.max(some).alias("longest"), F.round(F.avg(some), 4).alias("mean"))


def histogram_of_counts(df: DataFrame, *keys: str) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).groupBy("rows").agg(F.count("*").alias("keys"))


def cross_tab(df: DataFrame, *by: Column | str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def kind_of(column: Column) -> Column:
    return F.when(column.isNull(), "null").when(column.cast("string") == "", "empty_string").otherwise("value")

"""Data contracts: each check gives the rows that break it, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """(column, n) of values that occur more than once; nulls don't count."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """(column, n) of other values; null passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set and has no parent."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_key")).distinct(), F.col(column) == F.col("_key"), "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows without a parent, those with a null key included."""
    return child.join(parent.select(F.col(key).alias("_key")).distinct(), F.col(column) == F.col("_key"), "left_anti")


def freshness(df: DataFrame, column: str, as_of: str, warn_hours: float, error_hours: float) -> DataFrame:
    """One row: latest, hours and status (pass, warn, error; error if there are no rows)."""
    latest = F.max(F.col(column).cast("timestamp"))
    hours = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("latest")) / 3600.0
    out = df.agg(latest.alias("latest")).withColumn("hours", F.round(hours, 2))
    status = F.when(F.col("hours").isNull() | (F.col("hours") > error_hours), "error").when(F.col("hours") > warn_hours, "warn").otherwise("pass")
    return out.withColumn("status", status)


def row_floor(df: DataFrame, least: int) -> DataFrame:
    """A row (n, least) if the table has fewer rows."""
    return df.agg(F.count("*").alias("n")).withColumn("least", F.lit(least).cast("long")).where("n < least")


def baseline_drift(counts: DataFrame, day: str, n: str, share: float = 0.5, days: int = 7) -> DataFrame:
    """Days whose count is off the mean of the ``days`` before by more than ``share``; one row a day is few."""
    from pyspark.sql import Window

    w = Window.orderBy(day).rowsBetween(-days, -1)
    return counts.withColumn("baseline", F.avg(n).over(w)).where(F.abs(F.col(n) - F.col("baseline")) > share * F.col("baseline"))

"""Checks on typed rows: ids that aren't blank, dates that can be, and Spanish records with an English sibling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.spec import SourceSpec

MOST_DAYS = 70 * 365


def blank(text: Column) -> Column:
    """Null, empty or nothing but white space of any kind."""
    return F.coalesce(~text.rlike(r"(?U)\S"), F.lit(True))


def odd_date(date: Column, as_of: Column) -> Column:
    """After ``as_of`` or more than 25,550 days before it; null is fine."""
    return F.coalesce((date > as_of) | (date < as_of - F.expr(f"INTERVAL {MOST_DAYS} DAYS")), F.lit(False))


def marked(valid: DataFrame, spec: SourceSpec, as_of: str) -> DataFrame:
    """``valid`` with a column ``_why``: what a row is rejected for, null if it passes.

    The sibling rule looks only at rows that passed the others, in this batch. Siblings are found by one join on the
    number, with the English numbers made distinct first.
    """
    now = F.lit(as_of).cast("timestamp")
    errors = [F.when(blank(F.col("source_recall_id")), "blank id"), *(F.when(odd_date(F.col(c), now), f"{c} out of range") for c in spec.sane_dates)]
    rows = valid.withColumn("_errors", F.array_compact(F.array(*errors)))
    odd = F.when(F.size("_errors") > 0, F.array_join("_errors", "; "))
    if not spec.siblings:
        return rows.select(*valid.columns, odd.alias("_why"))
    english = rows.where((F.size("_errors") == 0) & (F.col("langcode") == "English")).select("source_recall_id").distinct().withColumn("_english", F.lit(True))
    alone = (F.col("langcode") == "Spanish") & F.col("_english").isNull()
    return rows.join(english, "source_recall_id", "left").select(*valid.columns, F.coalesce(odd, F.when(alone, "no English sibling in the batch")).alias("_why"))


def check(valid: DataFrame, spec: SourceSpec, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rejected)."""
    rows = marked(valid, spec, as_of)
    rejected = rows.where("_why IS NOT NULL").select("source_recall_id", F.col("raw").alias("raw_record"), F.col("_why").alias("failure_reason"), F.lit("invariants").alias("failure_stage"), "raw_landing_path")
    return rows.where("_why IS NULL").drop("_why"), rejected

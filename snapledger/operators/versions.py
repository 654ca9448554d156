"""Insert-only versions: latest ones, what a batch adds, and what changed between versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """One row for each key: the last by ``order``; name enough columns to break ties. Nulls count as smallest.

    Spark keeps one row a key before the shuffle (WindowGroupLimit), so hot keys are cheap.
    """
    return _one(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return _one(df, keys, [F.col(c).asc_nulls_last() for c in order])


def top_by(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each key."""
    return _one(df, keys, order, n)


def latest_hash(stored: DataFrame, keys: Sequence[str], hash_col: str = "content_hash", at: str = "extraction_timestamp") -> DataFrame:
    """(keys, _latest): the hash of each key's newest version, in one aggregation; equal times by the larger hash."""
    return stored.groupBy(*keys).agg(F.max_by(hash_col, F.struct(at, hash_col)).alias("_latest"))


def new_versions(batch: DataFrame, stored: DataFrame, keys: Sequence[str], hash_col: str = "content_hash", at: str = "extraction_timestamp") -> DataFrame:
    """The rows of ``batch`` whose hash isn't the latest one stored for their key.

    So a value that comes back after another is a version again, and rows that repeat within the batch
    are all kept. Only the batch's keys are aggregated.
    """
    seen = stored.join(batch.select(*keys).distinct(), list(keys), "left_semi")
    return batch.join(latest_hash(seen, keys, hash_col, at), list(keys), "left").where(~F.col("_latest").eqNullSafe(F.col(hash_col))).drop("_latest")


def paired(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys with both versions side by side as structs ``old`` and ``new``."""
    return old.select(*keys, F.struct(*columns).alias("old")).join(new.select(*keys, F.struct(*columns).alias("new")), list(keys))


def column_diffs(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row: ``pairs`` and for each column how many pairs differ in it, null-safely, in one pass."""
    differs = [F.coalesce(F.sum((~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))).cast("long")), F.lit(0)).alias(f"{c}_diffs") for c in columns]
    return paired(old, new, keys, columns).agg(F.count("*").alias("pairs"), *differs)


def phantom_versions(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str], hash_col: str = "content_hash") -> DataFrame:
    """Pairs whose hashes differ although all ``columns`` are equal."""
    rows = paired(old, new, keys, [*columns, hash_col]).where(~F.col(f"old.{hash_col}").eqNullSafe(F.col(f"new.{hash_col}")))
    for c in columns:
        rows = rows.where(F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")))
    return rows


def wave(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys of ``after`` that were there before (re_versioned), that weren't (brand_new), and total."""
    old = before.select(*keys).distinct().withColumn("_old", F.lit(True))
    rows = after.select(*keys).distinct().join(old, list(keys), "left")
    return rows.agg(F.count("_old").alias("re_versioned"), F.count_if(F.col("_old").isNull()).alias("brand_new"), F.count("*").alias("total"))


def multi_version(df: DataFrame, keys: Sequence[str], hash_col: str, least: int = 2) -> DataFrame:
    """Keys with at least ``least`` different hashes."""
    return df.groupBy(*keys).agg(F.countDistinct(hash_col).alias("versions"), F.count("*").alias("rows")).where(F.col("versions") >= least)


def transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Beside each row its columns' previous values (``prev_``) and ``_change``: first_run, unchanged or changed.

    All lags share one window.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns} | {"_n": F.row_number().over(w)})
    verdicts = {f"{c}_change": F.when(F.col("_n") == 1, "first_run").when(F.col(c).eqNullSafe(F.col(f"prev_{c}")), "unchanged").otherwise("changed") for c in columns}
    return out.withColumns(verdicts).drop("_n")


def history(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], change_type: str | None = None) -> DataFrame:
    """(keys, order, field, old_value, new_value): a row for each field that changed from one version to the next.

    ``change_type`` names the column that tells what kind of run stored a version. Versions of runs other than routine
    ones are no edits by the publisher, so what changed in them isn't told; the next one is still compared with them.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("new_value")) for c in columns)))
    routine = F.col(change_type) == "routine" if change_type else F.lit(True)
    long = df.select(*keys, *order, routine.alias("_routine"), pairs.alias("x")).select(*keys, *order, "_routine", "x.*")
    w = Window.partitionBy(*keys, "field").orderBy(*order)
    out = long.withColumns({"old_value": F.lag("new_value").over(w), "_n": F.row_number().over(w)})
    changed = (F.col("_n") > 1) & ~F.col("old_value").eqNullSafe(F.col("new_value")) & F.coalesce("_routine", F.lit(False))
    return out.where(changed).select(*keys, *order, "field", "old_value", "new_value")


def presence(batch: DataFrame, run_id: str, source: str, keys: Sequence[str]) -> DataFrame:
    """The manifest of which identities a run has seen."""
    return batch.select(F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), *keys).distinct()


def lifecycle(seen: DataFrame, keys: Sequence[str], run: str, stored: DataFrame | None = None, hash_col: str = "content_hash") -> DataFrame:
    """Of each identity: first_seen, last_seen, runs_seen, is_currently_active, was_ever_retracted, and edit_count.

    ``run`` orders the runs. Runs get ordinals from their distinct values, a small table. An identity that was absent
    between two runs that saw it was retracted; one that the last run saw is active. ``edit_count`` is the number of
    different hashes that ``stored`` has of the identity (0 without any); without ``stored`` there is no such column.
    """
    runs = seen.select(run).distinct().withColumn("_ord", F.row_number().over(Window.orderBy(run)))
    last = runs.agg(F.max("_ord")).first()[0]
    rows = seen.select(*keys, run).distinct().join(F.broadcast(runs) if (last or 0) < 100_000 else runs, run)
    out = rows.groupBy(*keys).agg(F.min(run).alias("first_seen"), F.max(run).alias("last_seen"), F.count("*").alias("runs_seen"), F.min("_ord").alias("_a"), F.max("_ord").alias("_b"))
    gap = F.col("_b") - F.col("_a") + 1 > F.col("runs_seen")
    out = out.withColumns({"is_currently_active": F.col("_b") == F.lit(last), "was_ever_retracted": gap}).drop("_a", "_b")
    if stored is None:
        return out
    edits = stored.groupBy(*keys).agg(F.countDistinct(hash_col).alias("edit_count"))
    return out.join(edits, list(keys), "left").withColumn("edit_count", F.coalesce("edit_count", F.lit(0)).cast("long"))

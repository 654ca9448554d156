"""One run of a feed: parse, validate, check, append what is new, quarantine the rest, and keep the books."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import content_hash
from ..sources.readers import TransientError
from ..sources.spec import SourceSpec
from ..sources.state import Store
from . import invariants, validate, versions

MOST_REJECTED = 0.05


class IdentityError(ValueError):
    """A row without an identity fails the whole batch."""


class RejectionError(RuntimeError):
    """Too large a share was rejected. What was valid is stored all the same."""


@dataclass(frozen=True)
class IngestResult:
    run_id: str
    fetched: int
    inserted: int
    rejected: int
    status: str

    @property
    def rejection_rate(self) -> float:
        return self.rejected / self.fetched if self.fetched else 0.0


def hashed(rows: DataFrame, spec: SourceSpec, at: str) -> DataFrame:
    """Rows with content_hash (over the spec's columns but the excluded ones) and extraction_timestamp."""
    return rows.withColumns({"content_hash": content_hash(rows, spec.columns, spec.hash_exclude), "extraction_timestamp": F.lit(at).cast("timestamp")})


def without_identity(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    bad = F.lit(False)
    for c in spec.identity:
        bad = bad | F.col(c).isNull() | (F.col(c).cast("string") == "")
    return rows.where(bad)


def ingest(raw: DataFrame, spec: SourceSpec, store: Store, as_of: str, run_id: str | None = None, change_type: str = "routine", keep_cursor: bool = False) -> IngestResult:
    """Appends the new versions of ``raw`` to the feed's bronze table; ``as_of`` is the run's time.

    Order of writes: bronze, rejected, cursor, run log. A run that breaks off is run again: what is stored
    already has its hash and isn't stored twice. Rejections over 5 per cent raise after the writes, with the run
    logged as aborted. ``keep_cursor`` is for re-reads of history, which leave the cursor where it is. The
    cursor is the batch's latest date, even if that is earlier than before, and stays if nothing was valid.
    """
    run_id = run_id or uuid.uuid4().hex
    raw = raw.persist()
    try:
        fetched = raw.limit(spec.most_records + 1).count()
        if fetched > spec.most_records:
            raise TransientError(f"{spec.name}: more than {spec.most_records} records")
        parsed = validate.parsed(raw, spec).persist()
        valid, malformed = validate.split(parsed, spec)
        good, odd = invariants.check(valid, spec, as_of)
        if not without_identity(good, spec).isEmpty():
            raise IdentityError(f"{spec.name}: a record has no identity")
        batch = hashed(good, spec, as_of).drop("raw")
        stored = store.read("bronze", spec.name)
        fresh = versions.new_versions(batch, stored, spec.identity) if stored else batch
        fresh = fresh.persist()
        rejected = malformed.unionByName(odd).withColumns({"rejected_at": F.lit(as_of).cast("timestamp"), "run_id": F.lit(run_id)}).persist()
        inserted, n_rejected = fresh.count(), rejected.count()
        if inserted:
            store.append("bronze", spec.name, fresh)
        if n_rejected:
            store.append("rejected", spec.name, rejected)
        if spec.cursor and not keep_cursor:
            latest = good.agg(F.max(F.to_date(spec.cursor))).first()[0]
            if latest:
                store.put_cursor(spec.name, latest.isoformat(), as_of)
        store.append("presence", spec.name, versions.presence(good, run_id, spec.name, spec.identity))
        result = IngestResult(run_id, fetched, inserted, n_rejected, "success")
        if result.rejection_rate > MOST_REJECTED:
            result = IngestResult(run_id, fetched, inserted, n_rejected, "aborted")
        store.log_run(spec.name, result, as_of, change_type)
        if result.status == "aborted":
            raise RejectionError(f"{spec.name}: {n_rejected} of {fetched} rejected")
        return result
    finally:
        for df in ("raw", "parsed", "fresh", "rejected"):
            if df in locals():
                locals()[df].unpersist()


def cursor_start(store: Store, source: str, today: dt.date, lookback_days: int = 1) -> dt.date:
    """Where an incremental read begins: the cursor, or some days back without one. A cursor that isn't a date raises."""
    at = store.cursor(source)
    return dt.date.fromisoformat(at) if at else today - dt.timedelta(days=lookback_days)


def backfill_presence(store: Store, spec: SourceSpec, path: str, run_id: str, as_of: str) -> int:
    """Writes the manifest of a run from before there were manifests, from what it landed. Returns the identities; nothing else is written.

    A run that has a manifest already is left alone.
    """
    known = store.read("presence", spec.name)
    if known is not None and not known.where(F.col("run_id") == run_id).isEmpty():
        return 0
    valid = validate.valid(store.replay(path), spec)
    good, _ = invariants.check(valid, spec, as_of)
    rows = versions.presence(good, run_id, spec.name, spec.identity).persist()
    try:
        store.append("presence", spec.name, rows)
        return rows.count()
    finally:
        rows.unpersist()

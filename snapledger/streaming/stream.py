"""The same operators on streams: ingest by micro-batch, and event-time windows for late data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import RejectionError, ingest
from ..sources.spec import SourceSpec
from ..sources.state import Store


def ingest_stream(lines: DataFrame, spec: SourceSpec, store: Store, checkpoint: str, clock: Callable[[], str] = lambda: dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S")) -> StreamingQuery:
    """Runs ingest() on every micro-batch of a stream with a ``raw`` column and stops when all input is read.

    A batch that is run again after a failure stores nothing twice, as its hashes are the latest already. Too many
    rejections abort that batch's run in the log and don't stop the stream.
    """

    def one(batch: DataFrame, number: int) -> None:
        try:
            ingest(batch, spec, store, clock(), run_id=f"{spec.name}-{number}")
        except RejectionError as error:
            print(error)

    return lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str, width: str, delay: str, *by: str) -> DataFrame:
    """Counts by event-time window; rows later than ``delay`` behind the newest are left out on a stream."""
    return events.withWatermark(at, delay).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")

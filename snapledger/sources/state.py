"""Sinks and books: landing, append-only tables, cursors, run log, guarded removal. The only module that writes."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RUNS = "source string, run_id string, started_at timestamp, status string, records_extracted long, records_inserted long, records_rejected long, change_type string, response_status_code int, response_etag string, response_body_sha256 string, response_inner_content_sha256 string, raw_landing_path string, error_message string, response_headers map<string,string>"
CHANGE_TYPES = ("routine", "schema_rebaseline", "hash_helper_rebaseline", "historical_seed")


class Store:
    """Tables under one root folder, through Hadoop's file system, so any store that Spark can write to will do.

    Tables are appended to. Small state (a feed's cursor) is written whole to a new folder, and the newest
    folder counts; so no reader sees half a state, and nothing is overwritten while it's read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, kind: str, name: str) -> str:
        return f"{self.root}/{kind}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def exists(self, kind: str, name: str) -> bool:
        fs, place = self._fs(self.path(kind, name))
        return fs.exists(place)

    def read(self, kind: str, name: str) -> DataFrame | None:
        return self.spark.read.parquet(self.path(kind, name)) if self.exists(kind, name) else None

    def append(self, kind: str, name: str, df: DataFrame, *by: str) -> None:
        df.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(self.path(kind, name))

    def land(self, source: str, raw: DataFrame, date: str, errors: bool = False) -> str:
        """Writes raw lines, gzipped, to an immutable folder by source and date."""
        path = f"{self.root}/landing/{'errors/' if errors else ''}{source}/{date}/{uuid.uuid4().hex}"
        raw.select("raw").write.option("compression", "gzip").text(path)
        return path

    def land_manifest(self, source: str, date: str, archives: list[dict]) -> str:
        """One JSON object that names the archives a scan was put together from."""
        path = f"{self.root}/landing/{source}/{date}/{uuid.uuid4().hex}-manifest"
        self.spark.createDataFrame([(json.dumps({"archives": archives}, sort_keys=True),)], "value string").coalesce(1).write.text(path)
        return path

    def replay(self, path: str) -> DataFrame:
        """The raw lines of a landing folder, decompressed, to be ingested again."""
        return self.spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("raw_landing_path"))

    def _versions(self, kind: str) -> list[str]:
        fs, place = self._fs(self.path("state", kind))
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        return sorted(x for x in names if x.startswith("v") and fs.exists(self._fs(f"{self.path('state', kind)}/{x}/_SUCCESS")[1]))

    def _kinds(self, kind: str) -> list[str]:
        """The parts of a kind of state that are kept apart, one folder each."""
        fs, place = self._fs(self.path("state", kind))
        return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().startswith("of=")) if fs.exists(place) else []

    def state(self, kind: str) -> DataFrame | None:
        """The newest version; of a kind in parts, the newest of each together."""
        if parts := self._kinds(kind):
            found = [x for p in parts if (x := self.state(f"{kind}/{p}")) is not None]
            out = found[0] if found else None
            for x in found[1:]:
                out = out.unionByName(x)
            return out
        found = self._versions(kind)
        return self.spark.read.parquet(f"{self.path('state', kind)}/{found[-1]}") if found else None

    def put_state(self, kind: str, df: DataFrame) -> None:
        found = self._versions(kind)
        n = int(found[-1][1:]) + 1 if found else 0
        df.coalesce(1).write.parquet(f"{self.path('state', kind)}/v{n:012d}")

    def cursor(self, source: str) -> str | None:
        row = self._cursor(source)
        return row["cursor"] if row else None

    def _cursor(self, source: str):
        now = self.state(f"cursors/of={source}")
        return now.first() if now else None

    def put_cursor(self, source: str, cursor: str | None, at: str, etag: str | None = None, modified: str | None = None) -> None:
        """Replaces the source's row, which has a folder of its own, so that feeds don't wait for or undo each other. What isn't given of the
        answer's tags stays."""
        row = self._cursor(source)
        old = row.asDict() if row else {}
        values = (source, cursor, etag or old.get("etag"), modified or old.get("last_modified"), at)
        self.put_state(f"cursors/of={source}", self.spark.createDataFrame([values], "source string, cursor string, etag string, last_modified string, updated_at string"))

    def touch(self, source: str, at: str) -> None:
        """Freshness without new rows, for a feed that answered that nothing changed."""
        self.put_cursor(source, self.cursor(source), at)

    def log_run(self, source: str, result, at: str, change_type: str = "routine", **response) -> None:
        """Appends a run, at best effort: a log that can't be written doesn't fail a run whose rows are stored."""
        if change_type not in CHANGE_TYPES:
            raise ValueError(f"change type {change_type}")
        values = {"source": source, "run_id": result.run_id, "started_at": at, "status": result.status, "records_extracted": result.fetched, "records_inserted": result.inserted, "records_rejected": result.rejected, "change_type": change_type} | response
        names = [x.split()[0] for x in _RUNS.split(", ")]
        try:
            row = self.spark.createDataFrame([tuple(values.get(n) for n in names)], _RUNS.replace("started_at timestamp", "started_at string"))
            self.append("runs", "extraction_runs", row.withColumn("started_at", F.col("started_at").cast("timestamp")), "source")
        except Exception as error:
            print(f"run log not written: {error}")

    def remove(self, kind: str, name: str, expect: int) -> None:
        """Deletes a table if it has exactly ``expect`` rows; else raises and leaves it."""
        found = self.read(kind, name)
        n = found.count() if found else 0
        if n != expect:
            raise RuntimeError(f"{kind}/{name} has {n} rows, not {expect}")
        fs, place = self._fs(self.path(kind, name))
        fs.delete(place, True)

    def runs(self) -> DataFrame | None:
        return self.read("runs", "extraction_runs")

    def rejected(self, *sources: str) -> DataFrame | None:
        """The quarantine of several feeds as one table, tagged by ``source``; feeds without any are left out."""
        found = [x.withColumn("source", F.lit(s)) for s in sources if (x := self.read("rejected", s)) is not None]
        out = found[0] if found else None
        for x in found[1:]:
            out = out.unionByName(x, allowMissingColumns=True)
        return out

    def reset(self, source: str, at: str) -> None:
        """Empties a feed for a fresh start: its bronze, rejected and presence tables, its runs and its cursor.

        Raises and leaves all as it is if any of its runs wasn't routine, as such a run can't be had again.
        """
        runs = self.runs()
        odd = runs.where((F.col("source") == source) & (F.col("change_type") != "routine")).count() if runs else 0
        if odd:
            raise RuntimeError(f"{source} has {odd} runs that weren't routine")
        for kind, name in (("bronze", source), ("rejected", source), ("presence", source), ("runs", f"extraction_runs/source={source}"), ("state", f"cursors/of={source}")):
            fs, place = self._fs(self.path(kind, name))
            fs.delete(place, True)

    def prune(self, kind: str, name: str, at: str, now: str, daily: int = 90, monthly: int = 365) -> DataFrame:
        """Retention: all rows of the last ``daily`` days, and the first day's rows of each month of the last ``monthly`` days."""
        rows = self.read(kind, name)
        age = F.datediff(F.lit(now).cast("date"), F.to_date(at))
        firsts = rows.groupBy(F.trunc(at, "month").alias("_month")).agg(F.min(F.to_date(at)).alias("_first"))
        kept = rows.withColumn("_month", F.trunc(at, "month")).join(firsts, "_month").where((age <= daily) | ((age <= monthly) & (F.to_date(at) == F.col("_first"))))
        return kept.drop("_month", "_first")

"""Scans: landed files to one row for each raw record (``raw`` JSON text, ``raw_landing_path``)."""

from __future__ import annotations

import fnmatch
import hashlib
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spec import SourceSpec

def _landed() -> Column:
    return F.col("_metadata.file_path").alias("raw_landing_path")


class AuthError(RuntimeError):
    """The feed answered that the caller isn't allowed in."""


class TransientError(RuntimeError):
    """Worth another try."""


def json_array(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold one JSON array each (gzip or plain); a file is the unit of parallelism."""
    files = spark.read.option("wholetext", True).text(path).select("value", _landed())
    return files.select(F.explode(F.from_json("value", "array<string>")).alias("raw"), "raw_landing_path")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record a line: splittable, for feeds landed in bulk."""
    return spark.read.text(path).select(F.col("value").alias("raw"), _landed()).where("trim(raw) <> ''")


def envelope(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the form {"STATUSCODE", "MESSAGE", "RESULT": [...]}: 400 has rows, 412 none; 401 and others raise.

    Any number of page files make one scan.
    """
    pages = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "STATUSCODE string, MESSAGE string, RESULT array<string>").alias("page"), _landed())
    odd = pages.where("page.STATUSCODE IS NULL OR page.STATUSCODE NOT IN ('400', '412')").select("page.STATUSCODE", "page.MESSAGE").first()
    if odd:
        raise (AuthError if odd[0] == "401" else TransientError)(f"status {odd[0]}: {odd[1]}")
    return pages.select(F.explode("page.RESULT").alias("raw"), "raw_landing_path")


def zip_lines(spark: SparkSession, path: str, member: str = "*.txt", encoding: str = "utf-8") -> DataFrame:
    """Lines of the one member of each archive whose name fits; none or several raise.

    Split at LF or CRLF only; empty lines are left out. Spark has no codec for ZIP, so a Python task streams
    each archive; only its compressed bytes are in memory as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                archive = zipfile.ZipFile(io.BytesIO(content))
                fits = [x for x in archive.namelist() if fnmatch.fnmatch(x, member)]
                if len(fits) != 1:
                    raise ValueError(f"{name}: {len(fits)} members fit {member}")
                with io.TextIOWrapper(archive.open(fits[0]), encoding=encoding, newline="\n") as lines:
                    some: list[str] = []
                    for line in lines:
                        line = line.removesuffix("\n").removesuffix("\r")
                        if line:
                            some.append(line)
                        if len(some) == 10_000:
                            yield pa.RecordBatch.from_pydict({"value": some, "raw_landing_path": [name] * len(some)})
                            some = []
                    if some:
                        yield pa.RecordBatch.from_pydict({"value": some, "raw_landing_path": [name] * len(some)})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "value string, raw_landing_path string")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain files, split at LF or CRLF only and without empty ones; splittable."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), _landed())
    return lines.where("value <> ''")


def positional(lines: DataFrame, spec: SourceSpec, since: str | None = None, date_field: str = "rcdate") -> DataFrame:
    """Tab-separated lines to JSON records by position; no quoting. Lines with another number of fields keep ``raw`` as it is and have ``drift`` set.

    ``since`` leaves out records with an older or empty date, by comparing text; drifted lines are never left out.
    """
    names = spec.positions
    parts = lines.withColumn("f", F.split("value", "\t", -1)).withColumn("drift", F.size("f") != len(names))
    if since is not None:
        date = F.try_element_at("f", F.lit(names.index(date_field) + 1))
        parts = parts.where(F.col("drift") | ((date != "") & (date >= since)))
    record = F.to_json(F.map_from_arrays(F.array(*map(F.lit, names)), F.when(~F.col("drift"), F.col("f"))))
    return parts.select(F.when(F.col("drift"), F.to_json(F.struct(F.col("value").alias("line")))).otherwise(record).alias("raw"), "raw_landing_path", "drift")


def concatenated(*scans: DataFrame) -> DataFrame:
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan, allowMissingColumns=True)
    return out


def between(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """The historical scan: dates within the window, both ends included."""
    return df.where(F.to_date(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, bytes) of each file as it lies there."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def inner_fingerprints(spark: SparkSession, path: str, member: str = "*.txt") -> DataFrame:
    """(path, sha256) of what each archive holds: the wrapper may change where the content doesn't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for content in batch.column(1).to_pylist():
                archive, digest = zipfile.ZipFile(io.BytesIO(content)), hashlib.sha256()
                for name in sorted(fnmatch.filter(archive.namelist(), member)):
                    with archive.open(name) as data:
                        while part := data.read(1 << 20):
                            digest.update(part)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.string())], names=["path", "sha256"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, sha256 string")


def unchanged(current: DataFrame, previous: DataFrame) -> bool:
    """Whether a snapshot's fingerprints equal the last run's: then there is nothing to do."""
    return current.select("sha256").exceptAll(previous.select("sha256")).isEmpty() and previous.select("sha256").exceptAll(current.select("sha256")).isEmpty()


def matching(df: DataFrame, **fields: str) -> DataFrame:
    """Lookup and search by field: arrays of structs match if any element's any field has the text, texts if they contain it."""
    out = df
    for name, sought in fields.items():
        kind = df.schema[name].dataType.simpleString()
        column: Column = F.col(name)
        out = out.where(F.contains(F.lower(F.to_json(column) if kind.startswith("array") else column.cast("string")), F.lit(sought.lower())))
    return out

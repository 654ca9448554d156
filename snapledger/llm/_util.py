"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import work_dir

#: The bytes that separate words where a word is ``[^\x20\x09-\x0D]+``; the same set as bytes.split().
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Lower-cases A-Z and turns every byte outside ``[0-9a-z\x80-\xff]`` into a space.
NORMAL = bytes((c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20) for c in range(256))
#: Lower-cases A-Z only.
LOWER = bytes((c + 32 if 0x41 <= c <= 0x5A else c) for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each text of an Arrow column; None for null. Copies one text at a time."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if data is None:
        for i in range(len(column)):
            yield b"" if column[i].is_valid else None
        return
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data)
    some = column.is_valid().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield None if some and not some[i] else view[at[i] : at[i + 1]].tobytes()


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that column ``text`` of each slice has at most ``most`` bytes, or one row."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        if not len(column) or column.buffers()[2] is None:
            yield batch
            continue
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def _release() -> None:
    """Gives memory that is free within this process back: Python workers stay, and one step's peak would count in the next."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task over batches that leaves its worker as small as it can."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _release()

    return whole


def tidied_group(one: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of a group."""

    def whole(table: pa.Table) -> pa.Table:
        try:
            return one(table)
        finally:
            _release()

    return whole


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one in the warehouse."""
    return work_dir(spark)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes the rows to the shared folder as Parquet and reads them again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes what stored() wrote; only for tables that no plan reads any more."""
    for df in tables:
        spark = df.sparkSession
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def sweep(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nobody holds any more; it does so when the JVM collects them."""
    gc.collect()
    spark._jvm.System.gc()


def size_in_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's size: for a file scan, that of its files. Runs no job.

    Where Spark can't tell (rows that come from an RDD), 32 MB for each partition.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 50 else df.rdd.getNumPartitions() << 25

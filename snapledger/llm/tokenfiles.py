"""Token ids in Parquet: list columns, dictionary or delta encoded, small row groups and page indexes."""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._util import cells, size_in_bytes, slices, stored, tidied

#: Bytes of each of the two generations of words that a Python worker keeps, which bounds its memory: when the
#: newer one is full, the older one goes.
KEPT_BYTES = 64 << 20
#: Up to so many files their totals, 16 bytes each, are broadcast.
MOST_FILES = 1_000_000
#: Bytes of texts that are encoded at once, but at least one text.
SLICE_BYTES = 8 << 20
#: What goes to and from Python, and what the Parquet reader decodes, at once. Every core holds that several times over,
#: and with Spark's own limits, 64 MB and 4096 rows, whole texts and lists of ids fill an executor.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES), "spark.sql.parquet.columnarReaderBatchSize": "512"}
_ENTRY = 200  # bytes that a kept word takes besides its own and its ids'
_EDGE = b".,;:!?#*$%&|<>()\""

# The normaliser and pre-tokeniser for which words can be encoded one by one.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class TextEncoder:
    """The tokenizers library's ids of whole texts, for any tokenizer file."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's end."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast([t.decode() for t in cells(texts)], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.int32), np.cumsum([len(ids) for ids in found], dtype=np.int64)


class WordEncoder(TextEncoder):
    """The same ids, word by word, for tokenizers whose pre-tokens never cross white space (see fits()).

    The normaliser works on single words too (NFC doesn't compose across white space), so the ids of a text
    are those of its words, one after another. Each worker encodes a word once while it remembers it. Words
    that hold an added token go through the library as a whole.
    """

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        vocab = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        #: A character other than a letter of each added token: a word without any of them holds no added token.
        self.marks = sorted({next(c for c in t if not c.isalpha()).encode() for t in added if not t.isalpha()})
        self.in_letters = any(t.isalpha() for t in added)
        self.words: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.size = 0

    @staticmethod
    def fits(tokenizer) -> bool:
        """Whether a tokenizer splits and normalises as this class does, and no added token holds white space."""
        of = json.loads(tokenizer.to_str())
        plain = of["normalizer"] == NORMALIZER and of["pre_tokenizer"] == PRE_TOKENIZER and not of["post_processor"]
        model = of["model"]
        plain = plain and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not (model["dropout"] or model["unk_token"])
        return plain and all(t.content.split() == [t.content] for t in tokenizer.get_added_tokens_decoder().values() if t.content)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As above. Arrow splits the texts and finds the distinct words; only these are looked up one by one."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        parts = self._known(words)
        size = np.array([len(x) for x in parts], np.int32) // 4
        flat, first = np.frombuffer(b"".join(parts), np.intc), np.cumsum(size, dtype=np.int32) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        del lists, coded, words, parts
        many = size[at]
        ends = np.concatenate(([0], np.cumsum(many, dtype=np.int64)))
        place = np.arange(ends[-1], dtype=np.int32)
        place += np.repeat(first[at] - ends[:-1].astype(np.int32), many)
        return flat[place], ends[np.cumsum(counts, dtype=np.int64)]

    def _known(self, words: list[bytes]) -> list[bytes]:
        if self.size > KEPT_BYTES:
            self.before, self.words, self.size = self.words, {}, 0
        known, old = self.words, self.before
        parts = list(map(known.get, words))
        missing = [i for i, ids in enumerate(parts) if ids is None]
        new = []
        for i in missing:
            w = words[i]
            if (ids := old.get(w)) is None:
                new.append(w)
            else:
                known[w] = ids
        self._learn(new)
        for i in missing:
            parts[i] = known[words[i]]
        self.size += _ENTRY * len(missing) + sum(map(len, new))
        return parts

    def _learn(self, new: list[bytes]) -> None:
        words, tokenize, marks, whole, parts = self.words, self.tokenizer.model.tokenize, self.marks, [], []
        if self.in_letters:  # any word may hold an added token
            whole, new = new, []
        for word in new:
            if word.isalpha():  # of bytes: A-Z and a-z only
                low = word if word.islower() else word.lower()
                ids = words.get(low)
                if ids is None:
                    ids = words[low] = _packed([t.id for t in tokenize(low.decode())])
                words[word] = ids
                continue
            bare = word.strip(_EDGE)
            if bare.isalpha():
                low = bare.lower()
                core = low.decode()
            else:
                text = bare.decode()
                low = _lowered(text) if text.isalpha() else None
                if low is None:
                    whole.append(word)
                    continue
                core = low.decode("latin-1").translate(_WRITTEN)
            if len(bare) < len(word):
                for mark in marks:
                    if mark in word:
                        whole.append(word)
                        break
                else:
                    at = word.index(bare)
                    parts.append((word, word[:at], low, word[at + len(bare) :]))
            ids = words.get(low)
            if ids is None:
                ids = words[low] = _packed([t.id for t in tokenize(core)])
            words[word] = ids
        words[b""] = b""
        self._edges([x for x in {y for p in parts for y in (p[1], p[3])} if x not in words])
        for word, a, low, b in parts:
            words[word] = words[a] + words[low] + words[b]
        for word in whole:
            words[word] = _packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def _edges(self, some: list[bytes]) -> None:
        """Encodes marks, of one pre-token each, in few calls, and tells them apart by the ids that end a pre-token."""
        for at in range(0, len(some), 512):
            part = some[at : at + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.intc)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                self.words.update((x, ids[a:b].tobytes()) for x, a, b in zip(part, [0, *ends], ends, strict=False))
            else:  # some aren't one pre-token after normalisation
                self.words.update((x, _packed(self.tokenizer.encode(x.decode(), add_special_tokens=False).ids)) for x in part)


def _lowered(core: str) -> bytes | None:
    """A word of Latin letters as the normaliser leaves it: composed and lower case; None for other words.

    Only letters whose lower case is one letter, so that the word stays one pre-token.
    """
    low = core.lower()
    if max(core) > "\u017f" or len(low) != len(core) or not unicodedata.is_normalized("NFC", core):
        return None
    return low.encode()


#: How byte-level pre-tokenisation writes bytes: printable ones as they are in Latin-1, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}

_FEW = [struct.Struct(f"{n}i").pack for n in range(16)]


def _packed(ids: list[int]) -> bytes:
    return _FEW[len(ids)](*ids) if len(ids) < 16 else array("i", ids).tobytes()


@lru_cache(maxsize=2)
def encoder(file: str) -> TextEncoder:
    """By words where the tokenizer allows it, else by whole texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return WordEncoder(tokenizer) if WordEncoder.fits(tokenizer) else TextEncoder(tokenizer)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within have the limits of ``BATCHES``; one that the session sets itself holds."""
    unset = [k for k in BATCHES if spark.conf.get(k, None) is None]
    for k in unset:
        spark.conf.set(k, BATCHES[k])
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    encoding: str = "dictionary",
    row_group_bytes: int = 8 << 20,
    page_rows: int = 2000,
    bytes_per_file: int = 16 << 20,
) -> None:
    """Writes (id, n_tokens, offset, ids) in ascending id order: sorted within each file, files in order of their number.

    ``offset`` counts the ids before a row in its file. Ids are lists of int, each ended by ``end_id``;
    ``encoding`` is "dictionary" (16-bit indexes for a small vocabulary) or "delta" (for sorted or narrow
    ids). Row groups hold about ``row_group_bytes``; Parquet's page indexes and the sorted id column let a
    reader fetch a few rows' pages, and the metadata columns can be read without the ids. A null text counts
    as empty; null ids come first; rows with equal ids are ordered by a hash of their text, so that one id
    with many texts is spread over files. Repeated rows are each written; those of one id and text share a
    file, streamed, so only its length grows. Texts, not ids, are shuffled, as they are smaller, and every
    text is encoded once. The number of files follows the input's size: one for each ``bytes_per_file`` of it,
    and at least one for each core. Any tokenizer file will do; special tokens aren't added.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding is dictionary or delta, not {encoding}")
    from pyspark.sql.pandas.types import to_arrow_type

    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(text_col).alias("tie"))
    kind = rows.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("n_tokens", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, known = 0, encoder(tokenizer_file)
        for batch in slices(batches, 1, SLICE_BYTES):
            found, at = known.encode(batch.column(1))
            ends = np.concatenate(([0], at + np.arange(1, len(at) + 1)))
            values = np.insert(found, at, end_id)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), pa.array(ends[:-1] + before), ids], schema=schema)
            before += int(ends[-1])

    size = size_in_bytes(df)  # of two columns Spark would estimate a share by their types, though texts are nearly all of it
    files = max(1, size // bytes_per_file, df.sparkSession.sparkContext.defaultParallelism)
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    ordered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("id", "text")
    found = ordered.mapInArrow(tidied(run), f"id {kind.simpleString()}, n_tokens long, offset long, ids array<int>")
    with small_batches(df.sparkSession):
        (
            found.withColumnRenamed("id", id_col)
            .write.option("compression", "zstd")
            .option("parquet.writer.version", "PARQUET_2_0")
            .option("parquet.block.size", row_group_bytes)
            .option("parquet.page.row.count.limit", page_rows)
            .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
            .parquet(path)
        )


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """The rows of a folder of token files with ``start``, the number of ids in all rows before; ``ids=False`` reads metadata only.

    The files' totals, one small row for each file, are summed up in the order of their numbers. They are
    broadcast as long as there are at most ``MOST_FILES``, so that the ids aren't shuffled for them.
    """
    rows = spark.read.parquet(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    totals = rows.select(part.alias("part"), "n_tokens").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    columns = [id_col, "n_tokens", "offset", *["ids"] * ids]
    if len(rows.inputFiles()) <= MOST_FILES:
        bases = F.broadcast(bases)
    return rows.select(*columns, part.alias("part")).join(bases, "part").select(id_col, (F.col("base") + F.col("offset")).alias("start"), "n_tokens", *["ids"] * ids)


def checksums(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Replaces ``ids`` by ids_crc32, the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = rows.select(id_col, "start", "n_tokens", "ids")
    kind = rows.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_pylist()
            view = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], schema=schema)

    return rows.mapInArrow(tidied(run), f"id {kind.simpleString()}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def digest(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The checksums of a folder of token files, read now and in small batches; what is kept of it is one small row each."""
    with small_batches(spark):
        return stored(checksums(read_tokens(spark, path, id_col), id_col), "checksums")

"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import cells, tidied

#: Texts longer than this many code points are split at safe boundaries before encoding.
LONG = 1 << 16


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The library's encoder for a rank file (base64 token, rank on each line), one per Python worker."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: Before white space that follows something else. No match of a GPT-style pattern crosses such a
#: place: its alternatives are white space only, or one optional space and then no white space; and the
#: look-ahead of ``\s+(?!\S)`` is decided by what stands behind the run, which stays with the run.
_SAFE = regex.compile(r"(?<=\S)(?=[ \n])")

#: White space so long that the library's backtracking may run out of stack on it.
_BLANK = regex.compile(r"\s{4096,}")


def pieces(text: str, size: int = LONG) -> Iterator[str]:
    """Splits a long text at safe boundaries, each piece the first one of at least ``size`` code points."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def matches(text: str, size: int = LONG, blank: regex.Pattern = _BLANK) -> Iterator[tuple[str, bool]]:
    """The pieces of a long text, and of each whether it's one match of the pattern by itself.

    Those are long runs of white space. ``\\s+(?!\\S)`` takes such a run whole at the end of a text, and elsewhere
    all of it but the last character, which goes with what follows.
    """
    start = 0
    for run in blank.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > start:
            yield from ((x, False) for x in pieces(text[start : run.start()], size))
        yield text[run.start() : end], True
        start = end
    if start < len(text):
        yield from ((x, False) for x in pieces(text[start:], size))


def encode(text: str, encoder: tiktoken.Encoding, size: int = LONG, blank: regex.Pattern = _BLANK) -> list[int]:
    """The library's ids; of a text longer than ``size`` piece by piece."""
    if len(text) <= size:
        return encoder.encode_ordinary(text)
    ids: list[int] = []
    for piece, one in matches(text, size, blank):
        ids += encoder._encode_single_piece(piece) if one else encoder.encode_ordinary(piece)
    return ids


def _each(of: Callable, rank_file: str, pattern: str, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_file, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *of(batch.column(1), encoder)], schema=schema)

    return run


def encode_texts(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its id and ``ids`` (array of int).

    A null text counts as empty and gives no ids. Every row stands alone, so null ids, repeated rows and
    other columns (which are not read) do no harm. Special tokens' strings are ordinary text.
    """

    def of(texts: pa.Array, encoder: tiktoken.Encoding) -> list[pa.Array]:
        return [pa.array([encode((t or b"").decode(), encoder) for t in cells(texts)], pa.list_(pa.int32()))]

    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = pa.schema([("id", _arrow(df, id_col)), ("ids", pa.list_(pa.int32()))])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidied(_each(of, rank_file, pattern, schema)), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``df``: its id and ``bytes``, the raw bytes of ``ids_col``; null ids give none."""

    def of(lists: pa.Array, encoder: tiktoken.Encoding) -> list[pa.Array]:
        return [pa.array([encoder.decode_bytes(x or []) for x in lists.to_pylist()], pa.binary())]

    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = pa.schema([("id", _arrow(df, id_col)), ("bytes", pa.binary())])
    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(tidied(_each(of, rank_file, pattern, schema)), f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.select(F.col(name)).schema[0].dataType)


def round_trip(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass, keeping digests only: n_tokens, ids_sha256, decoded_sha256.

    The pipeline and the check of a corpus need no more, and ids of a whole corpus need not be shuffled.
    Nulls, repeated rows and other columns as in encode_texts().
    """

    def of(texts: pa.Array, encoder: tiktoken.Encoding) -> list[pa.Array]:
        counts, of_ids, of_bytes = [], [], []
        for text in cells(texts):
            ids = encode((text or b"").decode(), encoder)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(encoder.decode_bytes(ids)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = pa.schema([("id", _arrow(df, id_col)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(tidied(_each(of, rank_file, pattern, schema)), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)

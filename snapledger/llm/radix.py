"""Suffix-array dedup on bytes: suffixes ordered only to the threshold's depth, most significant digits first.

The stretches of text that can hold a repeat come together by a gram that they share (see _repeats). There, the
suffixes that start in them are sorted by their first digit of eight bytes, then, within groups of equal ones, by
the next, and so on through the threshold. A suffix whose digits nobody shares drops out of all further passes. The
groups that are left at the end are exactly the repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _repeats as r
from . import _windows as w
from ._util import slices, tidied

#: Bytes of the gram by which stretches are dealt to tasks.
GRAM = 48
#: Bytes of a digit.
DIGIT = 8


def equal_suffixes(raw: np.ndarray, suffixes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, group) of those that share their first ``width`` bytes with another, by passes over digits."""
    group = np.zeros(len(suffixes), np.int64)
    for depth in range(0, width, DIGIT):
        size = min(DIGIT, width - depth)
        digit = np.zeros(len(suffixes), np.uint64)
        for i in range(size):
            digit = (digit << np.uint64(8)) | raw[suffixes + (depth + i)]
        order = np.lexsort((digit, group))
        suffixes, digit, group = suffixes[order], digit[order], group[order]
        same = (digit[1:] == digit[:-1]) & (group[1:] == group[:-1])
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
        group = np.cumsum(~np.concatenate(([False], same)))
        suffixes, group = suffixes[shared[: len(suffixes)]], group[: len(suffixes)][shared[: len(suffixes)]]
    return suffixes, group


def equal_windows(held: list[bytes], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, offset, group) of windows that start in the first ``counts`` bytes of a stretch and aren't alone."""
    raw = np.frombuffer(b"".join(held), np.uint8)
    begin = np.cumsum([0, *map(len, held)])[: len(held)]
    stretch = np.repeat(np.arange(len(held)), counts)
    starts = np.arange(len(stretch)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[stretch]
    suffix, group = equal_suffixes(raw, starts, width)
    of = np.searchsorted(begin, suffix, "right") - 1
    return of, suffix - begin[of], group


def cut(text: bytes, first: list[int], size: list[int]) -> list[bytes]:
    """The bytes of each stretch of a text."""
    return [text[a : a + n] for a, n in zip(first, size, strict=True)]


def windows(width: int = 100, **more) -> r.Windows:
    equal = lambda held, counts: equal_windows(held, counts, width)
    return r.Windows(tokens=w.byte_tokens, cut=cut, equal=equal, width=width, gram=min(GRAM, max(1, width // 2)), earlier=True, **more)


def without(text: bytes | None, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text without the spans, and how many maximal runs were removed."""
    text, parts, last = text or b"", [], 0
    for a, b in spans:
        parts.append(text[last:a])
        last = b
    return b"".join([*parts, text[last:]]), len(spans)


def remove_repeats(df: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """One row per row of ``df``: id, n_bytes, n_removed, n_spans, ``kept`` (binary: a cut may split a character), kept_sha256.

    A byte goes if it lies in a string of ``width`` bytes that also starts earlier: in a document with a
    smaller id, or earlier in the same one. Strings are judged on the input and never cross documents. Null
    texts count as empty; shorter texts lose nothing. A null id counts as smaller than all ids; rows that share an
    id, or have none, are ordered by hashes of their text; repeated rows are one document and each get its
    answer. Ids are whole numbers. Other columns aren't read. An empty table gives no rows.
    """
    names = [("z", pa.int32()), ("k", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())]
    schema = pa.schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, r.SLICE_BYTES // 2):
            out = []
            for text, spans in zip(r.unpacked(batch.column(3)), batch.column(4).to_pylist(), strict=True):
                kept, n = without(text, r.cover(spans))
                size = len(text or b"")
                out.append((size, size - len(kept), n, kept, hashlib.sha256(kept).hexdigest()))
            columns = zip(*out, strict=True) if out else [[]] * 5
            arrays = [pa.array(x, f.type) for x, f in zip(columns, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], schema=schema)

    found = r.with_spans(df, windows(width, **more), id_col, text_col)
    rows = found.mapInArrow(tidied(run), "z int, k long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return rows.selectExpr(f"CASE WHEN z = 1 THEN k END AS `{id_col}`", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")

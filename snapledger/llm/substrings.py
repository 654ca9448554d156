"""Substring dedup on words: prefix-partitioned suffix trees, whose deep internal nodes are the repeats.

The stretches of text that can hold a repeat come together by a gram that they share (see _repeats). There, the
suffixes that start in them are split by prefixes of varying length: by the first word, and where too many
share it, by as many more words as it takes, so that each group fits in memory; small neighbours are put together. Of
each group the tree is built as its leaves in order and the depths at which neighbours part. An internal node as deep
as the threshold is a block of leaves that don't part before it: all their windows repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import _repeats as r
from . import _windows as w
from ._util import slices, tidied

#: Words of the gram by which stretches are dealt to tasks.
GRAM = 12
#: Suffixes of a group whose tree is built at once: of 35 words each, 7 MB.
MOST = 50_000


def prefix_groups(words: np.ndarray, suffixes: np.ndarray, width: int, most: int = MOST) -> Iterator[tuple[np.ndarray, int]]:
    """Suffixes split by prefixes: (suffixes, words that all of them share) of groups of at most ``most``.

    Only a group whose suffixes share ``width`` words may be larger, as it is one node. Suffixes that share more
    than the words told are never apart.
    """
    left = [(suffixes, 0)]
    while left:
        some, depth = left.pop()
        if len(some) <= most or depth == width:
            yield some, depth
            continue
        some = some[np.argsort(words[some + depth], kind="stable")]
        word = words[some + depth]
        begin = 0  # of the small neighbours that are put together
        cuts = [0, *(np.flatnonzero(word[1:] != word[:-1]) + 1).tolist(), len(some)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > most:
                if begin < a:
                    yield some[begin:a], depth
                left.append((some[a:b], depth + 1))
                begin = b
            elif b - begin > most:
                yield some[begin:a], depth
                begin = a
        if begin < len(some):
            yield some[begin:], depth


def subtree(words: np.ndarray, suffixes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of a group's tree in order, and of each how many words it shares with the one before: ``width`` at most."""
    rows = words[suffixes[:, None] + np.arange(width)]
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    same = rows[1:] == rows[:-1]
    depth = np.where(same.all(axis=1), width, np.argmin(same, axis=1)) if len(rows) > 1 else np.zeros(0, np.int64)
    return suffixes[order], np.concatenate(([0], depth))[: len(rows)]


def deep_nodes(leaves: np.ndarray, depth: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, node) of the leaves under internal nodes of ``width`` words or more."""
    joined = depth >= width
    under = joined | np.concatenate((joined[1:], [False]))
    return leaves[under], np.cumsum(~joined)[under]


def equal_windows(held: list[bytes], counts: np.ndarray, width: int, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, offset, node) of windows that start in the first ``counts`` words of a stretch and aren't alone."""
    lists = pc.ascii_split_whitespace(pa.array(held, pa.large_binary()).cast(pa.large_string()))
    words = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    begin = lists.offsets.to_numpy()[:-1].astype(np.int64) if len(held) else np.zeros(0, np.int64)
    stretch = np.repeat(np.arange(len(held)), counts)
    suffixes = np.arange(len(stretch)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[stretch]
    found, nodes, last = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for some, shared in prefix_groups(words, suffixes, width, most):
        if len(some) < 2:
            continue
        leaves, depth = subtree(words, some, width) if shared < width else (some, np.full(len(some), width))
        leaf, node = deep_nodes(leaves, depth, width)
        found.append(leaf)
        nodes.append(node + last)
        last += len(some) + 1
    leaf, node = np.concatenate(found), np.concatenate(nodes)
    of = np.searchsorted(begin, leaf, "right") - 1
    return of, leaf - begin[of], node


def cut(text: bytes, first: list[int], size: list[int]) -> list[bytes]:
    """The words of each stretch of a text, joined by one space."""
    words = text.split()
    return [b" ".join(words[a : a + n]) for a, n in zip(first, size, strict=True)]


def windows(width: int = 35, most: int = MOST, **more) -> r.Windows:
    equal = lambda held, counts: equal_windows(held, counts, width, most)
    return r.Windows(tokens=w.word_tokens, cut=cut, equal=equal, width=width, gram=min(GRAM, width), earlier=False, **more)


def kept_words(text: bytes | None, spans: list[tuple[int, int]]) -> tuple[list[bytes], list[bytes]]:
    """All words of a text, and those outside the spans."""
    words, kept, last = (text or b"").split(), [], 0
    for a, b in spans:
        kept += words[last:a]
        last = b
    return words, kept + words[last:]


def remove_repeats(df: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """One row per row of ``df``: id, n_words, n_removed, ``kept`` (the words left, joined by one space), kept_sha256.

    A word goes if it lies in a window of ``width`` words whose sequence also starts elsewhere, in the same
    document or another; windows are judged on the input. Null texts have no words and count as empty; texts
    of fewer words lose none. A repeated row is one more document, so its windows repeat. Ids are
    whole numbers or null; rows without an id, and rows that share one, are told apart by their texts. Other
    columns aren't read. An empty table gives no rows.
    """
    schema = pa.schema([("z", pa.int32()), ("k", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, r.SLICE_BYTES // 2):
            out = []
            for text, spans in zip(r.unpacked(batch.column(3)), batch.column(4).to_pylist(), strict=True):
                words, kept = kept_words(text, r.cover(spans))
                left = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), left, hashlib.sha256(left).hexdigest()))
            columns = zip(*out, strict=True) if out else [[]] * 4
            arrays = [pa.array(x, f.type) for x, f in zip(columns, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], schema=schema)

    found = r.with_spans(df, windows(width, **more), id_col, text_col)
    rows = found.mapInArrow(tidied(run), "z int, k long, n_words long, n_removed long, kept binary, kept_sha256 string")
    return rows.selectExpr(f"CASE WHEN z = 1 THEN k END AS `{id_col}`", "n_words", "n_removed", "CAST(kept AS string) AS kept", "kept_sha256")

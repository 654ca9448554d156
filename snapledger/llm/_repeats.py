"""Deals repeated stretches of texts out to tasks, where an operator finds the windows that occur more than once.

Windows of ``width`` tokens are grouped by their *sample*, the least hash of the grams that they hold, so equal
windows have equal samples. Consecutive windows with one sample are a *run* (see _windows), and the tokens of a
run's windows a *stretch*.

1. Which samples are shared? Each slice of the input sends every sample once. Runs whose sample nobody else has
   hold no repeat and are done. A sample with more than ``most_runs`` runs is *hot*.
2. The stretches of the other runs meet, with what they hold, by sample. Those of hot samples are first cut into
   single windows, which meet by a hash of their own, so that a phrase which stands in very many places is
   spread out. Equal stretches of a slice are sent once.
3. Within a task the operator compares what the stretches hold; no hash decides what is equal.

What is sent goes in packed arrays by bucket; the number of buckets follows the input's size.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _windows as w
from ._util import cells, forget, size_in_bytes, slices, stored, tidied, tidied_group

#: Hot samples that are told to all tasks, the most frequent ones: 16 MB at most. What is hot beyond them is still
#: right, but meets in one task for each sample.
MOST_HOT = 1 << 20
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Windows:
    """What counts as a repeat: ``width`` tokens; ``earlier``: a window goes only if it also starts earlier.

    ``tokens`` gives a hash for each token of a column of texts and where each text's end; ``cut`` the bytes of a
    text's stretches from (first, tokens); ``equal`` the windows of some stretches that aren't alone, as
    (stretch, offset, group).
    """

    tokens: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    cut: Callable[[bytes, list[int], list[int]], list[bytes]]
    equal: Callable[[list[bytes], np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    width: int
    gram: int
    earlier: bool
    longest_run: int = 64
    bucket_bytes: int = 4 << 20
    most_runs: int = 20_000


KEYS = ["z", "k", "h"]


def keys(id_col: str, text_col: str) -> list[Column]:
    """What stands for a document: whether it has an id, the id (else a hash of the text), and a 64-bit hash of the text."""
    text, number = F.col(text_col), F.col(id_col).cast("long")
    return [
        number.isNotNull().cast("int").alias("z"),
        F.coalesce(number, F.xxhash64(F.lit("no id"), text)).alias("k"),
        F.xxhash64(text).alias("h"),
    ]


def id_of(id_col: str) -> Column:
    return F.when(F.col("z") == 1, F.col("k")).alias(id_col)


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(z, k, h, text) with texts compressed, for joins that must shuffle them; a null text as null."""
    schema = pa.schema([("z", pa.int32()), ("k", pa.int64()), ("h", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in slices(batches, 3, SLICE_BYTES):
            texts = [None if t is None else squeeze(t) for t in cells(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.binary())], schema=schema)

    return df.select(*keys(id_col, text_col), F.col(text_col).cast("string").alias("text")).mapInArrow(tidied(run), "z int, k long, h long, text binary")


def unpacked(column: pa.Array) -> Iterator[bytes | None]:
    grow = zstandard.ZstdDecompressor().decompress
    for t in cells(column):
        yield None if t is None else grow(t)


# --- documents and packed arrays ---------------------------------------------------------------------------------

Docs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _ranked(docs: Docs) -> tuple[Docs, np.ndarray]:
    """The distinct documents in order (without an id first, then by id, then by hash), and each one's place among them."""
    order = np.lexsort(docs[::-1])
    ordered = tuple(x[order] for x in docs)
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([x[1:] != x[:-1] for x in ordered], axis=0)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return tuple(x[new] for x in ordered), rank


def _docs(batch: pa.RecordBatch) -> Docs:
    return tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return (w.mix(x.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, and the rows that it gets, in their order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for some in np.split(order, cuts):
        if len(some):
            yield int(bucket[some[0]]), some


def _pack(x: tuple) -> bytes:
    return zstandard.ZstdCompressor(1).compress(pickle.dumps(x, 5))


def _unpack(column: pa.ChunkedArray) -> list[tuple]:
    grow = zstandard.ZstdDecompressor().decompress
    return [pickle.loads(grow(x)) for x in column.to_pylist()]


def _chosen(docs: Docs, rank: np.ndarray) -> tuple[Docs, np.ndarray]:
    """The documents that some rows use, and the rows' places among them."""
    used, place = np.unique(rank, return_inverse=True)
    return tuple(x[used] for x in docs), place


def _gathered(parts: list[tuple]) -> tuple[Docs, list[np.ndarray]]:
    """Parts of (documents, place, columns...) as one."""
    shift = np.cumsum([0, *(len(p[0][0]) for p in parts)])
    docs, rank = _ranked(tuple(np.concatenate([p[0][i] for p in parts]) for i in range(3)))
    places = np.concatenate([p[1] + s for p, s in zip(parts, shift, strict=False)]).astype(np.int64)
    return docs, [rank[places], *(np.concatenate([p[i] for p in parts]) for i in range(2, len(parts[0])))]


_DEALT = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("rows", pa.binary())])
_DEALT_DDL = "bucket int, kind byte, rows binary"
MEET, HOME, HOT = 0, 1, 2


def _sent(found: list[tuple[int, int, tuple]]) -> pa.RecordBatch:
    columns = zip(*((b, kind, _pack(x)) for b, kind, x in found), strict=True) if found else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _DEALT, strict=True)], schema=_DEALT)


def _homes(docs: Docs, rank: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[tuple[int, int, tuple]]:
    """Rows of (document, columns...) for the buckets where documents are put together again."""
    home = _bucket(docs[1] ^ docs[2], buckets)[rank] if len(rank) else rank
    out = []
    for b, some in _by_bucket(home):
        of, place = _chosen(docs, rank[some])
        out.append((b, HOME, (of, place, *(c[some] for c in columns))))
    return out


def _table(found: list[tuple[int, int, tuple]]) -> pa.Table:
    return pa.Table.from_batches([_sent(found)])


def _parts(table: pa.Table, kind: int) -> list[tuple]:
    return _unpack(table.filter(pa.compute.equal(table.column("kind"), kind)).column("rows"))


_PER_DOC = pa.schema([("z", pa.int32()), ("k", pa.int64()), ("h", pa.int64()), ("of", pa.binary())])
_PER_DOC_DDL = "z int, k long, h long, of binary"


def _per_document(dealt: DataFrame, merge: Callable[[list[np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """One row per document: its key and ``of``, the packed columns of all its rows, made fewer by ``merge``."""

    def one(table: pa.Table) -> pa.Table:
        docs, (rank, *columns) = _gathered(_parts(table, HOME))
        rank, *columns = merge([rank, *columns])
        first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))) if len(rank) else rank
        of = [pickle.dumps(tuple(x), 5) for x in zip(*(np.split(c, first[1:]) for c in columns), strict=True)] if len(rank) else []
        arrays = [*(pa.array(x[rank[first]]) for x in docs), pa.array(of, pa.binary())]
        return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(arrays, _PER_DOC, strict=True)], schema=_PER_DOC)

    return dealt.where(F.col("kind") == HOME).groupBy("bucket").applyInArrow(tidied_group(one), _PER_DOC_DDL)


def _merged(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (document, begin, end) in order, with overlapping and touching spans of a document made one."""
    rank, begin, end = columns
    order = np.lexsort((begin, rank))
    rank, begin, end = rank[order], begin[order].astype(np.int64), end[order].astype(np.int64)
    if not len(rank):
        return [rank, begin, end]
    far = np.int64(1 << 32)
    reach = np.maximum.accumulate(end + rank * far) - rank * far  # documents ascend, so one never reaches into the next
    new = np.concatenate(([True], (rank[1:] != rank[:-1]) | (begin[1:] > reach[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(rank)])) - 1
    return [rank[first], begin[first], reach[last]]


def _runs_once(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (document, first, windows, sample) in order, each once."""
    order = np.lexsort((columns[1], columns[0]))
    rank, first = columns[0][order], columns[1][order]
    new = np.concatenate(([True], (rank[1:] != rank[:-1]) | (first[1:] != first[:-1]))) if len(order) else np.zeros(0, bool)
    return [c[order][new] for c in columns]


# --- pass one: which samples are shared --------------------------------------------------------------------------


def _sampled(of: Windows, buckets: int) -> Callable:
    """Of each slice: its samples for the buckets where they meet, and the runs that are known to share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, SLICE_BYTES):
            docs, rank = _ranked(_docs(batch))
            tokens, ends = of.tokens(batch.column(3).fill_null(""))
            found = []
            for doc, begin, end in zip(rank.tolist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                if end - begin >= of.width:
                    key, first, count, many = w.runs(tokens[begin:end], of.width, of.gram, of.longest_run)
                    found.append((np.full(len(key), doc, np.int32), key, first.astype(np.int32), (2 * count + many).astype(np.int32)))
            if not found:
                continue
            # windows twice, plus one if the run may hold a window several times
            doc, key, first, count = (np.concatenate([x[i] for x in found]) for i in range(4))
            order = np.argsort(key, kind="stable")
            doc, key, first, count = (x[order] for x in (doc, key, first, count))
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.concatenate((begin, [len(key)])))
            alone = size == 1
            one, more = begin[alone], begin[~alone]
            known = (count % 2 == 1) | (np.repeat(size, size) > 1)
            out = _homes(docs, doc[known], [first[known], count[known], key[known]], buckets)
            where = _bucket(key[begin], buckets)
            where_one, where_more = where[alone], where[~alone]
            rest = dict(_by_bucket(where_more))
            none = np.zeros(0, np.int64)
            for b, some in _by_bucket(where_one):
                at, others = one[some], rest.pop(b, none)
                used, place = _chosen(docs, doc[at])
                out.append((b, MEET, (used, place, key[at], first[at], count[at], key[more[others]], size[~alone][others])))
            empty = tuple(x[:0] for x in docs)
            for b, others in rest.items():
                out.append((b, MEET, (empty, none, key[:0], first[:0], count[:0], key[more[others]], size[~alone][others])))
            yield _sent(out)

    return run


def _shared(dealt: DataFrame, of: Windows, buckets: int) -> DataFrame:
    """Brings the samples of a bucket together: the runs whose sample is shared, for their homes, and hot samples."""

    def one(table: pa.Table) -> pa.Table:
        out = _passed_on(table)
        if parts := _parts(table, MEET):
            docs, (rank, key, first, count) = _gathered([p[:5] for p in parts])
            groups, size = (np.concatenate([p[i] for p in parts]) for i in (5, 6))
            every, place = np.unique(np.concatenate((key, groups)), return_inverse=True)
            runs = np.bincount(place, weights=np.concatenate((np.ones(len(key)), size)), minlength=len(every))
            look = runs[place[: len(key)]] > 1
            out += _homes(docs, rank[look], [first[look], count[look], key[look]], buckets)
            if (hot := runs > of.most_runs).any():
                out.append((0, HOT, (every[hot], runs[hot].astype(np.int64))))
        return _table(out)

    return dealt.groupBy("bucket").applyInArrow(tidied_group(one), _DEALT_DDL)


def _passed_on(table: pa.Table) -> list[tuple[int, int, tuple]]:
    """What is on its way home already."""
    home = table.filter(pa.compute.equal(table.column("kind"), HOME))
    return [(b, HOME, x) for b, x in zip(home.column("bucket").to_pylist(), _unpack(home.column("rows")), strict=True)]


def _hot(one: DataFrame) -> np.ndarray:
    """The hot samples, sorted: at most MOST_HOT, so that they can be told to every task."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for row in one.where(F.col("kind") == HOT).select("rows").toLocalIterator():
        found.append(pickle.loads(zstandard.ZstdDecompressor().decompress(row.rows)))
        if sum(len(x[0]) for x in found) > 2 * MOST_HOT:
            found = [_largest(found)]
    return np.sort(_largest(found)[0])


def _largest(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, n = (np.concatenate([x[i] for x in found]) for i in (0, 1))
    keep = np.argsort(-n, kind="stable")[:MOST_HOT]
    return key[keep], n[keep]


# --- pass two: what the stretches hold ---------------------------------------------------------------------------


def _classes(held: list[bytes], rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, class in that order, where classes begin): equal stretches stand together, the earliest of them first."""
    code = pa.array(held, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((first, rank, code))
    begin = np.flatnonzero(np.concatenate(([True], code[order][1:] != code[order][:-1]))) if len(order) else order
    return order, code, begin


def _settled(held: list[bytes], columns: list[np.ndarray], of: Windows) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(the earliest run of each class, whether its class is known to repeat, spans that repeat).

    ``columns`` are document, first, windows, flag; the flag tells of a class that repeated in one slice already.
    """
    rank, first, count, flag = columns
    order, _, begin = _classes(held, rank, first)
    size = np.diff(np.concatenate((begin, [len(order)])))
    head = np.repeat(order[begin], size)
    itself = (rank[order] == rank[head]) & (first[order] == first[head])
    twice = (size > 1) | (np.maximum.reduceat(flag[order], begin) > 0 if len(begin) else False)
    gone = order[~itself if of.earlier else np.repeat(twice, size)]
    return order[begin], twice, [rank[gone], first[gone], first[gone] + count[gone] + of.width - 1]


def _held(of: Windows, buckets: int, hot: np.ndarray) -> Callable:
    """Of each slice its stretches, equal ones once, for the buckets where they meet, and spans that repeat within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, SLICE_BYTES // 4):
            docs, rank = _ranked(_docs(batch))
            held, found = [], []
            for doc, text, runs in zip(rank.tolist(), unpacked(batch.column(3)), batch.column(4).to_pylist(), strict=True):
                first, count, key = pickle.loads(runs)
                count, many = count // 2, count % 2
                if len(hot) and (burns := hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key).any():
                    cut = np.concatenate([np.arange(a, a + n) for a, n in zip(first[burns], count[burns], strict=True)])
                    pieces = of.cut(text, cut.tolist(), [of.width] * len(cut))
                    held += pieces
                    own = np.array([xxhash.xxh3_64_intdigest(x) for x in pieces], np.uint64)
                    found.append((np.full(len(cut), doc, np.int64), cut, np.ones(len(cut), np.int64), own, np.zeros(len(cut), np.int32)))
                    first, count, key, many = first[~burns], count[~burns], key[~burns], many[~burns]
                held += of.cut(text, first.tolist(), (count + of.width - 1).tolist())
                found.append((np.full(len(first), doc, np.int64), first, count, key, many))
            rank, first, count, key, many = (np.concatenate([x[i] for x in found]) for i in range(5))
            first, count = first.astype(np.int64), count.astype(np.int64)
            kept, twice, spans = _settled(held, [rank, first, count, np.zeros(len(rank), np.uint8)], of)
            out = _homes(docs, spans[0], [x.astype(np.int32) for x in spans[1:]], buckets)
            for b, some in _by_bucket(_bucket(key[kept], buckets)):
                at = kept[some]
                used, place = _chosen(docs, rank[at])
                bodies = [held[i] for i in at.tolist()]
                lengths = np.array([len(x) for x in bodies], np.int32)
                flag = (twice[some] + 2 * many[at]).astype(np.uint8)
                columns = (first[at].astype(np.int32), count[at].astype(np.int32), flag, key[at], lengths)
                out.append((b, MEET, (used, place, *columns, b"".join(bodies))))
            yield _sent(out)

    return run


def _compared(dealt: DataFrame, of: Windows, buckets: int) -> DataFrame:
    """Brings the stretches of a bucket together and sends the spans that repeat home."""

    def one(table: pa.Table) -> pa.Table:
        out = _passed_on(table)
        if parts := _parts(table, MEET):
            docs, (rank, first, count, flag, key, lengths) = _gathered([p[:7] for p in parts])
            bodies, at = memoryview(b"".join(p[7] for p in parts)), np.cumsum(np.concatenate(([0], lengths))).tolist()
            held = [bytes(bodies[a:b]) for a, b in zip(at, at[1:], strict=False)]
            del bodies, parts
            first, count = first.astype(np.int64), count.astype(np.int64)
            kept, twice, spans = _settled(held, [rank, first, count, flag % 2], of)
            all_spans = [spans]
            _, group, runs = np.unique(key[kept], return_inverse=True, return_counts=True)
            look = (runs[group] > 1) | (flag[kept] > 1)
            if not of.earlier:
                look &= ~(twice & (runs[group] == 1))
            some = kept[look]
            stretch, offset, label = of.equal([held[i] for i in some.tolist()], count[some])
            doc, begin = rank[some][stretch], first[some][stretch] + offset
            order = np.lexsort((begin, doc, label))
            doc, begin, label = doc[order], begin[order], label[order]
            if of.earlier and len(label):
                later = np.concatenate(([False], label[1:] == label[:-1]))
                doc, begin = doc[later], begin[later]
            all_spans.append([doc, begin, begin + of.width])
            spans = _merged([np.concatenate([x[i] for x in all_spans]) for i in range(3)])
            out += _homes(docs, spans[0], [x.astype(np.int32) for x in spans[1:]], buckets)
        return _table(out)

    return dealt.groupBy("bucket").applyInArrow(tidied_group(one), _DEALT_DDL)


def repeated(df: DataFrame, of: Windows, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(z, k, h, of) for documents with tokens covered by repeated windows; ``of`` packs the spans' begins and ends."""
    spark = df.sparkSession
    buckets = max(8, size_in_bytes(df.select(id_col, text_col)) // of.bucket_bytes)
    texts = df.select(*keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    one = stored(_shared(texts.mapInArrow(tidied(_sampled(of, buckets)), _DEALT_DDL), of, buckets), "samples")
    hot = spark.sparkContext.broadcast(_hot(one))
    look = _per_document(one, _runs_once)
    rows = packed(df, id_col, text_col).join(look, KEYS).select(*KEYS, "text", "of")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _held(of, buckets, hot.value)(batches)

    two = _compared(rows.mapInArrow(tidied(held), _DEALT_DDL), of, buckets)
    spans = stored(_per_document(two, _merged), "spans")
    forget(one)
    return spans


def with_spans(df: DataFrame, of: Windows, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(z, k, h, text, of): every document's compressed text and its packed spans (null if it has none)."""
    return packed(df, id_col, text_col).join(repeated(df, of, id_col, text_col), KEYS, "left").select(*KEYS, "text", "of")


def cover(of: bytes | None) -> list[tuple[int, int]]:
    """The spans of a row of with_spans(), in order."""
    if of is None:
        return []
    begin, end = pickle.loads(of)
    return list(zip(begin.tolist(), end.tolist(), strict=True))

"""N-gram Jaccard join: exact links between sets of word shingles, found with signature trees.

1. Every text becomes a set of 64-bit shingle hashes. Equal sets are one class, compared once.
2. Signatures decide which sets can be similar at all. Shingles are dealt by their hash into parts, more
   than the number of shingles in which similar sets of that size can differ, so similar sets have a
   part in common that isn't empty (pigeonhole); the few sets with too many empty parts add signatures of single
   shingles by the prefix rule. Sets that share a signature are put into one cluster. Shingles that stand
   in very many sets, as a line that many texts have does, aren't signed, or come last; else all those texts met.
3. A cluster falls apart where sizes and sketches, counts of elements by ranges of hashes, rule links out.
4. In each cluster the sets that share a signature are compared: pairs that bitmaps and sizes can't rule out exactly,
   in large groups found by traversing a signature tree against itself. Clusters of too many bytes are split by
   size range and salt, and block meets block.
5. Links make components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _repeats as r
from . import _windows as w
from . import sigtree
from ._util import cells, forget, size_in_bytes, slices, stored, sweep, tidied, tidied_group
from .components import components

BLOCK_BYTES = 48 << 20
SLICE_BYTES = 4 << 20
#: Stars of so many sets aren't compared by sketches in one task but go to blocks at once.
MOST_STAR = 8_000
#: Shingles are common if they stand in so many sets; of more than MOST_COMMON (256 KB) the most frequent are.
COMMON_SETS, MOST_COMMON = 200, 1 << 16
_NONE = np.zeros(0, np.uint32)
#: Bytes that a set takes in a task for each of its elements: text, hashes, bits and signatures.
SET_BYTES = 32


def shingle_sets(texts: pa.Array, n: int = 4) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles of ``n`` words; of fewer words, but not none, the whole sequence."""
    tokens, ends = w.word_tokens(pc.ascii_lower(texts.fill_null("")))
    parts = (tokens[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False))
    return [np.unique(w.chained(x, min(n, len(x)))) if len(x) else x for x in parts]


def shingles(text: bytes | None, n: int = 4) -> np.ndarray:
    return shingle_sets(pa.array([(text or b"").decode()]), n)[0]


def differ(size: int, per_cent: int) -> int:
    """In how many elements two similar sets, the larger of ``size``, can differ: |x| + |y| - 2 overlap."""
    return (100 - per_cent) * 2 * size // (100 + per_cent)


def _partner(size: int, per_cent: int) -> int:
    return 100 * size // per_cent


def _slack(size: int, per_cent: int) -> int:
    """How many more parts are signed than can differ; a set with fewer thin ones is sure to meet its like."""
    return 3 + differ(size, per_cent) // 5


def _parts(grade: int) -> int:
    """The numbers of parts that are in use: each 1.41 times the one before."""
    return int(np.ceil(2 ** (grade / 2)))


@lru_cache(maxsize=100_000)
def _scheme(size: int, per_cent: int) -> tuple[int, int]:
    """(grade, parts that are signed) for pairs whose larger set has ``size`` elements."""
    signed, grade = differ(size, per_cent) + _slack(size, per_cent), 0
    while _parts(grade) < signed:
        grade += 1
    return grade, signed


def _is_common(mixed: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which of mixed hashes have their lower half in ``common``, which is in order."""
    if not len(common):
        return np.zeros(len(mixed), bool)
    low = mixed.astype(np.uint32)
    return common[np.minimum(np.searchsorted(common, low), len(common) - 1)] == low


def signatures(x: np.ndarray, per_cent: int, common: np.ndarray = _NONE) -> np.ndarray:
    """The signatures of a set; similar but different sets have one in common.

    A pair is compared under the scheme of its larger set. That may be any size up to size * 100 / per_cent,
    so a set signs, under each number of parts that occurs there, as many parts as the largest asks for. Of the
    parts that the larger set asks for at most differ() are unequal. The equal ones have two elements or more
    unless a set has so many thin parts, of one element or none, that they may be all of them; thin parts
    aren't signed, as one frequent shingle would bring very many unlike sets together, and a set with that
    many signs single shingles by the prefix rule as well. If only one of a pair has, the other rules it out.

    Elements that are ``common`` (see _common) stay out of the parts and come last in the order of the prefix rule. Two
    sets without them differ in no more elements than with them, so as many parts are equal, and any order that
    holds for all sets serves the prefix rule; which elements are common changes what is compared, never what is linked.
    """
    size = len(x)
    if not size or not differ(_partner(size, per_cent), per_cent):
        return x[:0]
    out = []
    (low, _), (high, signed) = _scheme(size, per_cent), _scheme(_partner(size, per_cent), per_cent)
    mixed = w.mix(x)
    last = _is_common(mixed, common)
    spread = np.sort(mixed[~last])
    thin_ones = not len(spread)
    for grade in range(low, high + 1 if len(spread) else low):
        parts = _parts(grade)
        part = ((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascending, as the elements are
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        count = np.diff(np.concatenate((first, [len(spread)])))
        total = np.add.reduceat(w.mix(spread + np.uint64(grade + 1)), first)
        keep = (part[first] < min(parts, signed)) & (count > 1)
        out.append(w.mix(total[keep] ^ w.mix(part[first][keep] * np.uint64(64) + np.uint64(grade))))
        thin_ones |= min(parts, signed) - int(keep.sum()) >= _slack(size, per_cent)
    if thin_ones:
        ordered = np.concatenate((spread, np.sort(mixed[last])))
        out.append(w.mix(ordered[: size - -(-per_cent * size // 100) + 1] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.unique(np.concatenate(out))


_SETS = pa.schema([("u", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sketch", pa.binary()), ("bucket", pa.int32()), ("rows", pa.binary())])
_SETS_DDL = "u long, id long, n long, s1 long, s2 long, sketch binary, bucket int, rows binary"


def sketch(x: np.ndarray) -> np.ndarray:
    """How many elements of a set fall into each of equal ranges of hashes, up to 255: one range for each four elements or so.

    Two sets differ in at least as many elements as their sketches do in counts, and so do sketches of fewer ranges.
    """
    bits = next((b for b, most in ((6, 256), (8, 2048), (10, 16384)) if len(x) < most), 12)
    return np.minimum(np.bincount((w.mix(x) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


_COUNTED = pa.schema([("hash", pa.int64()), ("sets", pa.int64())])


def _common(rows: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Lower halves of mixed hashes, in order, of shingles that stand in very many sets, counted over all (u, text) rows.

    Equal sets in a slice count once. Whichever are common, no link is lost.
    """
    fewest = COMMON_SETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE_BYTES):
            sets = {_fingerprint(x): x for x in shingle_sets(batch.column(0), n)}
            low = w.mix(np.concatenate(list(sets.values()))).astype(np.uint32) if sets else _NONE
            out = [(b, low[some].tobytes()) for b, some in r._by_bucket((low.astype(np.int64) * buckets) >> 32)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "hashes"])

    def one(table: pa.Table) -> pa.Table:
        values, counts = np.unique(np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint32), return_counts=True)
        many = counts >= fewest
        return pa.Table.from_arrays([pa.array(values[many].astype(np.int64)), pa.array(counts[many].astype(np.int64))], schema=_COUNTED)

    hashes = rows.select("text").mapInArrow(tidied(run), "bucket int, hashes binary")
    counted = stored(hashes.groupBy("bucket").applyInArrow(tidied_group(one), "hash long, sets long"), "common")
    found = counted.orderBy(F.desc("sets"), "hash").limit(MOST_COMMON).select("hash").toArrow()
    forget(counted)
    return np.sort(found.column("hash").to_numpy().astype(np.uint32))


def _sets(rows: DataFrame, n: int, per_cent: int, buckets: int, common: np.ndarray) -> DataFrame:
    """From (u, id, text) rows of two kinds: (u, id, n, s1, s2) of a document and its set; (bucket, rows), packed signatures.

    Of equal sets in a slice only the first signs. A bucket holds 40 bits of each signature beyond those that name the
    bucket, and about as many signatures at any size of the input; a chance match costs a comparison and no more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, SLICE_BYTES):
            ids = batch.column(0).to_pylist()
            info, least, sketches = [], {}, []
            signed: dict[tuple, np.ndarray] = {}
            for i, x in enumerate(shingle_sets(batch.column(2), n)):
                kind = _fingerprint(x)
                info.append(kind)
                sketches.append(sketch(x).tobytes() if len(x) else None)
                if len(x):
                    if kind not in least:
                        signed[kind] = signatures(x, per_cent, common)
                    least[kind] = min(least.get(kind, ids[i]), ids[i])
            of = [*(pa.array([x[j] for x in info], pa.int64()) for j in range(3)), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *of, pa.nulls(len(info), pa.int32()), pa.nulls(len(info), pa.binary())], schema=_SETS)
            if not signed:
                continue
            sig = np.concatenate(list(signed.values()))
            u = np.repeat(np.array([least[x] for x in signed], np.int64), [len(x) for x in signed.values()])
            level = np.repeat(np.array([_level(x[0], per_cent) for x in signed], np.int16), [len(x) for x in signed.values()])
            rest = sig // np.uint64(buckets)
            low, high = rest.astype(np.uint32), (rest >> np.uint64(32)).astype(np.uint8)
            out = []
            for b, some in r._by_bucket((sig % np.uint64(buckets)).astype(np.int64)):
                first = np.flatnonzero(np.concatenate(([True], np.diff(u[some]) != 0)))
                runs = np.diff(np.append(first, len(some))).astype(np.int32)
                out.append((b, r._pack((low[some], high[some], u[some][first], level[some][first], runs))))
            void = [pa.nulls(len(out), f.type) for f in list(_SETS)[:6]]
            yield pa.RecordBatch.from_arrays([*void, pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], schema=_SETS)

    return rows.select("u", "id", "text").mapInArrow(tidied(run), _SETS_DDL)


def _fingerprint(x: np.ndarray) -> tuple[int, int, int]:
    """A set's size and 128 bits that tell it from others."""
    if not len(x):
        return 0, 0, 0
    return len(x), int(x.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(w.mix(x + np.uint64(7))).astype(np.int64))


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _level(size: int, per_cent: int) -> int:
    """Sets are as large as a per_cent of the next level's or more, so similar ones are on one level or on neighbouring ones."""
    return int(np.log(max(1, size)) / np.log(100 / per_cent) + 1e-9)


def _candidates(dealt: DataFrame) -> DataFrame:
    """Distinct edges (u, v) from each document to the least that shares a signature with it and is about as large.

    A set joins the group of its signature and level, and that of its signature and the next level. All who are in one
    group have an edge to its least, who is the least of its class too, as that one signs the same. So similar sets have an
    edge to the same one, or one to the other.
    """

    def one(table: pa.Table) -> pa.Table:
        parts = r._unpack(table.column("rows"))
        sig = np.concatenate([p[0] for p in parts]) | (np.concatenate([p[1] for p in parts]).astype(np.uint64) << np.uint64(32))
        runs = np.concatenate([p[4] for p in parts])
        u, level = (np.repeat(np.concatenate([p[i] for p in parts]), runs) for i in (2, 3))
        order = np.lexsort((u, sig))
        sig, u, level = sig[order], u[order], level[order]
        same = sig[1:] == sig[:-1]
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
        sig, u, level = sig[shared], u[shared], level[shared]
        sig, u, level = np.concatenate((sig, sig)), np.concatenate((u, u)), np.concatenate((level, level + 1))
        order = np.lexsort((u, level, sig))
        sig, u, level = sig[order], u[order], level[order]
        begin = np.flatnonzero(np.concatenate(([True], (sig[1:] != sig[:-1]) | (level[1:] != level[:-1])))) if len(sig) else np.zeros(0, np.int64)
        head = np.repeat(u[begin], np.diff(np.concatenate((begin, [len(sig)]))))
        other = u != head
        edges = np.unique(np.stack([u[other], head[other]], axis=1), axis=0)
        return pa.Table.from_arrays([pa.array(np.ascontiguousarray(edges[:, i])) for i in range(2)], schema=_EDGES)

    return dealt.select("bucket", "rows").groupBy("bucket").applyInArrow(tidied_group(one), "u long, v long").distinct()


def _close(sizes: np.ndarray, sketches: list[bytes], per_cent: int) -> np.ndarray:
    """Of each set the number of the first one that it's joined with by a chain of pairs whose sizes and sketches allow a link.

    All are compared with the first one, and those that can't be linked with it with all.
    """
    n = len(sizes)
    width = np.array([len(x) for x in sketches])
    rows = [np.frombuffer(x, np.uint8) for x in sketches]
    fold = lambda x, to: np.minimum(x.reshape(to, -1).sum(axis=1, dtype=np.int32), 255)
    #: Of each width, who is as wide at least, and their sketches of that width.
    tables = {w: (np.flatnonzero(width >= w), np.stack([fold(x, w) for x in rows if len(x) >= w]).astype(np.int16)) for w in set(width.tolist())}

    def near(i: int) -> np.ndarray:
        differ = np.zeros(n, np.int64)
        for w, (who, table) in tables.items():
            if w <= width[i]:
                some = np.minimum(width[who], width[i]) == w
                differ[who[some]] = np.abs(table[some] - fold(rows[i], w).astype(np.int16)).sum(axis=1, dtype=np.int64)
        both = (sizes + sizes[i] - differ) // 2  # the overlap at most
        return 100 * both >= per_cent * (sizes + sizes[i] - both)

    label = np.where(near(0), 0, np.arange(n))
    for i in np.flatnonzero(label != 0).tolist():
        close = near(i)
        close[i] = True
        joined = np.unique(label[close])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    return label


_MEMBERS = pa.schema([("u", pa.int64()), ("cluster", pa.int64()), ("size", pa.int64())])


def _likely(stars: DataFrame, per_cent: int, tasks: int) -> DataFrame:
    """(u, cluster, size) of the clusters that are left of stars (cluster, u, size, sketch), named by their least member.

    Stars fall apart where sketches rule links out, and sets that are left alone go. What is left of different stars and
    has the same least member is one cluster.
    """

    def one(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("u").to_numpy(), table.column("cluster").to_numpy()))
        table = table.take(order)
        cluster, u, size = (table.column(c).to_numpy() for c in ("cluster", "u", "size"))
        sketches = table.column("sketch").to_pylist()
        cuts = [0, *(np.flatnonzero(np.diff(cluster)) + 1).tolist(), len(cluster)] if len(cluster) else [0]
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            label = _close(size[a:b], sketches[a:b], per_cent)
            some = np.bincount(label, minlength=b - a)[label] > 1
            out.append((u[a:b][some], u[a + label[some]], size[a:b][some]))
        columns = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(3)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_MEMBERS)

    dealt = stars.select(F.pmod(F.xxhash64("cluster"), F.lit(tasks)).alias("task"), "cluster", "u", "size", "sketch")
    return dealt.groupBy("task").applyInArrow(tidied_group(one), "u long, cluster long, size long").distinct()


def _tasks(members: DataFrame, per_cent: int, block_bytes: int, tasks: int) -> DataFrame:
    """(u, cluster, tasks) from (u, cluster, size): the names of the groups in which each set is compared.

    Clusters within ``block_bytes`` are dealt to ``tasks`` groups and compared one by one. A larger one is split:
    sets of one size range (each a per_cent of the next) are salted into blocks, and every two blocks of the same or
    neighbouring ranges make a group, so that all pairs that can be similar meet, and no group is larger than two blocks.
    """
    level = F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / F.lit(float(np.log(100 / per_cent)))).cast("int")
    rows = members.withColumn("level", level)
    sums = rows.groupBy("cluster", "level").agg(F.sum(F.col("size") * SET_BYTES + 500).alias("bytes"))
    salts = F.struct("level", F.ceil(F.col("bytes") / block_bytes).cast("int").alias("salts"))
    whole = stored(sums.groupBy("cluster").agg(F.sum("bytes").alias("bytes"), F.map_from_entries(F.collect_list(salts)).alias("salts")), "cluster-sizes")
    rows = rows.join(whole, "cluster")
    own = F.concat_ws(".", "level", F.pmod(F.xxhash64("u"), F.element_at("salts", F.col("level"))))

    def blocks(i: Column) -> Column:
        """The names of all blocks of a level, none if it has no sets."""
        many = F.coalesce(F.try_element_at("salts", i), F.lit(0))
        names = F.transform(F.sequence(F.lit(0), F.greatest(many - 1, F.lit(0))), lambda s: F.concat_ws(".", i, s))
        return F.when(many > 0, names).otherwise(F.array().cast("array<string>"))

    around = F.flatten(F.transform(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1), blocks))
    pairs = F.array_distinct(F.transform(around, lambda x: F.concat_ws("-", F.least(x, own), F.greatest(x, own))))
    task = F.when(F.col("bytes") <= block_bytes, F.array(F.pmod(F.xxhash64("cluster"), F.lit(tasks)).cast("string")))
    named = F.transform(pairs, lambda x: F.concat_ws("-", F.col("cluster").cast("string"), x))
    return rows.select("u", "cluster", F.coalesce(task, named).alias("tasks"))


def _links(members: DataFrame, texts: DataFrame, n: int, per_cent: int, block_bytes: int, tasks: int) -> DataFrame:
    """Edges (u, v) of the components within each cluster, from (u, cluster, size) and (u, text). Texts are fetched by number, never by cluster."""
    planned = _tasks(members, per_cent, block_bytes, tasks).join(texts, "u")
    grouped = planned.select("cluster", F.explode("tasks").alias("task"), "u", "text")

    def one(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("u").to_numpy(), table.column("cluster").to_numpy()))
        table = table.select(["cluster", "u", "text"]).take(order)
        cluster, u = table.column("cluster").to_numpy(), table.column("u").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cluster)) + 1).tolist(), len(cluster)] if len(cluster) else [0]
        edges = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            texts = pa.array([t.decode() for t in r.unpacked(table.column("text").slice(a, b - a).combine_chunks())], pa.large_string())
            sets = shingle_sets(texts, n)
            head = sigtree.group(sets, per_cent, [signatures(x, per_cent) for x in sets])
            linked = head != np.arange(b - a)
            edges.append((u[a:b][linked], u[a + head[linked]]))
        columns = [np.concatenate([e[i] for e in edges]) if edges else np.zeros(0, np.int64) for i in range(2)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_EDGES)

    return grouped.groupBy("task").applyInArrow(tidied_group(one), "u long, v long")


def _squeezed(rows: DataFrame) -> DataFrame:
    """(u, text) with texts compressed, for a join that must shuffle them."""
    schema = pa.schema([("u", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in slices(batches, 1, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([squeeze(t or b"") for t in cells(batch.column(1))], pa.binary())], schema=schema)

    return rows.select("u", "text").mapInArrow(tidied(run), "u long, text binary")


def linked(
    df: DataFrame,
    n: int = 4,
    per_cent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    bucket_bytes: int = 8 << 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id, ``kept`` (whether it answers for its component) and ``row``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the distinct shingles of ``n`` words, or
    the whole sequence where there are fewer. Two rows are linked when 100 * overlap >= per_cent * union.
    component_id is the least id within reach, itself included. Null or empty texts have an empty set and
    are linked with nothing. Ids are whole numbers or null; a null id counts as the smallest and comes out as null. Every
    row is a document of its own: repeated rows are linked as equal texts are, and one of them is kept. Other
    columns aren't read. An empty table gives no rows.

    ``row`` numbers the rows. ``row_col`` may name a column that does so already, if ``df`` is a stored table whose
    rows come out the same each time; else numbers are given here, and the rows are written to the shared folder.
    """
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    rows = df.select(number.cast("long").alias("u"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    buckets = max(8, size_in_bytes(df.select(id_col, text_col)) // bucket_bytes)
    if row_col is None:
        rows = stored(rows, "rows")
    common = _common(rows, n, buckets)
    sweep(df.sparkSession)
    dealt = stored(_sets(rows, n, per_cent, buckets, common), "sets")
    sets = stored(dealt.where("bucket IS NULL").drop("bucket", "rows"), "set-sizes")
    least = F.struct(F.col("id").isNotNull().cast("int").alias("has"), "id", "u")
    info = sets.select("u", "id", "n", "s1", "s2")
    classes = stored(info.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("u").alias("rep"), F.min(least).alias("least")), "classes")
    reps = classes.select(F.col("rep").alias("u"), F.col("n").alias("size"))
    edges = stored(_candidates(dealt.where("bucket IS NOT NULL")).join(reps, "u").select("u", F.col("v").alias("cluster"), "size"), "stars")
    forget(dealt)  # signatures aren't read any more
    sweep(df.sparkSession)
    heads = edges.select(F.col("cluster").alias("u")).distinct().join(reps, "u").select("u", F.col("u").alias("cluster"), "size")
    stars = edges.unionByName(heads)
    large = stored(edges.groupBy("cluster").agg(F.count("*").alias("rows")).where(F.col("rows") >= MOST_STAR).select("cluster"), "large-stars")
    likely = stars.join(large, "cluster", "left_anti").join(sets.where("sketch IS NOT NULL").select("u", "sketch"), "u")
    members = stored(_likely(likely, per_cent, buckets).unionByName(stars.join(large, "cluster", "left_semi").select("u", "cluster", "size")), "members")
    forget(edges, large)
    sweep(df.sparkSession)
    same = components(_links(members, _squeezed(rows), n, per_cent, block_bytes, buckets)).select(F.col("u").alias("rep"), "root")
    rooted = classes.join(same, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    answers = rooted.join(first, "root").select("n", "s1", "s2", "first")
    out = info.join(answers, ["n", "s1", "s2"], "left").withColumn("first", F.coalesce("first", least))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("first.id").alias("component_id"),
        (F.col("u") == F.col("first.u")).alias("kept"),
        F.col("u").alias("row"),
    )

import base64
import glob
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from snapledger.llm import _windows, bpe, decontam, jaccard, licenses, pii, quality, radix, sigtree, substrings, tokenfiles, urlgraph
from snapledger.llm._util import fresh_path
from snapledger.llm.components import components

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 997} Über{i % 31}" for i in range(20_000))
# null and repeated ids, repeated rows, null, empty and long texts, and columns that clash with results and inner names
EDGES = [(1, "one two three four five six seven eight nine ten eleven"), (1, "one two three four five six seven eight nine ten eleven"), (2, None), (None, "lone text with a null id"), (None, None), (3, ""), (3, " \n\t "), (4, LONG), (5, LONG)]
CLASH = "doc_id long, text string, k string, h string, n_words string, spans string, kept string, id string, row string, n_entities string, kinds string, component_id string, value string, bucket string, found string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *["x"] * 13) for r in rows], CLASH).repartition(parts) if rows else spark.createDataFrame([], CLASH)


OPERATORS = {
    "substrings": substrings.remove_repeats, "radix": radix.remove_repeats, "quality": quality.judge, "bpe": lambda d: bpe.round_trip(d, RANKS, P.PATTERN), "jaccard": lambda d: jaccard.linked(d).drop("kept", "row"),
    "licenses": lambda d: licenses.digest(licenses.scan(d)), "decontam": lambda d: decontam.digest(decontam.contamination(d, d.selectExpr("doc_id AS item_id", "'seven eight nine ten' AS text").limit(1))), "pii": lambda d: pii.replace(d, "key"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    got = OPERATORS[name](table(spark, EDGES)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((i is None, i) for i, _ in EDGES)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0] == by[1][1]
    if name == "substrings":
        assert [(r.n_words, r.n_removed) for r in (*by[1], *by[2], *by[4], *by[5])] == [(11, 0), (11, 0), (0, 0), (40_000, 40_000), (40_000, 40_000)]
    if name == "radix":
        size = len(LONG.encode())
        assert by[2][0].kept_sha256 == hashlib.sha256(b"").hexdigest() and by[5][0].n_removed == size and by[5][0].n_spans == 1 and by[4][0].n_bytes == size
    if name == "jaccard":
        assert [r.component_id for r in (*by[1], *by[2], *by[4], *by[5])] == [1, 1, 2, 4, 4] and {r.n_shingles for r in by[3]} == {0}
    if name == "quality":
        assert by[2][0].base_failed and by[1][0].kept
    if name == "decontam":
        assert by[1][0].n_hit == 4 and by[1][0].items_sha256 and by[2][0].n_words == 0
    assert OPERATORS[name](table(spark, [])).collect() == []


def test_token_files(spark):
    path = fresh_path(spark, "t")
    tokenfiles.write_token_files(table(spark, EDGES), path, WORDS, bytes_per_file=1 << 14)
    rows = sorted(tokenfiles.read_tokens(spark, path).collect(), key=lambda r: r.start)
    library, at = Tokenizer.from_file(WORDS), 0
    assert [r.doc_id for r in rows][:2] == [None, None] and [r.doc_id for r in rows][2:] == sorted(i for i, _ in EDGES if i)
    want = sorted(tuple([*library.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in EDGES)
    assert sorted(tuple(r.ids) for r in rows) == want
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in tokenfiles.checksums(tokenfiles.read_tokens(spark, path)).collect()}
    assert all(sums[r.doc_id, r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    assert tokenfiles.read_tokens(spark, path, ids=False).columns == ["doc_id", "start", "n_tokens"]
    tokenfiles.write_token_files(table(spark, []), path + "-none", WORDS, encoding="delta")
    assert tokenfiles.read_tokens(spark, path + "-none").count() == 0


ODD = [
    "İstanbul ΣΑΣ ﬁne don't can't'll x'smart 'S it's <|endoftext|>hi", "Å ÅÅÅ ...abc... (İİ) \"É\"", "a\x1cb\x85c 𝔘𝔫 ½ ² ٣٤ \x00", "ﾊﾞ ｶﾞ", "e\u0301 <\u0338 \u0301x",
    "a <|endoftext|> b", '"<|endoftext|>"', "x <|startoftext|>, y", "(<|endoftext|>)!", "<|EndOfText|> <|endoftext|><|startoftext|>", "endoftext <| endoftext |>",
]


def encoded(own, texts):
    ids, ends = own.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends], ends, strict=False)]


def wanted(library, texts):
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_encoded_as_the_library_does():
    library, own = Tokenizer.from_file(WORDS), tokenfiles.encoder(WORDS)
    assert isinstance(own, tokenfiles.WordEncoder)
    odd = ["", " \t", *ODD, " a  b\x0b\x0cc\r\n\n", ""]
    assert encoded(own, odd) == wanted(library, odd) == [encoded(own, [t])[0] for t in odd] and encoded(own, []) == []
    assert encoded(own, ["a <|endoftext|> b"]) == [[320, 49407, 321]]
    ids, ends = own.encode(pa.array(["x", "a b", None, "c"]).slice(1, 3).fill_null(""))
    assert ids[: ends[0]].tolist() == wanted(library, ["a b"])[0] and ends[1] == ends[0]


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr(tokenfiles, "KEPT_BYTES", 3000)
    library, own, rng = Tokenizer.from_file(WORDS), tokenfiles.WordEncoder(Tokenizer.from_file(WORDS)), random.Random(1)
    for _ in range(60):
        texts = [" ".join(rng.choice(["Wörd", "plain", "End.", "$$$", "x%d" % rng.randrange(50), "<|endoftext|>"]) for _ in range(30)) for _ in range(3)]
        assert encoded(own, texts) == wanted(library, texts)


def test_other_tokenizers_are_used_as_they_are():
    other = P.path("byte_bpe_50k.json")
    own = tokenfiles.encoder(other)
    assert not isinstance(own, tokenfiles.WordEncoder) and encoded(own, ODD) == wanted(Tokenizer.from_file(other), ODD)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_have_the_encodings_and_page_indexes_asked_for(spark, encoding):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(30_000)}" for _ in range(60))) for i in range(6000)]
    path = fresh_path(spark, "layout")
    tokenfiles.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, WORDS, encoding=encoding, row_group_bytes=1 << 16, page_rows=100)
    files = sorted(glob.glob(f"{path.removeprefix('file://')}/*.parquet"))
    assert len(files) >= 4
    last = -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        assert len(groups) > 1
        for g in groups:
            columns = {g.column(j).path_in_schema.split(".")[0]: g.column(j) for j in range(g.num_columns)}
            assert columns["doc_id"].statistics.min > last and all(c.has_offset_index and c.has_column_index for c in columns.values())
            last = columns["doc_id"].statistics.max
            kinds = set(columns["ids"].encodings)
            assert ("RLE_DICTIONARY" in kinds or "PLAIN_DICTIONARY" in kinds) if encoding == "dictionary" else "DELTA_BINARY_PACKED" in kinds
    plan = tokenfiles.read_tokens(spark, path, ids=False).where("doc_id BETWEEN 100 AND 120")
    assert "ids" not in plan._jdf.queryExecution().executedPlan().toString() and plan.count() == 21


def test_token_files_follow_the_size_of_the_input(spark):
    rng = random.Random(6)
    path = fresh_path(spark, "input")
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(400)), "en", "web", 4000) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(path)
    size = sum(len(open(f, "rb").read()) for f in glob.glob(f"{path.removeprefix('file://')}/*.parquet"))
    tokenfiles.write_token_files(spark.read.parquet(path), path + "-out", WORDS, bytes_per_file=size // 20)
    assert len(glob.glob(f"{path.removeprefix('file://')}-out/*.parquet")) >= 18


def test_texts_and_ids_cross_in_small_batches(spark, monkeypatch):
    class Counted:
        def encode(self, texts):
            return np.full(len(texts), len(texts), np.int32), np.arange(1, len(texts) + 1)

    def lengths(rows, id_col):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

        return rows.mapInArrow(run, "n long")

    path, before = fresh_path(spark, "batches"), {k: spark.conf.get(k) for k in tokenfiles.BATCHES}
    df = spark.createDataFrame([(i, "x" * 5000) for i in range(2000)], "doc_id long, text string").repartition(3)
    monkeypatch.setitem(tokenfiles.BATCHES, "spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 16))
    with monkeypatch.context() as m:
        m.setattr(tokenfiles, "encoder", lambda _: Counted())
        tokenfiles.write_token_files(df, path, WORDS)
    assert max(r.ids[0] for r in tokenfiles.read_tokens(spark, path).collect()) <= 20
    tokenfiles.write_token_files(df.selectExpr("doc_id", "repeat('a ', 5000) AS text"), path + "-long", WORDS)
    with monkeypatch.context() as m:
        m.setattr(tokenfiles, "checksums", lengths)
        assert max(r.n for r in tokenfiles.digest(spark, path + "-long").collect()) <= 20
    got = {(r.doc_id, r.start, r.n_tokens) for r in tokenfiles.digest(spark, path + "-long").collect()}
    assert got == {(i, i * 5001, 5001) for i in range(2000)}
    with pytest.raises(Exception):
        tokenfiles.write_token_files(df, path, WORDS)  # the folder exists
    assert {k: spark.conf.get(k) for k in before} == before
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "77")
    with tokenfiles.small_batches(spark):
        assert {k: spark.conf.get(k) for k in before} == tokenfiles.BATCHES | {"spark.sql.parquet.columnarReaderBatchSize": "77"}
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "77"
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")


def test_long_white_space_does_not_stop_the_library():
    encoder, blank = bpe.encoding(RANKS, P.PATTERN), re.compile(r"\s{3,}")
    random.seed(2)
    for _ in range(500):
        t = "".join(random.choice(["a", " ", "   ", "\n\n\n\n", "1", "'s", "\u3000\u3000", "\x85", "日"]) for _ in range(random.randint(0, 40)))
        assert "".join(x for x, _ in bpe.matches(t, 5, blank)) == t and bpe.encode(t, encoder, 5, blank) == encoder.encode_ordinary(t)
    for t in (" " * 1_000_000 + "x", "x" + "\n" * 1_000_000, " \n" * 500_000 + "y", "a" * 1_000_000):
        assert encoder.decode_bytes(bpe.encode(t, encoder)) == t.encode()
    t = " " * 60_000 + "x"
    assert bpe.encode(t, encoder, 1000) == encoder.encode_ordinary(t)
    long = LONG * 3
    assert len(long) > 2 * bpe.LONG and bpe.encode(long, encoder) == encoder.encode_ordinary(long)


def brute_bytes(docs, width):
    seen, out = set(), []
    for i, t in sorted(docs):
        gone = bytearray(len(t))
        for s in range(len(t) - width + 1):
            if t[s : s + width] in seen:
                gone[s : s + width] = b"\1" * width
            seen.add(t[s : s + width])
        out.append((i, len(t), sum(gone), bytes(c for c, x in zip(t, gone, strict=True) if not x)))
    return out


def brute_words(docs, width):
    places = {}
    split = {i: t.split() for i, t in docs}
    for i, ws in split.items():
        for s in range(len(ws) - width + 1):
            places.setdefault(tuple(ws[s : s + width]), []).append((i, s))
    gone = {i: set() for i in split}
    for of in places.values():
        if len(of) > 1:
            for i, s in of:
                gone[i] |= set(range(s, s + width))
    return sorted((i, len(ws), len(gone[i]), b" ".join(w for j, w in enumerate(ws) if j not in gone[i]).decode()) for i, ws in split.items())


@pytest.mark.parametrize("width, seed", [(100, 1), (20, 2), (7, 3)])
def test_repeats_against_brute_force(spark, width, seed):
    rng = random.Random(seed)
    base = [bytes(rng.choice(b"abcdefgh ") for _ in range(rng.choice([0, 5, width - 1, width, width + 1, 3 * width, 400]))) for _ in range(20)]
    docs = []
    for i in range(50):
        x = rng.choice(base)
        if rng.random() < 0.5:
            y, p = rng.choice(base), rng.randint(0, len(x))
            x = x[:p] + y[: rng.randint(0, len(y))] + x[p:]
        if rng.random() < 0.2:
            x += b"ab " * rng.randint(0, 100)  # repeats itself
        docs.append((i, x))
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string").repartition(5)
    for most_runs in (20_000, 2):  # with and without samples that are cut into single windows
        got = radix.remove_repeats(df, width, most_runs=most_runs).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == brute_bytes(docs, width)
        words = max(3, width // 7)
        got = substrings.remove_repeats(df, words, most=40, most_runs=most_runs).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_words(docs, words)


def test_trees_and_digit_passes_find_equal_windows():
    rng = np.random.default_rng(3)
    for trial in range(200):
        width = int(rng.integers(1, 12))
        letters = [b"a", b"b", b"c"][: int(rng.integers(1, 4))]
        held = [[letters[i] for i in rng.integers(0, len(letters), int(rng.integers(width, 40)))] for _ in range(int(rng.integers(0, 8)))]
        counts = np.array([int(rng.integers(1, len(x) - width + 2)) for x in held], np.int64)
        places = {}
        for i, x in enumerate(held):
            for j in range(counts[i]):
                places.setdefault(tuple(x[j : j + width]), set()).add((i, j))
        want = sorted(sorted(of) for of in places.values() if len(of) > 1)
        for found in (radix.equal_windows([b"".join(x) for x in held], counts, width), substrings.equal_windows([b" ".join(x) for x in held], counts, width, most=5)):
            groups = {}
            for i, j, g in zip(*(x.tolist() for x in found), strict=True):
                groups.setdefault(g, []).append((i, j))
            assert sorted(map(sorted, groups.values())) == want


def test_groups_share_their_prefix_and_are_small():
    rng = np.random.default_rng(4)
    words = rng.choice(4, 3000, p=[0.7, 0.1, 0.1, 0.1])
    got = list(substrings.prefix_groups(words, np.arange(2900), 20, most=50))
    assert sorted(i for some, _ in got for i in some.tolist()) == list(range(2900)) and max(len(some) for some, _ in got) <= 50
    assert len({depth for _, depth in got}) > 1 and all(len(np.unique(words[some[:, None] + np.arange(depth)], axis=0)) == 1 for some, depth in got if depth)


def test_texts_whose_polynomials_collide_stay_apart(spark):
    word = "a"
    for _ in range(11):  # Thue-Morse
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"{word} {tail}"), (2, f"{other} {tail}")], "doc_id long, text string")
    assert [r.n_removed for r in substrings.remove_repeats(df).collect()] == [40, 40]
    assert len(np.intersect1d(jaccard.shingles(word.encode()), jaccard.shingles(other.encode()))) == 0


def test_documents_without_an_id_and_the_least_id(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(None, f"x{i} {a} y{i}" if i < 2 else f"lone{i} {b[: 20 + i]}") for i in range(6)] + [(-(1 << 63), f"{a} z"), (0, "other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in got) == sorted((i is None, i or 0, 50 if a in t else 0) for i, t in rows)
    got = radix.remove_repeats(df).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [-(1 << 63), 0] and sum(r.n_removed > 0 for r in got) == 2
    assert [r.n_removed for r in got if r.doc_id is not None and r.doc_id < 0] == [len(a) + 1]  # with the space behind it; a null id is the smallest


def brute_links(docs, n, per_cent):
    sets = []
    for _, t in docs:
        ws = (t or "").lower().split()
        sets.append({tuple(ws[j : j + n]) for j in range(max(1, len(ws) - n + 1))} if ws else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= per_cent * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return [(docs[i][0], len(sets[i]), docs[find(i)][0]) for i in range(len(docs))]


@pytest.mark.parametrize("block_bytes, most_star", [(16 << 20, 20_000), (3000, 3)])
def test_jaccard_against_brute_force(spark, block_bytes, most_star, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_STAR", most_star)
    rng, words, docs = random.Random(2), [f"w{i}" for i in range(60)], []
    for i in range(250):
        ws = rng.choice(docs)[1].split() if docs and rng.random() < 0.7 else [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 5, 10, 20, 60, 150]))]
        for _ in range(rng.randint(0, 4)):
            if ws and docs:
                q = rng.randrange(len(ws))
                ws = ws[:q] + [rng.choice(words)] * rng.randint(0, 1) + ws[q + rng.randint(0, 1) :]
        docs.append((i, " ".join(ws)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(df, block_bytes=block_bytes).collect()) == brute_links(docs, 4, 85)


def test_one_row_of_each_component_is_kept(spark):
    got = jaccard.linked(table(spark, EDGES)).collect()
    assert len({r.row for r in got}) == len(got)
    kept = sorted((r.component_id is None, r.component_id or 0, r.doc_id or 0) for r in got if r.kept)
    assert kept == [(False, 1, 1), (False, 2, 2), (False, 3, 3), (False, 3, 3), (False, 4, 4), (True, 0, 0), (True, 0, 0)]


def test_signatures_lose_no_similar_pair():
    rng = np.random.default_rng(1)
    draw = lambda n: rng.integers(1, 1 << 62, n, dtype=np.int64).astype(np.uint64)
    tried = 0
    for _ in range(3000):
        size = int(rng.choice([6, 7, 8, 10, 14, 20, 33, 50, 100, 300]))
        x, d = draw(size), int(rng.integers(0, jaccard.differ(int(size / 0.85) + 1, 85) + 1))
        cut = int(rng.integers(0, d + 1))
        x, y = np.unique(x), np.unique(np.concatenate([x[cut:], draw(d - cut)]))
        if sigtree.similar(x, y, 85) and not np.array_equal(x, y):
            tried += 1
            assert len(np.intersect1d(jaccard.signatures(x, 85), jaccard.signatures(y, 85)))
    assert tried > 1000


def test_sketches_rule_out_no_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.choice([5, 30, 200, 1000, 1100, 5000]))
        base = rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)
        sets = [np.unique(rng.choice(base, int(size * rng.uniform(0.7, 1.3)), replace=False)) for _ in range(3)] + [np.unique(base[: size - i * size // 20]) for i in range(3)]
        label = jaccard._close(np.array([len(x) for x in sets]), [jaccard.sketch(x).tobytes() for x in sets], 80)
        assert all(label[i] == label[j] for i in range(6) for j in range(6) if sigtree.similar(sets[i], sets[j], 80))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(300, 340)] + [(0, i) for i in range(400, 500)]
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if find(x) != x}


def test_automaton_against_brute_force():
    rng = random.Random(5)
    for trial in range(800):
        words, width = [b"a", b"b", b"c"][: rng.choice([2, 3])], rng.choice([1, 3, 5, 10])
        items = [(str(k), [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 4, 12, 20] if trial % 2 else [0, 10, 12, 20]))]) for k in range(rng.randint(0, 4))]
        doc = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if items and trial % 3:
            p = rng.randint(0, len(doc))
            doc = doc[:p] + items[0][1] + doc[p:]
        hit, found = [0] * len(doc), set()
        for name, ws in items:
            size = min(len(ws), width)
            for i in range(len(ws) - size + 1) if ws else ():
                for j in range(len(doc) - size + 1):
                    if doc[j : j + size] == ws[i : i + size]:
                        found.add(name)
                        hit[j : j + size] = [1] * size
        automaton = decontam.Automaton(items, width)
        spans, got = automaton.spans(doc)
        assert (sum(b - a for a, b in spans), {automaton.names[k] for k in got}) == (sum(hit), found)


def test_columns_called_found_stay(spark):
    df = spark.createDataFrame([(1, "x alpha beta gamma y and some more words", "own", 7)], "doc_id long, text string, Found string, found_ long")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    out = decontam.remove_spans(df, items)
    assert out.columns == df.columns and out.first().asDict() == {"doc_id": 1, "text": "x  y and some more words", "Found": "own", "found_": 7}
    assert decontam.digest(decontam.contamination(df, items)).first().n_hit == 3


def test_decontamination_by_blocks_and_removal(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma"), (2, "Delta, epsilon"), (3, None), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x ALPHA, beta gamma y delta epsilon z and more words here"), (2, "alpha beta gamma"), (3, None), (4, "clean words")], "doc_id long, text string")
    one = decontam.digest(decontam.contamination(docs, items)).collect()
    assert sorted(one) == sorted(decontam.digest(decontam.contamination(docs, items, block_words=1)).collect())
    assert {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in one} == {1: (5, 2, True), 2: (3, 1, True), 3: (0, 0, False), 4: (0, 0, False)}
    left = {r.doc_id: r.text for r in decontam.remove_spans(docs, items).collect()}
    assert left == {1: "x  y  z and more words here", 3: None, 4: "clean words"} == {r.doc_id: r.text for r in decontam.remove_spans(docs, items, block_words=1).collect()}


def test_quality_statistics_and_cascade(spark):
    text = "a b c d e a b c d e x\nline one\n\nline one\n#$ !"
    page = quality.Page(text.encode())
    assert (page.n_words, page.word_chars, page.n_symbols, page.n_dup_lines, page.n_repeat_words) == (17, 28, 2, 1, 10)
    junk, fine = "# $ % & * " * 9, "Plain words that make a clean and ordinary document of more than ten words."
    figures = {"too_few_words": (1.0, 0.5), "repeated_windows": (9.0, 0.9), "symbols": (1.0, 0.05)}
    assert [r.name for r in quality.cascade(quality.BASE + quality.MORE[:1], figures)] == ["too_few_words", "repeated_windows", "symbols"]
    left = quality.filter_quality(table(spark, [(1, junk), (2, fine), (3, None), (4, "A! B! " * 9), (5, "same line here again\n" * 9), (2, fine)]))
    assert [r.doc_id for r in left.collect()] == [2, 2] and len(left.columns) == 15
    assert quality.filter_quality(table(spark, [])).count() == 0


def test_prose_rules_and_samples_by_file(spark, tmp_path):
    fine = b"The cat that sat on the mat and the dog.\nIt is what it has to be..."
    assert quality.rejected_by(fine, quality.PROSE[:3]) is None and quality.rejected_by(fine, quality.PROSE) == "ellipses"
    assert quality.rejected_by(b"- the and\n* the and\n", quality.PROSE[2:]) == "bullets" and quality.rejected_by("12 34 56 é".encode(), quality.PROSE) == "few_letters"
    assert quality.rejected_by(b"cat mat dog", quality.PROSE) == "no_stop_words"
    spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'few' ELSE repeat('enough words of some kind ', 5) END AS text").repartition(64).write.parquet(f"{tmp_path}/docs")
    df = spark.read.parquet(f"{tmp_path}/docs")
    some, part = quality._some_files(df)
    assert part == 1 / 4 and 0 < some.count() < 2000 and quality._some_files(df.groupBy("text").count())[0].count() == 2
    figures = quality.measured(df, quality.BASE)
    assert 0.3 < figures["too_few_words"][1] < 0.7 and quality.filter_quality(df, quality.BASE[:1]).count() == 1500


def garbled(rng, x):
    t = list(x.text)
    for _ in range(rng.randint(0, x.edits + 2)):
        p = rng.randrange(len(t))
        t[p : p + rng.randint(0, 1)] = rng.choice("abcxyzé")
    return "".join(t)


def test_license_seeds_lose_no_match():
    rng, of = random.Random(3), licenses.notices()
    lines = ["under the mit license under the mit license"]
    for x in of.of:
        lines += [f"some words {garbled(rng, x)} more words" for _ in range(8)]
        lines += [f"{garbled(rng, x)}{rng.choice(['', ' ', ' and '])}{garbled(rng, rng.choice(of.of))}" for _ in range(4)]
    for line in lines:
        n, joined = licenses.joined(line.encode())
        assert {f[2] for f in licenses.fuzzy(joined.decode(), of)} == {x.label for x in of.of if least_edits(x.text, joined.decode()) <= x.edits}, line
    assert licenses.places(licenses.joined(b"x Under THE mit-license, under the MIT license")[1]) == [(1, 4, "mit"), (5, 4, "mit")]


def least_edits(notice, line):
    """The fewest edits that make some stretch of the line the notice, by dynamic programming."""
    at, sought = np.arange(len(notice) + 1), np.array([ord(c) for c in notice])
    row, least = at, len(notice)
    for c in line:
        new = np.concatenate(([0], np.minimum(row[:-1] + (sought != ord(c)), row[1:] + 1)))
        row = np.minimum.accumulate(new - at) + at
        least = min(least, int(row[-1]))
    return least


def edits_between(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def brute_licenses(text):
    """Every column of the query but labels and score, which follow from the spans, word by word."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_query_against_brute_force(spark):
    rng, of = random.Random(8), licenses.notices()
    texts = [None, "", "Under the MIT license; apache LICENSE, version-2! cc by nc cc by nc", "mit license under the", "ünder the mit license x under the mit license"]
    for _ in range(25):
        texts.append(" ".join(rng.choice(["filler wörds", "Under the MIT License", "CC-BY-NC", "Apache License Version 2", garbled(rng, rng.choice(of.of)), "x" * 50]) for _ in range(rng.randint(1, 6))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    spans = {r.doc_id: r for r in licenses.scan(df).collect()}
    for r in licenses.digest(licenses.scan(df)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(texts[r.doc_id])
        line = licenses.joined((texts[r.doc_id] or "").encode())[1].decode()
        close = {x.label for x in of.of if least_edits(x.text, line) <= x.edits}
        assert r.labels == ",".join(sorted(close | set(filter(None, r.base_labels.split(","))))), line
        shares = []
        for s in spans[r.doc_id].notices:
            some = " ".join(line.split()[s.first_word : s.first_word + s.n_words + 1])
            x = min((x for x in of.of if x.label == s.label and len(x.text) == s.length), key=lambda x: edits_between(x.text, some))
            assert s.edits <= x.edits and edits_between(x.text, some) >= s.edits  # a span of whole words about the match
            shares.append(1 - s.edits / s.length)
        assert abs(r.score - (1.0 if r.n_base else max(shares, default=0.0))) < 1e-12


def test_unequal_notices_side_by_side_are_all_found():
    text = b"relased under the mit license released under the mit license and released undr the mit license"
    got = [f for f in licenses.fuzzy(licenses.joined(text)[1].decode(), licenses.notices()) if f[4] == 30]
    assert [f[3] for f in got] == [1, 0, 1] and got[0][0] < 3


def test_url_rules(spark):
    urls = ["https://a.EXAMPLE.com/en/7x?q", "http://example.com/en/8", "http://other.com/en/", "http://com/en/", "http://x.net/de/8", "http://m.example.net/de/81#t", "http://x.org/es", "http://notexample.com/fr/", "no scheme", None, "x://h?a", "://", "http://élan.net/de/"]
    html = '<a href="http://bad.org/es/1">x</a><a href="//other.com/">y</a><a HREF=\'https://bad.org\'>z</a>'
    df = spark.createDataFrame([(i, u, html if i == 6 else None, "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urlgraph.judge(df).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == [
        ("a.example.com", "/en/7x", "example.com/en/7"), ("example.com", "/en/8", "com/en/"), ("other.com", "/en/", "com/en/"), ("com", "/en/", "com/en/"), ("x.net", "/de/8", "net/de/"), ("m.example.net", "/de/81", "example.net/de/8"),
        ("x.org", "/es", None), ("notexample.com", "/fr/", None), ("", "", None), ("", "", None), ("h", "", None), ("", "", None), ("élan.net", "/de/", "net/de/"),
    ]
    assert got[6].verdict == "block" and got[6].distrust > 0 and got[9].verdict == "allow" and got[0].verdict == "allow"  # x.org links to a blocked host
    assert urlgraph.judge(df.limit(0)).collect() == []


def test_odd_pages(spark):
    long = "x" * 3_000_000 + '<a href="http://bad.org/es/">'
    rows = [(None, "http://s.org/a", long), (1, "http://s.org/a", None), (1, "http://s.org/a", None), (2, "http://bad.org/es/1", ""), (3, None, long), (4, "http://far.org/", "href='//'")]
    schema = "page_id long, url string, html string, host string, path string, verdict string, rule string, src string, allow string, rank string, trust string, n string"
    df = spark.createDataFrame([(*r, *["x"] * 9) for r in rows], schema).repartition(3)
    got = urlgraph.judge(df).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got) == [(0, "s.org", "block"), (1, "s.org", "block"), (1, "s.org", "block"), (2, "bad.org", "block"), (3, "", "allow"), (4, "far.org", "allow")]
    assert urlgraph.judge(df.where("page_id = 4")).first().verdict == "allow"  # no seeds at all


def test_a_row_repeated_very_often_is_written_each_time(spark):
    df = spark.createDataFrame([(7, "same text") for _ in range(3000)] + [(i, f"w{i}") for i in range(100)] + [(None, "x") for _ in range(500)], "doc_id long, text string").repartition(5)
    path = fresh_path(spark, "hot")
    tokenfiles.write_token_files(df, path, WORDS)
    rows = sorted(tokenfiles.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == 3600 and [r.doc_id for r in rows[:500]] == [None] * 500 and [r.doc_id for r in rows[500:]] == sorted(r.doc_id for r in rows[500:])
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]


def settled(seeds, edges, keep=0.85):
    """Personalised PageRank in floating point, far beyond the tolerance, to a mass of one."""
    total, out = sum(seeds.values()), {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    start = {h: (1 - keep) * n / total for h, n in seeds.items()}
    rank = start
    for _ in range(400):
        new = dict(start)
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0) + keep * rank.get(a, 0) * w / out[a]
        rank = new
    return rank


def test_ranks_settle_and_reach_every_host(spark):
    rng = random.Random(6)
    edges = {(f"c{i}", f"c{i + 1}"): 1 for i in range(12)} | {("c12", "c11"): 1}  # far from the seed
    edges |= {("hub", f"h{i}"): 10**9 for i in range(200)} | {("c3", "hub"): 1, ("c3", "c4"): 10**7}  # more links than rank
    edges |= {(f"r{rng.randrange(20)}", f"r{rng.randrange(20)}"): rng.randint(1, 9) for _ in range(60)}
    seeds = {True: {"c0": 3, "r1": 1}, False: {"r2": 5, "c5": 2}}
    table = spark.createDataFrame([(k, a, b, w) for k in seeds for (a, b), w in edges.items()], "allow boolean, src string, dst string, weight long")
    given = spark.createDataFrame([(k, h, n) for k, of in seeds.items() for h, n in of.items()], "allow boolean, host string, n long")
    got = {(r.allow, r.host): int(r.rank) / (urlgraph.MASS * urlgraph.FINE) for r in urlgraph.spread(given, table).collect()}
    want = {(k, h): x for k, of in seeds.items() for h, x in settled(of, edges).items() if x > 0}
    assert got.keys() == want.keys() and (True, "c12") in got and (True, "h7") in got
    assert all(abs(got[x] - want[x]) < 1e-8 for x in want)


def test_verdicts_reach_beyond_five_links(spark):
    chain = [(i, f"http://s{i}.org/x", f'<a href="http://s{i + 1}.org/">') for i in range(9)] + [(9, "http://s9.org/x", '<a href="http://bad.org/es/">'), (10, "http://bad.org/es/", None)]
    got = {r.page_id: r for r in urlgraph.judge(spark.createDataFrame(chain, "page_id long, url string, html string")).collect()}
    assert [got[i].verdict for i in range(11)] == ["block"] * 11 and got[0].distrust > 0 and got[0].trust == 0


def test_ranks_of_a_small_graph_settle_without_a_shuffle(spark, monkeypatch):
    links = spark.createDataFrame([(a, f"h{i}", f"h{(i * 7 + k) % 60}", 1 + i % 3) for a in (True, False) for i in range(60) for k in range(3)], "allow boolean, src string, dst string, weight long")
    seeds = spark.createDataFrame([(True, "h1", 3), (True, "h5", 1), (False, "h9", 2)], "allow boolean, host string, n long")
    plans, stored = [], urlgraph.stored

    def seen(df, name):
        if name == "ranks":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(urlgraph, "stored", seen)
    rows = lambda small: sorted(map(tuple, urlgraph.spread(seeds, links, tolerance=1e-3, small=small).collect()))
    few = rows(1000)
    assert plans and not any("Exchange" in p for p in plans)
    assert few == rows(0) and "Exchange" in plans[-1]  # dealt out, the ranks are the same


def test_every_subdomain_has_an_edge_to_its_parent(spark):
    hosts = ["www.site.com", "site.com", "a.b.c.net", "shop.co.uk", "m.shop.co.uk", "10.0.0.1", "10.0.0.2:80", "x..org", "two.org", "com", "", None]
    pages = spark.createDataFrame([(h, '<a href="http://WWW.Linked.org/">' if h == "two.org" else None) for h in hosts], "host string, html string")
    got = {(r.src, r.dst): r.weight for r in urlgraph.host_edges(pages).collect()}
    up = [("www.site.com", "site.com"), ("a.b.c.net", "b.c.net"), ("b.c.net", "c.net"), ("m.shop.co.uk", "shop.co.uk"), ("www.linked.org", "linked.org")]
    assert got == {e: 1 for a, b in up for e in ((a, b), (b, a))} | {("two.org", "www.linked.org"): 1}
    rows = [(1, "http://bad.org/es/1"), (2, "http://bad.org/fr/"), (3, "http://www.bad.org/fr/")]
    judged = urlgraph.judge(spark.createDataFrame([(*r, None) for r in rows], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.verdict for r in judged} == {1: "block", 2: "block", 3: "block"}


def hexes(seed, i):
    return int(hashlib.sha256(f"{seed}:{i // 16}".encode()).hexdigest()[i % 16 * 4 :][:4], 16)


def reshape(text, seed, alphabets):
    return "".join(next((a[hexes(seed, i) % len(a)] for a in alphabets if c in a), c) for i, c in enumerate(text, 1))


def luhn(digits):
    return sum(d - 9 * (d > 9) for d in (int(c) * (1 + (len(digits) - i) % 2) for i, c in enumerate(digits, 1))) % 10


def seed_of(kind, value, key, attempt=0):
    return hashlib.sha256(f"{key}|{kind}|{attempt}|{value}".encode()).hexdigest()


def in_form(digits, form):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form) + "".join(left)


def brute_surrogate(value, key="key"):
    """What an entity of the kinds other than person becomes at the first draw."""
    digits = re.sub(r"\D", "", value)
    if "@" in value:
        low = value.lower()
        top = re.search(r"\.[a-z]{2,}$", low)[0]
        new = reshape(low[: -len(top)], seed_of("email", low, key), pii.ALPHABETS) + top
        return "".join(n.upper() if c.isupper() else n for c, n in zip(value, new, strict=True))
    if re.fullmatch(r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", value):
        if luhn(digits):
            return value
        body = digits[0] + reshape(digits[1:-1], seed_of("card", digits, key), pii.ALPHABETS)
        return in_form(body + next(str(d) for d in range(10) if not luhn(body + str(d))), value)
    if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", value):
        seed, (a, b, *_) = seed_of("ip", value, key), map(int, value.split("."))
        free = [str(hexes(seed, i) % 256) for i in (1, 2, 3)]
        if a in (0, 10, 127) or a >= 224:
            return ".".join([str(a), *free])
        if (a, b) in ((192, 168), (169, 254)):
            return ".".join([str(a), str(b), *free[1:]])
        if a == 172 and 16 <= b < 32:
            return ".".join([str(a), str(hexes(seed, 1) % 16 + 16), *free[1:]])
        if a == 100 and 64 <= b < 128:
            return ".".join([str(a), str(hexes(seed, 1) % 64 + 64), *free[1:]])
        return ".".join([str(pii.PUBLIC[hexes(seed, 0) % len(pii.PUBLIC)]), *free])
    if value[0] in "+(":
        code = 0 if value[0] == "(" else 1 if digits[0] in "17" else 2 if digits[:2] in pii.COUNTRIES else 3
        plain = ("+" if value[0] == "+" else "") + digits
        rest = plain[1 + code :] if value[0] == "+" else plain
        return in_form(digits[:code] + reshape(rest, seed_of("phone", plain, key), pii.ALPHABETS), value)
    return reshape(value, seed_of("secret", value, key), pii.HEX if re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) else pii.ALPHABETS)


def brute_person(value, key="key"):
    """A person of one of the scripts and genders at the first draw."""
    title, *names = value.split(" ")
    sex = "f" if title.rstrip(".") in pii.TITLES["f"] else "m"
    script = "cyrillic" if "\u0400" <= names[0][0] < "\u0530" else "greek" if "\u0370" <= names[0][0] < "\u0400" else "latin"
    seed = seed_of("surname", f"{'' if script == 'latin' else sex}|{script}|{names[-1]}", key)
    of = pii.SYLLABLES[script]
    surname = ("".join(of[hexes(seed, i) % len(of)] for i in (1, 2, 3)) + pii.SURNAME_ENDS[sex, script]).capitalize()
    given = pii.GIVEN[sex, script]
    first = [given[hexes(seed_of("given", f"{sex}|{script}|{names[0]}", key), 0) % len(given)]] if len(names) > 1 else []
    return " ".join([title, *first, surname])


FOUND = r"[\w.%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|(?<!\d)\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?!\d)|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d])|\+\d{1,3} \(\d{3}\) \d{3}-\d{4}|(?<=token = \")[0-9a-fA-F]{40}(?=\")|(?<=TOKEN = \")[0-9a-fA-F]{40}(?=\")"


def brute_pii(text, key="key"):
    return re.sub(FOUND, lambda m: brute_surrogate(m[0], key), text)


def test_surrogates_against_brute_force(spark):
    texts = ["mail the.99@mail9.example.com### or +1 (017) 555-7713, card 4845168114407329 not 7536784127813051", 'ip 97.51.17.173. token = "cf1d64a9a4cd9723e1f4eafc27395915e6868ffa" again the.99@mail9.example.com', "THE.99@MAIL9.EXAMPLE.COM!! 4845 1681 1440 7329", "clean 12345678 1.2.3 a@b \ufdd0", "mark \ufdd0 the.99@mail9.example.com"]
    got = [r.text for r in pii.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "key").collect()]
    assert got == [brute_pii(t) for t in texts] and got[3] == texts[3] and "555-7713" not in got[0]


def test_forms_that_the_tables_do_not_hold(spark):
    found = [("phone", "+14155552671"), ("phone", "415-555-2671"), ("phone", "(030) 1234567"), ("phone", "+49 30 1234567"), ("card", "378282246310005"), ("card", "3782 822463 10005"), ("card", "4222222222222")]
    texts = [(k, f"see {v} now", v) for k, v in found] + [("secret", f"{q[0]}abcDEF0123456789xyz{q[1]} end", "abcDEF0123456789xyz") for q in (("password='", "'"), ("API_KEY=", ""), ('"token": "', '"'))]
    texts += [("secret", "password='abcdefghijklmnopqrst'", "abcdefghijklmnopqrst")]
    left = ["ids 1234567890123 and 2024-10-11", "token: internationalization", "+5 10 points (2020) 12"]
    rows = [(i, t) for i, t in enumerate([t for _, t, _ in texts] + left)]
    got = sorted(pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect(), key=lambda r: r.doc_id)
    for (kind, text, value), r in zip(texts, got, strict=False):
        assert r.kinds == kind and r.n_entities == 1 and value not in r.text and len(r.text) == len(text), text
    assert [r.text for r in got[len(texts) :]] == left


def test_one_entity_in_many_forms_has_one_surrogate(spark):
    texts = [
        "Ann.Lee@example.com ann.lee@example.com", "4845168114407329 4845 1681 1440 7329 4845-1681-1440-7329", "Mr Kim Park, Mr. Kim Park, Herr Park, Ms Park",
        "+1 (415) 555-2671, +14155552671, +49 30 1234567, +49301234567", "192.168.0.1 127.0.0.1 10.1.2.3 172.20.1.1 100.64.0.9 169.254.7.7 239.1.1.1 8.8.4.4",
        "Frau Greta Müller, госпожа Анна Петрова, господин Петров, κύριος Νίκος, κύριος Πέτρος Νίκος",
    ]
    got = [r.text for r in pii.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "key").collect()]
    a, b = got[0].split(" ")
    assert a != b and a.lower() == b and a[0].isupper() and a[4].isupper()
    assert len({re.sub(r"\D", "", x) for x in (got[1][:16], got[1][17:36], got[1][37:])}) == 1 and got[1][21] == " " and got[1][41] == "-"
    first, second, third, fourth = (x.split(" ") for x in got[2].split(", "))
    assert first[1:] == second[1:] and first[0] == "Mr" and second[0] == "Mr." and first[2] == third[1] == fourth[1] != "Park"
    phones = [re.sub(r"\D", "", x) for x in got[3].split(", ")]
    assert phones[0] == phones[1] and phones[2] == phones[3] and phones[0][0] == "1" and phones[2][:2] == "49"
    for old, new, kept in zip(texts[4].split(), got[4].split(), ("192.168.", "127.", "10.", "172.", "100.", "169.254.", "239.", ""), strict=True):
        assert new == brute_surrogate(old) and new.startswith(kept) and new != old
    assert got[2] == ", ".join(map(brute_person, texts[2].split(", "))) and got[5] == ", ".join(map(brute_person, texts[5].split(", ")))


def test_more_persons_than_short_names_stay_names(spark):
    rows = spark.range(6000).selectExpr("'surname' AS kind", "concat('|latin|Q', translate(lpad(conv(id, 10, 16), 5, '0'), '0123456789ABCDEF', 'abcdefghijklmnop')) AS value")
    known = pii.draws(rows, "key").collect()
    assert len({r.surrogate for r in known}) == 6000 and all(re.fullmatch(r"\|latin\|[A-Z][a-z]+man", r.surrogate) for r in known)
    given = pii.draws(spark.range(60).selectExpr("'given' AS kind", "concat('f|cyrillic|', chr(1040 + id % 30), repeat('а', 1 + cast(id as int))) AS value"), "key").collect()
    assert len({r.surrogate for r in given}) == 60 and all(re.fullmatch(r"f\|cyrillic\|[А-Я][а-я]+", r.surrogate) for r in given)


def test_surrogates_stay_distinct_and_coreferent(spark):
    names = [f"Mr. {'ABC'[i % 3]}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(300)]
    rows = [(i, f"{a}, {names[(i * 7) % 300]}" + (", \ufdd0" if i % 2 else "")) for i, a in enumerate(names)] + [(5, None), (7, ", "), (7, ", ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = pii.draws(pii.entities(df), "key").collect()
    assert len({r.surrogate for r in known}) == len(known) == 300 and not {r.surrogate for r in known} & {r.value for r in known} and max(r.attempt for r in known) > 0
    to = {"Mr. " + r.value.split("|")[2]: "Mr. " + r.surrogate.split("|")[2] for r in known}
    out = pii.replace(df, "key")
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == sorted((i, ", ".join(to.get(x, x) for x in (t or "").split(", "))) for i, t in rows)
    person = pii.replace(spark.createDataFrame([(1, "Frau Greta Müller, госпожа Анна Петрова, κύριος Νίκος")], "doc_id long, text string"), "key").first()
    a, b, c = person.text.split(", ")
    assert person.kinds == "person" and re.fullmatch(r"Frau (%s) [A-Z][a-z]+" % "|".join(pii.GIVEN["f", "latin"]), a) and re.fullmatch(r"госпожа (%s) [А-Я][а-я]+ова" % "|".join(pii.GIVEN["f", "cyrillic"]), b) and re.fullmatch(r"κύριος \w+ίδης", c)


def test_links_leave_no_signatures_or_stars_on_disk(spark):
    at = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/" + spark.sparkContext.applicationId
    before = set(glob.glob(f"{at}/*"))
    out = jaccard.linked(table(spark, EDGES))
    left = {p.rsplit("/", 1)[1].split("-")[0] for p in set(glob.glob(f"{at}/*")) - before}
    assert out.count() == len(EDGES) and not left & {"sets", "stars", "large"}


def test_signatures_without_common_shingles_lose_no_similar_pair():
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(1, 1 << 62, n, dtype=np.int64).astype(np.uint64)
    tried = 0
    for _ in range(2000):
        size = int(rng.choice([6, 7, 8, 10, 14, 20, 33, 50, 100, 300]))
        x, d = draw(size), int(rng.integers(0, jaccard.differ(int(size / 0.85) + 1, 85) + 1))
        cut = int(rng.integers(0, d + 1))
        x, y = np.unique(x), np.unique(np.concatenate([x[cut:], draw(d - cut)]))
        either = np.union1d(x, y)
        common = np.unique(_windows.mix(rng.choice(either, int(len(either) * rng.choice([0.05, 0.3, 0.9, 1])), replace=False)).astype(np.uint32))
        if sigtree.similar(x, y, 85) and not np.array_equal(x, y):
            tried += 1
            assert len(np.intersect1d(jaccard.signatures(x, 85, common), jaccard.signatures(y, 85, common)))
    assert tried > 600


@pytest.mark.parametrize("most_star, fewest", [(20_000, 2), (3, 10)])
def test_jaccard_with_common_shingles_against_brute_force(spark, most_star, fewest, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_SETS", fewest)
    test_jaccard_against_brute_force(spark, 3000, most_star, monkeypatch)


def test_a_line_that_many_texts_have_brings_no_texts_together(spark, monkeypatch):
    rng, counts, put = random.Random(6), {}, jaccard.stored

    def told(df, name):
        out = put(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", told)
    monkeypatch.setattr(jaccard, "MOST_STAR", 20)
    monkeypatch.setattr(jaccard, "COMMON_SETS", 10, raising=False)
    line = [f"l{i}" for i in range(40)]
    docs = [(i, " ".join([*line, *(f"w{rng.randrange(10**9)}" for _ in range(80))])) for i in range(150)]
    docs.append((150, docs[7][1] + " more"))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(df).collect()) == brute_links(docs, 4, 85)
    assert counts["large-stars"] == 0 and counts["members"] == 2

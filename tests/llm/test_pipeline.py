import base64
import hashlib
import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
import public_tokenizers as P  # noqa: E402
import tiktoken  # noqa: E402

from snapledger.llm import quality  # noqa: E402
from snapledger.llm._util import NORMAL  # noqa: E402
from snapledger.llm.queries import KEY  # noqa: E402

from .test_operators import RANKS, brute_links, brute_pii  # noqa: E402

DATA = "/root/testdata/sf0.001"
WIDTH = 10


def cut(text, items):
    """The benchmark stage by brute force: the text without covered spans, or None if more than half is covered."""
    raw = text.encode()
    clean = raw.translate(NORMAL)
    at, places = 0, []
    for word in clean.split():
        at = clean.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    words = clean.split()
    hit = [False] * len(words)
    for ws in items:
        size = min(len(ws), WIDTH)
        windows = {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)} if ws else set()
        for j in range(len(words) - size + 1):
            if windows and tuple(words[j : j + size]) in windows:
                hit[j : j + size] = [True] * size
    if not any(hit):
        return text
    if sum(hit) > 0.5 * len(words):
        return None
    out, last, i = [], 0, 0
    while i < len(words):
        if hit[i]:
            begin = places[i][0]
            while i < len(words) and hit[i]:
                i += 1
            out.append(raw[last:begin])
            last = places[i - 1][1]
        else:
            i += 1
    return b"".join([*out, raw[last:]]).decode()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_pipeline_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    items = [r.text.encode().translate(NORMAL).split() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if quality.rejected_by((t or "").encode(), quality.BASE + quality.MORE) is None]
    docs = [d for d, (i, _, root) in zip(docs, brute_links(docs, 5, 80), strict=True) if i == root]
    docs = [(i, x) for i, t in docs if (x := cut(t, items)) is not None]
    docs = [(i, brute_pii(t, KEY)) for i, t in docs]
    library = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    want = []
    for i, t in docs:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, DATA).collect())
    assert got == sorted(want)


def test_stages_keep_columns_and_survive_odd_rows(spark, tmp_path):
    fine = "Plain words that make a clean and ordinary document of more than ten words."
    rows = [(1, fine, "en", "s", 9, "z"), (1, fine, "en", "s", 9, "z"), (2, None, None, None, None, None), (None, fine + " But another one, of which there is no other copy at all.", "en", "s", 9, "z"), (3, "", "en", "s", 9, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    spark.createDataFrame([(1, "no such words anywhere in here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, f"file://{tmp_path}")
            if name != "token_ids":
                assert docs.schema == spark.createDataFrame([], schema).schema, name
        assert sorted((r.doc_id is None, r.doc_id) for r in docs.collect()) == ([(False, 1), (True, None)] if some else [])
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), "")
    assert left.count() == 4

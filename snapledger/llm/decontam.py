"""Benchmark decontamination with a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import NORMAL, cells, slices, tidied

#: Test items are put into automata of about this many words, but at least one item; a further block costs a
#: further pass. Building one took 300 MB on the driver for 200,000 words; packed it was 13 MB, which is what is broadcast.
BLOCK_WORDS = 200_000


class _Builder:
    """Generalised suffix automaton over item words, with the items whose windows end in each state.

    A window is ``width`` consecutive words of an item, or the whole item when it has fewer (not none).
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        self.width = width
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        self.grams: set[tuple[bytes, ...]] = set()
        items = [x for x in items if x[1]]
        self.least = min([min(len(words), width) for _, words in items], default=0)
        self.gram = min(4, self.least)
        for _, words in items:
            last, states = 0, []
            for word in words:
                last = self._extend(last, word)
                states.append(last)
            ends.append(states)
            self.grams.update(zip(*(words[i:] for i in range(self.gram)), strict=False))
        #: Of each state: [(window length, items)] for windows that are suffixes of what the state stands for.
        self.windows: list[dict[int, set[int]]] = [{} for _ in self.link]
        self.names = [name for name, _ in items]
        for k, (_, words) in enumerate(items):
            size = min(len(words), width)
            for state in self._states(words, size):
                self.windows[state].setdefault(size, set()).add(k)
        #: The nearest state along the suffix links, itself included, that has windows.
        self.nearest = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.nearest[state] = state if self.windows[state] else self.nearest[self.link[state]] if self.link[state] > 0 else -1

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        now = self._state({}, self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = now
            p = self.link[p]
        if p < 0:
            self.link[now] = 0
        else:
            q = self.next[p][word]
            self.link[now] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return now

    def _state(self, moves: dict[bytes, int], length: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _states(self, words: list[bytes], size: int) -> Iterator[int]:
        """The states of the item's windows: for each place, the state whose lengths include ``size``."""
        state, matched = 0, 0
        for word in words:
            state, matched = self.next[state][word], matched + 1
            while self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if matched >= size:
                yield state


class Automaton:
    """The automaton packed into arrays of integers, which is what workers hold.

    ``step`` has the sorted keys state * words + word of all moves and ``goal`` where they lead; the windows of
    a state are the rows from ``first[state]`` to ``first[state + 1]`` of ``size`` and ``item``.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        built = _Builder(items, width)
        self.width, self.least, self.gram, self.names = width, built.least, built.gram, built.names
        self.words = {word: i for i, word in enumerate(sorted({w for _, ws in items for w in ws}))}
        n = self.n_words = max(1, len(self.words))
        moves = sorted((state * n + self.words[word], goal) for state, of in enumerate(built.next) for word, goal in of.items())
        self.step, self.goal = array("q", [k for k, _ in moves]), array("i", [g for _, g in moves])
        self.link, self.length, self.nearest = array("i", built.link), array("i", built.length), array("i", built.nearest)
        rows = [[(size, k) for size, of in sorted(sizes.items()) for k in sorted(of)] for sizes in built.windows]
        self.first = array("i", np.cumsum([0, *map(len, rows)]).tolist())
        self.size, self.item = (array("i", [x[j] for row in rows for x in row]) for j in (0, 1))
        #: Hashes of the grams; a chance match costs a look and no more.
        self.grams = frozenset(map(_gram_key, built.grams))

    def move(self, state: int, word: int) -> int:
        """The state that a word leads to, or -1."""
        key = state * self.n_words + word
        at = bisect_left(self.step, key)
        return self.goal[at] if at < len(self.step) and self.step[at] == key else -1

    def regions(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Parts of a text outside which no window can lie: each window holds one of the grams looked up."""
        g, step, grams, n = self.gram, self.least - self.gram + 1, self.grams, len(words)
        start = end = -1
        starts = range(0, n, step)
        for i, gram in zip(starts, zip(*(words[j::step] for j in range(g)), strict=False), strict=False):
            if _gram_key(gram) in grams:
                a, b = max(0, i - self.width + g), min(n, i + self.width)
                if a > end:
                    if end > 0:
                        yield start, end
                    start = a
                end = b
        if end > 0:
            yield start, end

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The merged (start, end) word spans of windows that occur, and the items they belong to.

        Streams the words of a region through the automaton, tracking the longest match that ends at each.
        """
        out: list[tuple[int, int]] = []
        items: set[int] = set()
        if not self.least:
            return out, items
        link, length, nearest, move = self.link, self.length, self.nearest, self.move
        for a, b in self.regions(words):
            state = matched = 0
            for i in range(a, b):
                word = self.words.get(words[i])
                if word is None:  # no item has it
                    state = matched = 0
                    continue
                goal = move(state, word)
                while state and goal < 0:
                    state = link[state]
                    matched = length[state]
                    goal = move(state, word)
                if goal >= 0:
                    state, matched = goal, matched + 1
                at, widest = nearest[state], 0
                while at > 0:
                    for row in range(self.first[at], self.first[at + 1]):
                        if self.size[row] <= matched:
                            items.add(self.item[row])
                            widest = max(widest, self.size[row])
                    at = nearest[link[at]] if link[at] > 0 else -1
                if widest:
                    begin = i + 1 - widest
                    while out and out[-1][1] >= begin:
                        begin = min(begin, out.pop()[0])
                    out.append((begin, i + 1))
        return out, items


def _gram_key(words: tuple[bytes, ...]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, width: int, most: int) -> Iterator[Automaton]:
    """Streams the items to the driver, one partition at a time, and builds one automaton after another."""
    block, size = [], 0
    for name, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = (text or "").encode().translate(NORMAL).split()
        block.append((name, words))
        size += len(words)
        if size >= most:
            yield Automaton(block, width)
            block, size = [], 0
    yield Automaton(block, width)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of ``docs``: its columns, and last a struct (n_words, spans, items).

    The struct is called ``found``, with underscores added while ``docs`` has a column of that name. ``spans``
    are the merged (start, end) word spans covered by occurrences of item windows, ``items`` the
    sorted ids, as strings, of the items that they come from. Null texts have no words. Null or empty
    items have no window; an item without an id hits words but isn't listed; repeated item rows count
    once, as ids are distinct. Repeated rows of ``docs`` get a result each. With no items nothing is hit.

    Test items are the small side: an automaton holds about ``block_words`` words, which bounds what is
    broadcast; a larger benchmark takes one pass over the rows for each block, merging spans as it goes.
    """
    return _scanned(docs, _blocks(benchmark, item_col, item_text_col, width, block_words), text_col, None)


#: Bytes of texts that are looked at together.
SLICE_BYTES = 4 << 20


def _scanned(docs: DataFrame, blocks: Iterator[Automaton], text_col: str, finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None) -> DataFrame:
    """The rows with ``found``, a pass for each block; ``finish`` makes rows like those of ``docs`` of them again, within the last pass."""
    spark = docs.sparkSession
    kind = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    arrow = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
    at, seen = docs.columns.index(text_col), len(docs.columns)
    taken, name = {c.lower() for c in docs.columns}, "found"
    while name in taken:
        name += "_"
    out = docs.withColumn(name, F.lit(None).cast(kind))
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        shared, end = spark.sparkContext.broadcast(block), finish if following is None else None

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, end=end) -> Iterator[pa.RecordBatch]:
            automaton: Automaton = shared.value
            for batch in slices(batches, at, SLICE_BYTES):
                found = []
                before = batch.column(seen).to_pylist() if batch.column(seen).null_count < len(batch) else [None] * len(batch)
                for text, old in zip(cells(batch.column(at)), before, strict=True):
                    words = (text or b"").translate(NORMAL).split()
                    spans, items = automaton.spans(words)
                    names = {automaton.names[k] for k in items} - {None}
                    if old:
                        spans = _merged(spans + [(x["start"], x["end"]) for x in old["spans"]])
                        names |= set(old["items"])
                    found.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(names)})
                done = pa.RecordBatch.from_arrays([*batch.columns[:seen], pa.array(found, arrow)], names=batch.schema.names)
                yield end(done) if end else done

        out = out.mapInArrow(tidied(scan), docs.schema if end else out.schema)
        block = following
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated from contamination()'s rows."""
    of = found.columns[-1]
    hit = F.aggregate(f"{of}.spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        F.col(id_col),
        F.col(f"{of}.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(f"{of}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{of}.items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def remove_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    most_coverage: float = 0.5,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Drops rows whose covered share of words exceeds ``most_coverage``; cuts the covered spans out of the others.

    Rows without a hit keep their text as it is, null included. A text with hits loses each covered span
    from the first byte of its first word to the last byte of its last; all columns stay.
    """
    columns = docs.columns
    at = columns.index(text_col)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keep = [], []
        for text, found in zip(cells(batch.column(at)), batch.column(len(columns)).to_pylist(), strict=True):
            covered = sum(x["end"] - x["start"] for x in found["spans"])
            keep.append(covered <= most_coverage * found["n_words"])
            texts.append(_without(text, found["spans"]) if covered else text)
        arrays = list(batch.columns[: len(columns)])
        arrays[at] = pa.array(texts, pa.binary()).cast(batch.column(at).type)
        return pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[: len(columns)]).filter(pa.array(keep, pa.bool_()))

    return _scanned(docs, _blocks(benchmark, item_col, item_text_col, width, block_words), text_col, cut)


def _without(text: bytes, spans: list[dict]) -> bytes:
    clean, out, at, word, last = text.translate(NORMAL), [], 0, 0, 0
    for span in spans:
        while word < span["start"]:
            at, word = _word(clean, at)[1], word + 1
        begin = _word(clean, at)[0]
        while word < span["end"]:
            at, word = _word(clean, at)[1], word + 1
        out.append(text[last:begin])
        last = at
    return b"".join([*out, text[last:]])


def _word(clean: bytes, at: int) -> tuple[int, int]:
    while clean[at] == 0x20:
        at += 1
    end = clean.find(b" ", at)
    return at, len(clean) if end < 0 else end

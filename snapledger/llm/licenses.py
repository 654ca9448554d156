"""License scans: exact phrases, and short notices with a bounded number of edits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import NORMAL, cells, tidied

# Phrases that must stand word for word, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Short notices, normalised, that may be garbled a little, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("under the terms of the gnu affero general public license", "agpl-3"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("to the extent possible under law the author has waived all copyright and related rights", "cc0-1"),
    ("distributed under the boost software license version 1 0", "bsl-1"),
    ("made available under the terms of the eclipse public license", "epl"),
)


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int
    #: Twice as many exact pieces as the pigeonhole needs, and where they begin in the notice.
    pieces: tuple[tuple[str, int], ...]
    pattern: regex.Pattern

    @property
    def seeds(self) -> list[tuple[str, int]]:
        """Pairs of neighbouring pieces: one more than the edits, so some seed of any match is untouched."""
        return [(a + b, at) for (a, at), (b, _) in zip(self.pieces[::2], self.pieces[1::2], strict=True)]

    def fits(self, line: str, at: int) -> bool:
        """Whether enough pieces stand about where they would if the notice began near ``at``.

        An edit spoils one piece at most, so of a match all but ``edits`` pieces are found, each shifted by
        no more than ``edits`` characters.
        """
        left, reach = self.edits, self.edits
        for piece, offset in self.pieces:
            first = at + offset
            if line.find(piece, max(0, first - reach), first + len(piece) + reach) < 0:
                left -= 1
                if left < 0:
                    return False
        return True


def notice(text: str, label: str, per_edit: int = 10) -> Notice:
    """Allows one edit for each ``per_edit`` characters; finding seeds exactly loses no match."""
    edits = max(1, len(text) // per_edit)
    n = 2 * (edits + 1)
    cuts = [len(text) * i // n for i in range(n + 1)]
    pieces = tuple((text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False))
    pattern = regex.compile(f"(?b)(?:{regex.escape(text, literal_spaces=True)}){{e<={edits}}}")
    return Notice(text, label, edits, pieces, pattern)


class Notices:
    """Short notices with one automaton that finds the seeds of all of them in one pass over a text."""

    def __init__(self, of: tuple[Notice, ...]):
        self.of = of
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, x in enumerate(of):
            for seed, offset in x.seeds:
                seeds.setdefault(seed, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), tuple(places)))
        if of:
            self.automaton.make_automaton()

    def regions(self, line: str) -> dict[int, list[tuple[int, int]]]:
        """Of each notice the parts of a text outside which it has no match: about seeds whose surroundings fit."""
        out: dict[int, list[tuple[int, int]]] = {}
        if not self.of or not line:
            return out
        for last, (size, places) in self.automaton.iter(line):
            for k, offset in places:
                x, at = self.of[k], last + 1 - size - offset
                if x.fits(line, at):
                    out.setdefault(k, []).append((max(0, at - x.edits), min(len(line), at + len(x.text) + x.edits)))
        return out


@lru_cache(maxsize=4)
def notices(of: tuple[tuple[str, str], ...] = NOTICES, per_edit: int = 10) -> Notices:
    return Notices(tuple(notice(text, label, per_edit) for text, label in of))


def joined(text: bytes | None) -> tuple[int, bytes]:
    """The number of words, and the normalised words with one space before and after each."""
    words = (text or b"").translate(NORMAL).split()
    return len(words), b" " + b" ".join(words) + b" " if words else b""


def places(line: bytes, phrases: tuple[tuple[str, str], ...] = PHRASES) -> list[tuple[int, int, str]]:
    """(first word, words, label) of each place where a phrase's words stand consecutively."""
    out = []
    for phrase, label in phrases:
        sought, at, word, seen = f" {phrase} ".encode(), -1, 0, 0
        while (at := line.find(sought, at + 1)) >= 0:
            word, seen = word + line.count(b" ", seen, at), at
            out.append((word, phrase.count(" ") + 1, label))
    return sorted(out)


def fuzzy(line: str, of: Notices) -> list[tuple[int, int, str, int, int]]:
    """(first character, end, label, edits, notice length) of the best matches about each place that can hold one."""
    out = []
    for k, regions in of.regions(line).items():
        x, done = of.of[k], -1
        for a, b in _merged(regions):
            for m in _matches(x, line[a:b]):
                if a + m.start() >= done:
                    done = a + m.end()
                    out.append((a + m.start(), done, x.label, sum(m.fuzzy_counts), len(x.text)))
    return sorted(out)


def _matches(x: Notice, piece: str) -> list[regex.Match]:
    """Matches that don't overlap, in order: the best one first, then those before and behind it."""
    out, left = [], [(0, len(piece))]
    while left:
        a, b = left.pop()
        if b - a >= len(x.text) - x.edits and (m := x.pattern.search(piece, a, b)):
            out.append(m)
            left += [(a, m.start()), (m.end(), b)]
    return sorted(out, key=lambda m: m.start())


def _merged(regions: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(regions):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def near(line: str, of: Notices) -> list[dict]:
    """The matches of fuzzy() as spans in words."""
    out, word, seen = [], 0, 1
    for a, b, label, edits, size in fuzzy(line, of):
        if a >= seen:
            word, seen = word + line.count(" ", seen, a + 1), a + 1
        out.append({"first_word": word, "n_words": len(line[a:b].split()), "label": label, "edits": edits, "length": size})
    return out


_SPAN = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("edits", pa.int64()), ("length", pa.int64())])


def scan(
    df: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    texts: tuple[tuple[str, str], ...] = NOTICES,
    per_edit: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``df``: its id, n_words, ``base`` and ``notices``, arrays of spans in words.

    A span has first_word, n_words, label, edits and the notice's length in characters (0 edits and
    length 0 for a phrase). A null text has no words and no spans. Each row stands alone: ids may be null
    or repeated, and other columns aren't read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("base", pa.list_(_SPAN)), ("notices", pa.list_(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = notices(texts, per_edit)
        for batch in batches:
            counts, base, short = [], [], []
            for text in cells(batch.column(1)):
                n, line = joined(text)
                counts.append(n)
                base.append([{"first_word": a, "n_words": k, "label": x, "edits": 0, "length": 0} for a, k, x in places(line, phrases)])
                short.append(near(line.decode(), sought))
            arrays = [pa.array(counts, pa.int64()), pa.array(base, pa.list_(_SPAN)), pa.array(short, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=schema)

    span = "array<struct<first_word:bigint,n_words:bigint,label:string,edits:bigint,length:bigint>>"
    return rows.mapInArrow(tidied(run), f"id {kind.simpleString()}, n_words long, base {span}, notices {span}").withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The per-document summary of scan(): places, labels, and a score of 1 for a phrase, else the best notice's share of unedited characters."""
    labels = lambda *cols: F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.col(f"{c}.label") for c in cols)))), ",")
    starts = F.col("base.first_word")
    best = F.array_max(F.transform("notices", lambda x: 1 - x["edits"].cast("double") / x["length"]))
    return found.select(
        F.col(id_col), "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("base", "notices").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )

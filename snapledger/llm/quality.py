"""Quality rules as a short-circuit cascade, ordered by rejection per cost as measured on a sample."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import SPACES, cells, size_in_bytes, tidied

SYMBOLS = b"#*$%&|<>"
_NO_LETTERS = bytes(c for c in range(256) if not (0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0xC0))
# Frequent function words of four languages, marks that begin list items, and marks that break off.
STOPS = frozenset(b"the be to of and that have with der die das und ist nicht le la les et est une el los de que y en".split())
BULLETS = (b"-", b"*", "•".encode(), "‣".encode(), "◦".encode())
ELLIPSES = (b"...", "…".encode())
_NOT_COUNTED = SPACES + bytes(range(0x80, 0xC0))  # what remains has one byte for each code point


class Page:
    """A text's statistics, each computed when first asked for. A null text has no words."""

    def __init__(self, text: bytes | None):
        self.text = text or b""
        self._kept: dict[str, object] = {}

    def __getattr__(self, name: str):
        if name.startswith("_") or name == "text":
            raise AttributeError(name)
        kept = self._kept
        if name not in kept:
            kept[name] = getattr(self, f"_{name}")()
        return kept[name]

    def _words(self) -> list[bytes]:
        return self.text.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        return len(self.text.translate(None, _NOT_COUNTED))

    def _n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    def _letters(self) -> int:
        """Letters a-z and all that is beyond ASCII, by code points."""
        return len(self.text.translate(None, _NO_LETTERS))

    def _n_stops(self) -> int:
        return len(STOPS.intersection(self.words))

    def _n_bullets(self) -> int:
        return sum(x.lstrip().startswith(BULLETS) for x in self.lines)

    def _n_trailing(self) -> int:
        return sum(x.rstrip().endswith(ELLIPSES) for x in self.lines)

    def _n_shouts(self) -> int:
        return self.text.count(b"!")

    def _lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip()]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self, size: int = 5) -> int:
        """Words inside a window of five words that the text holds twice or more, the first one included."""
        words = self.words
        windows = list(zip(*(words[i:] for i in range(size)), strict=False))
        if len(set(windows)) == len(windows):
            return 0
        counts, total, end = Counter(windows), 0, 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                total += i + size - max(i, end)
                end = i + size
        return total


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Page], bool]


#: The rules that every corpus gets; their order here has no meaning, the cascade finds its own.
BASE = (
    Rule("too_few_words", lambda p: p.n_words < 10),
    Rule("repeated_windows", lambda p: 100 * p.n_repeat_words > 20 * p.n_words),
)
MORE = (
    Rule("symbols", lambda p: 100 * p.n_symbols > 25 * p.n_words),
    Rule("shouting", lambda p: 100 * p.n_shouts > 50 * p.n_words),
    Rule("word_length", lambda p: p.word_chars < 2 * p.n_words or p.word_chars > 14 * p.n_words),
    Rule("repeated_lines", lambda p: 100 * p.n_dup_lines > 30 * len(p.lines)),
)


#: About so many files are looked into for a sample, if the table has more.
SAMPLE_FILES = 16


def _some_files(df: DataFrame) -> tuple[DataFrame, float]:
    """About SAMPLE_FILES of a table's files, picked by a hash of their names, and their share; the whole table if it isn't one of files.

    Spark leaves the other files out when it plans, so a sample doesn't cost a scan.
    """
    every = max(1, len(df.inputFiles()) // SAMPLE_FILES)
    if every > 1:
        try:
            return df.where(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(every)) == 0), 1 / every
        except AnalysisException:  # rows that come out of a plan don't know their files
            pass
    return df, 1.0


def measured(df: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", sample_bytes: int = 8 << 20) -> dict[str, tuple[float, float]]:
    """Of each rule (seconds a row, share of rows it rejects), from a sample of about ``sample_bytes``.

    The sample's size is a parameter and doesn't grow with the table. Executors time the rules on the
    rows they hold; one row for each rule comes back. Rules share what a page has worked out already, in the cascade as
    here, where they take turns in going first. The sample only sets the order in which rules run, so it never
    changes which rows are kept. An empty sample gives each rule cost 0, share 0.
    """
    some, part = _some_files(df)
    share = min(1.0, sample_bytes / max(1, size_in_bytes(df.select(text_col))) / part)
    schema = pa.schema([("rule", pa.string()), ("seconds", pa.float64()), ("rows", pa.int64()), ("rejected", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [Page(t) for t in cells(batch.column(0))]
            seconds, rejected = [0.0] * len(rules), [0] * len(rules)
            for turn in range(len(rules)):
                some = pages[turn :: len(rules)]
                for i in (*range(turn, len(rules)), *range(turn)):
                    began = time.thread_time()
                    rejected[i] += sum(rules[i].rejects(page) for page in some)
                    seconds[i] += time.thread_time() - began
            out = [(r.name, seconds[i], len(pages), rejected[i]) for i, r in enumerate(rules)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    rows = some.select(F.col(text_col).cast("string")).sample(False, share, seed=7)
    sums = rows.mapInArrow(tidied(run), "rule string, seconds double, rows long, rejected long").groupBy("rule").agg(F.sum("seconds"), F.sum("rows"), F.sum("rejected"))
    found = {name: (seconds / rows, rejected / rows) for name, seconds, rows, rejected in sums.collect() if rows}
    return {r.name: found.get(r.name, (0.0, 0.0)) for r in rules}


def cascade(rules: tuple[Rule, ...], figures: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """The rules by rejection per cost, highest first; equal ones by name."""
    return tuple(sorted(rules, key=lambda r: (-figures[r.name][1] / max(figures[r.name][0], 1e-9), figures[r.name][0], r.name)))


def rejected_by(text: bytes | None, order: tuple[Rule, ...]) -> str | None:
    """The first rule in the cascade that rejects the text; later ones don't run."""
    page = Page(text)
    return next((r.name for r in order if r.rejects(page)), None)


def filter_quality(df: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns, whatever their names.

    A null or empty text has no words and so goes with too_few_words. Repeated rows are judged alike.
    """
    order = cascade(rules, measured(df, rules, text_col))
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([rejected_by(t, order) is None for t in cells(batch.column(at))], pa.bool_()))

    return df.mapInArrow(tidied(run), df.schema)


#: Rules for corpora in languages that STOPS covers; not among those of the registered query, whose texts are invented words.
PROSE = (
    Rule("few_letters", lambda p: 100 * p.letters < 60 * p.word_chars),
    Rule("no_stop_words", lambda p: p.n_stops < 2),
    Rule("bullets", lambda p: 100 * p.n_bullets > 90 * len(p.lines)),
    Rule("ellipses", lambda p: 100 * p.n_trailing > 30 * len(p.lines)),
)

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(df: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its id, the five statistics, ``base_failed`` and ``kept``.

    The statistics are wanted of every text, so only the verdict runs as a cascade; it reuses what is
    already computed. A null text has no words: all statistics are 0 and it fails. Ids may be null or
    repeated; other columns aren't read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = cascade(more, measured(df, more, text_col))
    kind = rows.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), *((x, pa.int64()) for x in STATS), ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in cells(batch.column(1)):
                page = Page(text)
                failed = any(r.rejects(page) for r in base)
                out.append((*(getattr(page, x) for x in STATS), failed, not failed and not any(r.rejects(page) for r in order)))
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, f.type) for x, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    names = ", ".join(f"{x} long" for x in STATS)
    return rows.mapInArrow(tidied(run), f"id {kind.simpleString()}, {names}, base_failed boolean, kept boolean").withColumnRenamed("id", id_col)

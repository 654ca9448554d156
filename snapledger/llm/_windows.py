"""Hashes of tokens and windows, vectorised, and the cutting of texts into runs of windows.

A window is ``width`` consecutive tokens. Its *sample* is the least hash of the grams (``gram`` tokens) that
it holds, so equal windows have equal samples, wherever they stand. Consecutive windows with one sample make
a *run*. Every window is in one run, and a text has only about two runs for each ``width - gram`` tokens.

Samples say who may be equal, never who is: their hash is a polynomial, which some unlike texts share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_P = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S1, _S2, _S3 = np.uint64(30), np.uint64(27), np.uint64(31)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _S1)) * _M1
    x = (x ^ (x >> _S2)) * _M2
    return x ^ (x >> _S3)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _P)


def _power(base: np.uint64, n: int) -> np.ndarray:
    name = str(base)
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def byte_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte of a column of texts without nulls, and where each text's end."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return _BYTES[raw], at[1:] - at[0]


def word_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word ``[^\\x20\\x09-\\x0D]+`` of a column of texts without nulls, and where each text's end."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in words], np.uint64)
    at = coded.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
    if b"" in words:  # what Arrow sees before leading and behind trailing white space
        real = at != words.index(b"")
        ends = np.concatenate(([0], np.cumsum(real)))[ends]
        at = at[real]
    return hashes[at], ends


def sums(tokens: np.ndarray) -> np.ndarray:
    """Prefix sums from which spans() tells the hash of any stretch of the tokens."""
    out = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens * _power(_P, len(tokens)), out=out[1:])
    return out


def spans(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[begin]) * _power(_INVERSE, len(prefix))[begin])


def chained(tokens: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive tokens, mixed anew with every token."""
    out = mix(tokens[: len(tokens) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = mix(out * _P + tokens[i : len(tokens) - n + 1 + i])
    return out


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive numbers, in two passes over blocks."""
    if size == 1:
        return x
    n = len(x)
    blocks = -(-n // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - size + 1], ahead[size - 1 : n])


def runs(tokens: np.ndarray, width: int, gram: int, most: int) -> tuple[np.ndarray, ...]:
    """(sample, first window, windows, repeats itself) of each run of a text, at most ``most`` windows long.

    A run in which the sample occurs more than once may hold one window several times, which the last array
    tells. The text has at least ``width`` tokens.
    """
    n = len(tokens) - width + 1
    prefix = sums(tokens)
    at = np.arange(len(tokens) - gram + 1)
    grams = spans(prefix, at, at + gram)
    sample = _least(grams, width - gram + 1)
    first = np.flatnonzero(np.concatenate(([True], sample[1:] != sample[:-1])))
    count = np.diff(np.concatenate((first, [n])))
    if count.max() > most:
        parts = -(-count // most)
        offset = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        whole = np.repeat(count, parts)
        first = np.repeat(first, parts) + offset * most
        count = np.minimum(most, whole - offset * most)
    key = sample[first]
    last = first + count - 1 + width - gram  # last gram of the run
    many = _count_equal(grams, key, first, last) > 1
    return key, first, count, many


def _count_equal(grams: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """How often each key occurs among grams[first..last], looking only at grams whose value is some key."""
    order = np.argsort(grams, kind="stable")
    sorted_grams = grams[order]
    lo, hi = np.searchsorted(sorted_grams, key, "left"), np.searchsorted(sorted_grams, key, "right")
    out = np.ones(len(key), dtype=np.int64)
    for i in np.flatnonzero(hi - lo > 1):
        where = order[lo[i] : hi[i]]
        out[i] = np.searchsorted(where, last[i], "right") - np.searchsorted(where, first[i], "left")
    return out

"""Texts as flat byte arrays: words and their hashes by whole-array numpy operations."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

#: Bytes of the ASCII blanks of the pattern [^\x20\x09-\x0D]+ (a fixed value).
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte; the odd base of the polynomial has an inverse modulo 2**64.
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
#: The base of a second hash, independent of the first.
OTHER_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = {b: pow(b, -1, 2**64) for b in (_BASE, OTHER_BASE)}
_PIECE = 1 << 20
_powers: dict[int, np.ndarray] = {}


def give_back() -> None:
    """Returns memory that is free to the system: workers live on between tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: What modules keep between the tasks of a worker, and how each is let go.
_kept: dict[str, Callable[[], None]] = {}


def keeps(module: str, let_go: Callable[[], None]) -> None:
    _kept[module] = let_go


def let_others_go(module: str) -> None:
    """Lets go of what other modules have kept: a worker that goes on with another operator's tasks needs its memory for them."""
    others = [name for name in _kept if name != module]
    for name in others:
        _kept.pop(name)()
    if others:
        give_back()


def lean(body: Callable) -> Callable:
    """A worker function (of batches, or of tables) that gives memory back when it is done."""

    @wraps(body)
    def batches(rows):
        let_others_go(body.__module__)
        try:
            yield from body(rows)
        finally:
            give_back()

    def done(*args):
        try:
            return body(*args)
        finally:
            give_back()

    # Spark tells tables from pairs of tables by the number of arguments
    one, two = (lambda table: done(table)), (lambda left, right: done(left, right))
    return batches if body.__code__.co_flags & 0x20 else one if body.__code__.co_argcount == 1 else two


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, _PIECE + 4096)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher that spreads every bit of h over all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of the ordered pairs (a, b)."""
    return mix(a * np.uint64(_BASE) + b)


def prefix_sums(buf: np.ndarray, base: int = _BASE) -> np.ndarray:
    out = np.empty(len(buf) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_TABLE[buf] * powers(base, len(buf)), out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hashes of the byte strings [start, end) of the buffer that has these prefix sums."""
    return mix((sums[end] - sums[start]) * powers(_INVERSE[base], len(sums))[start] + (end - start).astype(np.uint64))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hashes of spans in ascending order, in pieces that bound the memory."""
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _PIECE, "right")))
        first = int(start[i])
        out[i:j] = between(prefix_sums(buf[first : int(end[i:j].max())], base), start[i:j] - first, end[i:j] - first, base)
        i = j
    return out


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and the offset of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def pieces(off: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `limit` bytes together, or a single longer text."""
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_spans(buf: np.ndarray, off: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of the first word of each text (one more entry than texts)."""
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[:-1] = ~blank[buf]
    before = np.zeros(len(buf) + 1, np.int8)
    before[1:] = inside[:-1]
    edges = off[1:-1]
    cut = edges[(edges > 0) & (edges < len(buf))]
    cut = cut[(inside[cut] == 1) & (before[cut] == 1)]
    change = inside - before
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if len(cut):
        cut = np.unique(cut)
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    return start, end, np.searchsorted(start, off, "left")

#: Bytes that are no part of an alphabetic word: ASCII but for letters.  Bytes from 128 on belong to words.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[128:] = False
NOT_LETTER[65:91] = NOT_LETTER[97:123] = False


def lower(buf: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and Latin-1 letters in UTF-8; other bytes stay."""
    out = LOWER[buf]
    if len(out) > 1:
        second = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        out[1:][second] += 0x20
    return out

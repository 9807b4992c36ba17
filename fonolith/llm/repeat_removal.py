"""Removal of repeated passages by prefix-free parsing.

Texts are parsed into phrases at trigger strings, found by a rolling hash: in every window of `length` bytes the trigger
with the least hash (the leftmost of equals) is the window's own, so each window has a trigger, and equal windows have it at
the same place.  The windows that share a trigger occurrence make up a phrase: its bytes hold all of them.  A phrase that
occurs again repeats all its windows, whatever they are: the parse decides.

Distinct phrases that share a trigger may have some windows in common.  A range of triggers is a small, highly repetitive
corpus of such phrases; it is parsed again, now prefix-free: at every string of eight bytes whose rolling hash is 0 modulo
a number, each piece ending with the trigger that the next one begins with.  The suffixes of the dictionary of distinct
pieces are sorted by prefix doubling, and so are the suffixes of the parse.  A place of the corpus is a suffix of a piece
and then a suffix of the parse; as no such suffix of a piece is a prefix of another one, the pair of ranks puts all places in
the order of the suffixes of the corpus.  There equal windows are neighbours, and they are compared byte by byte.  Of equal
windows the first by document and place is kept.

Texts are dealt into groups.  A group sends each distinct phrase once, in blobs by ranges of trigger hashes, so a passage
that occurs very often takes one entry a group; a range decides for all groups; answers meet the group's texts again.
Where a trigger has very many distinct phrases (it ends a line that is everywhere, say), windows instead of phrases go
to ranges of their own hashes, each distinct window once a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import dealing
from fonolith.workers import ready

#: Bytes of a window and of a trigger; bytes of text in a group, on average.
LENGTH, TRIGGER = 100, 32
GROUP = 8 << 20
_PIECE, _PLACE = 1 << 20, np.uint64(26)
#: Bytes of a trigger of the second parse, and the number that its hashes are taken modulo.
INNER, INNER_MOD = 8, np.uint64(16)
#: What the parse says of a phrase: its windows are new, all occur earlier, its suffixes must be compared, or there are
#: too many phrases with its trigger (more than CROWD) to meet in one place, so that its windows go to their own ranges.
#: Phrases of a trigger, and windows there, are equal if 128 bits of hashes are; else windows are compared by bytes.
NEW, REPEATED, COMPARE, SCATTER = 0, 1, 2, 3
CROWD = 4096
#: Windows of a range that are put in order at a time, or those of one trigger if these are more (69 * CROWD at most).
CHUNK = 200_000


def slices(off: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Offsets of the texts of each piece; a longer text comes in slices that share length - 1 bytes, so each window is in one.

    No piece is so long that a place in it needs more than _PLACE bits.
    """
    most = min(_PIECE, (1 << int(_PLACE)) - length + 1)
    for i, j in tk.pieces(off, most):
        if off[j] - off[i] <= most:
            yield off[i : j + 1]
            continue
        for a in range(int(off[i]), int(off[j]) - length + 1, most):
            yield np.array([a, min(a + most + length - 1, int(off[j]))])


def parse(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, trigger: int = TRIGGER) -> dict[str, np.ndarray]:
    """The phrases of texts in corpus order: trigger hash, phrase hash, first window, number of windows, trigger's distance."""
    keys = ("key", "phrase", "start", "windows", "ahead")
    parts: dict[str, list[np.ndarray]] = {k: [] for k in keys}
    span = length - trigger + 1
    for ends in slices(off, length):
        base, own = int(ends[0]), ends - ends[0]
        data = buf[base : int(ends[-1])]
        many = np.maximum(np.diff(own) - length + 1, 0)
        if not many.sum():
            continue
        sums = tk.prefix_sums(data)
        place = np.arange(len(data) - trigger + 1)
        h = tk.between(sums, place, place + trigger)
        low = (h >> _PLACE << _PLACE) | place.astype(np.uint64)
        width = 1
        while width * 2 <= span:  # the minimum of twice as many neighbours, then of span
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        text = np.repeat(np.arange(len(many)), many)
        window = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + own[:-1][text]
        at = (low[window] & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        cut = np.flatnonzero(first)
        windows, start, at = np.diff(np.append(cut, len(first))), window[cut], at[cut]
        ahead = at - start
        phrase = tk.combine(tk.between(sums, start, start + windows + length - 1), (ahead * length + windows).astype(np.uint64))
        # the least of many hashes is small; mixed again, triggers spread over all ranges
        for k, v in zip(keys, (tk.mix(h[at]), phrase, start + base, windows, ahead), strict=True):
            parts[k].append(v)
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
    return {k: np.concatenate(v) if v else np.zeros(0, kind) for (k, v), kind in zip(parts.items(), kinds, strict=True)}


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """The rank (from 1) of each row by the keys, the first one first; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def _doubled(rank: np.ndarray, rest: np.ndarray, known: int) -> np.ndarray:
    """Ranks of suffixes, from the ranks of their first `known` symbols.  rest: symbols from each place to its string's end."""
    most = int(rest.max(initial=0))
    while known < most and rank.max(initial=0) < len(rank):
        on = rest > known
        after = np.zeros(len(rank), np.int64)
        after[on] = rank[np.flatnonzero(on) + known]
        rank, known = _ranks(rank, after), known * 2
    return rank


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; zeros after the end."""
    wide = np.append(data, np.zeros(8, np.uint8))
    return np.lib.stride_tricks.sliding_window_view(wide, 8)[: len(data)].copy().view(">u8").ravel().astype(np.uint64)


def _runs(size: np.ndarray) -> np.ndarray:
    """0, 1, ... for each entry, as many as it says."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def prefix_free(data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each piece of the texts begins (one after the other in data), its length, and the text it is of."""
    end = np.cumsum(size)
    sums, place = tk.prefix_sums(data), np.arange(max(0, len(data) - INNER + 1))
    text = np.searchsorted(end, place, "right")
    hit = (tk.between(sums, place, place + INNER) % INNER_MOD == 0) & (place + INNER <= end[np.minimum(text, len(end) - 1)])
    begin = np.union1d(place[hit], (end - size)[size > 0])
    text = np.searchsorted(end, begin, "right")
    last = np.append(text[1:] != text[:-1], True)
    stop = np.where(last, end[text], np.append(begin[1:], 0) + INNER)
    return begin, stop - begin, text


def corpus_order(data: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The order of the suffixes of texts that begin at the given places of data, by the suffix arrays of dictionary and parse."""
    begin, length, text = prefix_free(data, size)
    # the dictionary: one of each distinct piece; pieces of equal hash are held against it byte by byte
    sums = tk.prefix_sums(data)
    names, first, word = np.unique(tk.between(sums, begin, begin + length), return_index=True, return_inverse=True)
    k = _runs(length)
    if (length != length[first][word]).any() or (data[np.repeat(begin, length) + k] != data[np.repeat(begin[first][word], length) + k]).any():
        raise ArithmeticError("two pieces of a text have the same hash")
    own = length[first]
    at = np.cumsum(own) - own  # where each word of the dictionary begins
    k = _runs(own)
    words, rest = data[np.repeat(begin[first], own) + k], np.repeat(own, own) - k
    short = np.minimum(rest, 8)
    head = _eight(words) & np.where(short == 8, ~np.uint64(0), ~(~np.uint64(0) >> (8 * (short % 8)).astype(np.uint64)))
    suffix = _doubled(_ranks(head, short), rest, 8)
    # the parse: the rank of each piece's word, one text after the other
    last = np.append(text[1:] != text[:-1], True)
    ends = np.flatnonzero(last)
    to_end = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text)) + 1
    parse = _doubled(_ranks(suffix[at[word]]), to_end, 1)
    after = np.where(last, 0, np.append(parse[1:], 0))
    piece = np.searchsorted(begin, place, "right") - 1
    return np.lexsort((after[piece], suffix[at[word[piece]] + place - begin[piece]]))


def equal_windows(data: np.ndarray, size: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """A number for each place that places of equal windows of data share; -1 for a window without an equal.

    In the order of the corpus equal windows are neighbours.
    """
    order = corpus_order(data, size, place)
    at, eight = place[order], _eight(data)
    same = np.arange(1, len(at))  # neighbours that agree so far
    for o in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length > 8 else [])]:
        same = same[eight[at[same] + o] == eight[at[same - 1] + o]]
    if length < 8:
        same = same[[bytes(data[at[i] : at[i] + length]) == bytes(data[at[i - 1] : at[i - 1] + length]) for i in same]] if len(same) else same
    new = np.ones(len(at), bool)
    new[same] = False
    number = np.cumsum(new) - 1
    out = np.full(len(at), -1)
    shared = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.zeros(0, bool)
    out[order[shared]] = number[shared]
    return out


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a), codec="zstd", asbytes=True) if a.size else b""


def _unpack(blob: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


#: What groups and ranges send each other: group, range, kind, number of entries, and blobs of what each kind has of it.
_BLOBS = ("keys", "hashes", "docs", "places", "data", "state")
_ROW = {"g": pa.int32(), "r": pa.int32(), "kind": pa.int32(), "size": pa.int64(), **{c: pa.binary() for c in _BLOBS}}
_SCHEMA = "g int, r int, kind int, size long, " + ", ".join(f"{c} binary" for c in _BLOBS)
#: Kinds: distinct phrases and what the parse says of them, the states of a group (to itself), phrases to compare, windows.
PHRASES, STATES, COMPARED, WINDOWS = 0, 1, 2, 3


def _table(rows: list[dict]) -> pa.Table:
    return pa.table([pa.array([r.get(c) for r in rows], k) for c, k in _ROW.items()], names=list(_ROW))


def _of(table: pa.Table, kind: int) -> pa.Table:
    """The rows of a kind, by range."""
    return table.filter(pa.array(np.asarray(table.column("kind")) == kind)).sort_by("r")


def _blobs(table: pa.Table, column: str, kind: type, sizes: list[int] | None = None) -> list[np.ndarray]:
    sizes = table.column("size").to_pylist() if sizes is None else sizes
    return [_unpack(b, kind, n) for b, n in zip(table.column(column).to_pylist(), sizes, strict=True)]


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _sorted_keys(table: pa.Table) -> np.ndarray:
    return _joined([np.cumsum(d, dtype=np.uint64) for d in _blobs(table, "keys", np.uint64)], np.uint64)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.append(keys[:1], np.diff(keys)))


def _answers(asked: pa.Table, kind: int, values: list[np.ndarray], pack) -> list[dict]:
    return [{"g": g, "r": r, "kind": kind, "size": len(v), "state": pack(v)} for g, r, v in zip(asked.column("g").to_pylist(), asked.column("r").to_pylist(), values, strict=True)]


def _bits(v: np.ndarray) -> bytes:
    return _pack(np.packbits(v))


def _split(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1]) if sizes else []


def _cuts(keys: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of sorted 64-bit keys."""
    cut = np.searchsorted(keys, np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64))
    return [(r, int(a), int(z)) for r, (a, z) in enumerate(zip(np.append(0, cut), np.append(cut, len(keys)), strict=True)) if a < z]


class Group:
    """The texts of a group in corpus order, parsed."""

    def __init__(self, table: pa.Table, length: int, trigger: int) -> None:
        self.length = length
        self.table = table.sort_by([("o", "ascending"), ("t", "ascending")])
        self.buf, self.off = tk.flat(self.table.column("t"))
        self.ids = np.asarray(self.table.column("o")).astype(np.int64)
        # rows that repeat an id come one after the other
        run = np.arange(len(self.ids))
        again = run - np.maximum.accumulate(np.where(np.append(True, self.ids[1:] != self.ids[:-1]), run, 0)) if len(run) else run
        self.p = p = parse(self.buf, self.off, length, trigger)
        text = np.searchsorted(self.off, p["start"], "right") - 1
        self.doc, self.place = self.ids[text], p["start"] - self.off[text] + (again[text] << 40)
        # one of each distinct phrase goes out: the first in corpus order
        order = np.lexsort((p["start"], p["phrase"], p["key"]))
        key, phrase = p["key"][order], p["phrase"][order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (phrase[1:] != phrase[:-1])
        self.sent, self.again = order[new], order[~new]

    def phrases(self, g: int, ranges: int) -> Iterator[dict]:
        """The distinct phrases, for the ranges of their triggers."""
        p, s = self.p, self.sent
        for r, a, z in _cuts(p["key"][s], ranges):
            w = s[a:z]
            yield {"g": g, "r": r, "kind": PHRASES, "size": z - a, "keys": _pack_keys(p["key"][w]), "hashes": _pack(p["phrase"][w]), "docs": _pack(self.doc[w]), "places": _pack(self.place[w])}

    def states(self, answers: pa.Table) -> np.ndarray:
        """What the ranges say of each phrase."""
        out = np.zeros(len(self.p["key"]), np.uint8)
        out[self.sent] = _joined(_blobs(_of(answers, PHRASES), "state", np.uint8), np.uint8)
        out[self.again] = REPEATED
        return out

    def to_compare(self, g: int, state: np.ndarray, ranges: int) -> Iterator[dict]:
        """The bytes of the phrases in state COMPARE, for the ranges of their triggers."""
        p, some = self.p, self.sent[state[self.sent] == COMPARE]
        for r, a, z in _cuts(p["key"][some], ranges):
            w = some[a:z]
            n = p["windows"][w] + self.length - 1
            yield {"g": g, "r": r, "kind": COMPARED, "size": z - a, "keys": _pack_keys(p["key"][w]), "hashes": _pack(p["windows"][w]), "docs": _pack(self.doc[w]), "places": _pack(self.place[w]), "data": _pack(self.buf[np.repeat(p["start"][w], n) + _runs(n)])}

    def scattered(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of phrases in state SCATTER, the phrase of each; the distinct pairs of hashes, and the first window of each."""
        some = np.sort(self.sent[state[self.sent] == SCATTER])
        n = self.p["windows"][some]
        phrase, window = np.repeat(some, n), np.repeat(self.p["start"][some], n) + _runs(n)
        one, two = (tk.span_hashes(self.buf, window, window + self.length, b) for b in (tk._BASE, tk.OTHER_BASE))
        order = np.lexsort((window, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = order[new]
        return window, phrase, one[first], two[first], first

    def windows(self, g: int, state: np.ndarray, ranges: int) -> Iterator[dict]:
        """The distinct windows of phrases in state SCATTER, for the ranges of their hashes."""
        window, phrase, one, two, first = self.scattered(state)
        for r, a, z in _cuts(one, ranges):
            w = first[a:z]
            place = self.place[phrase[w]] + window[w] - self.p["start"][phrase[w]]
            yield {"g": g, "r": r, "kind": WINDOWS, "size": z - a, "keys": _pack_keys(one[a:z]), "hashes": _pack(two[a:z]), "docs": _pack(self.doc[phrase[w]]), "places": _pack(place)}

    def gone(self, state: np.ndarray, answers: pa.Table) -> np.ndarray:
        """Whether each byte goes, by the answers for phrases and windows."""
        p, length = self.p, self.length

        def hits(kind: int) -> np.ndarray:
            rows = _of(answers, kind)
            sizes = rows.column("size").to_pylist()
            bits = _blobs(rows, "state", np.uint8, [-(-n // 8) for n in sizes])
            return _joined([np.unpackbits(b)[:n] for b, n in zip(bits, sizes, strict=True)], np.uint8).astype(bool)

        edge = np.zeros(len(self.buf) + 1, np.int32)
        whole = np.flatnonzero(state == REPEATED)
        np.add.at(edge, p["start"][whole], 1)
        np.add.at(edge, p["start"][whole] + p["windows"][whole] + length - 1, -1)
        some = self.sent[state[self.sent] == COMPARE]
        n = p["windows"][some]
        compared = (np.repeat(p["start"][some], n) + _runs(n))[hits(COMPARED)]
        scattered, _, _, _, first = self.scattered(state)
        repeated = np.ones(len(scattered), bool)
        repeated[first] = hits(WINDOWS)
        for w in (compared, scattered[repeated]):
            np.add.at(edge, w, 1)
            np.add.at(edge, w + length, -1)
        return np.cumsum(edge[:-1]) > 0


def decide(keys: np.ndarray, phrases: np.ndarray, docs: np.ndarray, places: np.ndarray, crowd: int = CROWD) -> np.ndarray:
    """The state of each phrase of a range: by the number of phrases of its trigger, and whether it occurs earlier."""
    order = np.lexsort((places, docs, phrases, keys))
    k, p = keys[order], phrases[order]
    new_key, new = np.ones(len(k), bool), np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new[1:] = new_key[1:] | (p[1:] != p[:-1])
    group = np.cumsum(new_key) - 1
    distinct = np.bincount(group, new)
    many = distinct[group]
    state = np.where(~new, REPEATED, np.where(many > crowd, SCATTER, np.where(many > 1, COMPARE, NEW)))
    out = np.empty(len(k), np.uint8)
    out[order] = state
    return out


def settle(keys: np.ndarray, docs: np.ndarray, places: np.ndarray, windows: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """For each window of the phrases of a range, whether an equal one occurs earlier.

    data: the bytes of the phrases one after the other, each windows + length - 1 long.  Equal windows have one trigger;
    the phrases of some triggers at a time bound the memory.
    """
    size = windows + length - 1
    begin, first = np.cumsum(size) - size, np.cumsum(windows) - windows
    out = np.zeros(int(windows.sum()), bool)
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(order) else np.zeros(0, int)
    upto = np.append(0, np.cumsum(windows[order]))
    part = np.unique(upto[edges] // CHUNK, return_index=True)[1]
    cuts = np.append(edges[part], len(order))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        some = order[a:z]
        n, k = windows[some], _runs(windows[some])
        own = np.repeat(np.arange(len(some)), n)
        texts = data[np.repeat(begin[some], size[some]) + _runs(size[some])]
        group = equal_windows(texts, size[some], (np.cumsum(size[some]) - size[some])[own] + k, length)
        tied = np.flatnonzero(group >= 0)
        o = tied[np.lexsort((places[some][own[tied]] + k[tied], docs[some][own[tied]], group[tied]))]
        hit = o[1:][group[o][1:] == group[o][:-1]]
        out[first[some][own[hit]] + k[hit]] = True
    return out


def reply(table: pa.Table, crowd: int) -> pa.Table:
    """A range says what it knows of each phrase."""
    state = decide(_sorted_keys(table), *(_joined(_blobs(table, c, kind), kind) for c, kind in (("hashes", np.uint64), ("docs", np.int64), ("places", np.int64))), crowd)
    return _table(_answers(table, PHRASES, _split(state, table.column("size").to_pylist()), _pack))


def answer(table: pa.Table, length: int) -> pa.Table:
    """A range says which windows occur earlier: of phrases that it compares, and of windows scattered by hash."""
    rows = _of(table, STATES).select(["g", "r", "kind", "size", "state"]).to_pylist()
    asked = _of(table, COMPARED)
    if asked.num_rows:
        windows = _blobs(asked, "hashes", np.int64)
        data = _joined(_blobs(asked, "data", np.uint8, [int((w + length - 1).sum()) for w in windows]), np.uint8)
        hit = settle(_sorted_keys(asked), *(_joined(_blobs(asked, c, np.int64), np.int64) for c in ("docs", "places")), _joined(windows, np.int64), data, length)
        rows += _answers(asked, COMPARED, _split(hit, [int(w.sum()) for w in windows]), _bits)
    asked = _of(table, WINDOWS)
    if asked.num_rows:
        one, two = _sorted_keys(asked), _joined(_blobs(asked, "hashes", np.uint64), np.uint64)
        order = np.lexsort((*(_joined(_blobs(asked, c, np.int64), np.int64) for c in ("places", "docs")), two, one))
        hit = np.zeros(len(one), bool)
        hit[order[1:]] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        rows += _answers(asked, WINDOWS, _split(hit, asked.column("size").to_pylist()), _bits)
    return _table(rows)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, trigger: int = TRIGGER, with_kept: bool = True, crowd: int = CROWD, group: int = GROUP) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) and, with_kept, kept (binary): a row for each row of docs.

    Every byte goes that a `length`-byte string covers which starts earlier too (smaller key, or same row at an earlier
    byte); overlaps count, no string crosses rows, and strings are judged on the input.  Null counts as an empty text.
    Rows that repeat a key are in the order of their texts, and rows with a null key come last, in the order of a hash of
    their texts.  Very long texts are parsed whole, in slices.  An empty table gives an empty table.  The key must be a
    whole number below 2**62.  Triggers with more than `crowd` distinct phrases are scattered; group: bytes of texts that a
    task holds.
    """
    ready(docs.sparkSession)
    t = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(t))).first()[0] or 0
    groups, ranges = dealing(docs.sparkSession, size, group)
    k = F.col(key).cast("long")
    place = F.coalesce(k, F.lit(2**62) + F.shiftrightunsigned(F.xxhash64(F.lit(37), t), 2))
    dealt = docs.select(k.alias("k"), place.alias("o"), t.alias("t")).withColumn("g", F.pmod(F.xxhash64(F.lit(31), "o"), F.lit(groups)).cast("int"))
    names = ["k", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept]

    def ask(table: pa.Table) -> pa.Table:
        return _table(list(Group(table, length, trigger).phrases(table.column("g")[0].as_py(), ranges)))

    def decided(table: pa.Table) -> pa.Table:
        return reply(table, crowd)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([])
        g, own = left.column("g")[0].as_py(), Group(left, length, trigger)
        state = own.states(right)
        rows = [{"g": g, "r": g, "kind": STATES, "size": len(state), "state": _pack(state)}]
        return _table(rows + list(own.to_compare(g, state, ranges)) + list(own.windows(g, state, ranges)))

    def answered(table: pa.Table) -> pa.Table:
        return answer(table, length)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            left = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.string())], names=["k", "o", "t"])
        own = Group(left, length, trigger)
        gone, off = own.gone(_joined(_blobs(_of(right, STATES), "state", np.uint8), np.uint8), right), own.off
        before = np.append(False, gone[:-1]) if len(gone) else gone
        before[off[:-1][off[:-1] < len(gone)]] = False
        total = lambda x: np.diff(np.append(0, np.cumsum(x))[off])
        kept = [own.buf[a:z][~gone[a:z]].tobytes() for a, z in zip(off[:-1], off[1:], strict=True)]
        columns = [own.table.column("k"), pa.array(np.diff(off), pa.int64()), pa.array(total(gone), pa.int64()), pa.array(total(gone & ~before), pa.int64()), pa.array([hashlib.sha256(b).hexdigest() for b in kept], pa.string()), pa.array(kept, pa.binary())]
        return pa.table(columns[: len(names)], names=names)

    replies = dealt.groupBy("g").applyInArrow(tk.lean(ask), _SCHEMA).groupBy("r").applyInArrow(tk.lean(decided), _SCHEMA)
    compared = dealt.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(tk.lean(compare), _SCHEMA)
    answers = compared.groupBy("r").applyInArrow(tk.lean(answered), _SCHEMA)
    schema = "k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return dealt.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(tk.lean(remove), schema).withColumnRenamed("k", key)


def op5_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_kept=False)


#: The same result in DuckDB's SQL, from all windows.
OP5_SQL = f"""
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(length(hex(encode(coalesce(text, '')))) // 2 AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, x, unnest(range(0, n - {LENGTH - 1})) AS i FROM h WHERE n >= {LENGTH}),
w AS (SELECT doc_id, i, md5_number(substring(x, 2 * i + 1, {2 * LENGTH})) AS k FROM p),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM w) WHERE place > 1),
runs AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run
         FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS opens FROM later)),
spans AS (SELECT doc_id, min(i) AS s, max(i) + {LENGTH} AS e FROM runs GROUP BY doc_id, run),
kept AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS b FROM spans),
cut AS (SELECT doc_id, sum(e - s) AS gone, count(*) AS n_spans, string_agg(substring(x, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) || substring(any_value(x), 2 * max(e) + 1) AS rest
        FROM kept JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, x))) AS kept_sha256 FROM h LEFT JOIN cut USING (doc_id)
"""

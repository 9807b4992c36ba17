"""Removal of passages that an earlier document has, by fixed-block anchors.

The index holds the non-overlapping blocks of BLOCK words of each document: the words from 0, BLOCK, 2 * BLOCK ... on.  A window
of WINDOW = 2 * BLOCK - 1 words has just one whole block of its document in it, so a repeated window is found by probing the
index with the BLOCK words from each word on.  A probe hits if some document has these words as a block and another one has
them too.  Hits are extended: a window that holds an anchor goes at most BLOCK - 1 words beyond it on either side, so the
BLOCK windows around the anchor say how far the text goes along with an earlier one, and as windows of neighbouring anchors
overlap, what is removed are maximal repeats of at least WINDOW words.

Texts are packed in chunks, written once.  A chunk sends each distinct probe once, with two bits, to ranges of their hashes;
a range says which are hits; the chunk's windows around hits go to ranges of their own hashes, each distinct one once with the
smallest document that has it around a block; the answer is the smallest of all.  So a passage that is everywhere takes one
entry a chunk, and no pair of documents is formed.

Probes have a hash of few bits: that a hit may be none costs an entry more.  Windows are equal by 96 bits of two hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import dealing, materialize
from fonolith.workers import ready

#: Words of a window and of a block.
WINDOW, BLOCK = 13, 7
#: Bytes of texts in a chunk, and that a range stands for, at least; bits of a probe's hash beyond those that count the bytes.
CHUNK, HELD, SPARE = 8 << 20, 64 << 20, 4
_PIECE = 1 << 20
_LEVEL = 5
_LAST = np.iinfo(np.int64).max
#: What chunks and ranges send each other: chunk, range, kind, number of entries, blobs.
_ROW = {"g": pa.int64(), "r": pa.int64(), "kind": pa.int32(), "size": pa.int64(), **{c: pa.binary() for c in ("keys", "more", "docs", "bits")}}
_SCHEMA = "g long, r long, kind int, size long, keys binary, more binary, docs binary, bits binary"
_CHUNK_SCHEMA = "size long, ids binary, known binary, off binary, data binary"
PROBES, ASKED, WINDOWS = 0, 1, 2


def pack(a: np.ndarray) -> bytes:
    """The numbers of an array by places of their bytes, compressed: places that are mostly zero cost little."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True) if a.size else b""


def unpack(blob: bytes, kind: type, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _sorted(keys: np.ndarray) -> bytes:
    return pack(np.append(keys[:1], np.diff(keys)))


def _unsorted(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64, n), dtype=np.uint64)


def _table(rows: list[dict]) -> pa.Table:
    return pa.table([pa.array([r.get(c) for r in rows], k) for c, k in _ROW.items()], names=list(_ROW))


def _ranges(keys: np.ndarray, bits: int, ranges: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of sorted hashes of so many bits."""
    cut = np.searchsorted(keys, np.array([(r << bits) // ranges for r in range(1, ranges)], np.uint64))
    for r, (a, z) in enumerate(zip(np.append(0, cut), np.append(cut, len(keys)), strict=True)):
        if a < z:
            yield r, int(a), int(z)


def chunks_of(docs: DataFrame, chunk: int) -> DataFrame:
    """Texts (k, t) in chunks (size, ids, known, off, data) of about so many bytes, or one longer text; known: bits of ids that aren't null."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            buf, off = tk.flat(batch.column(1))
            known = ~np.asarray(batch.column(0).is_null())
            ids = np.asarray(batch.column(0).fill_null(_LAST)).astype(np.int64)
            for i, j in tk.pieces(off, chunk):
                held.append((ids[i:j].copy(), known[i:j], np.diff(off[i : j + 1]), buf[off[i] : off[j]].copy()))
                if sum(len(h[3]) for h in held) >= chunk:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        ids, known, sizes, data = (np.concatenate(x) for x in zip(*held, strict=True))
        row = [len(ids), pack(ids), pack(np.packbits(known)), pack(sizes), pa.Codec("zstd", compression_level=_LEVEL).compress(data, asbytes=True) if len(data) else b""]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if k == 0 else pa.binary()) for k, v in enumerate(row)], names=["size", "ids", "known", "off", "data"])

    return docs.select("k", "t").mapInArrow(tk.lean(body), _CHUNK_SCHEMA)


class Chunk:
    """The texts of a chunk, their words and hashes of these."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, data: bytes) -> None:
        self.ids, self.known = ids, known
        self.off = np.append(0, np.cumsum(sizes)).astype(np.int64)
        n = int(self.off[-1])
        self.buf = np.frombuffer(pa.decompress(data, n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
        self.start, self.end, self.first = tk.word_spans(self.buf, self.off)
        self.count = np.diff(self.first)

    @classmethod
    def of(cls, row: dict) -> Chunk:
        n = row["size"]
        return cls(unpack(row["ids"], np.int64, n), np.unpackbits(unpack(row["known"], np.uint8, -(-n // 8)))[:n].astype(bool), unpack(row["off"], np.int64, n), row["data"])

    def words(self, base: int = tk._BASE) -> np.ndarray:
        return tk.span_hashes(self.buf, self.start, self.end, base)

    def places(self, words: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each run of so many words in texts that have a window, and the number of its text."""
        n = np.where(self.count >= window, self.count - words + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        return np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + self.first[:-1][text], text

    def probes(self, window: int, block: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first word, text and hash of each run of `block` words."""
        at, text = self.places(block, window)
        return at, text, run_hashes(self.words(), at, block) >> np.uint64(64 - bits)

    def joined(self, kept: np.ndarray) -> Iterator[bytes]:
        """The kept words of each text, joined by one space."""
        wide = np.append(self.buf, np.uint8(32))
        for i, j in tk.pieces(self.off, _PIECE):
            a, z = self.first[i], self.first[j]
            some = a + np.flatnonzero(kept[a:z])
            size = self.end[some] - self.start[some] + 1
            upto = np.cumsum(size)
            out = wide[np.arange(int(size.sum())) + np.repeat(self.start[some] - upto + size, size)]
            out[upto - 1] = 32
            edge = np.append(0, upto)[np.searchsorted(some, self.first[i : j + 1])]
            for x, y in zip(edge[:-1], edge[1:], strict=True):
                yield out[x : max(x, y - 1)].tobytes()


def run_hashes(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words from each place on."""
    h = np.zeros(len(at), np.uint64)
    for o in range(n):
        h = tk.combine(h, words[at + o])
    return h


def hits(keys: list[np.ndarray], flags: list[np.ndarray]) -> list[np.ndarray]:
    """Of each chunk's distinct probes of a range, those that are somebody's block and that two documents have.

    flags: 1 for a block of some document of the chunk, 2 if several documents of the chunk have the words.
    """
    every, said = np.concatenate(keys), np.concatenate(flags)
    order = np.argsort(every, kind="stable")
    new = np.append(True, every[order][1:] != every[order][:-1])
    first = np.flatnonzero(new)
    known = np.bitwise_or.reduceat(said[order], first)
    several = (np.diff(np.append(first, len(every))) > 1) | (known & 2 > 0)
    out = np.empty(len(every), bool)
    out[order] = (several & (known & 1 > 0))[np.cumsum(new) - 1]
    return np.split(out, np.cumsum([len(k) for k in keys])[:-1])


def earliest(one: np.ndarray, two: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each entry the smallest of docs of all entries with the same two hashes."""
    order = np.lexsort((two, one))
    new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))
    least = np.minimum.reduceat(docs[order], np.flatnonzero(new))
    out = np.empty(len(one), np.int64)
    out[order] = least[np.cumsum(new) - 1]
    return out


def distinct_windows(chunk: Chunk, at: np.ndarray, text: np.ndarray, window: int, anchored: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of the distinct windows at the given words, the smallest document that has each around a hit block of its own, and each window's number."""
    one = run_hashes(chunk.words(), at, window)
    two = (run_hashes(chunk.words(tk.OTHER_BASE), at, window) >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((two, one))
    new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])) if len(at) else np.zeros(0, bool)
    number = np.empty(len(at), np.int64)
    number[order] = np.cumsum(new) - 1
    docs = np.zeros(0, np.int64)
    if anchored is not None and len(at):
        docs = np.minimum.reduceat(np.where(anchored, chunk.ids[text], _LAST)[order], np.flatnonzero(new))
    return one[order][new], two[order][new], docs, number


def remove_earlier(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_kept: bool = True, chunk: int = CHUNK) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) and, with_kept, kept (binary): a row for each row of docs.

    Every word goes that is in a window of `window` (an odd number) consecutive words which also starts in a row with a smaller
    key; what goes is judged on the input.  kept: the other words, joined by one space.  Words are runs without blanks,
    compared as they are; null counts as an empty text, which has none.  Rows that repeat a key aren't earlier than each
    other; rows with a null key come after all others and don't count as earlier than any.  A very long text is read whole,
    by one task, which takes some 40 times its bytes.  An empty table gives an empty table.  chunk: bytes of texts that are
    packed together.
    """
    if window % 2 == 0:
        raise ValueError("a window must have an odd number of words")
    spark, block = docs.sparkSession, (window + 1) // 2
    ready(spark)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    # a chunk is small where else some cores would idle; from some TB on chunks and ranges grow with the root of the size
    groups, ranges = dealing(spark, size, chunk, held=max(HELD, math.isqrt(size * 10_000)))
    most = max(1, size // groups)
    bits = min(64, max(16, size.bit_length() + SPARE))
    chunks = materialize(chunks_of(rows, most).withColumn("g", F.monotonically_increasing_id()))
    names = ["k", "n_words", "n_removed", "kept_sha256", "kept"][: 4 + with_kept]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Chunk.of(row)
                at, doc, h = own.probes(window, block, bits)
                order = np.argsort(h, kind="stable")
                keys, first = np.unique(h[order], return_index=True)
                flags = np.zeros(len(keys), np.uint8)
                if len(keys):
                    ids = own.ids[doc][order]
                    flags |= np.bitwise_or.reduceat(((at - own.first[:-1][doc]) % block == 0).astype(np.uint8)[order], first)
                    flags |= (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)).astype(np.uint8) * 2
                sent = [{"g": row["g"], "r": r, "kind": PROBES, "size": z - a, "keys": _sorted(keys[a:z]), "bits": pack(flags[a:z])} for r, a, z in _ranges(keys, bits, ranges)]
                yield from _table(sent).to_batches()

    def reply(table: pa.Table) -> pa.Table:
        asked = table.select(["g", "r", "size", "keys", "bits"]).to_pylist()
        found = hits([_unsorted(r["keys"], r["size"]) for r in asked], [unpack(r["bits"], np.uint8, r["size"]) for r in asked])
        return _table([{"g": r["g"], "r": r["r"], "kind": PROBES, "size": r["size"], "bits": pack(np.packbits(f))} for r, f in zip(asked, found, strict=True)])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            own, g = Chunk.of(row), row["g"]
            at, doc, h = own.probes(window, block, bits)
            hit = np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(unpack(r["bits"], np.uint8, -(-r["size"] // 8)))[: r["size"]] for r in sorted(right.select(["r", "size", "bits"]).to_pylist(), key=lambda r: r["r"]))]).astype(bool)
            struck = np.zeros(len(own.start) + block, bool)
            struck[at] = hit[np.searchsorted(np.unique(h), h)]
            # windows that hold a hit, and whether the block of the text itself that they hold is one
            place, owner = own.places(window, window)
            ahead = np.cumsum(np.append(0, struck))
            some = ahead[place + block] > ahead[place]
            place, owner = place[some], owner[some]
            inside = place - own.first[:-1][owner]
            anchored = struck[place + (-inside) % block]
            one, two, ids, _ = distinct_windows(own, place, owner, window, anchored)
            out += [{"g": g, "r": r, "kind": WINDOWS, "size": z - a, "keys": _sorted(one[a:z]), "more": pack(two[a:z]), "docs": pack(ids[a:z])} for r, a, z in _ranges(one, 64, ranges)]
            marks = np.zeros(len(own.start), bool)
            marks[place] = True
            out.append({"g": g, "r": (g + (g >> 33)) % ranges, "kind": ASKED, "size": len(marks), "bits": pack(np.packbits(marks))})
        return _table(out)

    def answer(table: pa.Table) -> pa.Table:
        passed = table.filter(pa.array(np.asarray(table.column("kind")) == ASKED))
        asked = table.filter(pa.array(np.asarray(table.column("kind")) == WINDOWS)).select(["g", "r", "size", "keys", "more", "docs"]).to_pylist()
        if not asked:
            return passed.cast(_table([]).schema)
        sizes = [r["size"] for r in asked]
        found = earliest(*(np.concatenate([f(r) for r in asked]) for f in (lambda r: _unsorted(r["keys"], r["size"]), lambda r: unpack(r["more"], np.uint32, r["size"]), lambda r: unpack(r["docs"], np.int64, r["size"]))))
        said = [{"g": r["g"], "r": r["r"], "kind": WINDOWS, "size": r["size"], "docs": pack(x)} for r, x in zip(asked, np.split(found, np.cumsum(sizes)[:-1]), strict=True)]
        return pa.concat_tables([passed.cast(_table([]).schema), _table(said)])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: len(names)]], names=names)
        own, said = Chunk.of(left.to_pylist()[0]), right.to_pylist()
        marks = next(np.unpackbits(unpack(r["bits"], np.uint8, -(-r["size"] // 8)))[: r["size"]] for r in said if r["kind"] == ASKED)
        place = np.flatnonzero(marks)
        owner = np.searchsorted(own.first, place, "right") - 1
        least = np.concatenate([np.zeros(0, np.int64), *(unpack(r["docs"], np.int64, r["size"]) for r in sorted((r for r in said if r["kind"] == WINDOWS), key=lambda r: r["r"]))])
        number = distinct_windows(own, place, owner, window)[3]
        gone = place[least[number] < own.ids[owner]]
        edge = np.bincount(gone, minlength=len(own.start) + 1) - np.bincount(gone + window, minlength=len(own.start) + 1)
        kept = np.cumsum(edge[: len(own.start)]) == 0
        removed = np.diff(np.append(0, np.cumsum(~kept))[own.first])
        hexes, texts = [], []
        for x in own.joined(kept):
            hexes.append(hashlib.sha256(x).hexdigest())
            if with_kept:
                texts.append(x)
        columns = [pa.array(own.ids, pa.int64(), mask=~own.known), pa.array(own.count, pa.int64()), pa.array(removed, pa.int64()), pa.array(hexes, pa.string()), pa.array(texts, pa.binary())]
        return pa.table(columns[: len(names)], names=names)

    probes = chunks.mapInArrow(tk.lean(ask), _SCHEMA)
    struck = probes.groupBy("r").applyInArrow(tk.lean(reply), _SCHEMA)
    compared = chunks.groupBy("g").cogroup(struck.groupBy("g")).applyInArrow(tk.lean(compare), _SCHEMA)
    answers = compared.groupBy("r").applyInArrow(tk.lean(answer), _SCHEMA)
    schema = "k long, n_words long, n_removed long, kept_sha256 string" + ", kept binary" * with_kept
    return chunks.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(tk.lean(remove), schema).withColumnRenamed("k", key)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_kept=False)


#: The same result in DuckDB's SQL, from all windows.
OP11_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {WINDOW}),
k AS (SELECT doc_id, i, md5_number(array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ')) AS k FROM p),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM k) WHERE first < doc_id),
words AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM gone),
cut AS (SELECT doc_id, list(i) AS gone FROM words GROUP BY doc_id),
kept AS (SELECT w.doc_id, ws, gone, CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM w LEFT JOIN cut ON cut.doc_id = w.doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept
"""

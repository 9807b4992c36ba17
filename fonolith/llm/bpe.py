"""Byte-level BPE encoding and decoding.

A text is cut at special tokens and then by the pre-tokenizer's pattern; each piece becomes byte symbols in a doubly
linked list, and a priority queue of (merge rank, place) joins the best pair until none is left.  Entries of the queue
whose symbols have changed since are stale and skipped.  Decoding concatenates vocabulary strings.  Pieces repeat, so
each Python worker keeps what it has encoded in a table of bounded size.  The vocabulary's path is a parameter; the file
is read where it is used.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from fonolith.llm import textkernel as tk
from fonolith.workers import ready

#: The pattern of the byte-level pre-tokenizer (a fixed value), with blanks as Unicode's property White_Space.
_W = r"\p{White_Space}"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_W}\p{{L}}\p{{N}}]+|{_W}+(?!(?!{_W})[\s\S])|{_W}+"
#: The same for texts of ASCII, for the quicker engine: letters, digits and blanks are the ASCII ones.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Encoded pieces that a worker keeps: so many of late, and so many before, of which those in use move on.  Longer pieces
#: are encoded each time.
CACHE, CACHED_CHARS = 160_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next letter from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, after = [], 256
    for b in range(256):
        out.append(chr(b) if b in kept else chr(after))
        after += b not in kept
    return out


class Tokenizer:
    """An encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.letters = spec["model"], byte_letters()
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = {vocab[a] << 24 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.byte_ids = [vocab[c] for c in self.letters]
        back = {c: b for b, c in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings = {str(i): bytes(back[c] for c in s) for s, i in vocab.items()} | {str(i): s.encode() for s, i in self.special.items()}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pattern, self.ascii_pattern = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        self.known: dict[str, str] = {}
        self.before: dict[str, str] = {}

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece of text."""
        merges, ids, n = self.merges, list(map(self.byte_ids.__getitem__, data)), len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m[0], i, a, b, m[1]) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := merges.get(a << 24 | b))]
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            _, i, left, right, new = pop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get(new << 24 | ids[k]):
                    push(queue, (m[0], i, new, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get(ids[h] << 24 | new)):
                push(queue, (m[0], h, ids[h], new, m[1]))
        return [x for x in ids if x >= 0]

    def _miss(self, piece: str) -> str:
        out = self.before.get(piece) or ",".join(map(str, self.piece(piece.encode("utf-8"))))
        if len(piece) <= CACHED_CHARS:
            if len(self.known) >= CACHE:
                self.known, self.before = {}, self.known
            self.known[piece] = out
        return out

    def encode(self, text: str) -> str:
        """The decimal ids of text, joined by commas."""
        parts: list[str] = []
        at = 0
        if self.split:
            for m in self.split.finditer(text):
                parts += self._ordinary(text[at : m.start()])
                parts.append(str(self.special[m[0]]))
                at = m.end()
        parts += self._ordinary(text[at:] if at else text)
        return ",".join(parts)

    def _ordinary(self, text: str) -> list[str]:
        pieces = (self.ascii_pattern if text.isascii() else self.pattern).findall(text)
        miss, known = self._miss, self.known  # misses may start a new table; this text goes on with the one it has
        return [known.get(p) or miss(p) for p in pieces]

    def decode(self, ids: str) -> str:
        """The text of decimal ids joined by commas; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.strings.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


_open: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _open:
        _open[path] = Tokenizer(path)
        tk.keeps(__name__, _open.clear)
        tk.give_back()  # reading the file takes more than what stays
    return _open[path]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) and, with_ids, the ids (array<int>) and the decoded text.

    Null counts as empty: no tokens, and the hashes of an empty string.  Rows that repeat are encoded alike, an empty
    table gives an empty table, and no other column is read.  No row is shuffled.
    """
    ready(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, sha = tokenizer(path), hashlib.sha256
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for s in part.column(1).to_pylist():
                    ids = t.encode(s or "")
                    back = t.decode(ids)
                    row = [ids.count(",") + 1 if ids else 0, sha(ids.encode()).hexdigest(), sha(back.encode("utf-8")).hexdigest()]
                    rows.append(row + [list(map(int, ids.split(","))) if ids else [], back] if with_ids else row)
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=False))], names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 4 + 2 * with_ids])

    return docs.select(key, text).mapInArrow(tk.lean(body), schema)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)

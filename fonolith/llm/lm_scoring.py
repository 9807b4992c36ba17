"""Language-model scores by a weighted backoff automaton of order three.

States are histories that occur in the training texts: none (the root), one token, two tokens.  A state has an arc for
each token that follows it in training, with the smoothed log-probability of the token, to the state of the longest
history that goes on; and a failure arc to the state of the shorter history, with the log of the backoff weight.  A text
is scored in one traversal from left to right that carries the state: where a state has no arc for the next token, the
failure arc is taken and its weight added, until one has; the root takes every token.

Smoothing: the root adds one, and order n mixes with order n-1 by a Dirichlet prior: p(w|h) = (c(hw) + m p(w|h')) /
(c(h) + m) on arcs and m / (c(h) + m) on failure arcs, so the probabilities of each state sum to one.  The strength m of
an order is the one at which failures are as frequent as new n-grams are when each training token is left out: it solves
sum over h of c(h) m / (c(h) - 1 + m) = number of n-grams seen once.

Counts cover all training texts and never meet in one place: texts are dealt into groups; a group asks for the counts of
its distinct n-grams, in blobs by ranges of their hashes (64 bits for tokens; for n-grams so many that about one lookup in
half a million meets another n-gram's hash, whatever the size of the input); each range adds up all groups' counts and answers each blob;
a group builds the part of the automaton that its texts can reach from the answers and walks it.  Hot words and n-grams
take one entry a group however often they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import dealing, materialize
from fonolith.workers import ready

#: Bytes of text in a group, on average.
GROUP = 8 << 20
#: Tokens of n-grams; the most tokens that one lane of a traversal scores.
ORDER, LANE = 3, 256
#: Hashes of the end of a text and of the start state (fixed values no word is likely to have).
END, START = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
#: Counts up to this have a bin of their own in histograms; larger ones share bins of five leading bits.
EXACT = 256
_ENDS = np.uint32(1 << 31)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token (words in lower case, then one end), and where each text begins."""
    buf, off = tk.flat(texts)
    buf = tk.LOWER[buf]
    start, end, first = tk.word_spans(buf, off)
    n = len(off) - 1
    begin = first + np.arange(n + 1)
    token = np.empty(int(begin[-1]), np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    token[np.arange(len(start)) + owner] = tk.span_hashes(buf, start, end)
    token[begin[1:] - 1] = END
    return token, begin


def ngrams(token: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the bigram and the trigram that end at each token, and which tokens have a trigram (all but first ones).

    The start state stands before the first token.  An n-gram's hash is that of its history's hash and its last token.
    """
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[begin[:-1]] = START
    pair = tk.combine(before, token)
    inner = np.ones(len(token), bool)
    inner[begin[:-1]] = False
    three = np.empty_like(token)
    three[1:] = tk.combine(pair[:-1], token[1:])
    return pair, three, inner


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a), codec="zstd", asbytes=True) if len(a) else b""


def _unpack(blob: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, the bytes of one weight together: the upper ones are zeros and cost nothing."""
    steps = np.append(keys[:1], np.diff(keys))
    return _pack(steps.view(np.uint8).reshape(-1, 8).T)


def _unpack_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(_unpack(blob, np.uint8, 8 * n).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _requests(keys: np.ndarray, counts: np.ndarray, bits: int, ranges: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(range, number of keys, keys, counts) for each range of sorted keys of so many bits."""
    cut = np.searchsorted(keys, np.array([(r << bits) // ranges for r in range(1, ranges)], np.uint64))
    for r, (a, z) in enumerate(zip(np.append(0, cut), np.append(cut, len(keys)), strict=True)):
        if a < z:
            yield r, int(z - a), _pack_keys(keys[a:z]), _pack(counts[a:z])


def counted(keys: np.ndarray, learn: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and how often each occurs among those to learn from; the top bit marks keys that end a text."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(new)
    counts = np.add.reduceat(learn[order].astype(np.uint32), at) if len(at) else np.zeros(0, np.uint32)
    if ends is not None and len(at):
        counts = counts | np.where(ends[order][at], _ENDS, np.uint32(0))
    return k[at], counts.astype(np.uint32)


def bins(counts: np.ndarray) -> np.ndarray:
    """The bin of each count: its own up to EXACT, else the least count with the same five leading bits."""
    drop = np.maximum(np.floor(np.log2(np.maximum(counts, 1).astype(np.float64))).astype(np.int64) - 4, 0)
    return np.where(counts <= EXACT, counts.astype(np.int64), counts.astype(np.int64) >> drop << drop)


def answer(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The sum of the counts of equal keys, for each key of each list; the sums of distinct keys, and which of them end texts."""
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    many = np.concatenate(counts)
    total = np.bincount(where, (many & ~_ENDS).astype(float), len(distinct)).astype(np.uint64)  # over all groups: more than 32 bits
    ends = np.zeros(len(distinct), bool)
    ends[where[many >= _ENDS]] = True
    return np.split(total[where], np.cumsum([len(k) for k in keys])[:-1]), total, ends


def strength(histories: dict[int, tuple[int, int]], once: int) -> float:
    """The m that solves sum c m / (c - 1 + m) = once.  histories: bin of counts -> (histories, sum of their counts)."""
    if not histories:
        return 1.0
    n, total = (np.array(x, float) for x in zip(*histories.values(), strict=True))
    c = total / n
    low, high = 1e-3, 1e9
    for _ in range(100):
        m = np.sqrt(low * high)
        low, high = (m, high) if (total * m / (c - 1 + m)).sum() < once else (low, m)
    return float(np.sqrt(low * high))


class Directory:
    """Values by 64-bit keys that are spread evenly: sorted, with the place where each run of leading bits begins."""

    def __init__(self, keys: np.ndarray) -> None:
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        self.start = np.searchsorted(self.keys, np.arange(1 << int(64 - int(self.shift)), dtype=np.uint64) << self.shift)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The number (as given) of each key, -1 for one that isn't there."""
        out = np.full(len(key), -1)
        if not len(self.keys):
            return out
        at, live = self.start[(key >> self.shift).astype(np.int64)], np.arange(len(key))
        while len(live):
            at = np.minimum(at, len(self.keys) - 1)
            have = self.keys[at]
            hit = have == key[live]
            out[live[hit]] = self.order[at[hit]]
            on = (have < key[live]) & (at < len(self.keys) - 1)
            live, at = live[on], at[on] + 1
        return out


class Automaton:
    """States, arcs and failure arcs of n-grams and their counts.

    A state is known by the hash of its history, and an arc by the hash of the state's history and the token.
    """

    def __init__(self, words: tuple, pairs: tuple, threes: tuple, whole: int, starts: int, m2: float, m3: float) -> None:
        """words: keys and counts; pairs, threes: keys, counts and the keys of two parts: history and the n-gram without
        its first token.  whole: N + V + 1; starts: training texts.
        """
        log, self.unknown = np.log10, -np.log10(whole)
        seen = words[1] > 0
        word, c1 = words[0][seen], words[1][seen].astype(float)
        p1 = (c1 + 1) / whole
        # states: 0 the root, then the start, then words, then pairs
        pair, c2, first, last = (x[pairs[1] > 0] for x in pairs)
        three, c3, history, tail = (x[threes[1] > 0] for x in threes)
        c2, c3 = c2.astype(float), c3.astype(float)
        n1, n2 = len(word) + 1, len(pair)
        self.hash = np.concatenate([np.zeros(1, np.uint64), [START], word, pair])
        by_word, by_pair = Directory(np.append(START, word)), Directory(pair)
        count1 = np.append(float(starts), c1)
        v, w = by_word.find(first), by_word.find(last)
        p2 = (c2 + m2 * p1[w - 1]) / (count1[v] + m2)
        of, into = by_pair.find(history), by_pair.find(tail)
        p3 = (c3 + m3 * p2[into]) / (c2[of] + m3)
        self.fail = np.concatenate([[0], np.zeros(n1, np.int64), 1 + w])
        self.backoff = np.concatenate([[0.0], log(m2 / (count1 + m2)), log(m3 / (c2 + m3))])
        self.arcs = Directory(np.concatenate([word, pair, three]))
        self.weight = np.concatenate([log(p1), log(p2), log(p3)])
        self.to = np.concatenate([2 + np.arange(len(word)), 1 + n1 + np.arange(n2), 1 + n1 + into]).astype(np.int64)
        self.start = 1 if starts else 0

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a token each, and the weights of the failure arcs and the arc on the way."""
        state, added, live = state.copy(), np.zeros(len(state)), np.arange(len(state))
        while len(live):
            s, t = state[live], token[live]
            arc = self.arcs.find(np.where(s > 0, tk.combine(self.hash[s], t), t))
            found, lost = arc >= 0, (arc < 0) & (s == 0)
            added[live[found]] += self.weight[arc[found]]
            state[live[found]] = self.to[arc[found]]
            added[live[lost]] += self.unknown
            on = ~found & ~lost
            added[live[on]] += self.backoff[s[on]]
            state[live[on]] = self.fail[s[on]]
            live = live[on]
        return state, added

    def walk(self, token: np.ndarray, begin: np.ndarray, lane: int = LANE) -> np.ndarray:
        """log10 of each token's probability.  All texts are walked side by side, long ones in lanes of so many tokens.

        A lane that begins within a text gets its state from the tokens before it, as many as a history has.
        """
        size = np.diff(begin)
        lanes = -(-size // lane)
        text = np.repeat(np.arange(len(size)), lanes)
        k = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at, until = begin[:-1][text] + k * lane, np.minimum(begin[:-1][text] + (k + 1) * lane, begin[1:][text])
        state = np.where(at - begin[:-1][text] < ORDER - 1, self.start, 0)
        for back in range(ORDER - 1, 0, -1):
            inside = np.flatnonzero((k > 0) & (at - back >= begin[:-1][text]))
            state[inside] = self.step(state[inside], token[at[inside] - back])[0]
        order = np.argsort(at - until, kind="stable")
        at, until, state = at[order], until[order], state[order]
        out, live = np.empty(len(token)), len(at)
        for i in range(int((until - at).max(initial=0))):
            live = int(np.searchsorted(-(until - at)[:live], -i, "left"))
            place = at[:live] + i
            state[:live], out[place] = self.step(state[:live], token[place])
        return out


def build(token: np.ndarray, begin: np.ndarray, sums: dict[int, np.ndarray], whole: int, starts: int, m2: float, m3: float, bits: int = 64) -> Automaton:
    """The automaton of the n-grams of texts.

    sums: for each order, the counts of their distinct n-grams in the order of hashes, of pairs and threes by the upper bits.
    """
    pair, three, inner = ngrams(token, begin)
    words = np.unique(token)
    pairs, one = np.unique(pair, return_index=True)
    threes, two = np.unique(three[inner], return_index=True)
    two = np.flatnonzero(inner)[two]
    # keys are sorted, and so are their upper bits
    by = lambda keys, order: sums[order][np.cumsum(np.append(False, np.diff(keys >> np.uint64(64 - bits)) > 0))] if len(keys) else sums[order]
    opens = np.zeros(len(token), bool)
    opens[begin[:-1]] = True
    first = np.where(opens[one], START, token[np.maximum(one - 1, 0)])
    return Automaton((words, sums[1]), (pairs, by(pairs, 2), first, token[one]), (threes, by(threes, 3), pair[two - 1], pair[two]), whole, starts, m2, m3)


def score_documents(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """(key, fr_train, n_tokens, n_known, train_tokens, base_score, score, strength_2, strength_3), a row for each row of docs.

    train: which rows to learn from.  Null counts as an empty text, whose only token is the end.  Rows that repeat are
    texts of their own, in the counts too; very long texts are scored whole.  An empty table gives an empty table.
    group: bytes of texts that a task holds.
    """
    ready(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    t = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(t))).first()[0] or 0
    groups, ranges = dealing(docs.sparkSession, size, group)
    bits = min(64, max(16, size.bit_length() + 16))
    # rows without a key, or of one key, are dealt by their texts too
    dealt = docs.select(F.col(key).alias("k"), t.alias("t"), F.coalesce(train, F.lit(False)).alias("train"), F.pmod(F.xxhash64(F.lit(29), key, t), F.lit(groups)).cast("int").alias("g"))

    def ask(table: pa.Table) -> pa.Table:
        g = table.column("g")[0].as_py()
        token, begin = tokens(table.column("t"))
        learn = np.repeat(table.column("train").to_numpy(zero_copy_only=False), np.diff(begin))
        pair, three, inner = ngrams(token, begin)
        low, rows = np.uint64(64 - bits), []
        for order in (1, 2, 3):
            found = counted(token, learn) if order == 1 else counted(pair >> low, learn, token == END) if order == 2 else counted(three[inner] >> low, learn[inner])
            rows += [(g, order, *r, int(learn.sum()) if order == 1 and i == 0 else 0) for i, r in enumerate(_requests(*found, 64 if order == 1 else bits, ranges))]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["g", "n", "r", "size", "keys", "counts", "tokens"])

    def reply(table: pa.Table) -> pa.Table:
        sizes, order = table.column("size").to_pylist(), table.column("n")[0].as_py()
        keys = [_unpack_keys(b, s) for b, s in zip(table.column("keys").to_pylist(), sizes, strict=True)]
        counts = [_unpack(b, np.uint32, s) for b, s in zip(table.column("counts").to_pylist(), sizes, strict=True)]
        sums, total, ends = answer(keys, counts)
        # of histories: how many have a count, and the sum of their counts, by bin; the end is counted for the start state
        own = total[(total > 0) & ~ends]
        names, where = np.unique(bins(own), return_inverse=True)
        stats = [{"bin": int(b), "n": int(n), "total": int(s)} for b, n, s in zip(names, np.bincount(where, minlength=len(names)), np.bincount(where, own.astype(float), len(names)), strict=True)] if order < ORDER else []
        heads = [int((total > 0).sum()), int((total == 1).sum())]
        per = lambda first, rest: [first, *[rest] * (len(sizes) - 1)]
        columns = [table.column("g"), table.column("n"), table.column("r"), table.column("size"), pa.array([_pack(s) for s in sums], pa.binary()), table.column("tokens"), pa.array(per(heads[0], 0), pa.int64()), pa.array(per(heads[1], 0), pa.int64()), pa.array(per(stats, []), pa.list_(pa.struct([("bin", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])))]
        return pa.table(columns, names=["g", "n", "r", "size", "sums", "tokens", "known", "once", "hist"])

    asked = dealt.groupBy("g").applyInArrow(tk.lean(ask), "g int, n int, r int, size long, keys binary, counts binary, tokens long")
    replies = materialize(asked.groupBy("n", "r").applyInArrow(tk.lean(reply), "g int, n int, r int, size long, sums binary, tokens long, known long, once long, hist array<struct<bin:long,n:long,total:long>>"))
    facts = {r["n"]: r for r in replies.groupBy("n").agg(F.sum("tokens").alias("tokens"), F.sum("known").alias("known"), F.sum("once").alias("once")).collect()}
    n, v = (facts[1]["tokens"], facts[1]["known"]) if 1 in facts else (0, 0)
    spread: dict[int, dict] = {1: {}, 2: {}}
    for r in replies.select("n", F.explode("hist").alias("h")).groupBy("n", "h.bin").agg(F.sum("h.n").alias("c"), F.sum("h.total").alias("total")).collect():
        spread[r["n"]][r["bin"]] = (r["c"], r["total"])
    m2, m3 = (strength(spread[k], facts[k + 1]["once"] if k + 1 in facts else 0) for k in (1, 2))
    starts = docs.where(F.coalesce(train, F.lit(False))).count()
    whole = n + v + 1

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        token, begin = tokens(left.column("t"))
        sums = {}
        for order in (1, 2, 3):
            rows = sorted(zip(*(right.filter(pa.array(np.asarray(right.column("n")) == order)).column(c).to_pylist() for c in ("r", "size", "sums")), strict=True), key=lambda x: x[0])
            sums[order] = np.concatenate([_unpack(b, np.uint64, s) for _, s, b in rows]) if rows else np.zeros(0, np.uint64)
        c = sums[1][np.searchsorted(np.unique(token), token)]
        add = lambda x: np.add.reduceat(x, begin[:-1])
        columns = [left.column("k"), left.column("train"), pa.array(np.diff(begin)), pa.array(add((c > 0).astype(np.int64))), pa.array(add(np.log10((c + 1.0) / whole)))]
        machine = build(token, begin, sums, whole, starts, m2, m3, bits)
        columns.append(pa.array(add(machine.walk(token, begin))))
        return pa.table(columns, names=["k", "fr_train", "n_tokens", "n_known", "base_score", "score"])

    schema = f"k {kind}, fr_train boolean, n_tokens long, n_known long, base_score double, score double"
    scored = dealt.groupBy("g").cogroup(replies.select("g", "n", "r", "size", "sums").groupBy("g")).applyInArrow(tk.lean(score), schema)
    return scored.select(F.col("k").alias(key), "fr_train", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", F.lit(m2).alias("strength_2"), F.lit(m3).alias("strength_3"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return score_documents(docs, ~held).select("doc_id", (~F.col("fr_train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "strength_2", "strength_3")

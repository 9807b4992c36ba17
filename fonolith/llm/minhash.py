"""Near-duplicate documents by ProbMinHash.

A document is the weighted set of its five-word shingles (weight: how often a shingle occurs).  Each shingle is a Poisson
process whose rate is its weight; its arrivals fall on random components, and a component keeps the shingle that arrives
first.  Once a shingle's next arrival is later than the latest first arrival of all components, the shingle stops.  Two
documents agree in a component with the probability Jaccard similarity of their weighted sets.  Components are joined in
bands; documents that agree in a band become candidates, and the probability Jaccard of a candidate pair is verified
exactly.  Equal documents are one class from the start, so copies never meet as pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import drop_files, materialize, packed
from fonolith.llm.graph import components
from fonolith.workers import ready

#: Words of a shingle, least similarity of a link, bands, components of a band.
WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 40, 8
#: Buckets of at most so many members are compared pair by pair; larger ones in blocks of about so many.
PAIRED, BLOCK = 8, 256
_PIECE = 1 << 21


def shingles(buf: np.ndarray, off: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of each distinct shingle, ordered by both, and two hashes of each text's words.

    A text of fewer than n words, but at least one, has one shingle of all its words.
    """
    start, end, first = tk.word_spans(buf, off)
    w = tk.span_hashes(buf, start, end)
    count = np.diff(first)
    long_ = np.maximum(count - n + 1, (count > 0).astype(np.int64))
    text = np.repeat(np.arange(len(count)), long_)
    at = np.arange(len(text)) - np.repeat(np.cumsum(long_) - long_, long_) + first[:-1][text]
    h, left = np.zeros(len(text), np.uint64), np.minimum(count[text], n)
    for o in range(n):
        use = o < left
        h[use] = tk.combine(h[use], w[at[use] + o])
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    places = np.flatnonzero(new)
    weight = np.diff(np.append(places, len(h)))
    same = np.zeros((2, len(count)), np.uint64)
    if len(w):
        some = np.flatnonzero(count)
        position = (np.arange(len(w)) - np.repeat(first[:-1], count)).astype(np.uint64)
        for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            same[k, some] = np.add.reduceat(tk.combine(w ^ np.uint64(salt), position), first[:-1][some])
    return text[places], h[places], weight, same[0], same[1]


def signatures(text: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """The shingle that arrives first at each of `size` components of n texts (0 for a text without shingles)."""
    first, sig = np.full(n * size, np.inf), np.zeros(n * size, np.uint64)
    latest = np.full(n, np.inf)
    live, when, turn = np.arange(len(h)), np.zeros(len(h)), 0
    while len(live):
        r = tk.mix(h[live] + np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) % 2**64))
        gap = -np.log(((r >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52)
        t = when[live] = when[live] + gap / weight[live]
        owner = text[live]
        slot = owner * size + ((r & np.uint64(0xFFF)) * np.uint64(size) >> np.uint64(12)).astype(np.int64)
        better = t < first[slot]
        slot, t_b, h_b = slot[better], t[better], h[live[better]]
        np.minimum.at(first, slot, t_b)
        won = first[slot] == t_b
        sig[slot[won]] = h_b[won]
        some = np.unique(owner)
        latest[some] = first.reshape(n, size)[some].max(1)
        live = live[t < latest[owner]]
        turn += 1
    return sig.reshape(n, size)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Of two weighted sets, each a sorted array of distinct hashes and their weights."""
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    ca, cb = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    pairs, times = np.unique(np.stack([ca, cb]), axis=1, return_counts=True)
    only_a, only_b = float(wa.sum()) - ca.sum(), float(wb.sum()) - cb.sum()
    return float(sum(k / (np.maximum(ca / x, cb / y).sum() + only_a / x + only_b / y) for (x, y), k in zip(pairs.T, times, strict=True)))


def banded(texts: DataFrame, bands: int, rows: int, words: int) -> DataFrame:
    """(place, id, c1, c2, bands) of (place, id, t): the class hashes of each text and the hash of each of its bands; none for texts without words."""

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = tk.flat(batch.column(2))
            for i, j in tk.pieces(off, _PIECE):
                owner, h, weight, c1, c2 = shingles(buf[off[i] : off[j]], off[i : j + 1] - off[i], words)
                sig = signatures(owner, h, weight, j - i, bands * rows).reshape(j - i, bands, rows)
                band = np.repeat(np.arange(bands, dtype=np.uint64)[None], j - i, 0)  # a band's hash holds its number
                for r in range(rows):
                    band = tk.combine(band, sig[:, :, r])
                full = np.bincount(owner, minlength=j - i) > 0
                values = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32), pa.array(band[full].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), values], names=["place", "id", "c1", "c2", "bands"])

    return texts.select("place", "id", "t").mapInArrow(tk.lean(body), "place long, id long, c1 long, c2 long, bands array<long>")


def weighted_sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, s, w) of (id, t): the sorted shingle hashes of each text and their weights, as bytes."""

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = tk.flat(batch.column(1))
            for i, j in tk.pieces(off, _PIECE):
                owner, h, weight, _, _ = shingles(buf[off[i] : off[j]], off[i : j + 1] - off[i], words)
                cut = np.searchsorted(owner, np.arange(j - i + 1))
                s = [h[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)]
                w = [weight[a:z].astype(np.uint32).tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(s, pa.binary()), pa.array(w, pa.binary())], names=["id", "s", "w"])

    return texts.select("id", "t").mapInArrow(tk.lean(body), "id long, s binary, w binary")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The rows of pairs (a, b) whose documents are at least that similar."""

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("s", "w", "s2", "w2")}
            last: dict[bytes, np.ndarray] = {}
            keep = []
            for s, w, s2, w2 in zip(*cols.values(), strict=True):
                if s2 not in last:
                    last = {s2: np.frombuffer(s2, np.uint64)}
                keep.append(probability_jaccard(np.frombuffer(s, np.uint64), np.frombuffer(w, np.uint32), last[s2], np.frombuffer(w2, np.uint32)) >= least - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("id").alias("a"), "s", "w"), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("s").alias("s2"), F.col("w").alias("w2")), "b")
    return two.select("a", "b", "s", "w", "s2", "w2").mapInArrow(tk.lean(body), "a long, b long")


def linked_in_block(sets: list[bytes], weights: list[bytes], comp: np.ndarray, block: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of places whose documents are similar enough, as many as it takes to join what is linked.

    Pairs of one comp don't count; neither do pairs of one block, if there are two.  A probability Jaccard is at most the
    share of either document's weight that is on common shingles; pairs that pass that are computed exactly.
    """
    s, w = [np.frombuffer(x, np.uint64) for x in sets], [np.frombuffer(x, np.uint32) for x in weights]
    n, owner = len(s), np.repeat(np.arange(len(s)), [len(x) for x in s])
    _, column = np.unique(np.concatenate(s), return_inverse=True)
    weight, shared = np.concatenate(w).astype(np.float32), np.bincount(column)[column] > 1
    owner, weight, column = owner[shared], weight[shared], np.unique(column[shared], return_inverse=True)[1]
    common, width = np.zeros((n, n), np.float32), int(column.max(initial=-1)) + 1
    for a in range(0, width, 4096):
        some = (column >= a) & (column < a + 4096)
        has, much = np.zeros((2, n, min(4096, width - a)), np.float32)
        has[owner[some], column[some] - a], much[owner[some], column[some] - a] = 1, weight[some]
        common += much @ has.T
    share = common / np.array([max(1, int(x.sum())) for x in w], np.float32)[:, None]
    near = np.triu(np.minimum(share, share.T) >= least - 1e-4, 1) & (comp[:, None] != comp[None])
    if block.any():
        near &= block[:, None] != block[None]
    at, out = np.unique(comp, return_inverse=True)[1], []
    for i, j in zip(*np.nonzero(near), strict=True):
        if at[i] != at[j] and probability_jaccard(s[i], w[i], s[j], w[j]) >= least - 1e-9:
            out.append((int(i), int(j)))
            at[at == at[j]] = at[i]
    return out


def block_links(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join the members (h, size, rep, comp) of each bucket h; every two members meet in some block."""
    cut = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64(F.lit(9), "rep"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("h", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "comp", F.col("rep").alias("id")).join(sets, "id")

    def body(group: pd.DataFrame) -> pd.DataFrame:
        own = group["own"].to_numpy()
        two = (own != own.min()) if group["b1"].iloc[0] != group["b2"].iloc[0] else np.zeros(len(own), bool)
        pairs = linked_in_block(list(group["s"]), list(group["w"]), group["comp"].to_numpy(), two, least)
        ids = group["id"].to_numpy()
        if len(group) > BLOCK // 2:
            tk.give_back()
        return pd.DataFrame([(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in pairs], columns=["a", "b"]).astype("int64")

    return cut.groupBy("h", "b1", "b2").applyInPandas(body, "a long, b long")


def placed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(place, id, t) of docs: a number of its own for each row, its key and its text."""
    return docs.select(F.monotonically_increasing_id().alias("place"), F.col(key).cast("long").alias("id"), F.col(text).alias("t"))


def linked_rows(texts: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, keyless: bool = True) -> DataFrame:
    """(place, id, of_text, of_class) of texts (place, id, t), which must be written: each row's first equal row and the first that links reach.

    Both are structs (known, id, place), null for a text without words.  First is the row of the smallest id, rows without an
    id coming last, and of equal ids that of the smallest place.  keyless: whether rows without an id take part.
    """
    each = materialize(banded(texts, bands, rows, words))
    real = each.where(F.size("bands") > 0)
    if not keyless:
        real = real.where("id is not null")
    # a class of equal texts is a node, numbered once written; its first row stands for it
    first = F.struct(F.col("id").isNull().alias("unknown"), "id", "place")
    classes = materialize(real.groupBy("c1", "c2").agg(F.min(first).alias("first"), F.min_by("bands", "place").alias("bands")).withColumn("rep", F.monotonically_increasing_id()))
    spread = classes.select("rep", F.explode("bands").alias("h"))
    full = materialize(spread.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    # tables that grow with the corpus are merged at any size, never broadcast where they happen to be small
    met = crowd = materialize(spread.join(full.hint("merge"), "h").distinct())
    # each member of a bucket meets the member that meets most others over all bands (of a text and its edited copies, the
    # text), and the first member ...
    degree = met.groupBy("rep").agg(F.sum("n").alias("degree"))
    ends = met.join(degree, "rep").groupBy("h").agg(F.min("rep").alias("lo"), F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("hi"))
    met = materialize(met.select("h", "rep").join(ends, "h"))
    star = materialize(met.select("rep", F.explode(F.array("lo", "hi")).alias("b")).where("rep <> b").select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct())
    # one text stands for a class: its row is met by its place, so a key that repeats brings none together
    nodes = classes.select(F.col("first.place").alias("place"), F.col("rep").alias("id")).join(met.select(F.col("rep").alias("id")).distinct().hint("shuffle_hash"), "id", "left_semi")
    sets = materialize(weighted_sets(texts.select("place", "t").join(nodes.hint("shuffle_hash"), "place").select("id", "t"), words))
    linked = materialize(verified(star, sets, similarity))
    joined = components(linked)
    # ... and members that neither has brought together meet each other: as pairs in small buckets, else in blocks
    known = met.join(joined, met.rep == joined.id, "left").select("h", "rep", "lo", "hi", F.coalesce("component", "rep").alias("comp"))
    home = known.where("rep <> lo and rep <> hi").groupBy("h").agg(F.min("comp").alias("c_lo"), F.max("comp").alias("c_hi"), F.count("*").alias("size")).where("c_lo < c_hi").select("h", "size")
    open_ = materialize(known.where("rep <> lo and rep <> hi").join(home, "h").select("h", "size", "rep", "comp"))
    few = open_.where(F.col("size") <= PAIRED)
    rest = few.select("h", F.col("rep").alias("a"), F.col("comp").alias("ca")).join(few.select("h", F.col("rep").alias("b"), F.col("comp").alias("cb")), "h").where("a < b and ca <> cb").select("a", "b").distinct()
    more = materialize(verified(rest.join(star, ["a", "b"], "left_anti"), sets, similarity).unionByName(block_links(open_.where(F.col("size") > PAIRED), sets, similarity)))
    if more.limit(1).count():
        joined = components(linked.unionByName(more))
    for done in (full, crowd, met, star, sets, linked, open_, more):
        drop_files(done)
    # components of classes, then the first row of each
    named = materialize(classes.select("c1", "c2", "first", "rep").join(joined, classes.rep == joined.id, "left").select("c1", "c2", "first", F.coalesce("component", "rep").alias("node")))
    least = named.groupBy("node").agg(F.min("first").alias("of_class"))
    named = named.join(least, "node").select("c1", "c2", F.col("first").alias("of_text"), "of_class", F.lit(True).alias("real"))
    out = each.select("place", "id", "c1", "c2", ((F.size("bands") > 0) & (F.lit(keyless) | F.col("id").isNotNull())).alias("real"))
    return out.join(named, ["c1", "c2", "real"], "left").select("place", "id", "of_text", "of_class")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, class_id, text_id, kept), a row for each row of docs.

    text_id is the smallest key with the same words, class_id the smallest key reachable by links of at least the given
    similarity; kept: the key is the class_id.  Words are compared as they are; blanks between them don't matter.  A pair
    at the bound meets in a band with probability 1 - (1 - similarity ** rows) ** bands (0.9994 by default), a more
    similar one with a higher one.  Null, empty and blank texts link with nothing, and neither do rows with a null key
    (class_id null, kept).  Rows that repeat a key are texts of their own, each with its own class; equal rows are alike.
    Very long texts are shingled whole.  An empty table gives an empty table.
    """
    ready(docs.sparkSession)
    out = linked_rows(materialize(placed(docs, key, text)), words, similarity, bands, rows, keyless=False)
    found = F.coalesce("of_class.id", "id")
    return out.select(F.col("id").alias(key), found.alias("class_id"), F.coalesce("of_text.id", "id").alias("text_id"), F.coalesce(F.col("id") == found, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each class of near copies of docs, with the columns of docs: that of the smallest doc_id.

    Classes are those of near_classes(), but rows without a key are compared too, as the last of all.  Of equal rows, and of
    rows that agree in their key, one stays.  Rows without a word all stay.  Very long texts and empty tables are as in
    near_classes().
    """
    ready(docs.sparkSession)
    rows = materialize(packed(docs).withColumn("place", F.monotonically_increasing_id()))
    found = linked_rows(rows.select("place", F.col("fr_row.doc_id").cast("long").alias("id"), F.col("fr_row.text").alias("t")))
    gone = found.where("of_class.place <> place").select("place")
    # the narrow side is the hash table: texts aren't sorted
    return rows.join(gone.hint("shuffle_hash"), "place", "left_anti").select("fr_row.*")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_LEAST = SIMILARITY - 1e-9
#: The same result in DuckDB's SQL, from all pairs with a common shingle.
OP4_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {WORDS - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT doc_id, array_to_string(list_slice(ws, i, i + {WORDS - 1}), ' ') AS s, count(*)::DOUBLE AS n FROM i GROUP BY ALL),
total AS (SELECT doc_id, sum(n) AS n FROM g GROUP BY doc_id),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS x, b.n AS y, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
c AS (SELECT m.a, m.b, ta.n - sum(k * x) AS ra, tb.n - sum(k * y) AS rb FROM m JOIN total ta ON ta.doc_id = m.a JOIN total tb ON tb.doc_id = m.b
      GROUP BY m.a, m.b, ta.n, tb.n HAVING sum(k * x) >= {_LEAST} * ta.n AND sum(k * y) >= {_LEAST} * tb.n),
d AS (SELECT p.a, p.b, p.x, p.y, any_value(p.k) AS k, sum(q.k * greatest(q.x / p.x, q.y / p.y)) + any_value(c.ra) / p.x + any_value(c.rb) / p.y AS whole
      FROM c JOIN m p ON p.a = c.a AND p.b = c.b JOIN m q ON q.a = p.a AND q.b = p.b GROUP BY p.a, p.b, p.x, p.y),
l AS (SELECT a, b FROM d GROUP BY a, b HAVING sum(k / whole) >= {_LEAST}),
both_ AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON reach.b = both_.a),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
SELECT w.doc_id, class_id, CASE WHEN len(ws) > 0 THEN min(w.doc_id) OVER (PARTITION BY ws) ELSE w.doc_id END AS text_id, w.doc_id = class_id AS kept FROM w JOIN class ON class.doc_id = w.doc_id
"""

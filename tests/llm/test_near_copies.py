"""MinHash, repeated passages and vectors, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fonolith.llm import embedding_dedup, graph, minhash, repeat_removal
from tests.llm.edges import documents, no_documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest(nodes, links):
    at = {n: n for n in nodes}

    def find(x):
        while at[x] != x:
            at[x] = at[at[x]]
            x = at[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def weighted(text):
    w = WORD.findall(text or "")
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def jp(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[k] / a[d], b[k] / b[d]) for k in keys) for d in set(a) & set(b))


def classes(rows):
    sets = {k: weighted(t) for k, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and jp(sets[a], sets[b]) >= 0.8 - 1e-9]
    return smallest(sets, links)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)] + [(300, i) for i in range(301, 340)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a != b]
    assert got == smallest({x for p in real for x in p}, real)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    b = np.sort(np.concatenate([a[:220], rng.integers(0, 2**63, 90).astype(np.uint64)]))
    wa, wb = rng.integers(1, 5, 300), rng.integers(1, 5, 310)
    owner = np.concatenate([np.zeros(300, int), np.ones(310, int)])
    sig = minhash.signatures(owner, np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 4000)
    exact = minhash.probability_jaccard(a, wa, b, wb)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03
    ca, cb = (collections.Counter(dict(zip(x.tolist(), w.tolist(), strict=True))) for x, w in ((a, wa), (b, wb)))
    assert exact == pytest.approx(jp(ca, cb))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_minhash_brute(spark):
    rng = random.Random(7)
    rows = []
    for f in range(12):
        base = sentence(rng, 150)
        rows += [base, base.replace(" ", "  ")] + [edited(rng, base, rng.randrange(1, 8)) for _ in range(10)]
    rows += [sentence(rng, 3), "a b c", "a b c", "a b c d", "", "", None, " "]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(rows)


def test_minhash_blocks(spark, monkeypatch):
    """Members that leaders don't join, in buckets large enough for blocks."""
    monkeypatch.setattr(minhash, "PAIRED", 2)
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(9)
    base = sentence(rng, 120)
    chain = [base]
    for _ in range(40):
        chain.append(edited(rng, chain[rng.randrange(max(0, len(chain) - 3), len(chain))], 4))
    rows = list(enumerate(chain + [edited(rng, base, 6) for _ in range(30)]))
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(rows)


def test_minhash_edges(spark):
    docs = documents(spark)
    rows = minhash.near_classes(docs).collect()
    assert len(rows) == docs.count()
    real = {r.doc_id: r for r in rows if r.doc_id is not None}
    want = classes([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None])
    assert {k: r.class_id for k, r in real.items()} == want
    assert all(r.class_id is None and r.kept for r in rows if r.doc_id is None)
    kept = minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    # the rows without a key have the text of one that stays, and of equal rows with words one stays
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in want.items() if k == v)
    assert minhash.near_classes(no_documents(spark)).count() == 0


def removed(rows, length=100):
    seen, out = set(), {}
    for place, (_, key, text) in enumerate(sorted((k is None, k or 0, t or "") for k, t in rows)):
        b = text.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out[place] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return collections.Counter(out.values())


def result(df):
    return collections.Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize(("length", "crowd"), [(100, 4096), (24, 4096), (100, 1), (24, 3)])
def test_repeats_brute(spark, length, crowd):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abc ") for _ in range(300)) for _ in range(5)] + ["a" * 260, "xy" * 130, "abcdé " * 60]
    rows = []
    for i in range(90):
        cut = lambda: (p := rng.choice(parts))[rng.randrange(len(p)) :][: rng.randrange(300)]
        rows.append((i * 3, "".join(cut() if rng.random() < 0.7 else sentence(rng, 3) for _ in range(rng.randrange(8)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(repeat_removal.remove_repeats(df, length=length, trigger=max(4, length // 3), crowd=crowd, group=2500)) == removed(rows, length)


def test_corpus_order_is_that_of_suffixes():
    """The suffix arrays of dictionary and parse give the order of sorting all suffixes, and neighbours the equal windows."""
    rng = random.Random(12)
    parts = ["".join(rng.choice("ab\0") for _ in range(60)) for _ in range(4)] + ["é" * 30, "x" * 90]
    texts = ["".join(rng.choice(parts)[: rng.randrange(90)] for _ in range(rng.randrange(1, 6))).encode() for _ in range(120)]
    data, size = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    begin, length, text = repeat_removal.prefix_free(data, size)
    assert len(set(zip(begin, length, strict=True))) == len(begin) and len({bytes(data[a : a + n]) for a, n in zip(begin, length, strict=True)}) < len(begin)
    where = [(j, i) for j, t in enumerate(texts) for i in range(len(t))]
    place = np.arange(len(where))
    order = repeat_removal.corpus_order(data, size, place)
    suffixes = [texts[where[i][0]][where[i][1] :] for i in order]
    assert suffixes == sorted(suffixes)
    for n in (5, 8, 30, 100):
        some = np.array([p for p, (j, i) in enumerate(where) if i + n <= len(texts[j])], int)
        got = repeat_removal.equal_windows(data, size, some, n)
        by = collections.defaultdict(set)
        for g, p in zip(got, some, strict=True):
            by[bytes(data[p : p + n])].add(int(g))
        count = collections.Counter(bytes(data[p : p + n]) for p in some)
        assert all(len(v) == 1 and (count[w] == 1) == (v == {-1}) for w, v in by.items())
        assert len(set.union(*by.values()) - {-1}) == sum(c > 1 for c in count.values())


def test_repeats_beyond_the_bits_of_a_place(monkeypatch):
    """Windows of a text with more bytes than _PLACE can count (64 MiB, here 4 kB) are parsed like those of a short one."""
    monkeypatch.setattr(repeat_removal, "_PIECE", 1000)
    monkeypatch.setattr(repeat_removal, "_PLACE", np.uint64(12))
    rng = np.random.default_rng(4)
    passage = rng.integers(97, 123, 700, np.uint8)
    text = rng.integers(97, 123, 30_000, np.uint8)
    for at in (500, 9_300, 22_222):
        text[at : at + 700] = passage
    buf, off = np.append(text, passage), np.array([0, len(text), len(text) + 700])
    p = repeat_removal.parse(buf, off)
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(p["start"], p["windows"], strict=True)])
    assert np.array_equal(windows, np.append(np.arange(30_000 - 99), 30_000 + np.arange(601)))  # each once
    assert (p["ahead"] - p["windows"] + 1 >= 0).all() and (p["ahead"] <= 100 - 32).all()
    own = {int(w): (int(k), int(d - (w - a))) for a, n, k, d in zip(p["start"], p["windows"], p["key"], p["ahead"], strict=True) for w in range(a, a + n)}
    for at in (500, 9_300, 22_222):
        assert [own[at + i] for i in range(601)] == [own[30_000 + i] for i in range(601)]


def test_repeats_query_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(repeat_removal.op5_repeat_removal(spark, "/root/testdata/sf0.001")) == removed([(r.doc_id, r.text) for r in docs.collect()])
    edge = documents(spark)
    got = repeat_removal.remove_repeats(edge)
    assert result(got) == removed([(r.doc_id, r.text) for r in edge.collect()])
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())
    assert repeat_removal.remove_repeats(no_documents(spark)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, cls long, f string"


def links_of(rows, cosine=0.9):
    good = []
    for place, (key, v) in enumerate(rows):
        if key is not None and v and None not in v and np.isfinite(v).all() and any(v):
            x = np.asarray(v, np.float32).astype(float)
            good.append((place, key, x / np.sqrt((x * x).sum())))
    linked = [(a, b) for i, a in enumerate(good) for b in good[:i] if len(a[2]) == len(b[2]) and a[2] @ b[2] >= cosine]
    n = collections.Counter(x[0] for pair in linked for x in pair)
    return linked, n


def test_minhash_repeated_keys(spark):
    """A key that stands for several texts: each row has the class of its own text, alike in every run."""
    rng = random.Random(3)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(1, a), (5, b), (5, edited(rng, a, 1)), (7, b), (9, c), (9, c), (9, edited(rng, b, 1)), (12, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = collections.Counter({(1, 1): 1, (5, 5): 1, (5, 1): 1, (7, 5): 1, (9, 9): 2, (9, 5): 1, (12, 9): 1})
    for parts in (1, 5):
        assert collections.Counter((r.doc_id, r.class_id) for r in minhash.near_classes(df.repartition(parts)).collect()) == want
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in minhash.drop_near_copies(docs).collect()) == sorted([(1, a), (5, b), (9, c)])
    lost = docs.select(F.lit(None).cast("long").alias("doc_id"), "text", "lang", "source", "n_chars")
    assert minhash.drop_near_copies(lost).count() == 3


def test_one_key_for_all_texts(spark):
    """Texts under one key meet no more sets than texts with keys of their own: each text has one row of them."""
    rng = random.Random(4)
    texts = [f"{sentence(rng, 12)} {i // 2}" for i in range(600)]
    texts = [t if i % 2 == 0 else texts[i - 1] + " end" for i, t in enumerate(texts)]
    counted, whole = [], minhash.weighted_sets

    def counting(rows, words):
        counted.append(rows.count())
        return whole(rows, words)

    for key in (F.lit(7), F.col("i")):
        docs = spark.createDataFrame(list(enumerate(texts)), "i long, text string").withColumn("doc_id", key.cast("long"))
        minhash.weighted_sets = counting
        try:
            kept = minhash.drop_near_copies(docs).count()
        finally:
            minhash.weighted_sets = whole
        assert kept == 300
    assert counted == [600, 600]


def test_vectors_brute(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 32)).astype(np.float32)
    near = [b + s * rng.normal(size=32) for b in base[:12] for s in (0.05, 0.1, 0.3) for _ in range(3)] + [base[0] + 0.1 * rng.normal(size=32) for _ in range(60)]
    rows = [list(map(float, v)) for v in [*base, *near, base[5], base[5], 2 * base[6]]]
    rows += [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [], [1.0], [1.0], [-1.0], [1.0, 0.0], [1e-30] * 32, [1e-30] * 32]
    rows = [(i, v) for i, v in enumerate(rows)] + [(None, rows[0]), (3, rows[3])]
    df = spark.createDataFrame([(k, v, 0, 1, "f") for k, v in rows], VECTORS)
    got = collections.Counter(tuple(r) for r in embedding_dedup.link_vectors(df).collect())
    linked, n = links_of(rows)
    comp = smallest({k for k, _ in rows if k is not None}, [(a[1], b[1]) for a, b in linked])
    want = collections.Counter((k, n[i], comp.get(k), k is not None and comp[k] == k) for i, (k, _) in enumerate(rows))
    assert got == want
    assert embedding_dedup.link_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_vector_recall():
    """Pairs at exactly the bound meet in a filter."""
    rng = np.random.default_rng(2)
    for n in (5_000, 200_000):
        f = embedding_dedup.Filters(n, 64)
        x, z = rng.normal(size=(2, 1000, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        y = 0.9 * x + np.sqrt(0.19) * z / np.linalg.norm(z, axis=1, keepdims=True)
        assert f.met(x, y) > 0.95
        scores = np.rint(x[:50] * embedding_dedup.GRID)
        r, got = f.decode(x[:50])
        full = (scores[:, :32] @ f.codes[0].T)[:, :, None] + (scores[:, 32:] @ f.codes[1].T)[:, None]
        for i in range(50):
            s = full[i].ravel()
            bar = min(f.least, np.sort(s)[-embedding_dedup.LEAST_LISTED])
            assert set(got[r == i]) == set(np.flatnonzero(s >= bar))


def test_query_embeddings(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = {r.vec_id: r.n_links for r in embedding_dedup.op6_embedding_dedup(spark, "/root/testdata/sf0.001").collect()}
    _, n = links_of(rows)
    assert got == {k: n[i] for i, (k, _) in enumerate(rows)}

"""BPE, the language model, language identification and toxicity."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fonolith.llm import bpe, language_id, lm_scoring, toxicity
from fonolith.llm import textkernel as tk
from tests.llm.edges import documents, no_documents

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_word_spans_and_hashes():
    import pyarrow as pa

    texts = ["ab cd", "cd", None, "", " x\ty ", "end", "ab" * 3000]
    buf, off = tk.flat(pa.array(texts))
    start, end, first = tk.word_spans(buf, off)
    got = [[bytes(buf[a:z]).decode() for a, z in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert got == [WORD.findall(t or "") for t in texts]
    h = dict(zip([w for t in got for w in t], tk.span_hashes(buf, start, end), strict=True))
    assert len(set(h.values())) == len(h) and h["cd"] == tk.span_hashes(buf, start, end)[2]
    assert bytes(tk.lower(np.frombuffer("ÀÉ×ÑAz1".encode(), np.uint8))).decode() == "àé×ñaz1"


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_bpe_equals_library(vocabulary, spark):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    mine, rng = bpe.Tokenizer(vocabulary), random.Random(1)
    pool = [*"ab C1  \n\t\r\x0b\x0c\x1c\x1d\x85\xa0 　​é漢字😀'sll!?<|endoftext|>́﻿٣½ǅ", "<|endoftext|>", "  ", "'re", "don't", " \n", "x" * 70]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [r.text or "" for r in documents(spark).collect()]
    texts += ["".join(rng.choice("aZ 0 9'sd\n\t\r\x0b\x0c\x1c\x1f!-") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == ",".join(map(str, ids)), t
        assert mine.decode(mine.encode(t)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_cache_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    t = bpe.Tokenizer(vocabulary)
    first = t.encode("one two three four five six seven eight")
    assert len(t.known) <= 5 and len(t.before) <= 5 and t.encode("one two three four five six seven eight") == first


def test_bpe_documents(vocabulary, spark):
    docs = documents(spark)
    rows = bpe.encode_documents(docs, vocabulary).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert {r.decoded for r in rows} == {r.text or "" for r in docs.collect()}
    assert bpe.encode_documents(no_documents(spark), vocabulary).count() == 0


def backoff_walk(texts, learn, m2, m3):
    """(base score, score) of each text by an automaton of dicts, a token at a time; and its counts."""
    count = collections.Counter()
    for w, use in zip(texts, learn, strict=True):
        if use:
            h = ("<start>", *w)
            count.update((x,) for x in w)
            count.update(zip(h[:-1], h[1:], strict=True))
            count.update(zip(h[:-2], h[1:-1], h[2:], strict=True))
    n = sum(c for k, c in count.items() if len(k) == 1)
    whole = n + sum(len(k) == 1 for k in count) + 1
    as_history = collections.Counter(count)
    as_history["<start>",] = sum(learn)
    prior = {1: m2, 2: m3}

    def arc(h, x):
        """The weight of the arc of state h with token x, as a probability."""
        if not h:
            return (count[(x,)] + 1) / whole
        m = prior[len(h)]
        return (count[(*h, x)] + m * arc(h[1:], x)) / (as_history[h] + m)

    out = []
    for w in texts:
        state, score = ("<start>",) if any(learn) else (), 0.0
        for x in w:
            while state and not count[(*state, x)]:
                score += math.log10(prior[len(state)] / (as_history[state] + prior[len(state)]))
                state = state[1:]
            score += math.log10(arc(state, x))
            state = (*state, x)[-2:]
            while state and not as_history[state]:
                state = state[1:]
        out.append((sum(math.log10((count[(x,)] + 1) / whole) for x in w), score))
    return out, count, n


def test_lm_brute(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(documents(spark).select(F.col("doc_id") + 10_000, "text"))
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    got = lm_scoring.score_documents(docs, learn, group=30_000).collect()
    keys, texts = zip(*((r.doc_id, WORD.findall((r.text or "").translate(LOW)) + [None]) for r in docs.collect()), strict=True)
    used = [k is None or zlib.crc32(str(k).encode()) % 7 != 2 for k in keys]
    scores, count, n = backoff_walk(texts, used, got[0].strength_2, got[0].strength_3)
    want = collections.Counter((k, len(w), sum(count[(x,)] > 0 for x in w), n, round(base, 5), round(score, 5)) for k, w, (base, score) in zip(keys, texts, scores, strict=True))
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got) == want
    # each strength makes failures as frequent as n-grams seen once
    histories = {k: c for k, c in count.items() if k[-1] is not None}
    for size, m in ((1, got[0].strength_2), (2, got[0].strength_3)):
        cs = [c for k, c in histories.items() if len(k) == size] + [sum(used)] * (size == 1)
        once = sum(c == 1 for k, c in count.items() if len(k) == size + 1)
        assert sum(c * m / (c - 1 + m) for c in cs) == pytest.approx(once, rel=0.02)


def test_lm_lanes_agree():
    """A text walked in lanes of any length has the scores of one walk."""
    rng = np.random.default_rng(3)
    token = rng.integers(1, 9, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    begin = np.array([0, 1, 90, 91, 300, 400])
    token[begin[1:] - 1] = lm_scoring.END
    learn = np.repeat([True, False, True, True, True], np.diff(begin))
    pair, three, inner = lm_scoring.ngrams(token, begin)
    sums = {1: lm_scoring.counted(token, learn)[1], 2: lm_scoring.counted(pair, learn)[1], 3: lm_scoring.counted(three[inner], learn[inner])[1]}
    machine = lm_scoring.build(token, begin, sums, int(learn.sum()) + 10, 4, 3.0, 2.0)
    whole = machine.walk(token, begin, 1000)
    for lane in (1, 2, 3, 7):
        assert np.allclose(machine.walk(token, begin, lane), whole)
    texts = [token[a:z].tolist() for a, z in zip(begin[:-1], begin[1:], strict=True)]
    scores, count, n = backoff_walk(texts, [True, False, True, True, True], 3.0, 2.0)
    assert n + sum(len(k) == 1 for k in count) + 1 == int(learn.sum()) + len(np.unique(token[learn])) + 1
    machine = lm_scoring.build(token, begin, sums, n + sum(len(k) == 1 for k in count) + 1, 4, 3.0, 2.0)
    assert np.allclose(np.add.reduceat(machine.walk(token, begin), begin[:-1]), [s for _, s in scores])


def test_lm_sums_beyond_32_bits():
    most = np.array([2**31 - 1, 0], np.uint32)
    sums, total, ends = lm_scoring.answer([np.array([5, 9], np.uint64)] * 3, [most, most, most | np.uint32([1 << 31, 0])])
    assert [s.tolist() for s in sums] == [[3 * (2**31 - 1), 0]] * 3 and total.tolist() == [3 * (2**31 - 1), 0] and ends.tolist() == [True, False]
    assert lm_scoring._unpack(lm_scoring._pack(sums[0]), np.uint64, 2).tolist() == [3 * (2**31 - 1), 0]


def test_lm_keys_and_their_upper_bits():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 2**64, 1000, np.uint64))
    assert np.array_equal(lm_scoring._unpack_keys(lm_scoring._pack_keys(keys), len(keys)), keys)
    token = np.append(rng.integers(0, 40, 499).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), lm_scoring.END)
    begin, learn = np.array([0, 500]), np.ones(500, bool)
    pair, three, inner = lm_scoring.ngrams(token, begin)
    walks = []
    for bits in (64, 40, 4):
        low = np.uint64(64 - bits)
        sums = {1: lm_scoring.counted(token, learn)[1], 2: lm_scoring.counted(pair >> low, learn)[1], 3: lm_scoring.counted(three[inner] >> low, learn[inner])[1]}
        walks.append(lm_scoring.build(token, begin, sums, 600, 1, 3.0, 2.0, bits).walk(token, begin))
    assert np.allclose(walks[0], walks[1]) and not np.allclose(walks[0], walks[2])


def test_lm_states_sum_to_one():
    """Over all tokens of the training texts and the unknown one, the probabilities after each state add up to one."""
    rng = np.random.default_rng(1)
    token = rng.integers(1, 6, 60).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    begin = np.array([0, 20, 45, 60])
    token[begin[1:] - 1] = lm_scoring.END
    pair, three, inner = lm_scoring.ngrams(token, begin)
    learn = np.ones(60, bool)
    sums = {1: lm_scoring.counted(token, learn)[1], 2: lm_scoring.counted(pair, learn)[1], 3: lm_scoring.counted(three[inner], learn[inner])[1]}
    words = np.unique(token)
    machine = lm_scoring.build(token, begin, sums, 60 + len(words) + 1, 3, 1.5, 0.7)
    assert len(machine.hash) > 15
    for state in range(len(machine.hash)):
        if state < 2 or state - 2 >= len(words) or words[state - 2] != lm_scoring.END:
            every = np.append(words, np.uint64(7))
            p = 10 ** machine.step(np.full(len(every), state), every)[1]
            dead = state > len(words) + 1 and not (machine.hash[state] in set(pair[~(token == lm_scoring.END)].tolist()))
            assert dead or p.sum() == pytest.approx(1)


def test_lm_is_better_than_base(spark):
    rows = lm_scoring.op2_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]
    assert lm_scoring.score_documents(no_documents(spark), F.lit(True)).count() == 0


def test_codewords():
    for k in (2, 3, 4, 5, 12, 60):
        code = language_id.codewords(k)
        apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert code.shape[0] == k and min(apart) >= (1 if k == 2 else max(1, code.shape[1] // 4))
    assert language_id.codewords(1).shape == (1, 0)


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = language_id.op8_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.97 and 0 <= held[1] and held[2] <= 1


def test_language_id_edges(spark):
    docs = documents(spark)
    model = language_id.train(docs, "doc_id", "text", "lang", F.lit(True))
    rows = language_id.predict(docs, model).collect()
    assert len(rows) == docs.count() and model.languages == ["en", "fr"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        if r.doc_id is not None:
            has = any(ch.isalpha() for ch in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not has)
    empty = language_id.train(no_documents(spark), "doc_id", "text", "lang", F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, empty).collect()} == {"und"}
    one = language_id.train(docs.where("lang = 'en'"), "doc_id", "text", "lang", F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, one).collect()} == {"en", "und"}


def test_trigram_pieces_agree(monkeypatch):
    model = language_id.Model(["a", "b", "c"])
    model.w = np.random.default_rng(0).normal(size=model.w.shape).astype(np.float32)
    texts = [b"", b"x", b"some words here", b"long " * 300, b"\xc3\x89t\xc3\xa9"]
    buf, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = model.margins(buf, off)
    monkeypatch.setattr(language_id, "_PIECE", 64)
    assert np.allclose(whole, model.margins(buf, off), atol=1e-4)
    for i, t in enumerate(texts):
        assert np.allclose(model.margins(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0], whole[i], atol=1e-4)


def test_toxicity(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.op1_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").toPandas()
    right = (got.predicted == got.toxic).mean()
    assert right > 0.95 and got[got.toxic == 1].predicted.mean() > 0.75
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_toxicity_thresholds_cover_all_rows(spark):
    """All labelled rows but the fitted ones calibrate: of any length, and of a language that the sample hardly has."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(200)]
    text = lambda bad, n: " ".join(rng.choice(words) for _ in range(n)) + " vilest" * bad
    rows = [(i, text(i % 4 == 0, 20), "en", int(i % 4 == 0)) for i in range(1200)]
    rows += [(1200 + i, text(i < 3, 20), "rare", int(i < 3)) for i in range(24)]  # 3 toxic rows in 1,224
    rows += [(2000 + i, text(i % 2, 3100), "long", i % 2) for i in range(8)]  # over SAMPLE_WORDS words
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True), sample=100)
    assert set(model.thresholds) == {"en", "rare", "long"}
    assert model.thresholds["long"] != 0.5 and model.thresholds["rare"] != 0.5
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert sum(got[r[0]].flagged == r[3] for r in rows) > 0.97 * len(rows)
    # a threshold is the best one over all rows of its language that weren't fitted
    some, _ = toxicity.examples(labels, F.lit(True), sample=100)
    fitted = {r.k for r in some.where("fr_fit").collect()}
    for lang in ("rare", "long"):
        free = [r for r in rows if r[2] == lang and (r[0] not in fitted or lang == "long")]
        assert all(got[r[0]].flagged == r[3] for r in free)


def test_toxicity_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (2, 0, None), (None, 1, 1), (3, 1, 5), (9, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = toxicity.train(docs, some, F.lit(True), sample=10)
        rows = toxicity.score_documents(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_text = collections.defaultdict(set)
    for r in rows:
        if r.doc_id is not None:
            by_text[texts[r.doc_id]].add(round(r.score, 9))
    assert all(len(v) == 1 for v in by_text.values())
    assert toxicity.score_documents(no_documents(spark), model).count() == 0


def naive_toxicity(model, text):
    """The score of a text by loops over words, windows and filters."""
    low = "".join(c.lower() if c < "\x80" or "À" <= c <= "Þ" and c != "×" else c for c in text)
    found = [w.encode() for w in re.findall(r"[a-z\x80-\U0010ffff]+", low)]
    rows = [[int(tk.mix(tk.span_hashes(np.frombuffer(w[:n], np.uint8), np.array([0]), np.array([len(w[:n])])) + np.uint64(n))[0] >> np.uint64(46)) for n in (4, 6, 1 << 40)] for w in found]
    vectors = [sum(model.emb[r].astype(float) for r in three) for three in rows]
    z = float(model.bias)
    for number, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            fits = [sum(float(model.k[width][o][:, f] @ vectors[i + o]) for o in range(width)) + float(model.c[width][f]) for i in range(len(vectors) - width + 1)]
            z += max([0.0, *fits]) * float(model.out[number * toxicity.FILTERS + f])
    return 1 / (1 + math.exp(-(z + model.shift)))


def test_toxicity_brute(spark):
    """The query's scores are those of a naive pass over each text's windows."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    odd = documents(spark).where("doc_id is not null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text", "lang")
    rows = docs.select("doc_id", "text", "lang").limit(60).union(odd)
    got = {r.doc_id: r.score for r in toxicity.score_documents(rows, model).collect()}
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert len(got) > 70
    for k, score in got.items():
        assert score == pytest.approx(naive_toxicity(model, texts[k] or ""), abs=2e-4), k


def naive_language(model, text):
    """The language of a text by a dict of trigrams and the loss of each codeword."""
    low = "".join(c.lower() if c < "\x80" or "À" <= c <= "Þ" and c != "×" else c for c in text).encode()
    b = b"  " + bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in low) + b"  "
    grams = collections.Counter(b[i : i + 3] for i in range(len(b) - 2))
    margin = [float(model.bias[j]) for j in range(model.code.shape[1])]
    for g, n in grams.items():
        row = ((g[0] | g[1] << 8 | g[2] << 16) * 2654435761 % 2**32) >> 20
        for j in range(len(margin)):
            margin[j] += float(model.w[row, j]) * n / (len(b) - 2)
    losses = [sum(model.trust[j] * math.log1p(math.exp(-row[j] * m)) for j, m in enumerate(margin)) for row in model.code]
    p = [math.exp(min(losses) - x) for x in losses]
    return model.languages[p.index(max(p))], max(p) / sum(p)


def test_language_brute(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(docs, "doc_id", "text", "lang", F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in language_id.predict(docs.limit(60), model).collect():
        name, score = naive_language(model, texts[r.doc_id])
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-4)


def test_many_languages(spark, monkeypatch):
    """With more languages than are learned, the most frequent ones are; every text gets one of these."""
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    rows = [(i, chr(97 + i % 7) * 3 + " " + chr(97 + i % 7) * 2, f"l{i % 7}") for i in range(70)] + [(100 + i, f"ab{'cde'[i % 3]} " * 4, f"m{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, "doc_id", "text", "lang", F.lit(True))
    assert model.languages == ["m0", "m1", "m2"]
    assert {r.lang_pred for r in language_id.predict(docs, model).collect()} <= set(model.languages)


def test_draws_follow_the_share(spark):
    from fonolith.llm.common import by_chance

    rows = spark.range(200_000).withColumnRenamed("id", "k")
    for share in (1e-3, 0.3):
        assert rows.where(by_chance(F.lit(share), 5, "k")).count() == pytest.approx(200_000 * share, rel=0.2)


def test_pooling_stays_in_its_text():
    model = toxicity.Model()
    texts = ["one", "two words", "", "three more words", "a b c d e f"]
    data = [t.encode() for t in texts]
    ids, first = toxicity.word_ids(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    together = model.pooled(ids, first)
    for i, t in enumerate(data):
        alone, f = toxicity.word_ids(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        want = model.pooled(alone, f)[0] if len(alone) else np.zeros(together.shape[1])
        assert np.allclose(together[i], want, atol=1e-6), t


def test_best_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.2, 0.1]), np.array([1, 0, 0]), np.ones(3)) == pytest.approx(0.55)
    assert toxicity.best_threshold(np.array([0.9]), np.array([1]), np.ones(1)) == 0.5

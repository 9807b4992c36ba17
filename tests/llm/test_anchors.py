"""Removal of earlier passages against all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from fonolith.llm import anchor_dedup as ad
from tests.compare import same_as_sql
from tests.llm.edges import documents, no_documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def naive(rows, window=13):
    """{(doc_id, text): (n_words, n_removed, kept)} of rows (doc_id, text)."""
    words = [(LAST if k is None else k, WORD.findall(t or "")) for k, t in rows]
    first = {}
    for k, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(k, first.get(key, LAST))
    out = []
    for (k, w), (key, _) in zip(words, rows, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone).encode()
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def removed(df, **more):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, bytes(r.kept)) for r in ad.remove_earlier(df, **more).collect()), key=str)


def test_edges(spark):
    rng = random.Random(2)
    passage = sentence(rng, 60)
    extra = [f"{sentence(rng, k)} {passage} {sentence(rng, 5)}" for k in range(16)] + [passage[:200] + " x " + passage[100:], "a b c d e f g h i j k l m", "a b c d e f g h i j k l", " a\tb c d e\nf g h i j k l m n ", "z " * 40, "z " * 13]
    docs = documents(spark, extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = naive(rows)
    assert removed(docs) == want
    assert removed(docs.repartition(5), chunk=400) == want
    assert ad.remove_earlier(docs, with_kept=False).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert ad.remove_earlier(no_documents(spark)).count() == 0


@pytest.mark.parametrize("window", [3, 13])
def test_few_words(spark, window):
    """Texts over two words, so that nearly all windows are somewhere else too, at all distances from blocks."""
    rng = random.Random(window)
    rows = [(rng.randrange(40) * 3 - 50, " ".join(rng.choice("ab") for _ in range(rng.choice([2, 12, 13, 14, 20, 45])))) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(df, window=window, chunk=100) == naive(rows, window)


def test_one_passage_everywhere(spark):
    """Copies meet as one entry a chunk: what ranges get doesn't grow with the square of a passage's documents."""
    rng = random.Random(6)
    passage = sentence(rng, 40)
    rows = [(i, f"{sentence(rng, 3)} {passage} {i}") for i in range(700)]
    got = removed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == naive(rows) and sum(r[2] > 0 for r in got) == 699


def test_packing():
    rng = np.random.default_rng(1)
    for kind in (np.uint8, np.uint32, np.int64, np.uint64):
        a = rng.integers(0, 200, 500).astype(kind)
        assert (ad.unpack(ad.pack(a), kind, 500) == a).all() and not len(ad.unpack(ad.pack(a[:0]), kind, 0))


def test_sql(spark, duck):
    assert same_as_sql(spark, duck, ad.op11_substring_dedup, ad.OP11_SQL).n_removed.sum() > 0

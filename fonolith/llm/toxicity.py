"""Toxicity by a convolutional text classifier.

Words (runs of letters, in lower case) become vectors: the sum of hashed embeddings of the word, of its first four and of
its first six bytes, so that inflected forms share a part.  Filters of one, two and three words run over a text, the
largest value of each filter feeds a logistic output.  Training is numpy on a bounded sample; gradients flow only through
the places that hold the maxima.  Thresholds are calibrated for each language on all labelled rows that aren't fitted;
language has no part in a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import by_chance, join_checked, materialize
from fonolith.workers import ready

#: Rows of the embedding table, its columns, filters of each width, widths.
TABLE, EMBED, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
#: The sample to fit on: labelled rows of each class, and words of a text (longer ones aren't fitted; thresholds and scores
#: cover all).
SAMPLE, SAMPLE_WORDS = 4000, 3000
#: Bins of logits for thresholds: so many for a unit, and the number of the one around 0; the largest shift (0.99 as logit).
FINE, ZERO, MOST_SHIFT = 64, 4096, float(np.log(99))
_PIECE = 1 << 20


def word_ids(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three table rows for each word, and the number of the first word of each text."""
    low = tk.lower(buf)
    start, end, first = tk.word_spans(low, off, tk.NOT_LETTER)
    ids = [tk.span_hashes(low, start, np.minimum(end, start + n)) + np.uint64(n) for n in (4, 6, 1 << 40)]
    return np.stack([(tk.mix(h) >> np.uint64(46)).astype(np.int32) for h in ids], 1), first


class Model:
    """Embeddings, filters and the output layer."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.05, (TABLE, EMBED)).astype(np.float32)
        self.k = {w: rng.normal(0, 0.4, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.c = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out, self.bias = rng.normal(0, 0.2, FILTERS * len(WIDTHS)).astype(np.float32), np.float32(-2)
        self.shift, self.thresholds = 0.0, {}

    def pooled(self, ids: np.ndarray, first: np.ndarray, places: bool = False):
        """The largest value of each filter over the words of each text; 0 stands for a filter that fits nowhere.

        places: with, for each width, the first word of the window that has the maximum.
        """
        n, total = len(first) - 1, len(ids)
        out, at = np.zeros((n, FILTERS * len(WIDTHS)), np.float32), {}
        x = self.emb[ids[:, 0]]
        x += self.emb[ids[:, 1]]
        x += self.emb[ids[:, 2]]
        count = np.diff(first)
        for number, w in enumerate(WIDTHS):
            some = np.flatnonzero(count >= w)
            if not len(some):
                continue
            y = x[: total - w + 1] @ self.k[w][0]
            for o in range(1, w):
                y += x[o : total - w + 1 + o] @ self.k[w][o]
            # windows that begin in a text but end in the next one don't count
            for o in range(1, w):
                last = first[1:][count >= o] - o
                y[last[(last >= 0) & (last < len(y))]] = -1e9
            cut = np.append(first[:-1][some], total)[:-1]
            best = np.maximum.reduceat(y, cut, axis=0)
            value = np.maximum(best + self.c[w], 0)
            out[some, number * FILTERS : (number + 1) * FILTERS] = value
            if places:
                spans = list(zip(cut, np.append(cut[1:], len(y)), strict=True))
                at[w] = some, np.stack([a + y[a:z].argmax(0) for a, z in spans])
        return (out, at, x) if places else out

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(ids, first) @ self.out + self.bias

    def start(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """The first embedding column begins as shrunk log odds of a row's texts, and the first filter of a width reads it."""
        seen = np.zeros((2, TABLE), np.float32)
        for ids, label in zip(texts, y, strict=True):
            seen[int(label), np.unique(ids)] += 1
        n = np.maximum(np.bincount(y.astype(int), minlength=2), 1)
        odds = np.log((seen[1] / n[1] * n.sum() / 2 + 3) / (seen[0] / n[0] * n.sum() / 2 + 3))
        self.emb[:, 0] = np.clip(odds, -1, 3)
        for w in WIDTHS:
            self.k[w][:, 0, : FILTERS // 2] = np.abs(self.k[w][:, 0, : FILTERS // 2]) / w
        half = np.arange(len(self.out)) % FILTERS < FILTERS // 2
        self.out[half] = np.abs(self.out[half])

    def fit(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, least_steps: int = 900, rate: float = 0.05, seed: int = 13) -> None:
        """Adagrad on logistic loss.  texts: the word rows of each text; weight: how many rows of the corpus a text stands for."""
        if not len(texts):
            return
        self.start(texts, y)
        rng, weight = np.random.default_rng(seed), weight / weight.mean()
        past = {"emb": np.full((TABLE, 1), 1e-2, np.float32), "out": 1e-2 * np.ones_like(self.out), "bias": np.float32(1e-2), **{("k", w): 1e-2 * np.ones_like(self.k[w]) for w in WIDTHS}, **{("c", w): 1e-2 * np.ones_like(self.c[w]) for w in WIDTHS}}

        def step(value, grad, key):
            past[key] += grad * grad
            return (value - rate * grad / np.sqrt(past[key])).astype(np.float32)

        for _ in range(max(4, -(-least_steps * 64 // len(texts)))):
            order = rng.permutation(len(texts))
            for chunk in range(0, len(order), 64):
                pick = order[chunk : chunk + 64]
                ids = np.concatenate([texts[i] for i in pick])
                first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
                if not len(ids):
                    continue
                h, at, x = self.pooled(ids, first, places=True)
                g = ((1 / (1 + np.exp(-(h @ self.out + self.bias))) - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
                back = g[:, None] * self.out * (h > 0)
                self.out, self.bias = step(self.out, h.T @ g, "out"), step(self.bias, g.sum(), "bias")
                rows, grads = [], []
                for number, w in enumerate(WIDTHS):
                    if w not in at:
                        continue
                    some, place = at[w]
                    b = back[some, number * FILTERS : (number + 1) * FILTERS]
                    gk = np.zeros_like(self.k[w])
                    for o in range(w):
                        where = np.minimum(place + o, len(x) - 1)
                        gk[o] = np.einsum("nfe,nf->ef", x[where], b)
                        into = (b[:, :, None] * self.k[w][o].T[None]).reshape(-1, EMBED)
                        for column in range(3):
                            rows.append(ids[where, column].ravel())
                            grads.append(into)
                    self.k[w], self.c[w] = step(self.k[w], gk, ("k", w)), step(self.c[w], b.sum(0), ("c", w))
                unique, inverse = np.unique(np.concatenate(rows), return_inverse=True)
                total = np.zeros((len(unique), EMBED), np.float32)
                np.add.at(total, inverse, np.concatenate(grads))
                past["emb"][unique] += (total**2).mean(1, keepdims=True)
                self.emb[unique] -= rate * total / np.sqrt(past["emb"][unique])

    def outputs(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logit of each text, from all its words, and the number of these."""
        out, count = np.zeros(len(off) - 1), np.zeros(len(off) - 1, np.int64)
        for i, j in tk.pieces(off, _PIECE):
            ids, first = word_ids(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            out[i:j] = self.logits(ids, first) if len(ids) else self.bias
            count[i:j] = np.diff(first)
        return out, count


def best_threshold(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the largest F1; 0.5 if one of the classes is missing."""
    if not label.any() or label.all():
        return 0.5
    order = np.argsort(-score, kind="stable")
    s, hit, w = score[order], label[order] > 0, weight[order]
    true, flagged = np.cumsum(w * hit), np.cumsum(w)
    f1 = np.where(np.append(s[1:] < s[:-1], True), 2 * true / (flagged + (w * hit).sum()), 0)
    i = int(f1.argmax())
    return float((s[i] + (s[i + 1] if i + 1 < len(s) else 0)) / 2)


def examples(labels: DataFrame, where: Column, key: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(k, y, fr_fit) of the labelled rows to learn from, and their number by class.

    fr_fit: the rows to fit on, four fifths of about `sample` of each class, chosen by the hash of their key (only those
    of at most SAMPLE_WORDS words are fitted).
    """
    rows = labels.where(where & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("y") == 1, F.lit(sample / counts.get(1, 1))).otherwise(F.lit(sample / counts.get(0, 1)))
    chosen = by_chance(share, 5, "k")
    return rows.withColumn("fr_fit", chosen & (F.pmod(F.xxhash64(F.lit(7), "k"), F.lit(5)) > 0)), counts


def fit(docs: DataFrame, rows: DataFrame, counts: dict[int, int], key: str = "doc_id", text: str = "text") -> Model:
    """A model fitted on the texts of the rows with fr_fit, whose keys (at most about 2 * sample) are broadcast to find them."""
    model = Model()
    if not counts:
        return model
    found = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(rows.where("fr_fit")), "k").select(F.col("k").cast("string"), "y", "t")

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first = word_ids(*tk.flat(batch.column(2)))
            blobs = [ids[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)]
            fits = pa.array(np.diff(first) <= SAMPLE_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["k", "y", "x"]).filter(fits)

    got = found.mapInArrow(tk.lean(body), "k string, y int, x binary").toArrow().sort_by([("k", "ascending")])
    texts = [np.frombuffer(b, np.int32).reshape(-1, 3) for b in got.column("x").to_pylist()]
    y = np.array(got.column("y").to_pylist(), np.float32)
    in_sample = np.maximum(np.bincount(y.astype(int), minlength=2), 1)
    model.fit(texts, y, np.array([counts.get(0, 0) / in_sample[0], counts.get(1, 0) / in_sample[1]], np.float32)[y.astype(int)])
    return model


def logits(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, fr_lang, fr_logit, fr_long): the uncalibrated logit of each row of docs, and whether it has over SAMPLE_WORDS words."""
    ready(docs.sparkSession)
    kind, shared = dict(docs.dtypes)[key], docs.sparkSession.sparkContext.broadcast(model)

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, count = shared.value.outputs(*tk.flat(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out), pa.array(count > SAMPLE_WORDS)], names=[key, "fr_lang", "fr_logit", "fr_long"])

    return docs.select(key, text, F.col(lang).alias("fr_lang")).mapInArrow(tk.lean(body), f"`{key}` {kind}, fr_lang string, fr_logit double, fr_long boolean")


def best_logit(bins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float | None:
    """The logit between two bins with the largest F1; None if one of the classes is missing."""
    if not label.any() or label.all():
        return None
    return (best_threshold(bins.astype(float), label, weight) - ZERO) / FINE


def calibrate(model: Model, scored: DataFrame, rows: DataFrame, key: str = "doc_id") -> None:
    """Sets the model's shift and thresholds from all rows that weren't fitted, of any length.

    scored: see logits(); only it and the rows' labels are joined, no texts.  Logits are counted in bins by language and
    label, sums that partial aggregation makes before any shuffle; a language's bins make its threshold in one task.
    As long texts are never fitted, and the classes not in equal shares, an unfitted row stands for the rows of its class
    and kind of length.
    """
    bins = F.greatest(F.least(F.floor(F.col("fr_logit") * FINE + 0.5), F.lit(ZERO - 1)), F.lit(1 - ZERO)) + ZERO
    seen = rows.join(scored.withColumnRenamed(key, "k"), "k").select(
        F.coalesce("fr_lang", F.lit("")).alias("l"), "y", F.col("fr_long").alias("far"), (F.col("fr_fit") & ~F.col("fr_long")).alias("fitted"), bins.cast("int").alias("b")
    )
    table = materialize(seen.groupBy("l", "y", "far", "fitted", "b").agg(F.count("*").alias("n")))
    total, free = {}, {}
    for r in table.groupBy("y", "far", "fitted").agg(F.sum("n").alias("n")).collect():
        total[r.y, r.far] = total.get((r.y, r.far), 0) + r.n
        if not r.fitted:
            free[r.y, r.far] = r.n
    weight = {at: total[at] / n for at, n in free.items()}

    def best(t: pa.Table) -> float | None:
        b, y, far, n = (t.column(c).to_numpy() for c in ("b", "y", "far", "n"))
        return best_logit(b, y, n * np.array([weight[at] for at in zip(y.tolist(), far.tolist(), strict=True)]))

    order = [(c, "ascending") for c in ("b", "y", "far")]
    table = table.where(~F.col("fitted"))
    # the best common threshold becomes 0.5
    common = table.groupBy("y", "far", "b").agg(F.sum("n").alias("n")).toArrow().sort_by(order)
    model.shift = -min(MOST_SHIFT, max(-MOST_SHIFT, best(common) or 0.0))

    def threshold(t: pa.Table) -> pa.Table:
        return pa.table([t.column("l")[:1], pa.array([best(t.sort_by(order))], pa.float64())], names=["l", "at"])

    found = table.groupBy("l").applyInArrow(tk.lean(threshold), "l string, at double").collect()
    model.thresholds = {r["l"]: 0.5 if r["at"] is None else float(1 / (1 + np.exp(-(r["at"] + model.shift)))) for r in sorted(found, key=lambda r: r["l"])}


def finish(scored: DataFrame, model: Model) -> DataFrame:
    """scored with score, lang_threshold and flagged instead of the columns of logits()."""
    rows = scored.withColumn("score", 1 / (1 + F.exp(-(F.col("fr_logit") + F.lit(float(model.shift))))))
    limits = scored.sparkSession.createDataFrame(list(model.thresholds.items()), "fr_l string, lang_threshold double")
    rows = join_checked(rows, limits, F.coalesce("fr_lang", F.lit("")) == F.col("fr_l")).drop("fr_l").withColumn("lang_threshold", F.coalesce("lang_threshold", F.lit(0.5)))
    return rows.withColumn("flagged", F.col("score") >= F.col("lang_threshold")).drop("fr_lang", "fr_logit", "fr_long").select(*(c for c in scored.columns if not c.startswith("fr_")), "score", "lang_threshold", "flagged")


def train(docs: DataFrame, labels: DataFrame, where: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model fitted on a sample of the labelled rows and calibrated on all others; where: the rows to learn from."""
    ready(docs.sparkSession)
    rows, counts = examples(labels, where, key, label, sample)
    model = fit(docs, rows, counts, key, text)
    if counts:
        calibrate(model, logits(docs, model, key, text, lang), rows, key)
    return model


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, score, lang_threshold, flagged), a row for each row of docs.

    The score depends on the text alone; empty and null texts get the score of a text without words.  flagged compares it
    with the threshold of the row's language (0.5 for one that isn't known, or null).  Very long texts are read whole;
    rows that repeat are scored alike; an empty table gives an empty one; other columns, whatever their names, aren't
    read.
    """
    return finish(logits(docs, model, key, text, lang), model)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows, counts = examples(labels, ~held)
    model = fit(docs, rows, counts)
    scored = materialize(logits(docs, model))  # texts are scored once, for thresholds and result
    if counts:
        calibrate(model, scored, rows)
    return finish(scored, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang_threshold", "flagged")

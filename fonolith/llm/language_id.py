"""Language identification by error-correcting output codes.

Each language gets a codeword; for each bit of it a binary logistic classifier over hashed byte trigrams predicts the bit
from the text.  The nearest codeword by loss, each bit weighed by how reliable its classifier is, is the prediction.
Texts whose two nearest codewords are close are flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fonolith.llm import textkernel as tk
from fonolith.llm.common import by_chance
from fonolith.workers import ready

#: Hashed trigrams; texts in the training sample (over all languages); the languages to learn, the most frequent ones, at most
#: (a bound of the fit: texts of any other language still get a prediction).
DIM, SAMPLE, MOST_LANGUAGES = 4096, 4000, 2000
#: Scores of the best language below this are flagged as ambiguous.
AMBIGUOUS = 0.7
#: The mean size of a bit's margin on the training sample.
MARGIN = 2.0
_PIECE = 1 << 20
_SPACE = np.where(tk.NOT_LETTER, 32, np.arange(256)).astype(np.uint8)


def trigrams(buf: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that starts at each byte but the last two, in lower case with non-letters as blanks."""
    b = _SPACE[tk.lower(buf)].astype(np.uint32)
    return ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)) >> np.uint32(20)


def padded(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two blanks more around each text, so that every text has trigrams and none spans two texts."""
    n = len(off) - 1
    out = np.full(len(buf) + 2 * n + 2, 32, np.uint8)
    at = off + 2 * np.arange(n + 1)
    place = np.arange(len(buf)) + np.repeat(2 * np.arange(1, n + 1), np.diff(off))
    out[place] = buf
    return out, at


def frequencies(buf: np.ndarray) -> np.ndarray:
    out, _ = padded(buf, np.array([0, len(buf)]))
    return np.bincount(trigrams(out), minlength=DIM).astype(np.float32) / np.float32(max(1, len(out) - 2))


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k rows of +1 and -1: all splits of the classes for up to five, else random ones, the best of many by least distance."""
    if k <= 1:
        return np.ones((k, 0))
    if k <= 5:
        splits = [[1] + [1 - 2 * (i >> j & 1) for j in range(k - 1)] for i in range(1, 2 ** (k - 1))]
        return np.array(splits, float).T
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k))), None
    for _ in range(50 if k <= 200 else 5):
        code = rng.choice([-1.0, 1.0], (k, bits))
        code = code[:, np.abs(code.sum(0)) < k]
        agree = code @ code.T - 2 * bits * np.eye(k)
        if best is None or agree.max() < best[0]:
            best = (agree.max(), code)
    return best[1]


class Model:
    """Codewords and the linear classifiers of their bits."""

    def __init__(self, languages: list[str]) -> None:
        self.languages, self.code = languages, codewords(len(languages))
        bits = self.code.shape[1]
        self.w, self.bias, self.trust = np.zeros((DIM, bits), np.float32), np.zeros(bits), np.ones(bits)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 120, rate: float = 0.05, decay: float = 3e-4) -> None:
        """Logistic regression for all bits together, by Adam over all rows.  x: frequencies (they are scaled in place); y: numbers of languages."""
        bits = self.code.shape[1]
        if not bits or not len(x):
            return
        mean = x.mean(0, dtype=np.float64)
        scale = (1 / (np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x, dtype=np.float64) / len(x) - mean * mean, 0)) + 1e-4)).astype(np.float32)
        x *= scale  # in place: the sample is the largest thing on the driver
        target = (self.code[y] > 0).astype(np.float32)
        per_class = np.bincount(y, minlength=len(self.languages))
        weight = (1 / np.maximum(per_class, 1))[y].astype(np.float32)[:, None]
        weight /= weight.sum()
        w, b = np.zeros((DIM, bits), np.float32), np.zeros(bits, np.float32)
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
        for t in range(1, steps + 1):
            g = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - target) * weight
            gw, gb = x.T @ g + decay * w, g.sum(0)
            m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
            c = rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
            w -= c * m / (np.sqrt(v) + 1e-8)
            b -= c * mb / (np.sqrt(vb) + 1e-8)
        z = x @ w + b
        self.trust = np.maximum(2 * ((z > 0) == (target > 0)).mean(0) - 1, 0.01)
        calm = MARGIN / np.maximum(np.abs(z).mean(0), 1e-6)  # else the margins of separable classes grow without bound
        self.w, self.bias = (w * scale[:, None] * calm).astype(np.float32), (b * calm).astype(np.float64)

    def margins(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The classifiers' outputs for each text, from all its trigrams."""
        data, at = padded(buf, off)
        n = len(off) - 1
        out = np.zeros((n, self.w.shape[1]))
        for i, j in tk.pieces(at, _PIECE):
            for a in range(int(at[i]), int(at[j]), _PIECE):  # a long text in several pieces
                z = min(a + _PIECE, int(at[j]))
                values = self.w[trigrams(data[a : z + 2])]
                own = np.maximum(at[i:j], a) - a
                has = own < z - a
                out[i:j][has] += np.add.reduceat(values, own[has], axis=0, dtype=np.float64)
        return out / np.diff(at)[:, None] + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest language, and a score from the losses of all: softmax of their negatives."""
        wrong = self.trust * np.logaddexp(0, margins), self.trust * np.logaddexp(0, -margins)  # where a bit is -1, and +1
        loss = wrong[0] @ (self.code < 0).T + wrong[1] @ (self.code > 0).T if len(self.code) else np.zeros((len(margins), 1))
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        return p.argmax(1), p.max(1)


def training_sample(docs: DataFrame, key: str, text: str, lang: str, train: Column, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, frequencies and numbers of languages of about `sample` texts, chosen by hash, as many of each language.

    Besides its whole text, each chosen row gives one fragment of 40 to 200 bytes, so that short texts are known too.
    """
    ready(docs.sparkSession)
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("l"), F.col(key).alias("k"), F.col(text).alias("t"))
    common = rows.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGUAGES)
    counts = {r["l"]: r["n"] for r in common.collect()}
    if not counts:
        return [], np.zeros((0, DIM), np.float32), np.zeros(0, int)
    languages = sorted(counts)
    shares = docs.sparkSession.createDataFrame([(k, sample / len(counts) / n) for k, n in counts.items()], "l string, share double")
    chosen = rows.join(F.broadcast(shares), "l").where(by_chance(F.col("share"), 3, "k"))

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = tk.flat(batch.column(1))
            labels, blobs = [], []
            for i, label in enumerate(batch.column(0).to_pylist()):
                t = buf[off[i] : off[i + 1]]
                size = 40 + (len(t) * 7919) % 160
                a = (len(t) * 104729) % max(1, len(t) - size)
                for part in (t, t[a : a + size]):
                    labels.append(label)
                    blobs.append(frequencies(part).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(blobs, pa.binary())], names=["l", "x"])

    got = chosen.select("l", "t").mapInArrow(tk.lean(body), "l string, x binary").toArrow()
    x = np.empty((got.num_rows, DIM), np.float32)
    for i, blob in enumerate(got.column("x")):
        x[i] = np.frombuffer(blob.as_buffer(), np.float16)
    number = {name: i for i, name in enumerate(languages)}
    return languages, x, np.array([number[v] for v in got.column("l").to_pylist()], int)


def train(docs: DataFrame, key: str, text: str, lang: str, where: Column) -> Model:
    languages, x, y = training_sample(docs, key, text, lang, where)
    model = Model(languages)
    model.fit(x, y)
    return model


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, ambiguous), a row for each row of docs; nothing but the text decides.

    Null texts, and texts without a letter, get `und` and score 0; so does every text if no language was learned.  Very
    long texts are read whole, a piece at a time; rows that repeat are predicted alike; an empty table gives an empty one;
    other columns, whatever their names, aren't read.
    """
    ready(docs.sparkSession)
    kind, shared = dict(docs.dtypes)[key], docs.sparkSession.sparkContext.broadcast(model)

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            best, score = m.decode(m.margins(*tk.flat(batch.column(1))))
            letter = np.array(batch.column(2).to_pylist(), bool) & bool(m.languages)
            names = [m.languages[b] if x else "und" for b, x in zip(best, letter, strict=True)]
            score = np.where(letter, score, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)], names=[key, "lang_pred", "score", "ambiguous"])

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(key, text, letter.alias("letter")).mapInArrow(tk.lean(body), f"`{key}` {kind}, lang_pred string, score double, ambiguous boolean")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = train(docs, "doc_id", "text", "lang", ~held)
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")

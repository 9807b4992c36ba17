"""Small tables with all the awkward rows: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, fr_row string, h string, size long, k string"


def sentence(rng: random.Random, n: int = 30) -> str:
    return " ".join("".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def documents(spark, extra=()):
    rng = random.Random(11)
    base = [sentence(rng) for _ in range(6)]
    texts = [
        *base, base[0], base[0] + " ", base[1] + " one more word here", None, "", " \n\t ", "7 !", "ünïcode ñandú 漢字 😀 <|endoftext|> x", "a" * 5000, "word " * 4000,
        "line one is here\n" + base[2], "line one is here\n" + base[3], "\n".join(base * 40), *extra,
    ]
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2", ""][i % 4], None if t is None else len(t), i, "x", "h", 1, "k") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[4], "en", "s1", 5, None, None, None, None, None), (None, base[4], None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)

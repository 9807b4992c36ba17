"""Text and pronunciation functions against vectors traced by hand."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fonolith.functions.pronunciation import SPELLING, shape_codes, shape_names, unit_viseme, visemes, word_units
from fonolith.functions.text import BLANK, audio_prefix, clock, ends_phrase, is_word, join_tokens, language_or_default, normalize_text, normalize_word, seconds, strip


def apply(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select(f(F.col("v")).alias("x"), "i").orderBy("i").select("x").collect()]


WORDS = {"¡Pingüino!": "pingüino", "Él": "el", "covid-19,": "covid-19", "«o’clock»": "o'clock", "façade": "faade", "50%": "50", "…": "", "ÑANDÚ": "ñandu", "-hola-": "hola", "": "", " sí ": "si", None: ""}
TEXTS = {"  —Hola,  “mundo”...\n": 'Hola, "mundo"', "¿Qué tal?": "¿Qué tal?", "...": "", "Fin.": "Fin", "a\nb; ": "a b", None: ""}
UNITS = {
    "pingüino": "p i n g u i n o", "queso": "k e s o", "guerra": "g e rr a", "gente": "j e n t e", "blog": "b l o j", "gu": "g", "lengu": "l e n g", "muy": "m u i", "hacha": "a ch a",
    "niño": "n i ny o", "web": "u e b", "zinc": "s i n s", "covid-19": "k o b i d", "tic-tac": "t i k t a s", "güa": "g u a", "quark": "k u a r k", "agua": "a g u a", "vez": "b e s", "tic": "t i s",
    "qu": "k", "iraq": "i r a k", "y": "i", "yo": "i o".replace("i", "y"), "noche": "n o ch e", "llave": "ll a b e", "taxi": "t a s i", "cc": "k s", "2024": "", "h": "", "": "",
}


def test_normalize_word(spark):
    assert apply(spark, normalize_word, WORDS) == list(WORDS.values())


def test_normalize_word_step_by_step(spark):
    """One pass leaves what stripping, trimming and dropping after each other leave; is_word() says whether that is anything."""
    rng = random.Random(3)
    words = [None, "", *("".join(rng.choice("aB1ñÜ'’`-!¿ \n\x85\u3000éÁ…\u212a😀") for _ in range(rng.randrange(8))) for _ in range(600))]
    steps = []
    for w in words:
        t = (w or "").lower().translate(str.maketrans("’`áéíóú", "''aeiou"))
        steps.append(re.sub("[^a-z0-9ñü'-]+", "", re.sub(r"^[^a-z0-9ñü]+|[^a-z0-9ñü]+\Z", "", t)))
    assert apply(spark, normalize_word, words) == steps
    assert apply(spark, is_word, words) == [t != "" for t in steps]


def test_spelling_pattern_by_pattern(spark):
    """Plain replacements read a word as the patterns of SPELLING do; shapes are those of the units."""
    rng = random.Random(4)
    words = ["", *("".join(rng.choice("gguqcclrryeiaüñhx'-7k") for _ in range(rng.randrange(7))) for _ in range(600))]
    marks = {u: chr(0xF000 + i) for i, u in enumerate(sorted({u for units in SPELLING.values() for u in units}))}
    single = {"v": "b", "q": "k", "c": "k", "z": "s", "x": "s", "ñ": "ny", "w": "u", "ü": "u", **dict.fromkeys("h'-0123456789"), **{m: u for u, m in marks.items()}}
    want = []
    for w in words:
        for spelling, units in SPELLING.items():
            w = re.sub(spelling, "".join(marks[u] for u in units), w)
        want.append(" ".join(u for u in (single.get(c, c) for c in w) if u))
    assert apply(spark, lambda c: F.array_join(word_units(c), " "), words) == want
    assert apply(spark, lambda c: F.array_join(shape_names(shape_codes(c)), " "), words) == apply(spark, lambda c: F.array_join(visemes(word_units(c)), " "), words)


def test_clock(spark):
    ms = [None, -3.0, 0.0, 0.4999, 0.5, 1234.4, 1234.5, 61_000.0, 86_400_000.25, *(random.Random(5).uniform(0, 4e7) for _ in range(200))]
    assert apply(spark, clock, ms, "double") == [None if x is None else f"{x:.3f}" for x in apply(spark, seconds, ms, "double")]


def test_strip(spark):
    """All that BLANK names goes at both ends, nothing else, and without a pattern."""
    blanks = [chr(i) for i in range(0x3100) if re.match(BLANK, chr(i))]
    rng = random.Random(6)
    texts = [None, "", " ", *(f"{b}a{b}b{b}{b}" for b in blanks), *("".join(rng.choice(["a", "é", "😀", "\u200b", "\ufeff", *blanks]) for _ in range(rng.randrange(7))) for _ in range(300))]
    assert len(blanks) == 29 and apply(spark, strip, texts) == [None if t is None else re.sub(f"^{BLANK}+|{BLANK}+$", "", t) for t in texts]
    assert "regexp" not in spark.range(1).select(strip(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()


def test_normalize_text(spark):
    assert apply(spark, normalize_text, TEXTS) == list(TEXTS.values())


def test_units(spark):
    assert apply(spark, lambda c: F.array_join(word_units(c), " "), UNITS) == list(UNITS.values())


def test_visemes(spark):
    shapes = {"noche": "TD OO CH EE", "2024": "SIL", "llave": "YL AA PP EE", "": "SIL"}
    assert apply(spark, lambda c: F.array_join(visemes(word_units(c)), " "), shapes) == list(shapes.values())


def test_unit_viseme_defaults(spark):
    units = {"rr": "TD", " A ": "AA", "ei": "EE", "w": "TD", "ß": "TD", "7": "SIL", "": "SIL", "ñ": "YL"}
    assert apply(spark, unit_viseme, units) == list(units.values())


def test_join_tokens(spark):
    cases = [(["Hola", ",", "mundo", "!"], "Hola, mundo!"), (["(", "sí", ")", "no"], "(sí) no"), (['"', "a", '"', "b"], '"a "b'), (["", " x ", None, "y"], "x y"), ([], "")]
    assert apply(spark, join_tokens, [c[0] for c in cases], "array<string>") == [c[1] for c in cases]


@pytest.mark.parametrize(("token", "ends"), [("fin.", True), ("¡sí!\"", True), ("qué?)", True), ("puntos…", False), ("Sr.", True), ("no", False), ("", False), (None, False), (" a. ", True)])
def test_ends_phrase(spark, token, ends):
    assert apply(spark, ends_phrase, [token]) == [ends]


def test_prefix(spark):
    names = {"Canción 1.mp3": "canc", "ñ.wav": "nxxx", "01-a.mp3": "01ax", "日本.mp3": "audx", "/tmp/x.y/Ébano.m4a": "eban", ".mp3": "mp3x", "": "audx"}
    assert apply(spark, audio_prefix, names) == list(names.values())


def test_seconds(spark):
    ms = {-200.0: 0.0, 0.5: 0.001, 1234.4: 1.234, None: None}
    assert apply(spark, seconds, ms, "double") == list(ms.values())


def test_language(spark):
    assert apply(spark, language_or_default, [None, "", "EN"]) == ["es", "es", "en"]

"""Text expressions, Column to Column."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The characters that Unicode-aware stripping removes; Java's \s and trim know fewer (a fixed value).
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: These characters one by one.
_BLANKS = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: A token that ends a phrase: full stops, exclamation or question marks, then closing quotes or brackets (a fixed value).
PHRASE_END = r"""[.!?]+["')\]]*$"""
#: Characters that take no blank before them, and those that take none after them (fixed values).
NO_BLANK_BEFORE, NO_BLANK_AFTER = ".,!?;:)]}", "([{\"'"


def strip(c: Column) -> Column:
    # looks at the ends only, where a pattern would try every place
    return F.btrim(c, F.lit(_BLANKS))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, stripped; else the empty string."""
    return strip(F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit("")))


def normalize_word(c: Column) -> Column:
    """Lower case without acute accents; letters, digits, ñ, ü and inner apostrophes and hyphens stay."""
    # the characters of words, and what stands for others: fixed values
    t = F.translate(F.lower(F.coalesce(c, F.lit(""))), "’`áéíóú", "''aeiou")
    return F.regexp_replace(t, "^[^a-z0-9ñü]+|[^a-z0-9ñü]+$|[^a-z0-9ñü'-]+", "")


def is_word(c: Column) -> Column:
    """Whether normalize_word() leaves anything, without its replacements; false for null."""
    return F.coalesce(F.lower(c).rlike("[a-z0-9ñüáéíóú]"), F.lit(False))


def normalize_text(c: Column) -> Column:
    """One line with single blanks, straight quotes and plain dashes, and no blanks, dashes, stops or commas at its ends.

    Null becomes empty.
    """
    # quotes and dashes, and the characters that go at the ends: fixed values
    t = F.translate(F.coalesce(c, F.lit("")), "“”‘’—–", "\"\"''--")
    t = F.regexp_replace(t, f"{BLANK}+", " ")
    return F.regexp_replace(t, r"^[ \-.,;:]+|[ \-.,;:]+$", "")


def language_or_default(c: Column, default: str = "es") -> Column:
    return F.lower(F.coalesce(F.nullif(c, F.lit("")), F.lit(default)))


def ends_phrase(token: Column) -> Column:
    return strip(F.coalesce(token, F.lit(""))).rlike(PHRASE_END)


def join_plain(words: Column) -> Column:
    """The words that aren't empty, with single blanks between them."""
    return F.array_join(F.filter(words, lambda w: w != ""), " ")


def join_tokens(tokens: Column) -> Column:
    """Tokens as running text: no blank before closing punctuation, nor after an opening bracket or a straight quote."""
    full = F.filter(F.transform(tokens, lambda w: strip(F.coalesce(w, F.lit("")))), lambda w: w != "")

    def glue(f: Column) -> Column:
        def part(w: Column, i: Column) -> Column:
            joined = F.lit(NO_BLANK_BEFORE).contains(F.left(w, F.lit(1))) | F.lit(NO_BLANK_AFTER).contains(F.right(F.get(f, i - 1), F.lit(1)))
            return F.when((i == 0) | joined, w).otherwise(F.concat(F.lit(" "), w))

        return F.array_join(F.transform(f, part), "")

    return F.get(F.transform(F.array(full), glue), F.lit(0))


def seconds(ms: Column) -> Column:
    """Milliseconds as seconds with three decimals, never negative; null stays null."""
    return F.when(ms.isNotNull(), F.round(F.greatest(F.lit(0.0), ms / F.lit(1000.0)) + F.lit(1e-9), 3))


def clock(ms: Column) -> Column:
    """decimals() of seconds(), which are rounded once."""
    return F.when(ms.isNotNull(), decimals(F.greatest(F.lit(0.0), ms / F.lit(1000.0)) + F.lit(1e-9)))


def decimals(c: Column) -> Column:
    """Seconds as text with three decimals, rounded as round() does; null stays null."""
    # takes a fraction of what a format takes
    return c.cast("decimal(20,3)").cast("string")


@F.pandas_udf(StringType())
def without_accents(names: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks, for which Spark has no function.  Used once an audio file."""
    return names.map(lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


def audio_prefix(path: Column) -> Column:
    """Four letters or digits from the stem of a file name, filled up with x; audx if it has none."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    stem = F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)
    clean = F.lower(F.regexp_replace(without_accents(stem), "[^A-Za-z0-9]", ""))
    return F.when(F.coalesce(clean, F.lit("")) == "", F.lit("audx")).otherwise(F.rpad(F.left(clean, F.lit(4)), 4, "x"))

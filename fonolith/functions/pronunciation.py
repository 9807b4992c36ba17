"""Spanish spelling to pronunciation units, and units to mouth shapes, as string expressions without user functions.

A word's units, and its shapes, are held as a string with one character for each; such strings come from a few pattern
replacements, which are compiled, while functions over arrays would run a step at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fonolith.functions.text import strip
from fonolith.schema import UNIT_TO_VISEME, VISEMES

#: Spelling of more than one letter, or that depends on what follows, in the order it is tried, and its units (fixed values).
#: g, c, gu and qu are soft before e and i, and at the end of a word like there.
SPELLING = {"gü(?=[ei])": ("g", "u"), "ch": ("ch",), "ll": ("ll",), "rr": ("rr",), "qu(?=[ei]|$)": ("k",), "gu(?=[ei]|$)": ("g",), "g(?=[ei]|$)": ("j",), "c(?=[ei]|$)": ("s",), "y$": ("i",)}
#: The unit of a single letter where it isn't the letter itself; letters without a unit are silent (fixed values).
LETTER = {"v": "b", "q": "k", "c": "k", "z": "s", "x": "s", "ñ": "ny", "w": "u", "ü": "u"}
SILENT = "h'-0123456789"

#: The character of a unit of more than one letter; a unit found by SPELLING is a capital until single letters are read.
_WIDE = {"ch": "C", "ll": "L", "rr": "R", "ny": "N"}
_MARK = {u: _WIDE.get(u, chr(0xE000 + ord(u[0]))) for units in SPELLING.values() for u in units}
#: The character of a shape.
_SHAPE = {v: chr(ord("A") + i) for i, v in enumerate(VISEMES)}
#: What stands before and after a word while it is read, and a single letter's, or mark's, unit.
_BEGIN, _END = "\ue000", "\ue001"
_SINGLE = {**{m: u for u, m in _MARK.items() if u not in _WIDE}, **{a: _WIDE.get(u, u) for a, u in LETTER.items()}}
#: What follows soft letters.
_SOFT = "(?=[ei]|$)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _read(word: Column) -> Column:
    """A normalized word between _BEGIN and _END, with marks for spelling of more than one letter.

    Plain replacements take a fraction of what patterns take, so all that they can say is said by them.
    """
    code = F.concat(F.lit(_BEGIN), word, F.lit(_END))
    for spelling, units in SPELLING.items():
        marks = "".join(_MARK[u] for u in units)
        letters = spelling.removesuffix(_SOFT).removesuffix("$")
        after = "ei" + _END if spelling.endswith(_SOFT) else _END if spelling.endswith("$") else ("",)
        if letters.isalpha():
            for x in after:
                code = F.replace(code, F.lit(letters + x), F.lit(marks + x))
        else:
            code = F.regexp_replace(code, spelling, marks)
    return code


def unit_codes(word: Column) -> Column:
    """The units of a normalized word, a character each; empty for a word of digits."""
    return F.translate(_read(word), "".join(_SINGLE) + SILENT + _BEGIN + _END, "".join(_SINGLE.values()))


def characters(codes: Column) -> Column:
    return F.regexp_extract_all(codes, F.lit("."), F.lit(0))


def word_units(word: Column) -> Column:
    """The units of a normalized word; none for a word of digits."""
    wide = F.create_map(*(F.lit(x) for unit, code in _WIDE.items() for x in (code, unit)))
    return F.transform(characters(unit_codes(word)), lambda c: F.coalesce(F.element_at(wide, c), c))


def unit_viseme(unit: Column) -> Column:
    key = F.lower(strip(unit))
    first = F.left(key, F.lit(1))
    table = F.create_map(*(F.lit(x) for pair in UNIT_TO_VISEME.items() for x in pair))
    other = F.when(key == "", "SIL").when(first.isin(*"aeiou"), F.element_at(table, first)).when(first.rlike(r"\p{L}"), "TD").otherwise("SIL")
    return F.coalesce(F.element_at(table, key), other)


def visemes(units: Column) -> Column:
    """The mouth shapes of a word's units; silence if it has none."""
    return F.when(F.size(units) == 0, F.array(F.lit("SIL"))).otherwise(F.transform(F.filter(units, lambda u: u != ""), unit_viseme))


def shape_codes(word: Column) -> Column:
    """The mouth shapes of a normalized word, a character each; silence if it has no units."""
    table = {_WIDE.get(u, u): _SHAPE[v] for u, v in UNIT_TO_VISEME.items() if len(_WIDE.get(u, u)) == 1}
    table = {c: table.get(_SINGLE.get(c, c), _SINGLE.get(c, c)) for c in (*_SINGLE, *table) if c not in SILENT}

    def shapes(w: Column) -> Column:
        codes = F.translate(_read(w), "".join(table) + SILENT, "".join(table.values()))
        return F.translate(F.replace(codes, F.lit(_BEGIN + _END), F.lit(_SHAPE["SIL"])), _BEGIN + _END, "")

    # with the rows' other columns in one generated method these many steps would be more than the JVM compiles; let() keeps them out of it
    return let(word, shapes)


def shape_number(code: Column) -> Column:
    """The place of a shape's character in VISEMES."""
    return F.ascii(code) - ord("A")


def shape_name(code: Column) -> Column:
    """The name of a shape's character."""
    return F.get(F.array(*map(F.lit, VISEMES)), shape_number(code))


def shape_names(codes: Column) -> Column:
    return F.transform(characters(codes), shape_name)

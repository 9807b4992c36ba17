"""Constants and declared schemas of the speech tables.

Every table carries audio_id and an ordinal: position is part of the meaning.  Times are whole milliseconds until the
last projection, so sums don't depend on the order of rows.
"""

from __future__ import annotations

# Pronunciation unit -> mouth shape.
UNIT_TO_VISEME = {
    "sil": "SIL",
    "p": "PP", "b": "PP", "m": "PP",
    "f": "FF",
    "t": "TD", "d": "TD", "n": "TD", "l": "TD", "r": "TD", "rr": "TD",
    "s": "SS", "z": "SS", "j": "SS", "x": "SS",
    "ch": "CH", "sh": "CH",
    "k": "KG", "g": "KG", "q": "KG",
    "y": "YL", "ll": "YL", "ny": "YL", "ñ": "YL",
    "a": "AA", "e": "EE", "i": "II", "o": "OO", "u": "UU",
}

# The mouth shapes in the order of the output's inventory, and their weights in hundredths.
VISEMES = ("SIL", "PP", "FF", "TD", "SS", "CH", "KG", "YL", "AA", "EE", "II", "OO", "UU")
WEIGHTS = {"AA": 125, "EE": 120, "OO": 120, "II": 110, "UU": 110}
OTHER_WEIGHT = 100

# Defaults of the pipelines, in milliseconds where they are times.
SILENCE_MS, TOLERANCE_MS = 60, 1
MIN_PHRASE_MS, MAX_PHRASE_MS = 1500, 7000
MIN_SEGMENT_MS, END_PADDING_MS = 400, 250
AUDIO_EXTENSIONS = (".m4a", ".mp3", ".wav")
GENERATOR, DECIMALS = "spanish-viseme-pipeline", 3

#: Words, or spans, of a recording that one task may have.
LONG = 500_000
#: Bytes of texts, and words, that a task is dealt; a text of that size gives some 350,000 spans.
TASK_BYTES, TASK_WORDS = 2**19, 2**16 + 2**15
#: Words of a phrase that are cut by a fold, which takes a time that grows with their square; more are cut as rows.
MANY_WORDS = 2000

WORD = "struct<word string, text string, start double, end double, probability double>"
SEGMENT = f"struct<id bigint, start double, end double, text string, words array<{WORD}>>"
PHRASE = f"struct<start double, end double, text string, words array<{WORD}>>"
#: A transcript document, as the transcriber writes it.
TRANSCRIPT = f"audio_file string, model string, language string, text string, segments array<{SEGMENT}>, phrases array<{PHRASE}>"

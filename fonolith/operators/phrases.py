"""Phrases from the words of transcript segments.

words: (audio_id, seg, wi, word, start_ms, end_ms); segments: (audio_id, seg, text, start_ms, end_ms, words).
Phrases carry their words as an array in order; phrase_idx counts from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fonolith.functions.text import ends_phrase, join_tokens, strip
from fonolith.operators.chains import disordered, greedy_starts
from fonolith.operators.scans import apart, running
from fonolith.schema import MAX_PHRASE_MS, MIN_PHRASE_MS
from fonolith.storage import materialize

def _text(words: Column) -> Column:
    return join_tokens(F.transform(words, lambda w: w["word"]))


def build_phrases(segments: DataFrame) -> DataFrame:
    """Words in order, across segments, up to one that ends a phrase; what is left over is the last phrase.

    A segment without words but with text is a phrase of its own at once, so it comes before a phrase that is still open.
    """
    words = segments.where(F.size("words") > 0).select("audio_id", "seg", F.posexplode("words").alias("wi", "w"))
    order = Window.partitionBy("audio_id").orderBy("seg", "wi")
    closing = F.when(ends_phrase(F.col("w.word")), 1).otherwise(0)
    number = F.coalesce(F.sum(closing).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = words.withColumn("closing", closing).withColumn("n", number)
    spoken = marked.groupBy("audio_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("seg", "wi", "w"))).alias("all"),
        F.max("closing").alias("closed"),
        F.max(F.struct("seg", "wi")).alias("last"),
    )
    spoken = spoken.select(
        "audio_id",
        F.when(F.col("closed") == 1, F.col("last")).otherwise(F.struct(F.lit(2**62).cast("bigint").alias("seg"), F.lit(0).alias("wi"))).alias("at"),
        F.get("all", F.lit(0))["w"]["start_ms"].alias("start_ms"),
        F.element_at("all", -1)["w"]["end_ms"].alias("end_ms"),
        F.transform("all", lambda x: x["w"]).alias("words"),
    ).withColumn("text", _text(F.col("words")))
    silent = segments.where((F.coalesce(F.size("words"), F.lit(0)) <= 0) & (strip(F.coalesce("text", F.lit(""))) != "")).select(
        "audio_id", F.struct(F.col("seg").cast("bigint").alias("seg"), F.lit(-1).alias("wi")).alias("at"), "start_ms", "end_ms", F.array().cast(segments.schema["words"].dataType).alias("words"), strip(F.col("text")).alias("text")
    )
    place = F.row_number().over(Window.partitionBy("audio_id").orderBy("at"))
    return spoken.unionByName(silent).select("audio_id", place.alias("phrase_idx"), "start_ms", "end_ms", "text", "words")


def _place() -> Column:
    return F.row_number().over(Window.partitionBy("audio_id").orderBy("phrase_idx", "part"))


def split_long(phrases: DataFrame, longest: int = MAX_PHRASE_MS, many: int | None = None) -> DataFrame:
    """Phrases longer than that, cut before each word that would make a part of more than one word that long.

    Where a part begins depends on where the one before it ended, so a fold over the phrase's words numbers the parts.
    A phrase of just that length stays whole, and so does a single word.  many: phrases of more words are cut as chains of rows
    (see chains), with the same result, unless their words' times are out of order.
    """
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("from"), F.lit(0).alias("n"))

    def step(a: Column, w: Column) -> Column:
        cut = (a["n"] >= 1) & (w["end_ms"] - a["from"] >= longest)
        part = F.when(cut, a["part"] + 1).otherwise(a["part"])
        begin = F.when(cut | (a["n"] == 0), w["start_ms"]).otherwise(a["from"])
        return F.struct(F.concat(a["ids"], F.array(part)).alias("ids"), part.alias("part"), begin.alias("from"), F.when(cut, 1).otherwise(a["n"] + 1).alias("n"))

    long_ = (F.size("words") > 0) & (F.greatest(F.lit(0), F.col("end_ms") - F.col("start_ms")) > longest)
    chained = None
    if many is not None:
        phrases = phrases.withColumn("key", F.struct("audio_id", "phrase_idx"))
        large = materialize(phrases.where(long_ & (F.size("words") > many)).select("key", F.posexplode("words").alias("at", "w")))
        large = large.select("key", F.col("at").cast("long").alias("at"), F.col("w.start_ms").alias("start_ms"), F.col("w.end_ms").alias("end_ms"), "w")
        if large.limit(1).count():
            large = large.join(disordered(large.drop("w")), "key", "left_anti")
            starts = greedy_starts(large.drop("w"), longest, alone=False).withColumn("begins", F.lit(1).cast("long"))
            parts = running(large.join(starts, ["key", "at"], "left"), "key", [F.col("at")], part=("sum", F.coalesce("begins", F.lit(0).cast("long"))))
            cut = parts.groupBy("key", "part").agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("all")).withColumn("words", F.transform("all", lambda x: x["w"]))
            chained = cut.select("key.audio_id", "key.phrase_idx", F.col("part").cast("int").alias("part"), _rebuilt(F.col("words")).alias("p"))
            phrases = phrases.join(large.select("key").distinct(), "key", "left_anti")
        phrases = phrases.drop("key")
    ids = F.aggregate("words", start, step, lambda a: a["ids"])
    marked = phrases.withColumn("ids", F.when(long_, ids))
    parts = F.transform(F.sequence(F.lit(0), F.element_at("ids", -1)), lambda p: F.transform(F.filter(F.arrays_zip("ids", "words"), lambda x: x["ids"] == p), lambda x: x["words"]))
    whole = F.array(F.struct("start_ms", "end_ms", "text", "words"))
    pieces = marked.select("audio_id", "phrase_idx", F.posexplode(F.when(F.col("ids").isNotNull(), F.transform(parts, _rebuilt)).otherwise(whole)).alias("part", "p"))
    if chained is not None:
        pieces = pieces.unionByName(chained)
    return pieces.select("audio_id", _place().alias("phrase_idx"), "p.start_ms", "p.end_ms", "p.text", "p.words")


def _rebuilt(words: Column) -> Column:
    """A phrase made of these words."""
    return F.struct(F.get(words, F.lit(0))["start_ms"].alias("start_ms"), F.element_at(words, -1)["end_ms"].alias("end_ms"), _text(words).alias("text"), words.alias("words"))


def merge_short(phrases: DataFrame, shortest: int = MIN_PHRASE_MS, long: DataFrame | None = None) -> DataFrame:
    """Phrases in order, each taking in the next ones until it is long enough; the last may stay short.

    A merged phrase with words is made anew from its words alone, so text and times of a wordless part are lost; a bound
    that is null counts as no duration.  The fold is over one recording's phrases.  long: (audio_id), recordings of so many
    phrases that no row should have all of them; these are merged as chains of rows (see chains), with the same result, unless
    their times are out of order.
    """
    phrases, chained = apart(phrases, "audio_id", long)
    if chained is not None:
        rows = materialize(chained.withColumn("key", F.col("audio_id")).withColumn("at", F.col("phrase_idx").cast("long")))
        odd = materialize(disordered(rows.select("key", "at", "start_ms", "end_ms")))
        phrases = phrases.unionByName(rows.join(odd, "key", "left_semi").drop("key", "at"))
        rows = rows.join(odd, "key", "left_anti")
        starts = greedy_starts(rows.select("key", "at", "start_ms", "end_ms"), shortest, alone=True).withColumn("begins", F.lit(1).cast("long"))
        parts = running(rows.join(starts, ["key", "at"], "left"), "key", [F.col("at")], group=("sum", F.coalesce("begins", F.lit(0).cast("long"))))
        chained = parts.select("audio_id", (F.col("group") - 1).cast("int").alias("group"), F.struct("phrase_idx", "start_ms", "end_ms", "text", "words").alias("p"))
    rows = phrases.groupBy("audio_id").agg(F.array_sort(F.collect_list(F.struct("phrase_idx", "start_ms", "end_ms", "text", "words"))).alias("all"))
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(-1).alias("group"), F.lit(None).cast("bigint").alias("from"), F.lit(None).cast("bigint").alias("to"))

    def step(a: Column, p: Column) -> Column:
        new = (a["group"] < 0) | (F.greatest(F.lit(0).cast("bigint"), F.coalesce(a["to"] - a["from"], F.lit(0))) >= shortest)
        group = F.when(new, a["group"] + 1).otherwise(a["group"])
        return F.struct(F.concat(a["ids"], F.array(group)).alias("ids"), group.alias("group"), F.when(new, p["start_ms"]).otherwise(a["from"]).alias("from"), p["end_ms"].alias("to"))

    each = rows.select("audio_id", F.inline(F.arrays_zip(F.aggregate("all", start, step, lambda a: a["ids"]).alias("group"), F.col("all").alias("p"))))
    if chained is not None:
        each = each.unionByName(chained)
    groups = each.groupBy("audio_id", "group").agg(F.array_sort(F.collect_list(F.struct("p.phrase_idx", "p.start_ms", "p.end_ms", "p.text", "p.words"))).alias("all"))
    words = F.flatten(F.transform("all", lambda p: p["words"]))
    texts = F.filter(F.transform("all", lambda p: strip(F.coalesce(p["text"], F.lit("")))), lambda t: t != "")
    g = groups.withColumn("words", words)
    spoken = F.size("words") > 0
    return g.select(
        "audio_id",
        (F.col("group") + 1).alias("phrase_idx"),
        F.when(spoken, F.get("words", F.lit(0))["start_ms"]).otherwise(F.get("all", F.lit(0))["start_ms"]).alias("start_ms"),
        F.when(spoken, F.try_element_at("words", F.lit(-1))["end_ms"]).otherwise(F.element_at("all", -1)["end_ms"]).alias("end_ms"),
        F.when(spoken, _text(F.col("words"))).otherwise(F.array_join(texts, " ")).alias("text"),
        "words",
    )


def normalize_phrases(phrases: DataFrame, shortest: int = MIN_PHRASE_MS, longest: int = MAX_PHRASE_MS, long: DataFrame | None = None, many: int | None = None) -> DataFrame:
    return merge_short(split_long(phrases, longest, many), shortest, long)

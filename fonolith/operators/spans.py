"""Spans of mouth shapes: dealing a word's time to its shapes, merging, and the timeline of a recording.

Tables: spans (audio_id, seq, viseme, start_ms, end_ms); seq may be of any type that has an order.  All windows are by audio_id in the one order (start, end, seq),
so a plan needs one exchange by audio_id, and none if its input is already dealt so.  Recordings that are named as long are
dealt in parts instead, so that none of them is in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fonolith.functions.pronunciation import characters, let, shape_name, shape_number
from fonolith.operators.scans import apart, running
from fonolith.schema import OTHER_WEIGHT, SILENCE_MS, TOLERANCE_MS, VISEMES, WEIGHTS


def _runs(codes: Column) -> Column:
    """The runs of equal shapes in codes, see shape_codes()."""
    return F.regexp_extract_all(codes, F.lit(r"(.)\1*"), F.lit(0))


def _sums(runs: Column) -> Column:
    """Zero, and the weights of all shapes up to the end of each run."""
    weights = F.array(*(F.lit(WEIGHTS.get(v, OTHER_WEIGHT)) for v in VISEMES))
    return F.aggregate(runs, F.array(F.lit(0)), lambda a, r: F.array_append(a, F.element_at(a, -1) + F.length(r) * F.get(weights, shape_number(r))))


def shape_runs(codes: Column, merged: bool = True) -> Column:
    """array<struct<code, before, upto, total>>: each shape with the weights of all before it, up to its end, and of all.

    merged: equal neighbours are one, and code has the character of each.  codes: see shape_codes().
    """
    spans = lambda runs, c: F.transform(runs, lambda r, i: F.struct(r.alias("code"), F.get(c, i).alias("before"), F.get(c, i + 1).alias("upto"), F.element_at(c, -1).alias("total")))
    return let(_runs(codes) if merged else characters(codes), lambda runs: let(_sums(runs), lambda c: spans(runs, c)))


def _times(start: Column, end: Column, run: Column) -> tuple[Column, Column]:
    """Start and end of a run when the word's time is dealt in proportion to weights; the last one ends with the word."""
    at = lambda c: start + (end - start) * run[c] / run["total"]
    return at("before"), F.when(run["upto"] == run["total"], end.cast("double")).otherwise(at("upto"))


def _span(viseme: Column, start: Column, end: Column) -> Column:
    return F.struct(viseme.alias("viseme"), start.alias("start_ms"), end.alias("end_ms"))


def word_spans(start: Column, end: Column, codes: Column, time: Callable[[Column], Column] = lambda t: t, span: Callable[[Column, Column, Column], Column] = _span) -> Column:
    """array<struct<viseme, start_ms, end_ms>>: the word's time in proportion to weights, equal neighbours merged.

    The spans of a word touch each other, so merging is run-length encoding; all happens within the row, without a
    shuffle.  No spans if the word has no duration.  codes: see shape_codes().  time: what is made of a time where a span ends and the
    next one starts, once for both; span: what is made of a shape and its two times.
    """

    def times(c: Column) -> Column:
        return F.transform(c, lambda x: time(F.when(x == F.element_at(c, -1), end.cast("double")).otherwise(start + (end - start) * x / F.element_at(c, -1))))

    spans = let(_runs(codes), lambda runs: let(let(_sums(runs), times), lambda t: F.transform(runs, lambda r, i: span(shape_name(r), F.get(t, i), F.get(t, i + 1)))))
    return F.when(end > start, spans).otherwise(F.array())


def dealt_spans(words: DataFrame, *keep: str, merged: bool = True) -> DataFrame:
    """(<keep>, k, viseme, start_ms, end_ms): a row for each span that word_spans() has, k counts them in their word.

    words: start_ms, end_ms and codes (see shape_codes()).  merged: equal neighbours are one span.
    """
    # the generator's input is an expression: of an attribute a filter on its size would be inferred, which repeats all below
    each = words.where("end_ms > start_ms").select(*keep, "start_ms", "end_ms", F.posexplode(shape_runs(F.col("codes"), merged)).alias("k", "r"))
    a, z = _times(F.col("start_ms"), F.col("end_ms"), F.col("r"))
    return each.select(*keep, "k", shape_name(F.col("r.code")).alias("viseme"), a.alias("start_ms"), z.alias("end_ms"))


def merge_adjacent(spans: DataFrame, tolerance: int = TOLERANCE_MS, long: DataFrame | None = None) -> DataFrame:
    """spans without overlaps: equal shapes that touch (within the tolerance) merge, others are clipped to what came before.

    Gaps and islands: only spans that end later than all before them matter; an island begins where the shape changes or a
    gap opens.  Spans without duration go.  seq of the result counts from 0.  long: (audio_id), recordings of so many spans that
    no task should have all of one; these are merged in parts (see scans.running()), with the same result.
    """
    short, rest = apart(spans.where("end_ms > start_ms"), "audio_id", long)
    order = Window.partitionBy("audio_id").orderBy(*_ORDER)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    alive = short.withColumn("reach", F.max("end_ms").over(before)).where(_ALIVE)
    island = F.sum(_begins(F.lag("viseme").over(order), tolerance)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = alive.withColumn("island", island)
    if rest is not None:
        in_order = [F.col(c) for c in _ORDER]
        alive = running(rest, "audio_id", in_order, before=True, again=True, reach=("max", F.col("end_ms"))).where(_ALIVE)
        # of the rows before, the last one is the greatest by the order
        alive = running(alive, "audio_id", in_order, before=True, again=True, last=("max", F.struct(*_ORDER, "viseme")))
        alive = alive.withColumn("opens", _begins(F.col("last.viseme"), tolerance)).drop("last")
        parts = running(alive, "audio_id", in_order, island=("sum", F.col("opens").cast("long"))).drop("opens")
        numbered = numbered.unionByName(parts)
    numbered = numbered.withColumn("seq", F.col("island") - 1).withColumn("start_ms", F.greatest("start_ms", "reach"))
    # an island has one shape; as a key, it leaves numbers only to aggregate, which hashing can do
    merged = numbered.groupBy("audio_id", "seq", "viseme").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
    return merged.select("audio_id", "seq", "viseme", "start_ms", "end_ms")


_ORDER = ("start_ms", "end_ms", "seq")
_ALIVE = "reach IS NULL OR end_ms > reach"


def _begins(last: Column, tolerance: int) -> Column:
    """1 where an island begins: at the first span, at another shape than the last one's, after a gap."""
    return F.when(F.col("reach").isNull() | (F.col("viseme") != last) | (F.col("start_ms") > F.col("reach") + tolerance), 1).otherwise(0)


def timeline(spans: DataFrame, silence: bool = True, threshold: float = SILENCE_MS, long: DataFrame | None = None) -> DataFrame:
    """The timeline of each recording: spans in order, clipped, with silence where a gap reaches the threshold.

    Silence comes before the first span too, never after the last.  A row gives its silence and its span together, so
    what is above is computed once.  long: see merge_adjacent().
    """
    short, rest = apart(spans, "audio_id", long)
    order = Window.partitionBy("audio_id").orderBy(*_ORDER)
    rows = short.withColumn("place", F.row_number().over(order).cast("long")).withColumn("upto", F.max("end_ms").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    if rest is not None:
        in_order = [F.col(c) for c in _ORDER]
        parts = running(rest, "audio_id", in_order, before=True, upto=("max", F.col("end_ms")), place=("sum", F.lit(1).cast("long")))
        rows = rows.unionByName(parts.withColumn("place", F.coalesce("place", F.lit(0)) + 1))
    rows = rows.withColumn("cursor", F.greatest(F.lit(0.0), F.coalesce("upto", F.lit(0.0))))
    span = lambda v, a, z, k: F.struct(v.alias("viseme"), a.cast("double").alias("start_ms"), z.cast("double").alias("end_ms"), (F.col("place") * 2 + k).alias("seq"))
    both = [span(F.col("viseme"), F.greatest("start_ms", "cursor"), F.col("end_ms"), 1)]
    if silence:
        gap = F.col("start_ms") - F.col("cursor") >= max(0.0, threshold)
        both.insert(0, span(F.lit("SIL"), F.col("cursor"), F.when(gap, F.col("start_ms")).otherwise(F.col("cursor")), 0))
    kept = F.filter(F.array(*both), lambda s: s["end_ms"] > s["start_ms"])
    return merge_adjacent(rows.select("audio_id", F.inline(kept)), long=long)

"""Quality rules whose limits adapt to each language and source.

Each document gets a few non-negative integer measures.  Their distribution in every (lang, source) is held in a
quantile sketch: counts of logarithmic buckets that keep the leading bits of a value (relative error below 1/32).  Such
sketches are merged by adding counts, so partial aggregation builds them before any shuffle, no group meets in one task
and the result does not depend on the order of rows.  The limits read from the sketches are joined back and rows are
filtered.  Everything runs as built-in Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fonolith.llm.common import join_checked, let, materialize, packed, without, words

#: Symbols that count as noise (a fixed value).
SYMBOLS = "#*$%&|<>"
#: Measure: least distance of its upper limit from the median.  A document beyond the limit of any measure is rejected.
MARGINS = {"symbols": 100, "dup_lines": 250, "repeats": 150, "length": 200}
#: Words or lines that are added to a document's own where a measure divides by them, so that short texts don't swing.
PSEUDO = {"symbols": 10, "dup_lines": 4, "repeats": 10, "length": 5}
#: How many spreads (the distance of the 75 % quantile from the median: junk in up to a quarter of a group doesn't move it)
#: the limit lies above the median; how many times the limit of all documents it may be at most; and a bound that shares
#: of all lines can still exceed.
SPREADS, MOST_TIMES, MOST_SHARE = 4, 8, {"dup_lines": 800, "repeats": 200}
#: Limits of a group count as much as those of all documents if it has this many; smaller groups lean on all, larger ones
#: on their own.
PRIOR = 30


def repeated(w: Column, n: int = 5) -> Column:
    """How many words lie in n-word windows that occur twice or more in the array of words."""

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        places = lambda z: F.sort_array(
            F.transform(F.filter(z, lambda x, i: F.coalesce(F.get(z, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(z, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["at"])
        )
        total = lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(n), F.get(p, i + 1) - x)), F.lit(0), lambda a, b: a + b)
        return let(let(ordered, places), total)

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.size(h) - n + 1), lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, n))))

    def counted(w: Column) -> Column:
        hashes = let(F.transform(w, lambda x: F.xxhash64(x)), windows)  # of word hashes: quicker than of the words again
        return F.when(F.size(w) <= n, F.lit(0)).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))

    return let(w, counted)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one more column, fr_m: a struct of counts (null text: as empty)."""
    t = F.coalesce(F.col(text), F.lit(""))
    w = words(F.col(text))
    lines = F.filter(F.split(t, "\n"), lambda x: without(x, " \t\x0b\f\r") != "")
    cast = lambda c, name: c.cast("long").alias(name)
    return docs.withColumn(
        "fr_m",
        F.struct(
            cast(F.size(w), "n_words"), cast(F.length(without(t, " \t\n\x0b\f\r")), "word_chars"), cast(F.length(t) - F.length(without(t, SYMBOLS)), "n_symbols"),
            cast(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), "n_dup_lines"), cast(let(lines, F.size), "n_lines"), cast(repeated(w), "n_repeat_words"),
        ),
    )


def measures(m: Column) -> dict[str, Column]:
    """The measures that the limits are for, as integers (thousandths, or hundredths of a character)."""
    of = {"symbols": ("n_symbols", "n_words", 1000), "dup_lines": ("n_dup_lines", "n_lines", 1000), "repeats": ("n_repeat_words", "n_words", 1000), "length": ("word_chars", "n_words", 100)}
    return {k: F.floor(m[a] * times / (m[b] + PSEUDO[k])).cast("long") for k, (a, b, times) in of.items()}


def bucket(v: Column) -> Column:
    """The lower end of v's bucket: its six leading bits."""
    drop = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketch(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) of (lang, source, fr_m).  Sketches of parts are merged by adding n."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in measures(F.col("fr_m")).items())))
    return rows.select("lang", "source", pairs.alias("p")).groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count("*").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, size and, for each measure, the struct q_<measure> of its median and 75 % quantile."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    merged = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("size", F.sum("n").over(group))
    at = lambda k, q: F.min(F.when((F.col("measure") == k) & (F.col("upto") * 100 >= F.col("size") * q), F.col("bucket")))
    return merged.groupBy(*keys).agg(F.max("size").alias("size"), *(F.struct(at(k, 50).alias("mid"), at(k, 75).alias("high")).alias(f"q_{k}") for k in MARGINS))


def limits(sketches: DataFrame) -> DataFrame:
    """(lang, source, fr_limit): the struct of the limits of a group, a mean of its own and those of all documents.

    A group of n documents weighs n, all documents together PRIOR.  The group's own limits count up to MOST_TIMES those
    of all documents, and no limit passes MOST_SHARE, so a junk-heavy group can't lift its limits out of reach.
    """

    def limit(q: Column, k: str) -> Column:
        found = q["mid"] + F.greatest(F.lit(MARGINS[k]), SPREADS * (q["high"] - q["mid"]))
        return (F.least(found, F.lit(MOST_SHARE[k])) if k in MOST_SHARE else found).cast("long")

    as_limits = lambda df, *names: df.select(*names, F.struct(*(limit(F.col(f"q_{k}"), k).alias(k) for k in MARGINS)).alias("fr_own"))
    own = as_limits(quantiles(sketches, ["lang", "source"]), "lang", "source", "size")
    every = as_limits(quantiles(sketches.withColumn("everything", F.lit(0)), ["everything"])).select(F.col("fr_own").alias("fr_all"))
    mean = lambda k: F.floor((F.col("size") * F.least(F.col("fr_own")[k], MOST_TIMES * F.col("fr_all")[k]) + PRIOR * F.col("fr_all")[k]) / (F.col("size") + PRIOR)).cast("long")
    return own.join(F.broadcast(every)).select("lang", "source", F.struct(*(mean(k).alias(k) for k in MARGINS)).alias("fr_limit"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", counts_only: bool = False) -> DataFrame:
    """docs with fr_m (counts), fr_limit (limits of its group), fr_base_failed and fr_kept; every row stays.

    The counts of each document are made once and kept with its row in the shared folder; counts_only: without its text.
    Null and empty texts have no words and so fail the base rules.  Very long texts are counted whole.  Null lang or
    source is a group of its own.  Rows that repeat are judged alike; an empty table gives an empty table; other columns
    pass through untouched (names that begin with fr_ are this function's own).
    """
    rows = measured(docs, text)
    rows = materialize(rows.drop(text) if counts_only else rows)
    sketches = materialize(sketch(rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), "fr_m")))
    table = materialize(limits(sketches)).select(F.col("lang").alias("fr_lang"), F.col("source").alias("fr_source"), "fr_limit")
    joined = join_checked(rows, table, F.col(lang).eqNullSafe(F.col("fr_lang")) & F.col(source).eqNullSafe(F.col("fr_source"))).drop("fr_lang", "fr_source")
    m, lim = F.col("fr_m"), F.col("fr_limit")
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    beyond = F.lit(False)
    for k, v in measures(m).items():
        beyond = beyond | (v > lim[k])
    return joined.withColumn("fr_base_failed", failed).withColumn("fr_kept", ~F.col("fr_base_failed") & ~beyond)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs.

    Rows with a null or empty text go (they have no words); null lang and source, repeated rows, empty tables and very
    long texts are as in judge().
    """
    return judge(packed(docs), "fr_row.text", "fr_row.lang", "fr_row.source").where("fr_kept").select("fr_row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(docs, counts_only=True).select("doc_id", *(f"fr_m.{n}" for n in names), F.col("fr_base_failed").alias("base_failed"), F.col("fr_kept").alias("kept"))


_PER = {k: f"{a} * {times} // ({b} + {PSEUDO[k]})" for k, a, b, times in (("symbols", "n_symbols", "n_words", 1000), ("dup_lines", "n_dup_lines", "n_lines", 1000), ("repeats", "n_repeat_words", "n_words", 1000), ("length", "word_chars", "n_words", 100))}
_SHIFT = "greatest(length(bin({0})) - 6, 0)"

#: The same result in DuckDB's SQL.
OP3_SQL = rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, source, text, regexp_extract_all(text, '[^ 	-
]+') AS ws FROM t),
pos AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) > 5),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM pos),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t) WHERE regexp_matches(l, '[^ 	-
]') GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)),
f AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, '{k}' AS measure, {v} AS v FROM m" for k, v in _PER.items())}),
s AS (SELECT lang, source, measure, (v >> {_SHIFT.format("v")}) << {_SHIFT.format("v")} AS bucket, count(*) AS n FROM f GROUP BY ALL),
own AS (SELECT lang, source, measure, bucket, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS size FROM s),
every AS (SELECT measure, bucket, sum(n) OVER (PARTITION BY measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY measure) AS size FROM (SELECT measure, bucket, sum(n) AS n FROM s GROUP BY ALL)),
q AS (SELECT lang, source, measure, max(size) AS size, min(bucket) FILTER (upto * 100 >= size * 50) AS mid, min(bucket) FILTER (upto * 100 >= size * 75) AS high FROM own GROUP BY ALL),
qa AS (SELECT measure, min(bucket) FILTER (upto * 100 >= size * 50) AS mid, min(bucket) FILTER (upto * 100 >= size * 75) AS high FROM every GROUP BY ALL),
margin(measure, least, most) AS (VALUES {", ".join(f"('{k}', {v}, {MOST_SHARE.get(k, 2**62)})" for k, v in MARGINS.items())}),
lim AS (SELECT lang, source, measure, (size * least(own, {MOST_TIMES} * every) + {PRIOR} * every) // (size + {PRIOR}) AS lim
        FROM (SELECT q.lang, q.source, q.measure, q.size, least(most, q.mid + greatest(least, {SPREADS} * (q.high - q.mid))) AS own, least(most, qa.mid + greatest(least, {SPREADS} * (qa.high - qa.mid))) AS every
              FROM q JOIN qa USING (measure) JOIN margin USING (measure))),
bad AS (SELECT DISTINCT doc_id FROM f JOIN lim ON f.measure = lim.measure AND f.lang IS NOT DISTINCT FROM lim.lang AND f.source IS NOT DISTINCT FROM lim.source WHERE v > lim)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND bad.doc_id IS NULL AS kept
FROM m LEFT JOIN bad ON m.doc_id = bad.doc_id
"""

"""Quality rules, line dedup and mixing."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fonolith.llm import line_dedup, mixing, quality_rules
from fonolith.llm.queries import QUERIES, SQL
from tests.compare import same_as_sql
from tests.llm.edges import documents, no_documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert len(same_as_sql(spark, duck, QUERIES[name], SQL[name]))


def counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    docs = documents(spark, ["x y z a b x y z a b x", "#a ** $b\n#a ** $b\n\n\n c", "a b c d e f a b c d e"])
    for only in (True, False):
        rows = quality_rules.judge(docs, counts_only=only).join(docs.select("doc_id", F.col("text").alias("again")), "doc_id").collect()
        assert len(rows) > 20
        for r in rows:
            want = counts(r.again)
            assert tuple(r.fr_m)[:4] + (r.fr_m.n_repeat_words,) == (*want[:3], want[3], want[4]), r.doc_id
            assert r.fr_base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert not (r.fr_kept and r.fr_base_failed)
    assert quality_rules.judge(docs).count() == docs.count()


def test_quality_limits_adapt(spark):
    import random

    rng = random.Random(2)
    noisy = [(i, " | ".join(sentence(rng, 20).split()), "en", "tables", 1) for i in range(100)]
    plain = [(100 + i, sentence(rng, 40), "en", "prose", 1) for i in range(99)] + [(199, " ".join(w + "$$$" for w in sentence(rng, 40).split()), "en", "prose", 1)]
    rows = spark.createDataFrame(noisy + plain, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality_rules.filter_documents(rows).collect()}
    assert kept == set(range(199))  # many symbols are usual in one source and not in the other


def plain(rng, n, lines=8):
    return [(i, "\n".join(sentence(rng, 12) for _ in range(lines)), "en", "prose", 1) for i in range(n)]


@pytest.mark.parametrize("rule", quality_rules.MARGINS)
def test_each_rule_rejects_alone(spark, rule):
    """A document that passes the base rules and is beyond one measure's limit goes for that alone."""
    import random

    rng = random.Random(4)
    words = sentence(rng, 200).split()
    bad = {
        "symbols": " ".join(w + "#$" * (i % 3 == 0) for i, w in enumerate(words)),
        "dup_lines": "\n".join(["one two"] * 12 + [" ".join(words[i : i + 12]) for i in range(0, 180, 12)]),
        "repeats": " ".join(words + words[:11] + sentence(rng, 10).split() + words[50:61]),
        "length": " ".join("".join(words[i : i + 3]) for i in range(0, 198, 3)),
    }[rule]
    rows = spark.createDataFrame([*plain(rng, 80), (999, bad, "en", "prose", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    judged = quality_rules.judge(rows)
    row = judged.where("doc_id = 999").select("*", *(v.alias(f"v_{k}") for k, v in quality_rules.measures(F.col("fr_m")).items())).first()
    assert not row.fr_base_failed and not row.fr_kept
    assert [k for k in quality_rules.MARGINS if row[f"v_{k}"] > row.fr_limit[k]] == [rule]
    assert judged.where("fr_kept").count() == 80


def test_junk_does_not_lift_its_limits(spark):
    """A source of which a fifth is junk loses just that, also where it is small."""
    import random

    rng = random.Random(5)
    junk = [(1000 + i, " ".join(w + "$$" * (j % 2) for j, w in enumerate(sentence(rng, 90).split())), "en", s, 1) for i, s in enumerate(["big"] * 20 + ["small"] * 2)]
    good = [(i, t, "en", "big" if i < 80 else "small", 1) for i, t, *_ in plain(rng, 88)]
    kept = {r.doc_id for r in quality_rules.filter_documents(spark.createDataFrame(good + junk, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert kept == set(range(88))


def test_sketch_error_and_merging(spark):
    values = spark.range(1, 5000).select((F.col("id") * 37 % 4999).cast("long").alias("v"))
    got = values.select("v", quality_rules.bucket(F.col("v")).alias("b")).collect()
    assert all(r.b <= r.v and (r.v - r.b) * 32 <= max(r.v, 32) for r in got)
    parts = [spark.createDataFrame([("en", "s", "symbols", b, n)], "lang string, source string, measure string, bucket long, n long") for b, n in ((1, 2), (1, 3), (7, 5))]
    one = parts[0].union(parts[1]).union(parts[2])
    assert one.groupBy("bucket").agg(F.sum("n")).count() == 2
    assert quality_rules.quantiles(one, ["lang"]).select("q_symbols.mid", "q_symbols.high", "size").first() == (1, 7, 10)


def test_line_dedup_brute(spark):
    docs = documents(spark)
    ratio, least, far = 0.1, 2, 2.0
    got = collections.Counter((r.doc_id, r.source, r.text) for r in line_dedup.drop_lines(docs, ratio=ratio, least_pages=least, deviations=far).collect())
    rows = docs.collect()
    pages = collections.Counter(r.source for r in rows)
    have = collections.Counter((r.source, x.strip(" \t\r\x0b\x0c")) for r in rows for x in {x.strip(" \t\r\x0b\x0c") for x in (r.text or "").split("\n")} if x)
    bad = {k for k, n in have.items() if n >= least and n - ratio * pages[k[0]] > far * (pages[k[0]] * ratio * (1 - ratio)) ** 0.5}
    clean = lambda r: None if r.text is None else "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r\x0b\x0c")) not in bad)
    assert bad and got == collections.Counter((r.doc_id, r.source, clean(r)) for r in rows)


def test_lines_of_small_hosts(spark):
    """A line on all pages of a host goes also where these are few; one that two of many pages share stays."""
    rows = [(i, f"menu\npage {i}" + "\ncopied" * (i < 2), f"host{i // 4}", 0) for i in range(16)] + [(20 + i, f"top\nother {i}", "tiny", 0) for i in range(2)]
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")).collect()}
    assert got == {i: t.removeprefix("menu\n") for i, t, *_ in rows}


def test_odd_pages(spark, duck, tmp_path):
    """The query and its SQL agree on pages without html or url, without a host, empty, repeated, and with other columns."""
    page = "<p>nav</p><p>text {}</p>"
    rows = [(i, f"http://h{i % 2}/x", page.format(i), "z") for i in range(12)] + [(3, "http://h1/x", page.format(3), None), (None, None, page.format("n"), "q"), (50, None, None, ""), (51, "no url", "", ""), (52, "", "<br>", ""), (53, "http://h0/", None, "")]
    rows += [(60 + i, None, page.format(60 + i), "k") for i in range(4)]
    spark.createDataFrame(rows, "page_id long, url string, html string, host string").write.parquet(str(tmp_path / "pages.parquet"))
    want = duck.cursor().sql(line_dedup.OP10_SQL.replace("FROM pages)", f"FROM '{tmp_path}/pages.parquet/*.parquet')")).fetchall()
    got = line_dedup.op10_line_dedup(spark, str(tmp_path)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want) and sum(r.n_dropped for r in got) > 15
    none = tmp_path / "none"
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(none / "pages.parquet"))
    assert line_dedup.op10_line_dedup(spark, str(none)).count() == 0


def test_filters_keep_columns(spark):
    docs = documents(spark)
    for f in (quality_rules.filter_documents, line_dedup.clean_documents, mixing.mix_documents):
        assert f(docs).columns == docs.columns
        assert f(docs).where("fr_row is not null and fr_row <> 'x'").count() == 0
        assert f(no_documents(spark)).count() == 0


def test_page_lines(spark):
    html = '<html><head><style>p{}</style><script>var t="</p>";</script></head><body><!-- x <p>no --><ul><li><a href="/a">one</a></li><li>two</li></ul><p><b>three</b> <i>four</i><br>five</p></body></html>'
    row = spark.createDataFrame([(html,)], "h string").select(line_dedup.page_lines(F.col("h"))).first()
    assert row[0] == "one\ntwo\nthree four\nfive"
    urls = {"http://A.b.example/x?y": "a.b.example", "https://u@h.org:80/": "h.org", "no url": "", None: None}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(line_dedup.host_of(F.col("u"))).collect()
    assert [r[0] for r in got] == list(urls.values())


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rate = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if rate * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else rate * weight[s] for s in names}
        capped |= over


def check_mix(rows):
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 2
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_mixing(spark):
    docs = documents(spark)
    rows = mixing.taken_copies(docs).collect()
    assert len(rows) == docs.count()
    check_mix(rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.taken_copies(docs.repartition(7)).collect()))
    mixed = mixing.mix_documents(docs)
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.taken_copies(no_documents(spark)).count() == 0


def test_mixing_query(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 7)  # several levels of the tree
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = mixing.taken_copies(docs).collect()
    check_mix(got)
    assert {r.doc_id: r.size for r in got} == {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(QUERIES["op9_mixing"](spark, "/root/testdata/sf0.001").columns)


@pytest.mark.parametrize("equal", [True, False])
def test_pivot_keeps_mass_and_expectation(equal):
    rng = np.random.default_rng(0)
    size, p = np.sort(rng.integers(1, 200, 40))[::-1].astype(float), np.full(40, 0.37) if equal else rng.uniform(0.05, 0.95, 40)
    mean = np.zeros(40)
    for _ in range(3000):
        out, left = mixing.pivot_pairs(size, p, rng.integers(0, 2**64, 40, np.uint64))
        assert (out * size).sum() == pytest.approx((p * size).sum())
        assert all(x in (0, 1) for i, x in enumerate(out) if i != left)
        mean += out
    assert np.abs(mean / 3000 - p).max() < 0.04


def test_repeated_rows_are_told_apart(spark, monkeypatch):
    """Rows of one key, source and size but different texts are mixed as documents of their own, alike in every run."""
    rows = [(i % 3 or None, f"a b{i} c", "s", "x") for i in range(30)] + [(1, "a b c", "s", "x")] * 20 + [(5, f"w{i} v u", "t", "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place string")
    mixed = lambda d: collections.Counter((r.doc_id, r.text) for r in mixing.mix_documents(d).collect())
    one = mixed(docs.repartition(3))
    assert one == mixed(docs.repartition(11, "text")) and one.total() == sum(r.copies for r in mixing.taken_copies(docs).collect())
    check_mix(mixing.taken_copies(docs).collect())

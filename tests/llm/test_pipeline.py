"""The corpus pipeline, stage by stage."""

import collections
import hashlib

import corpus_pipeline
from fonolith.llm.bpe import encode_documents
from fonolith.llm.line_dedup import DEVIATIONS, LEAST_PAGES, RATIO
from fonolith.llm.minhash import near_classes
from fonolith.llm.quality_rules import OP3_SQL
from tests.llm.edges import documents, no_documents
from tests.llm.test_near_copies import classes
from tests.llm.test_text_filters import WORD, targets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality rules", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "BPE encoding"]
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = f(spark, docs, SF)
        assert docs.columns == columns
        docs = corpus_pipeline.materialize(docs)
        seen.append(docs.count())
    assert seen[0] > seen[1] == seen[2] > seen[3]
    assert near_classes(docs.dropDuplicates(["doc_id"])).where("not kept").count() == 0
    import public_tokenizers

    want = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "ids_sha256").collect()
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_odd_tables(spark):
    for docs in (documents(spark), no_documents(spark)):
        for _, f in corpus_pipeline.STAGES:
            docs = f(spark, docs, SF)
        docs.count()


def without_boilerplate(rows):
    """The texts of rows (doc_id, source, text), less the lines that are on too many of their source's."""
    blank = " \t\n\x0b\f\r"
    pages, on = collections.Counter(r[1] for r in rows), collections.Counter()
    for _, source, text in rows:
        on.update({(source, line.strip(blank)) for line in (text or "").split("\n") if line.strip(blank)})
    over = {k: n - pages[k[0]] * RATIO for k, n in on.items() if n >= LEAST_PAGES}
    bad = {k for k, x in over.items() if x > 0 and x * x > pages[k[0]] * DEVIATIONS**2 * RATIO * (1 - RATIO)}
    return {i: None if text is None else "\n".join(line for line in text.split("\n") if (source, line.strip(blank)) not in bad) for i, source, text in rows}


def test_stages_against_naive_versions(spark, duck):
    """Each stage's rows, from its own input, as plain passes over these make them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage, found = dict(corpus_pipeline.STAGES), {}
    before = docs
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, before, SF)
        if name != "BPE encoding":
            out = corpus_pipeline.materialize(out)
        found[name] = (before.collect(), out.collect())
        before = out
    assert set(found) == set(stage)
    ids = lambda rows: sorted(r.doc_id for r in rows)
    was, now = found["quality rules"]
    assert ids(now) == sorted(i for (i,) in duck.sql(f"SELECT doc_id FROM ({OP3_SQL}) WHERE kept").fetchall()) and len(now) < len(was)
    was, now = found["line dedup"]
    assert {r.doc_id: r.text for r in now} == without_boilerplate([(r.doc_id, r.source, r.text) for r in was]) and ids(now) == ids(was)
    was, now = found["MinHash near-dedup"]
    assert ids(now) == sorted(k for k, v in classes([(r.doc_id, r.text) for r in was]).items() if k == v) and len(now) < len(was)
    was, now = found["mixing sources to target weights"]
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in was}
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in was:
        sizes[r.source] += size[r.doc_id]
        largest[r.source] = max(largest[r.source], size[r.doc_id])
    for r in now:
        taken[r.source] += size[r.doc_id]
    assert all(abs(taken[s] - t) <= largest[s] + 1e-6 for s, t in targets(sizes).items())
    assert max(collections.Counter(ids(now)).values()) <= 2 and set(now) <= set(was)
    was, now = found["BPE encoding"]
    import public_tokenizers
    import tokenizers

    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.no_truncation()
    tok.no_padding()
    encoded = [(r.doc_id, tok.encode(r.text or "", add_special_tokens=False).ids) for r in was]
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in now) == sorted((i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in encoded)

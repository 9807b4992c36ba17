"""The prefix trie of conversations against nested dictionaries."""

import collections
import hashlib
import random
import re
import zlib

from fonolith.llm import conversation_trie as ct
from tests.compare import same_as_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = "conv_id long, turn long, role string, text string, conv long, pos long, row string"


def naive(rows):
    """{(conv_id, depth): the other columns} of rows (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    members = collections.defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append((c, len(turns)))
    nodes = {k: min(v)[0] for k, v in members.items()}
    kids = collections.Counter(k[:-1] for k in members if k)
    out = []
    for k, v in members.items():
        below = [b for b in members if b[: len(k)] == k]
        saved = sum((len(members[b]) - 1) * len(WORD.findall(b[-1][1])) for b in below if b)
        ends = ",".join(str(c) for c, n in sorted(v) if n == len(k))
        out.append((nodes[k], len(k), nodes[k[:-1]] if k else None, len(v), kids[k], sum(kids[b] == 0 for b in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def built(spark, rows, block=ct.BLOCK):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], ROWS).repartition(3)
    turns = ct.numbered_turns(df)
    convs = turns.select("conv").distinct()
    return sorted(map(tuple, ct.prefix_trie(ct.rebuilt_turns(turns, convs), convs, block).collect()), key=str)


def edge_rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(38, 64), 100, 999_999_999_999, -3, -40]:
        for t in range(rng.randrange(1, 7)):
            rows.append((c, rng.choice([t, t, None, 2]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", " a\n", "", None, "c", "ñ  ü", "d " * 3000])))
    rows += rows[:4] + [(None, 0, "user", "lost"), (64, None, None, None), (65, None, None, None)]
    rows += [(c, t, "user", "same") for c in (70, 71, 72, 73, 140) for t in range(5)]
    return rows


def test_edges(spark):
    rows = edge_rows()
    assert built(spark, rows) == naive(rows)
    assert built(spark, []) == []


def test_long_paths(spark):
    """Blocks of four turns, so that ranks of blocks are put together again and again."""
    rng = random.Random(8)
    rows = [(c, t, "u", rng.choice("ab") if t < 3 else "ab"[t % 2] if c % 3 else "a") for c in range(1, 24) for t in range(rng.choice([1, 2, 4, 9, 17, 33]))]
    assert built(spark, rows, 4) == naive(rows)


def test_many_ends(spark):
    """The numbers of a node's conversations make up several texts, over several batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(c, 0, "u", "hello there") for c in range(0, 4000, 7)]
        assert built(spark, rows) == naive(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sql(spark, duck):
    assert len(same_as_sql(spark, duck, ct.op13_conversation_trie, ct.OP13_SQL))

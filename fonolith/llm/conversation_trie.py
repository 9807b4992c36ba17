"""The prefix trie of conversations by preorder intervals.

A node is a distinct sequence of first turns.  It is known by its depth and by two hashes: the XOR of hashes of its turns, each
salted with the turn's place, so that a running XOR along a conversation gives all its nodes, in blocks of turns and over
several tasks for a long one.

Nodes are ranked lexicographically: by the digests of their turns in order, a prefix before what extends it.  That is the
preorder of the trie.  Each node also sends an end mark, a child that comes after all others, so the rank of the mark is
where the node's subtree ends.  In one distributed prefix sum over nodes and marks, what a subtree holds is the
difference between its mark and its node.

Paths are compared in blocks of turns.  What goes on below the first block is ranked by itself: ranks within blocks come first, and ranks over blocks twice as
long are made of two of them, until a block holds the deepest path.  So a row is no longer than a block, at any depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fonolith.llm.common import drop_files, materialize
from fonolith.operators.scans import running
from fonolith.workers import ready

#: Turns of a path that are compared at once.
BLOCK = 16
#: Conversations are rebuilt from the first turns of the first one in each run of so many numbers, fewer than so many turns (the contract's).
FAMILY, SHARED = 20, 4
#: An end mark comes after all digests, which are 16 bytes long.
_MARK = "X'" + "ff" * 17 + "'"
_WORD = r"[^\x20\x09-\x0D]+"
_NODE = ("depth", "x1", "x2")


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart; null role or text is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, words) of conversations: pos counts turns from 1, null turn first, ties by digest; words of the text.

    Texts don't go through any shuffle.  Rows without a conversation go; rows that repeat are turns of their own.
    """
    narrow = conversations.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), turn_digest(F.col(role), F.col(text)).alias("digest"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD)).cast("long").alias("words"))
    narrow = materialize(narrow.where("conv is not null").withColumn("row", F.monotonically_increasing_id()))
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    return running(narrow, "conv", order, pos=("sum", F.lit(1))).select("conv", F.col("pos").cast("long").alias("pos"), "digest", "words")


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """turns with each conversation c begun by the first h turns of c - c % FAMILY, in place of its own; h = crc32(c) % SHARED."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).cast("long")
    wanted = convs.select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), h.alias("h"))
    heads = turns.where(F.col("pos") < SHARED).withColumnRenamed("conv", "base").join(wanted, "base").where("pos <= h").select("conv", "pos", "digest", "words")
    heads = materialize(heads)
    had = heads.groupBy("conv").agg(F.count("*").alias("had"))
    own = turns.withColumn("h", h).where("pos > h").join(had, "conv", "left")
    return heads.unionByName(own.select("conv", (F.coalesce("had", F.lit(0)) + F.col("pos") - F.col("h")).alias("pos"), "digest", "words"))


def _with_nodes(turns: DataFrame, block: int) -> DataFrame:
    """turns with the node they end at (x1, x2), its parent (p1, p2), the node where its block begins (s1, s2) and the path from there."""
    rows = turns.withColumn("block", F.expr(f"(pos - 1) div {block}"))
    rows = rows.select("conv", F.col("pos").alias("depth"), "block", "digest", "words", *(F.xxhash64(F.lit(k), "pos", "digest").alias(f"o{k}") for k in (1, 2)))
    so_far = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv", "depth", "block", "words", "o1", "o2", *(F.bit_xor(f"o{k}").over(so_far).alias(f"x{k}") for k in (1, 2)), F.collect_list("digest").over(so_far).alias("path"))
    rows = materialize(rows)
    full = rows.where(F.col("depth") % block == 0).select("conv", "block", "x1", "x2")
    s1 = s2 = F.lit(0).cast("long")
    if full.limit(1).count():
        before = running(full, "conv", [F.col("block")], s1=("xor", F.col("x1")), s2=("xor", F.col("x2")))
        rows = rows.join(before.select("conv", (F.col("block") + 1).alias("block"), "s1", "s2"), ["conv", "block"], "left")
        s1, s2 = F.coalesce("s1", s1), F.coalesce("s2", s2)
    rows = rows.withColumn("s1", s1).withColumn("s2", s2)
    for k in (1, 2):
        rows = rows.withColumn(f"x{k}", F.col(f"x{k}").bitwiseXOR(F.col(f"s{k}"))).withColumn(f"p{k}", F.col(f"x{k}").bitwiseXOR(F.col(f"o{k}")))
    return rows.drop("o1", "o2", "block")


def _ranked(events: DataFrame, value: str) -> DataFrame:
    """events with r: the dense rank of a value, from 1."""
    distinct = running(events.select(value).distinct(), None, [F.col(value)], r=("sum", F.lit(1).cast("long")))
    return events.drop("r").join(distinct.withColumnRenamed(value, "fr_value"), F.col(value) == F.col("fr_value")).drop("fr_value")


def preorder(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(depth, x1, x2, mark, r): each node and its end mark with their ranks in the preorder of the trie; r is any ordered value."""
    cut = F.col("depth") % block == 0
    marks = nodes.select(*_NODE, F.lit(1).alias("mark"), F.expr(f"depth div {block}").alias("m"), F.when(cut, F.col("x1")).otherwise(F.col("s1")).alias("s1"), F.when(cut, F.col("x2")).otherwise(F.col("s2")).alias("s2"), F.concat(F.when(cut, F.array().cast("array<binary>")).otherwise(F.col("path")), F.array(F.expr(_MARK))).alias("path"))
    starts = nodes.select(*_NODE, F.lit(0).alias("mark"), F.expr(f"greatest(depth - 1, 0) div {block}").alias("m"), "s1", "s2", "path")
    events = starts.unionByName(marks)
    own = lambda path, below: F.struct(path.alias("path"), below.cast("long").alias("below"))
    shallow = events.where("m = 0").select(*_NODE, "mark", own(F.col("path"), F.lit(0)).alias("r"))
    deepest = (nodes.agg(F.max("depth")).first()[0] or 0) + 1
    if deepest <= block:
        return shallow
    # what goes on below the first block is ranked by itself
    deep = materialize(events.where("m > 0").withColumn("m", F.col("m") - 1))
    deep, size = materialize(_ranked(deep, "path").drop("path")), block
    while size < deepest - block:
        # a path that reaches into the second half of a block of twice the size is compared by the rank of the first half, then its own
        halves = deep.where("mark = 0").select(F.col("depth").alias("at"), F.col("x1").alias("s1"), F.col("x2").alias("s2"), F.col("r").alias("first"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
        second = deep.where("m % 2 = 1").withColumn("at", block + F.col("m") * size).join(halves, ["at", "s1", "s2"])
        second = second.select(*_NODE, "mark", "m", F.col("t1").alias("s1"), F.col("t2").alias("s2"), F.struct("first", F.col("r").alias("then")).alias("pair"))
        first = deep.where("m % 2 = 0").select(*_NODE, "mark", "m", "s1", "s2", F.struct(F.col("r").alias("first"), F.lit(0).cast("long").alias("then")).alias("pair"))
        both, old = materialize(first.unionByName(second).withColumn("m", F.shiftright("m", 1))), deep
        deep, size = materialize(_ranked(both, "pair").drop("pair")), size * 2
        drop_files(old)
    tops = nodes.where(F.col("depth") == block).select(F.col("x1").alias("s1"), F.col("x2").alias("s2"), "path")
    return shallow.unionByName(deep.join(tops, ["s1", "s2"]).select(*_NODE, "mark", own(F.col("path"), F.col("r")).alias("r")))


def ends_digest(ends: DataFrame, together: int = 8) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of (depth, x1, x2, conv): the hash of a node's numbers in order, with commas between them.

    Numbers that agree but for their last bits make up one text; the texts of a node go in order through one task, as the
    hash is one of a sequence, and none but the current one is held.
    """
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    texts = ends.withColumn("part", F.shiftright("conv", together)).groupBy(*_NODE, "part").agg(text.alias("text"))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *at, text in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "text")), strict=True):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _digests(done)
        yield _digests([(*node, state.hexdigest())] if node is not None else [])

    return texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "part").select(*_NODE, "text").mapInArrow(body, "depth long, x1 long, x2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 3 else pa.int64()) for k, c in enumerate(columns)], names=[*_NODE, "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node of the trie.

    turns: (conv, pos, digest, words), pos counting from 1 without gaps; convs: (conv), each once, also those without turns,
    which end at the root.  Conversations with the same turns share all nodes and end at the same one.  A conversation of
    many turns, and a node of many conversations, are in many tasks; only the hash of a node's numbers, which is one of a
    sequence, is streamed through one.  No conversations give no nodes.
    """
    ready(turns.sparkSession)
    rows = materialize(_with_nodes(turns, block))
    # all but conv follow from the node, so that a hash aggregate counts
    counted = rows.groupBy("depth", "x1", "x2", "p1", "p2", "s1", "s2", "path", "words").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), none.alias("p1"), none.alias("p2"), zero.alias("s1"), zero.alias("s2"), F.array().cast("array<binary>").alias("path"), zero.alias("words"), "n_convs", "conv_id")
    nodes = materialize(counted.unionByName(root))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"))
    held = nodes.select(*_NODE, ((F.col("n_convs") - 1) * F.col("words")).alias("saved")).join(kids, [*_NODE], "left").withColumn("n_children", F.coalesce("n_children", zero))
    held = materialize(held)
    starts = F.col("mark") == 0
    events = preorder(nodes, block).join(held.withColumn("mark", F.lit(0)), [*_NODE, "mark"], "left")
    sums = running(events, None, [F.col("r")], before=True, leaves=("sum", F.when(starts & (F.col("n_children") == 0), 1).otherwise(0).cast("long")), saving=("sum", F.when(starts, F.col("saved")).otherwise(0).cast("long")))
    over = lambda c: F.sum(F.when(starts, -F.coalesce(F.col(c), zero)).otherwise(F.col(c)))
    subtrees = sums.groupBy(*_NODE).agg(over("leaves").alias("n_leaves"), over("saving").alias("saved_tokens"))
    last = rows.groupBy("conv").agg(F.max(F.struct("depth", "x1", "x2")).alias("at"))
    ends = convs.join(last, "conv", "left").select("conv", *(F.coalesce(f"at.{c}", zero).alias(c) for c in _NODE))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.select(*_NODE, "p1", "p2", "n_convs", "conv_id").join(held.drop("saved"), [*_NODE]).join(subtrees, [*_NODE]).join(ends_digest(ends), [*_NODE], "left").join(parents, ["depth", "p1", "p2"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    convs = materialize(turns.select("conv").distinct())
    return prefix_trie(rebuilt_turns(turns, convs), convs)


_DIGEST = "md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))"
_CRC = "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch)::UBIGINT)), lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)"
#: The same result in DuckDB's SQL, from all prefixes of each conversation.
OP13_SQL = rf"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) AS i, {_DIGEST} AS k, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS words FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {_CRC} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM t)),
own AS (SELECT c.conv_id, 0 AS part, i, k, words FROM c JOIN t ON t.conv_id = c.base AND i <= h UNION ALL SELECT c.conv_id, 1, i, k, words FROM c JOIN t USING (conv_id) WHERE i > h),
r AS (SELECT conv_id, row_number() OVER w AS depth, list(k) OVER w AS path, words FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING)),
p AS (SELECT conv_id, depth, md5(array_to_string(path, ',')) AS node, CASE WHEN depth > 1 THEN md5(array_to_string(path[:-2], ',')) ELSE '' END AS parent, words FROM r
      UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
n AS (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT DISTINCT a.node, b.node AS part FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
held AS (SELECT below.node, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens FROM below JOIN n ON n.node = below.part LEFT JOIN kids ON kids.node = below.part GROUP BY below.node),
last AS (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id),
ends AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256 FROM last GROUP BY node)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN held USING (node) LEFT JOIN n up ON up.node = n.parent LEFT JOIN kids ON kids.node = n.node LEFT JOIN ends ON ends.node = n.node
"""

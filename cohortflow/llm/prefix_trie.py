"""Prefix trie of rebuilt conversations by van Emde Boas recursion.

Every sequence of turns is cut at half its depth, the halves again, down to single turns; one Spark
round does a whole level of the recursion for all subtrees at once, so the rounds grow with the
logarithm of the deepest conversation and no row ever holds a sequence.

* Blocks: aligned runs of 2**j turns of one conversation get a name, a digest of the names of their
  halves (`_blocks`).
* Cut: a segment is a root (the name of the prefix above it) and a block. Level by level it falls
  into its upper half under the same root and its lower half under a new root, named after the cut
  prefix. Equal segments of a root are one row with the number of conversations in it, so copies
  collapse before they are cut any further. Single turns at the end are the nodes (`_cut`).
* Graft: bottom-up, the sums of a lower forest are added to the block of the upper trie that it hangs
  from (`_forests`). Top-down through the levels, the sum below each cut node is its own forest plus
  what hangs from the ends of that forest's full segments (`_below`).

A conversation enters the recursion at its own level. All groupings are sums, minima or counts that
Spark aggregates before it shuffles, so a prefix that a third of all conversations share is one row
for each task. The turns of a conversation are numbered by a range partitioning, not in one task.
The digest of members is fed from chunks that the tasks of a range partitioning pack.

Edge cases: rows without conv_id belong to no conversation; null role or text is empty. Turns with
the same number are ordered by the digest of role and text; repeated rows are turns of their own. An
empty table has no root. Other columns are ignored. conv_id - conv_id % 5 truncates as in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm import common as C

#: Conversations in a group that share their first turns, and the number of lengths of that prefix.
GROUP, PREFIXES = 5, 9
#: Ids in a packed chunk of members.
CHUNK = 4096

_ROOT = "unhex('00000000000000000000000000000000')"
ORACLE = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda b, y: xor(b >> 1, 3988292384 * (b & 1)))) AS crc
  FROM (SELECT DISTINCT c FROM turns)),
heads AS (SELECT c, xor(crc, 4294967295) % {PREFIXES} AS h FROM convs),
rebuilt AS (
  SELECT v.c, 0 AS own, t.p, t.role, t.text FROM heads v JOIN turns t ON t.c = v.c - v.c % {GROUP} AND t.p <= v.h
  UNION ALL
  SELECT v.c, 1, t.p, t.role, t.text FROM heads v JOIN turns t ON t.c = v.c AND t.p > v.h),
placed AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d FROM rebuilt),
size AS (SELECT v.c, count(d) AS len FROM heads v LEFT JOIN placed p ON p.c = v.c GROUP BY v.c),
prefix AS (
  SELECT c, d, list(struct_pack(r := role, t := text)) OVER (PARTITION BY c ORDER BY d) AS path,
         octet_length(encode(text)) AS bytes FROM placed
  UNION ALL SELECT c, 0, [], 0 FROM heads),
members AS (SELECT c, d, bytes, min(c) OVER (PARTITION BY d, path) AS top FROM prefix),
nodes AS (
  SELECT top, d, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (s.len = d), '')) AS ends
  FROM members m JOIN size s ON s.c = m.c GROUP BY top, d),
parents AS (SELECT n.*, m.top AS parent FROM nodes n LEFT JOIN members m ON m.c = n.top AND m.d = n.d - 1),
kids AS (SELECT n.*, (SELECT count(*) FROM parents k WHERE k.parent = n.top AND k.d = n.d + 1) AS n_children FROM parents n),
totals AS (
  SELECT m.top, m.d, sum(k.saved) AS saved_tokens, count(*) FILTER (k.n_children = 0) AS n_leaves
  FROM kids k JOIN members m ON m.c = k.top AND m.d <= k.d GROUP BY m.top, m.d)
SELECT k.top AS conv_id, k.d AS depth, k.parent AS parent_conv_id, k.n_convs, k.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, k.ends AS ends_sha256
FROM kids k JOIN totals t ON t.top = k.top AND t.d = k.d
"""


def _name(*parts: str) -> str:
    """SQL of the 128-bit name of a list of binary expressions."""
    return f"unhex(substr(sha2(concat({', '.join(parts)}), 256), 1, 32))"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(c, p, name, bytes): the turns of each conversation, numbered from 1, without their texts."""
    role, text = "coalesce(role, '')", "coalesce(text, '')"
    turns = conversations.where("conv_id IS NOT NULL").selectExpr(
        "CAST(conv_id AS BIGINT) AS c", "turn",
        f"{_name(f'encode(concat(length({role}), {chr(39)}:{chr(39)}, {role}, {text}), {chr(39)}UTF-8{chr(39)})')} AS name",
        f"CAST(octet_length({text}) AS BIGINT) AS bytes", "monotonically_increasing_id() AS row")
    order = [F.asc("c"), F.asc_nulls_first("turn"), F.asc("name"), F.asc("row")]
    dealt = turns.repartitionByRange(C.partitions_for(conversations), *order).sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            c = b.column(0).to_numpy(zero_copy_only=False)
            if not len(c):
                continue
            new = np.concatenate([[True], c[1:] != c[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
            p = np.arange(len(c)) - start + 1
            if c[0] == last:
                p[: int(np.argmax(start > 0)) or len(c)] += seen
            last, seen = c[-1], int(p[-1])
            yield pa.RecordBatch.from_arrays([b.column(4), b.column(0), pa.array(p, pa.int64()), b.column(2), b.column(3)], names=["pid", "c", "p", "name", "bytes"])

    local = dealt.selectExpr("c", "turn", "name", "bytes", "spark_partition_id() AS pid")
    local = C.stored(local.mapInArrow(run, "pid int, c long, p long, name binary, bytes long"), "turns")
    # Only the first conversation of a partition can go on from an earlier one: one row a partition.
    ends = local.groupBy("pid").agg(F.min("c").alias("first"), F.max("c").alias("last")).join(
        local.groupBy("pid", "c").agg(F.count(F.lit(1)).alias("n")), "pid").where("c = first OR c = last")
    before = Window.partitionBy("c").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = ends.withColumn("shift", F.sum("n").over(before)).where("c = first AND shift > 0").select("pid", "c", "shift")
    return local.join(F.broadcast(shift), ["pid", "c"], "left").selectExpr("c", "p + coalesce(shift, 0) AS p", "name", "bytes")


def rebuilt_turns(turns: DataFrame, group: int = GROUP, prefixes: int = PREFIXES) -> tuple[DataFrame, DataFrame]:
    """The conversations (c, len) and their turns (c, b, name, bytes, len), b counting from 0."""
    h = f"crc32(encode(CAST(c AS STRING), 'UTF-8')) % {prefixes}"
    sizes = turns.groupBy("c").agg(F.max("p").alias("n"))
    convs = sizes.selectExpr("c", "n", f"c - c % {group} AS base", f"{h} AS h").join(
        sizes.selectExpr("c AS base", "n AS n_base"), "base", "left").selectExpr(
        "c", "h", "least(h, coalesce(n_base, 0)) AS k", "greatest(n - h, 0) AS own").selectExpr("c", "h", "h - k AS shift", "k + own AS len")
    convs = C.stored(convs, "convs")
    own = turns.where(f"p > {h}").join(convs.select("c", "shift", "len"), "c").selectExpr("c", "p - 1 - shift AS b", "name", "bytes", "len")
    around = f"filter(transform(sequence({1 - group}, {group - 1}), i -> c + i), x -> x - x % {group} = c)"
    heads = turns.where(f"c % {group} = 0 AND p < {prefixes}").selectExpr(f"explode({around}) AS c", "p", "name", "bytes")
    heads = heads.where(f"p <= {h}").join(convs.select("c", "len"), "c").selectExpr("c", "p - 1 AS b", "name", "bytes", "len")
    return convs.select("c", "len"), C.stored(own.union(heads), "blocks")


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each level the named blocks (c, b, name, len, left, right) of all conversations that long."""
    out = [turns.selectExpr("c", "b", "name", "len", "bytes")]
    for j in range(levels):
        halves = out[-1].where(f"len > {1 << j}").groupBy("c", F.expr("b DIV 2").alias("b")).agg(
            F.max(F.expr("IF(b % 2 = 0, name, NULL)")).alias("left"), F.max(F.expr("IF(b % 2 = 1, name, NULL)")).alias("right"), F.max("len").alias("len"))
        out.append(C.stored(halves.selectExpr("c", "b", f"{_name('left', 'coalesce(right, CAST(X{0} AS BINARY))'.format(chr(39) * 2))} AS name", "len", "left", "right"), "blocks"))
    return out


def _cut(blocks: list[DataFrame]) -> list[DataFrame]:
    """For each level the distinct segments (root, up, b, block, tail, n, c, full and halves or bytes).

    ``up`` is the root of the block of the upper trie that the root hangs from, ``tail`` the name of
    the last node of a full segment, ``c`` the smallest conversation in it, ``n`` how many.
    """
    out: list[DataFrame] = [None] * len(blocks)
    for j in range(len(blocks) - 1, -1, -1):
        rows = blocks[j].where(f"b = 0 AND len <= {1 << j}").selectExpr(
            f"{_ROOT} AS root", "CAST(NULL AS BINARY) AS up", "b", "name AS block", f"{_name(_ROOT, 'name')} AS tail", "1L AS n", "c")
        if j + 1 < len(blocks):
            above = out[j + 1]
            upper = above.selectExpr("root", "up", "2 * b AS b", "left AS block", f"{_name('root', 'left')} AS tail", "n", "c")
            lower = above.where("right IS NOT NULL").selectExpr(f"{_name('root', 'left')} AS root", "root AS up", "2 * b + 1 AS b", "right AS block", "tail", "n", "c")
            rows = rows.union(upper).union(lower)
        found = rows.groupBy("root", "block").agg(
            F.max("up").alias("up"), F.max("b").alias("b"), F.max("tail").alias("tail"), F.sum("n").alias("n"), F.min("c").alias("c"))
        of = ["bytes"] if j == 0 else ["left", "right"]
        out[j] = C.stored(found.join(blocks[j].select("c", "b", "len", *of), ["c", "b"]).selectExpr(
            "root", "up", "b", "tail", "n", "c", f"len >= (b + 1) * {1 << j} AS full", *of), "segments")
    return out


def _forests(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Sums over the forest below each root, within the block that the root opens: for each level the
    roots whose forest is a lower one there; and the sums below the root of the trie."""
    sums = [F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")]
    now = C.stored(nodes.groupBy("root").agg(F.max("up").alias("up"), F.max("b").alias("b"), *sums), "forests")
    out = []
    for _ in range(levels):
        out.append(now.where("b % 2 = 1").select("root", "saved", "leaves"))
        now = C.stored(now.selectExpr("IF(b % 2 = 1, up, root) AS root", "IF(b % 2 = 1, NULL, up) AS up", "b DIV 2 AS b", "saved", "leaves").groupBy("root").agg(
            F.max("up").alias("up"), F.max("b").alias("b"), *sums), "forests")
    return out, now.select("root", "saved", "leaves")


def _below(segments: list[DataFrame], forests: list[DataFrame], top: DataFrame) -> DataFrame:
    """(root, saved, leaves): the sums over all that hangs below each node that has children."""
    done = top
    for j in range(len(forests) - 1, -1, -1):
        tails = segments[j].where("b % 2 = 1 AND full").select("root", F.col("tail"))
        grafts = tails.join(done.withColumnRenamed("root", "tail"), "tail").select("root", "saved", "leaves")
        level = forests[j].union(grafts).groupBy("root").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        done = done.union(C.stored(level, "grafts"))
    return done


def _ends(convs: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end."""
    parts = convs.where("len = 0").selectExpr("c", "CAST(NULL AS STRUCT<j: INT, name: BINARY>) AS part")
    for j, level in enumerate(blocks):  # the blocks that make up the whole sequence, by the bits of its length
        parts = parts.union(level.where(f"(len >> {j}) % 2 = 1 AND b = (len >> {j}) - 1").selectExpr("c", f"named_struct('j', {-j}, 'name', name) AS part"))
    fold = _name("x", "y.name")
    last = parts.groupBy("c").agg(F.array_sort(F.collect_list("part")).alias("parts")).selectExpr("c", f"aggregate(parts, {_ROOT}, (x, y) -> {fold}) AS node")
    last = last.repartitionByRange(C.partitions_for(convs), "node", "c").sortWithinPartitions("node", "c")

    def runs(nodes: pa.Array) -> list[int]:
        x = nodes.to_pylist()
        return [i for i in range(len(x)) if i == 0 or x[i] != x[i - 1]] + [len(x)]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, cuts = pc.cast(b.column(0), pa.string()), runs(b.column(1))
            spans = [(i, min(i + CHUNK, z)) for a, z in zip(cuts, cuts[1:]) for i in range(a, z, CHUNK)]
            at = [a for a, _ in spans]
            yield pa.RecordBatch.from_arrays([b.column(1).take(pa.array(at, pa.int64())), b.column(0).take(pa.array(at, pa.int64())), pa.array([",".join(ids[a:z].to_pylist()) for a, z in spans], pa.string())], names=["node", "c", "ids"])

    chunks = last.mapInArrow(pack, "node binary, c long, ids string")
    chunks = chunks.repartition(C.partitions_for(convs), "node").sortWithinPartitions("node", "c")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = lambda node, sha: pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(sha, pa.string())], names=["node", "ends_sha256"])
        node, sha = None, None
        for b in batches:
            out: tuple[list, list] = ([], [])
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k == node:
                    sha.update(b"," + ids.encode())
                    continue
                if sha:
                    out[0].append(node)
                    out[1].append(sha.hexdigest())
                node, sha = k, hashlib.sha256(ids.encode())
            yield row(*out)
        if sha:
            yield row([node], [sha.hexdigest()])

    return chunks.mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = GROUP, prefixes: int = PREFIXES) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations (see `op11_prefix_trie`)."""
    convs, turns = rebuilt_turns(numbered_turns(conversations), group, prefixes)
    deepest = convs.agg(F.max("len")).first()[0] or 0
    levels = max(0, deepest - 1).bit_length()
    blocks = _blocks(turns, levels)
    segments = _cut(blocks)
    kids = C.stored(segments[0].groupBy("root").agg(F.count(F.lit(1)).alias("n_children")), "children")
    nodes = C.stored(segments[0].join(kids.withColumnRenamed("root", "tail"), "tail", "left").selectExpr(
        "root", "up", "b", "tail AS node", "c", "n", "coalesce(n_children, 0L) AS n_children", "(n - 1) * bytes AS saved", "IF(n_children IS NULL, 1L, 0L) AS leaves"), "nodes")
    forests, top = _forests(nodes, levels)
    below = _below(segments, forests, top)
    root = convs.agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n")).where("n > 0").selectExpr(
        "CAST(NULL AS BINARY) AS root", f"{_ROOT} AS node", "c", "0L AS depth", "n").join(
        kids.where(f"root = {_ROOT}").selectExpr("root AS node", "n_children"), "node", "left").selectExpr(
        "root", "node", "c", "depth", "n", "coalesce(n_children, 0L) AS n_children", "0L AS saved", "IF(n_children IS NULL, 1L, 0L) AS leaves")
    every = nodes.selectExpr("root", "node", "c", "b + 1 AS depth", "n", "n_children", "saved", "leaves").union(root)
    parents = every.where("n_children > 0").selectExpr("node AS root", "c AS parent_conv_id")
    return every.join(below.selectExpr("root AS node", "saved AS more_saved", "leaves AS more_leaves"), "node", "left") \
        .join(parents, "root", "left").join(_ends(convs, blocks), "node", "left").selectExpr(
        "c AS conv_id", "depth", "parent_conv_id", "n AS n_convs", "n_children", "leaves + coalesce(more_leaves, 0L) AS n_leaves",
        "saved + coalesce(more_saved, 0L) AS saved_tokens", f"coalesce(ends_sha256, '{hashlib.sha256().hexdigest()}') AS ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``: one row a node, with its smallest member as conv_id."""
    return prefix_trie(C.table(spark, sf_dir, "conversations"))

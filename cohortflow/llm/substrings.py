"""Removal of word sequences that a document with a smaller id has too.

A window is ``WINDOW`` consecutive words. A word goes if it lies in a window that also starts in a
document with a smaller id. The suffixes of all texts (by word) are split into groups by a prefix of
variable length, and each group's truncated suffix tree tells which windows documents share:

0. A text that a smaller id has word for word loses all of its windows; only the smallest id of equal
   texts (equal 128-bit hashes) goes on.
1. Each window has an anchor, the ``PREFIX``-word run in it with the least hash; equal windows have
   equal anchors, and about a fifth of all places are anchors. A first exchange of packed anchor
   hashes finds those that occur in two documents. Suffixes whose anchor occurs in one document
   only share no window with another one and go no further.
2. The surviving suffixes that share an anchor are neighbours and travel as one segment of text,
   under the anchor as prefix. Prefixes with at most ``GROUP`` segments are dealt to tasks, which
   read them in order and sort the suffixes of whole groups by prefix doubling up to depth
   ``WINDOW``: places of equal rank are the leaves under one internal node of that depth, a repeat,
   and the node's smallest id decides for all of its leaves.
3. A larger prefix - a passage that is in a third of all documents, say - first has its equal segments
   merged, summed up before they are shuffled. If at most ``GROUP`` different ones are left, they make
   one group as in 2. Else the prefix is lengthened until at most ``GROUP`` segments share it: first
   by half of the other words of a window, those before or those behind the anchor, which cuts a
   segment in two; where that is not enough, its windows are taken as suffixes of their own with
   prefixes of ``LENGTHS`` words. Each group that fits gets its tree. What is left are single nodes
   of full depth with more leaves than a task shall hold; the smallest id of such a node is an
   aggregate.
   Sets of large prefixes, nodes and segments are broadcast: above ``LARGE`` * ``GROUP`` rows
   ``GROUP`` grows with their number, so each has at most ``LARGE`` members of a few numbers.
   The nodes of a segment with more than ``GROUP`` rows are replicated, one copy for each ``GROUP``
   rows, so the rows that meet them spread.
4. The windows to remove meet their documents in a join on id and text hash.

Edge cases: null is the empty text. Documents without id take no part: they keep all words and take
none from others. Rows that repeat an id are one document: they don't remove each other's words
(an identical or other text under the same id is not smaller). Texts under ``WINDOW`` words have no
window. Kept words are joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common as C

WINDOW, PREFIX, GROUP, LARGE, CHUNK_SEGMENTS = 13, 5, 2000, 1 << 20, 50_000
LENGTHS, BEFORE = (9, 11, WINDOW), (WINDOW - PREFIX) // 2
FIELDS = {"n_words": "long", "n_removed": "long", "kept_text": "string"}


def anchors(h: np.ndarray, first: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie in one document, the place of each one's anchor, and the prefix hashes."""
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, C.U64)
    g = C.grams(h, prefix)
    n = len(h) - window + 1
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - prefix + 1):
        less = g[j: j + n] < best
        best[less] = g[j: j + n][less]
        at[less] = j
    win = np.flatnonzero(C.inside(first, window))
    return win, win + at[win], g


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary array of the bytes of values[cuts[i]:cuts[i + 1]]."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _by_group(group: np.ndarray, n: int, *values: np.ndarray) -> list[pa.Array]:
    o = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[o], np.arange(n + 1))
    return [_binary(v[o], cuts) for v in values]


def anchor_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, single, single_doc, several, known, known_doc) for each slice of documents:
    hashes found in one document of the slice, in several, and the latter with each document."""
    names = ["part", "single", "single_doc", "several", "known", "known_doc"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 1):
                w = C.Words(C.as_bytes(part.column(1)))
                _, at, g = anchors(w.hashes(), w.first)
                at = np.unique(at)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                h, doc = g[at], ids[w.doc[at]]
                o = np.lexsort((doc, h))
                h, doc = h[o], doc[o]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, doc = h[new], doc[new]
                begin = np.ones(len(h), bool)
                begin[1:] = h[1:] != h[:-1]
                size = np.diff(np.append(np.flatnonzero(begin), len(h)))
                many = np.repeat(size > 1, size)
                of = lambda x: ((x >> C.U64(20)) % C.U64(parts)).astype(np.int64)
                s, sd = _by_group(of(h[~many]), parts, h[~many], doc[~many])
                (v,) = _by_group(of(h[many & begin]), parts, h[many & begin])
                k, kd = _by_group(of(C.mix(doc[many].astype(C.U64))), parts, h[many], doc[many])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), s, sd, v, k, kd], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "part int, single binary, single_doc binary, several binary, known binary, known_doc binary")


def shared_anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, hashes): of each document the anchors that another document has too."""
    def run(table: pa.Table) -> pa.Table:
        get = lambda c, t: np.frombuffer(b"".join(x for x in table[c].to_pylist()), t)
        h, doc, several = get("single", C.U64), get("single_doc", np.int64), np.unique(get("several", C.U64))
        o = np.lexsort((doc, h))
        h, doc = h[o], doc[o]
        begin = np.ones(len(h), bool)
        begin[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(begin)
        group = np.cumsum(begin) - 1
        last = np.append(at[1:], len(h)) - 1
        shared = (doc[at] != doc[last])[group] if len(h) else np.zeros(0, bool)
        if len(several) and len(h):
            p = np.minimum(np.searchsorted(several, h), len(several) - 1)
            shared |= several[p] == h
        h, doc = np.concatenate([h[shared], get("known", C.U64)]), np.concatenate([doc[shared], get("known_doc", np.int64)])
        o = np.argsort(doc, kind="stable")
        h, doc = h[o], doc[o]
        ids, cut = np.unique(doc, return_index=True)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "hashes": _binary(h, np.append(cut, len(doc)))})

    blocks = anchor_blocks(docs, C.partitions_for(docs))
    return blocks.groupBy("part").applyInArrow(run, "doc_id long, hashes binary").groupBy("doc_id").agg(F.collect_list("hashes").alias("hashes"))


def segments(docs: DataFrame, first: DataFrame) -> DataFrame:
    """(doc_id, text_hash, starts, prefix, content): neighbouring windows under a shared anchor, once
    for each document however often they occur in it; of equal texts only the ``first`` ids."""
    names = ["doc_id", "text_hash", "starts", "prefix", "content"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2):
                w = C.Words(C.as_bytes(part.column(2)))
                h = w.hashes()
                win, at, g = anchors(h, w.first)
                lists = [b"".join(x or ()) for x in part.column(3).to_pylist()]
                have = np.frombuffer(b"".join(lists), C.U64)
                owner = np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists])
                tag = lambda d, h: C.mix(h ^ C.mix(d.astype(C.U64)))
                keep = np.isin(tag(w.doc[win], g[at]), tag(owner, have))
                win, at = win[keep], at[keep]
                if not len(win):
                    continue
                begin = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (win[1:] != win[:-1] + 1)]))
                n = np.diff(np.append(begin, len(win)))
                win, at = win[begin], at[begin]
                # the first and the last window of a segment overlap, so they tell its whole content
                whole = C.grams(h, WINDOW)
                same = tag(w.doc[win], C.mix(whole[win] * C.U64(3) + whole[win + n - 1]))
                _, first, group = np.unique(same, return_index=True, return_inverse=True)
                order = np.argsort(group, kind="stable")
                cuts = np.concatenate([[0], np.cumsum(np.bincount(group))])
                starts = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array((win - w.first[w.doc[win]])[order], pa.int32()))
                win, at, n = win[first], at[first], n[first]
                doc = w.doc[win]
                a, b = w.start[win], w.end[win + n + WINDOW - 2]
                # one space between words everywhere: the bytes can be taken as they are
                gap = np.concatenate([[0], np.cumsum((w.start[1:] - w.end[:-1] != 1) | (w.buf[w.end[:-1]] != 32))])
                plain = gap[win + n + WINDOW - 2] == gap[win]
                raw, content = w.raw, []
                for x, y, p in zip(a.tolist(), b.tolist(), plain.tolist()):
                    content.append(raw[x:y] if p else b" ".join(raw[x:y].split()))
                cols = [part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), starts, pa.array(g[at].view(np.int64)), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    shared = shared_anchors(docs).join(first, "doc_id")
    both = docs.join(shared, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "hashes")
    return both.mapInArrow(run, "doc_id long, text_hash long, starts array<int>, prefix long, content binary")


def shifted(starts: pa.Array, row: np.ndarray, by: np.ndarray) -> pa.ListArray:
    """For each pair of a row and a number the row's starts, moved by the number."""
    size = starts.value_lengths().to_numpy()
    first, n = np.cumsum(size) - size, size[row]
    place = np.repeat(first[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    values = starts.flatten().to_numpy()[place] + np.repeat(by, n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values, pa.int32()))


def whole_groups(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows in tables of about ``CHUNK_SEGMENTS`` rows that end where the value of ``column`` does."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_SEGMENTS:  # hand over all but the last group, which may go on
            table = pa.Table.from_batches(held)
            value = table[column].to_numpy()
            cut = int(np.flatnonzero(value != value[-1])[-1]) + 1 if value[0] != value[-1] else 0
            if cut:
                yield table.slice(0, cut)
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def frequent(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(key, n_rows) of the keys with more than ``most`` rows."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > most)


def half_segments(distinct: DataFrame) -> DataFrame:
    """(doc_id, prefix, segment, place, content, half): distinct segments cut into the windows that hold
    at least ``BEFORE`` words before their anchor and the others; ``half`` is the hash of the anchor
    with those words, or with those that the others have behind it. ``place`` is the number of the
    first window in the segment."""
    names = ["doc_id", "prefix", "segment", "place", "content", "half"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 4):
                w = C.Words(part.column(4).to_pylist())
                h = w.hashes()
                win, at, _ = anchors(h, w.first)
                early = at - win >= BEFORE
                row = w.doc[win]
                begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (early[1:] != early[:-1])]))
                last = win[np.append(begin[1:], len(win)) - 1] + WINDOW - 1
                win, at, early, row = win[begin], at[begin], early[begin], row[begin]
                before, behind = C.grams(h, PREFIX + BEFORE), C.grams(h, WINDOW - BEFORE + 1)
                half = np.where(early, before[np.where(early, at - BEFORE, 0)], behind[np.where(early, 0, at)])
                content = [w.raw[x:y] for x, y in zip(w.start[win].tolist(), w.end[last].tolist())]
                same = [part.column(i).take(pa.array(row)) for i in range(3)]
                place = part.column(3).to_numpy()[row] + win - w.first[row]
                yield pa.RecordBatch.from_arrays([*same, pa.array(place, pa.int32()), pa.array(content, pa.binary()), pa.array(half.view(np.int64))], names=names)

    rows = distinct.select("doc_id", "prefix", "segment", "place", "content")
    return rows.mapInArrow(run, "doc_id long, prefix long, segment long, place int, content binary, half long")


def single_windows(distinct: DataFrame) -> DataFrame:
    """(doc_id, prefix, segment, place, content, p9, ...): parts of segments split into their windows;
    ``place`` is a window's number in the segment, ``p9`` the hash of its first nine words."""
    names = ["doc_id", "prefix", "segment", "place", "content", *[f"p{n}" for n in LENGTHS]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 4, C.SLICE_BYTES // 4):
                w = C.Words(part.column(4).to_pylist())
                h, at = w.hashes(), np.flatnonzero(C.inside(w.first, WINDOW))
                row = w.doc[at]
                content = [w.raw[x:y] for x, y in zip(w.start[at].tolist(), w.end[at + WINDOW - 1].tolist())]
                same = [part.column(i).take(pa.array(row)) for i in range(3)]
                place = part.column(3).to_numpy()[row] + at - w.first[row]
                prefixes = [pa.array(C.grams(h, n)[at].view(np.int64)) for n in LENGTHS]
                yield pa.RecordBatch.from_arrays([*same, pa.array(place, pa.int32()), pa.array(content, pa.binary()), *prefixes], names=names)

    rows = distinct.select("doc_id", "prefix", "segment", "place", "content")
    return rows.mapInArrow(run, "doc_id long, prefix long, segment long, place int, content binary, " + ", ".join(f"p{n} long" for n in LENGTHS))


def lengthened(windows: DataFrame, most: int) -> DataFrame:
    """``windows`` with ``length`` and ``key``, the words and hash of the shortest prefix that at most
    ``most`` windows share; both are null where more share the whole window."""
    out = windows
    for n in LENGTHS:
        large = frequent(windows, f"p{n}", most).select(f"p{n}", F.lit(True).alias(f"large{n}"))
        out = out.join(F.broadcast(large), f"p{n}", "left")
    shortest = lambda value: F.coalesce(*[F.when(F.col(f"large{n}").isNull(), value(n)) for n in LENGTHS])
    return out.select(*windows.columns, shortest(F.lit).alias("length"), shortest(lambda n: F.col(f"p{n}")).alias("key"))


def tree_nodes(rows: DataFrame, *key: str) -> DataFrame:
    """(prefix, segment, place, least): the smallest id under the node of each window of ``rows``, from
    the trees of the groups of equal ``key``."""
    names = ["prefix", "segment", "place", "least"]

    def tree(rows: pa.Table) -> pa.RecordBatch:
        least, n = node_minima(rows["content"].to_pylist(), rows["doc_id"].to_numpy())
        row = np.repeat(np.arange(len(n)), n)
        place = rows["place"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return pa.RecordBatch.from_arrays([pa.array(rows["prefix"].to_numpy()[row]), pa.array(rows["segment"].to_numpy()[row]), pa.array(place, pa.int32()), pa.array(least)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(tree, whole_groups(batches, "group"))

    named = rows.select(F.xxhash64(*key).alias("group"), "doc_id", "prefix", "segment", "place", "content")
    dealt = named.repartition(C.partitions_for(rows), "group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "prefix long, segment long, place int, least long")


def removed_under_large(found: DataFrame, group: int) -> DataFrame:
    """(doc_id, text_hash, starts): as `removed_by_trees`, for segments under large prefixes."""
    found = found.withColumn("segment", F.xxhash64("content"))
    distinct = C.stored(found.groupBy("prefix", "segment", "content").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_rows")), "distinct")
    longer = frequent(distinct, "prefix", group).select("prefix", F.lit(True).alias("longer"))
    flagged = distinct.withColumn("place", F.lit(0)).join(F.broadcast(longer), "prefix", "left")
    nodes = tree_nodes(flagged.where("longer IS NULL"), "prefix")
    halves = C.stored(half_segments(flagged.where("longer")), "halves")
    wide = frequent(halves, "half", max(group, halves.count() // LARGE)).select("half", F.lit(True).alias("wide"))
    halves = halves.join(F.broadcast(wide), "half", "left")
    nodes = nodes.union(tree_nodes(halves.where("wide IS NULL"), "half"))
    windows = C.stored(single_windows(halves.where("wide")), "windows")
    n_windows = windows.count()
    if n_windows:
        most, whole = max(group, n_windows // LARGE), f"p{WINDOW}"
        keyed = lengthened(windows, most)
        nodes = nodes.union(tree_nodes(keyed.where("key IS NOT NULL"), "length", "key"))
        single = keyed.where("key IS NULL").select("doc_id", "prefix", "segment", "place", whole, F.xxhash64("content").alias("content_hash"))
        least = single.groupBy(whole, "content_hash").agg(F.min("doc_id").alias("least"))
        nodes = nodes.union(single.join(F.broadcast(least), [whole, "content_hash"]).select("prefix", "segment", "place", "least"))
    nodes = nodes.groupBy("prefix", "segment").agg(F.collect_list(F.struct("place", "least")).alias("nodes"))  # one segment's windows
    hot = F.broadcast(distinct.where(F.col("n_rows") > group).select("prefix", "segment", F.ceil(F.col("n_rows") / group).alias("copies")))
    copies = F.coalesce("copies", F.lit(1).cast("long"))
    nodes = nodes.join(hot, ["prefix", "segment"], "left").select("prefix", "segment", "nodes", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"))
    dealt = found.join(hot, ["prefix", "segment"], "left").select("doc_id", "text_hash", "starts", "prefix", "segment", F.pmod(F.xxhash64("doc_id", "text_hash"), copies).alias("copy"))
    hit = dealt.join(nodes, ["prefix", "segment", "copy"]).where(F.exists("nodes", lambda x: x["least"] < F.col("doc_id")))
    starts = F.expr("flatten(transform(filter(nodes, x -> x.least < doc_id), x -> transform(starts, s -> s + x.place)))")
    return hit.select("doc_id", "text_hash", starts.alias("starts"))


def node_minima(contents: list[bytes], least: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The truncated suffix tree of some segments: for each window of each segment the smallest id
    under its node, all in a row, and the number of windows of each segment."""
    w = C.Words(contents)
    rank = np.unique(w.hashes(), return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < window:  # ranks of twice the depth, at last overlapping
        step = min(depth, window - depth)
        n = len(rank) - step
        rank = np.unique(rank[:n] * np.int64(len(w.start) + 1) + rank[step:], return_inverse=True)[1].astype(np.int64)
        depth += step
    at = np.flatnonzero(C.inside(w.first, window))
    rank, ids = rank[at], least[w.doc[at]]
    out = np.full(int(rank.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(out, rank, ids)
    return out[rank], np.bincount(w.doc[at], minlength=len(contents))


def removed_by_trees(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, starts): the windows of each segment under a node with a smaller id."""
    names = ["doc_id", "text_hash", "starts"]

    def tree(rows: pa.Table) -> pa.RecordBatch:
        doc = rows["doc_id"].to_numpy()
        least, n = node_minima(rows["content"].to_pylist(), doc)
        row = np.repeat(np.arange(len(doc)), n)
        gone = np.flatnonzero(least < doc[row])
        offset = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))[gone]
        row = row[gone]
        lists = shifted(rows["starts"].combine_chunks(), row, offset)
        some, first = np.unique(row, return_index=True)  # the lists of a segment as one
        cuts = lists.offsets.to_numpy()[np.append(first, len(row))]
        return pa.RecordBatch.from_arrays([pa.array(doc[some]), pa.array(rows["text_hash"].to_numpy()[some]), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), lists.values)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(tree, whole_groups(batches, "prefix"))

    grouped = found.select("doc_id", "text_hash", "starts", "prefix", "content").repartition(C.partitions_for(found), "prefix").sortWithinPartitions("prefix")
    return grouped.mapInArrow(run, "doc_id long, text_hash long, starts array<int>")


def removed_windows(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, text_hash, copied, starts): texts that a smaller id has too (``copied``), and else
    the windows that a document with a smaller id has too."""
    spark = docs.sparkSession
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    named = docs.select("doc_id", "text_hash", F.xxhash64(F.lit("second"), "text").alias("second_hash")).distinct()
    first = C.stored(named.groupBy("text_hash", "second_hash").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text_hash"), "first")
    copies = named.select("doc_id", "text_hash").join(first, ["doc_id", "text_hash"], "left_anti")
    found = C.stored(segments(docs, first), "segments")
    C.free_shuffles(spark)
    group = max(group, found.count() // LARGE)
    large = frequent(found, "prefix", group).select("prefix", F.lit(True).alias("large"))
    flagged = found.join(F.broadcast(large), "prefix", "left")
    gone = removed_by_trees(flagged.where("large IS NULL")).union(removed_under_large(flagged.where("large"), group))
    gone = gone.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    whole = copies.select("doc_id", "text_hash", F.lit(True).alias("copied"), F.expr("CAST(array() AS array<int>)").alias("starts"))
    out = C.stored(gone.select("doc_id", "text_hash", F.lit(False).alias("copied"), "starts").union(whole), "removed")
    C.free_shuffles(spark)
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
                    group: int = GROUP) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_words``, ``n_removed``, ``kept_sha256`` and, on
    request, ``kept_text``."""
    rest = [c for c in docs.columns if c not in (text_col, *FIELDS, "kept_sha256")]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"), row.alias("row"))
    removed = removed_windows(rows.select("doc_id", "text_hash", "text"), group)
    joined = rows.join(removed, ["doc_id", "text_hash"], "left").select("row", "text", "starts", "copied")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 1):
                w = C.Words(C.as_bytes(part.column(1)))
                lists = part.column(2)
                n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(w.first[:-1], n)
                delta = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(delta, at, 1)
                np.add.at(delta, at + WINDOW, -1)
                copied = part.column(3).fill_null(False).to_numpy(zero_copy_only=False) & (np.diff(w.first) >= WINDOW)
                keep = (np.cumsum(delta[:-1]) == 0) & ~copied[w.doc]
                left = np.concatenate([[0], np.cumsum(keep)])
                texts = []
                for d, (a, b) in enumerate(zip(w.first.tolist(), w.first[1:].tolist())):
                    words = w.raw[w.at[d]: w.at[d + 1] - 1].split()
                    if left[b] - left[a] < b - a:
                        words = [x for x, k in zip(words, keep[a:b].tolist()) if k]
                    texts.append(b" ".join(words))
                total = np.diff(w.first)
                cols = [part.column(0), pa.array(total, pa.int64()), pa.array(total - np.diff(left[w.first]), pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                yield pa.RecordBatch.from_arrays([*cols, *([pa.array([t.decode() for t in texts], pa.string())] if with_text else [])], names=names)

    names = ["row", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]
    schema = joined.select("row", *[F.lit(0).cast("long").alias(c) for c in names[1:3]], *[F.lit("").alias(c) for c in names[3:]]).schema
    return joined.mapInArrow(run, schema).select(*[F.col("row")[c].alias(c) for c in rest], *names[1:])


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(C.table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)

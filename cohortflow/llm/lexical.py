"""Exact ranked lexical search: accumulators of short lists, then documents at a time over long ones.

* Index: each task turns its documents into blocks of postings of the query terms (term, document,
  occurrences), stored in the shared folder; the texts are read once for each set of queries.
* Statistics: documents, terms and document frequencies are summed over all blocks.
* A term's list is *short* below ``SHORT`` of the documents. For every block and query the short
  lists are summed term at a time into accumulators. The k-th best accumulator of all blocks is a
  lower bound of the query's k-th best score.
* Then the accumulators count as one iterator, bounded by their maximum, beside the long lists, each
  bounded by its maximum in the block. Iterators whose bounds together stay below the bound of the
  k-th score cannot bring a document in: the others name the candidates, range by range in document
  order, and the rest are only probed at candidates that can still get in. The bound rises as better
  documents are found.
* The best k of the blocks meet in a window over the query, cut to k before the shuffle.

Queries are handled in sets of about ``TERMS`` pairs of query and term, however many there are; only
such a set, its frequencies and its bounds are broadcast. A query's rows are never in one task.

Edge cases: null text has no terms. Items without id or without terms have no result; the rows of a
repeated item are one query. Rows without doc_id count in the statistics and are no results; a
repeated document is ranked once for each row. Equal scores go by ascending doc_id. Other columns
are ignored. Terms are found by hash and then compared byte by byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm import common as C

#: Share of the documents up to which a list is short; pairs of query and term handled at once;
#: postings in a block; documents in a range.
SHORT, TERMS, POSTINGS, RANGE = 1 / 16, 1 << 20, 1 << 18, 2048

_TERM = np.ones(256, bool)
_TERM[:128] = [chr(i).isalnum() for i in range(128)]
_BLOCK = "ids binary, named binary, n binary, terms binary, first binary, at binary, tf binary"

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SQL_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH docs AS (SELECT doc_id, {_SQL_TERMS} AS terms FROM documents),
numbered AS (SELECT *, row_number() OVER () AS row, len(terms) AS n FROM docs WHERE len(terms) > 0),
stats AS (SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM numbered),
query AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
words AS (SELECT row, doc_id, n, unnest(terms) AS term FROM numbered),
postings AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM words
  WHERE term IN (SELECT term FROM query) GROUP BY row, term),
frequency AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM frequency, stats),
part AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * all_docs) // all_terms))) AS score
  FROM postings JOIN weight USING (term), stats),
scored AS (
  SELECT item_id, doc_id, CAST(sum(score) AS BIGINT) AS score FROM query JOIN part USING (term)
  WHERE doc_id IS NOT NULL GROUP BY item_id, row, doc_id HAVING sum(score) > 0),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def term_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, starts and ends of their terms, and each term's text."""
    buf = C._LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = _TERM[buf]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return buf, start, end, np.searchsorted(at, start, "right") - 1


class Vocabulary:
    """Numbers of the distinct terms of a set of queries: a term's place in the list given."""

    def __init__(self, terms: list[bytes]) -> None:
        buf, start, end, at = term_spans(terms)
        assert np.array_equal(at, np.arange(len(terms))), "terms only"
        hashes = C.span_hashes(buf, start, end)
        order = np.argsort(hashes, kind="stable")
        self.buf, self.start, self.size, self.number, self.hashes = buf, start[order], (end - start)[order], order, hashes[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two query terms have the same 64-bit hash; split the queries")

    def find(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are terms of the vocabulary, and their numbers."""
        none = np.zeros(0, np.int64)
        if not len(self.hashes) or not len(start):
            return none, none
        h = C.span_hashes(buf, start, end)
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[i] == h) & (self.size[i] == end - start))
        i = i[hit]
        size = self.size[i]
        if len(hit):  # equal hashes: compare the bytes
            first = np.cumsum(size) - size
            step = np.arange(int(size.sum())) - np.repeat(first, size)
            same = np.logical_and.reduceat(buf[np.repeat(start[hit], size) + step] == self.buf[np.repeat(self.start[i], size) + step], first)
            hit, i = hit[same], i[same]
        return hit, self.number[i]


def index_blocks(documents: DataFrame, vocabulary, postings: int = POSTINGS) -> DataFrame:
    """Blocks of postings of the terms in the broadcast vocabulary; ``n`` has every document that
    holds a term of any kind."""
    def block(parts: list[tuple]) -> pa.RecordBatch:
        sizes = np.cumsum([0, *(len(x[0]) for x in parts)])
        ids, named, n, tf = (np.concatenate([x[k] for x in parts]) for k in (0, 1, 2, 5))
        term, at = np.concatenate([x[3] for x in parts]), np.concatenate([x[4] + s for x, s in zip(parts, sizes)])
        o = np.argsort(term, kind="stable")  # documents ascend in each list
        terms, first = np.unique(term[o], return_index=True)
        out = (ids, named, n, terms.astype(np.int32), np.append(first, len(o)).astype(np.int64), at[o].astype(np.int32), tf[o].astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in out], names=[x.split()[0] for x in _BLOCK.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(vocabulary.value)
        held, count = [], 0
        for batch in batches:
            for part in C.slices(batch, 1):
                buf, start, end, doc = term_spans(C.as_bytes(part.column(1)))
                n = np.bincount(doc, minlength=part.num_rows)
                some = np.flatnonzero(n)
                hit, term = words.find(buf, start, end)
                place = np.cumsum(n > 0) - 1
                key, tf = np.unique(place[doc[hit]] * len(words.hashes) + term, return_counts=True)
                ids = part.column(0).take(pa.array(some, pa.int64()))
                held.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False), n[some].astype(np.int64),
                             key % max(1, len(words.hashes)), key // max(1, len(words.hashes)), tf))
                count += len(key) + len(some)
                if count >= postings:
                    yield block(held)
                    held, count = [], 0
        if count:
            yield block(held)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _BLOCK)


class Block:
    """A block of postings with what each adds to a score."""

    def __init__(self, row: dict, weights: np.ndarray, all_docs: int, all_terms: int) -> None:
        named, n = np.frombuffer(row["named"], bool), np.frombuffer(row["n"], np.int64)
        self.ids, at, tf = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["at"], np.int32), np.frombuffer(row["tf"], np.int64)
        terms, self.first, self.at = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["first"], np.int64), at
        sizes, back = np.unique(n, return_inverse=True)
        m = np.array([50 + 50 * int(x) * all_docs // all_terms for x in sizes], np.int64)[back]
        w = np.repeat(weights[terms], np.diff(self.first))
        self.adds = np.where(named[at], w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[at])), 0)
        self.most = np.maximum.reduceat(self.adds, self.first[:-1]) if len(terms) else self.adds
        self.place = np.full(len(weights), -1, np.int64)
        self.place[terms] = np.arange(len(terms))

    def lists(self, terms: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(bound, documents, what they get) of each of the terms that the block has."""
        i = self.place[terms]
        return [(int(self.most[k]), self.at[self.first[k]: self.first[k + 1]], self.adds[self.first[k]: self.first[k + 1]]) for k in i[i >= 0]]

    def accumulators(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold one of the terms, and their sums: term at a time."""
        total = np.zeros(len(self.ids), np.int64)
        for _, docs, adds in self.lists(terms):
            total[docs] += adds
        docs = np.flatnonzero(total)
        return docs, total[docs]

    def best(self, short: np.ndarray, long: np.ndarray, low: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k documents with a score of ``low`` or more: document at a time."""
        docs, sums = self.accumulators(short)
        iterators = sorted([*([(int(sums.max()), docs, sums)] if len(docs) else []), *self.lists(long)], key=lambda x: x[0])
        reach = np.cumsum([x[0] for x in iterators])
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, len(self.ids), RANGE):
            probed = int(np.searchsorted(reach, low))
            if probed == len(iterators):
                break
            total = np.zeros(min(RANGE, len(self.ids) - a), np.int64)
            for _, docs, adds in iterators[probed:]:
                i, j = np.searchsorted(docs, (a, a + RANGE))
                total[docs[i:j] - a] += adds[i:j]
            found = np.flatnonzero(total)
            score = total[found]
            for i in range(probed - 1, -1, -1):
                ok = score + reach[i] >= low
                found, score = found[ok], score[ok]
                if not len(found):
                    break
                _, docs, adds = iterators[i]
                j = np.minimum(np.searchsorted(docs, found + a), len(docs) - 1)
                hit = docs[j] == found + a
                score[hit] += adds[j[hit]]
            ok = score >= low
            ids, scores = np.concatenate([ids, self.ids[a + found[ok]]]), np.concatenate([scores, score[ok]])
            if len(ids) >= k:
                o = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[o], scores[o]
                low = max(low, int(scores[-1]))
        return ids, scores


def _of_block(blocks: DataFrame, setting, found, schema: str) -> DataFrame:
    """Rows (query, ...) that ``found(block, query number, setting)`` gives for each block and query."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = setting.value
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}, s["weights"], s["docs"], s["terms"])
                rows = [(s["ids"][q], found(block, q, s)) for q in range(len(s["ids"]))]
                columns = list(zip(*(x for _, x in rows)))
                ids = np.repeat(np.array([q for q, _ in rows], np.int64), [len(x[0]) for _, x in rows])
                yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(np.concatenate(c)) for c in columns)], names=names)

    return blocks.mapInArrow(run, schema)


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of a frame with item_id and text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 1):
                buf, start, end, at = term_spans(C.as_bytes(part.column(1)))
                raw = buf.tobytes()
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array([raw[a:b] for a, b in zip(start.tolist(), end.tolist())], pa.binary())], names=["item_id", "term"])

    return items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "item_id long, term binary").distinct()


def _candidates(documents: DataFrame, pairs: pa.Table, k: int, short: float, postings: int) -> DataFrame:
    """(item_id, doc_id, score) rows among which are the best k of each item of the set."""
    spark = documents.sparkSession
    if not pairs.num_rows:
        return spark.createDataFrame([], "item_id long, doc_id long, score long")
    cast = spark.sparkContext.broadcast
    words = pairs["term"].combine_chunks().dictionary_encode()
    items, of = np.unique(pairs["item_id"].to_numpy(), return_inverse=True)
    vocabulary = words.dictionary.to_pylist()
    blocks = C.stored(index_blocks(documents, cast(vocabulary), postings), "postings")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, terms, first = (np.frombuffer(batch.column(k)[i].as_py(), t) for k, t in ((2, np.int64), (3, np.int32), (4, np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(terms, [-1, -2]).astype(np.int32)), pa.array(np.append(np.diff(first), [len(n), n.sum()]).astype(np.int64))], names=["term", "n"])

    counts = dict(map(tuple, blocks.mapInArrow(counted, "term int, n long").groupBy("term").agg(F.sum("n")).collect()))  # one row a term of the set
    n, total = counts.get(-1, 0), counts.get(-2, 0)
    df = np.array([counts.get(i, 0) for i in range(len(vocabulary))], np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
    term = words.indices.to_numpy()
    o = np.argsort(of, kind="stable")
    lists = np.split(term[o], np.flatnonzero(np.diff(of[o])) + 1)
    setting = {"weights": weights, "docs": n, "terms": total, "ids": items,
               "short": [x[df[x] <= short * n] for x in lists], "long": [x[df[x] > short * n] for x in lists]}

    def sums(block: Block, q: int, s: dict) -> tuple[np.ndarray]:
        _, x = block.accumulators(s["short"][q])
        return (np.partition(x, len(x) - k)[len(x) - k:] if len(x) > k else x,)

    sums_of = _of_block(blocks, cast(setting), sums, "item_id long, low long")
    order = Window.partitionBy("item_id").orderBy(F.desc("low"))
    ranked = sums_of.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    lows = dict(map(tuple, ranked.where(F.col("rank") == k).select("item_id", "low").collect()))  # one row an item of the set
    setting["low"] = [max(1, lows.get(int(i), 1)) for i in items]
    return _of_block(blocks, cast(setting), lambda block, q, s: block.best(s["short"][q], s["long"][q], s["low"][q], k), "item_id long, doc_id long, score long")


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 50, short: float = SHORT, terms: int = TERMS, postings: int = POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of each item (item_id, text)."""
    pairs = C.stored(item_terms(items), "query-terms")
    sets = max(1, math.ceil(pairs.count() / terms))
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(sets)))
    found = None
    for i in range(sets):  # a stated set of queries against all documents, in blocks
        own = pairs.where(F.col("part") == i).select("item_id", "term").toArrow()
        best = C.stored(_candidates(documents, own, k, short, postings), "candidates")
        found = best if found is None else found.union(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for each ``benchmark`` item."""
    return ranked_search(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"), 50)

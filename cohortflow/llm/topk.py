"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

Vectors and queries are packed into small blocks, stored once in the narrowest integers that hold
them. The blocks of queries are dealt into groups that fit into a task's memory, those of vectors into
groups of many blocks; every group of queries meets every group of vectors in one task, which holds the
queries and lets the blocks of vectors stream past. So no pair of vectors or blocks is a row, nothing
is broadcast, and a task's memory depends on the group of queries alone.

Each vector is cut into 1, then 4, then 16 segments. With segment means m, deviations s (root mean
square around the mean) and length n, the squared distance of two vectors is at least
sum n * ((m - m')^2 + (s - s')^2), which for the inner product means at most
sum n * (m * m' + s * s'). Queries whose k-th best score so far lies above the bound for all vectors
of a block are dropped level by level, then vectors whose bounds lie under it for all queries that are
left; the rest get exact integer scores. Similar vectors are laid side by side for that, and a level
that drops too little to pay is tried less and less often. The best k of each group of vectors meet
in a window over the query.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part, nor
do rows without id. Vectors meet only vectors of their own dimension. Rows with the query's own id
are no candidates for it; a repeated id as candidate counts for each row, and as query once (with
the smallest vector, should they differ). Ties go to the smaller id. Scores must fit into a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm import common as C

LEVELS = (1, 4, 16)
#: Rows of queries and of vectors that are scored at once, and vectors that give the first k-th best scores.
TILE, STEP, FIRST = 512, 4096, 256
#: Bytes of a block, of a group of queries (which a task holds), of a group of vectors (which it streams).
BLOCK_BYTES, QUERY_BYTES, VECTOR_BYTES = 1 << 18, 1 << 26, 1 << 27
#: Products that are worth a task of their own; bytes of queries that may always be copied to share the work.
WORK, COPIED_BYTES = 1 << 36, 1 << 29

ORACLE = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM good q JOIN good c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def bounds(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of ``x``: segment means and deviations, scaled."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    parts = []
    for a, b in zip(edges, edges[1:]):
        m = x[:, a:b].mean(axis=1)
        s = np.sqrt(np.square(x[:, a:b] - m[:, None]).mean(axis=1))
        parts += [m * math.sqrt(b - a), s * math.sqrt(b - a)]
    return np.stack(parts, axis=1)


def narrow(x: np.ndarray) -> np.ndarray:
    """``x`` in the smallest of 16, 32 and 64 bits that holds it."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    return x.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def norms(x: np.ndarray) -> float:
    """The greatest length of a row, rounded up."""
    return math.sqrt(max((float(np.square(x[a: a + STEP].astype(np.float64)).sum(axis=1).max()) for a in range(0, len(x), STEP)), default=0)) * (1 + 1e-9)


def largest(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


def alike(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """An order of the rows in which those that are nearest to the same pivot stand side by side."""
    return np.argsort(np.concatenate([(x[a: a + STEP].astype(pivots.dtype) @ pivots.T).argmax(axis=1) for a in range(0, len(x), STEP)]), kind="stable")


class Best:
    """The best ``k`` of all vectors offered so far for each query, exactly."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> None:
        self.pivots = q[:: max(1, len(q) // 32)][:32].astype(np.float64)
        self.at = alike(q, self.pivots)  # the given place of each query
        self.q_ids, self.q, self.k = q_ids[self.at], q[self.at], k
        self.by_id = np.argsort(self.q_ids, kind="stable")
        self.length, self.most = norms(q), largest(q)
        self.have = np.zeros(len(q), np.int64)
        self.score = np.full((len(q), k), np.iinfo(np.int64).min)
        self.ids = np.full((len(q), k), np.iinfo(np.int64).max)
        self.as_type: dict[type, np.ndarray] = {}
        self.levels: dict[tuple[int, int, type], np.ndarray] = {}
        self.skip, self.wait = [0] * len(LEVELS), [0] * len(LEVELS)
        self.room: dict[type, np.ndarray] = {}

    def offer(self, v_ids: np.ndarray, v: np.ndarray) -> None:
        if not (len(v) and len(self.q)):
            return
        if len(v) > STEP:
            order = alike(v, self.pivots)
            v_ids, v = v_ids[order], v[order]
        # the first k-th best scores come from a few vectors, so that later steps have few candidates
        cuts = [*({FIRST, 4 * FIRST} if not self.have.any() else ()), *range(0, len(v), STEP), len(v)]
        cuts = sorted({c for c in cuts if c <= len(v)})
        for a, b in zip(cuts, cuts[1:]):
            self._step(v_ids[a:b], v[a:b])

    def _step(self, v_ids: np.ndarray, v: np.ndarray) -> None:
        d, bound = v.shape[1], self.length * norms(v)  # no sum of some of the products is larger
        if bound < 2**24:
            kind, none = np.float32, -np.inf
        elif bound < 2**52:
            kind, none = np.float64, -np.inf
        elif self.most * largest(v) * d < 2**63:
            kind, none = np.int64, np.iinfo(np.int64).min
        else:
            kind, none = object, -(1 << 200)
        if kind not in self.as_type:
            self.as_type = {kind: self.q.astype(kind)}  # one kind at a time: memory
        q, x = self.as_type[kind], v.astype(kind)
        real = kind if kind in (np.float32, np.float64) else np.float64
        slack = bound * (1e-5 if kind is np.float32 else 1e-9) + 1e-6
        stats = [bounds(v.astype(np.float64), s).astype(real) for s in LEVELS]
        # places of the rows with a query's own id
        first, last = (np.searchsorted(self.q_ids, v_ids, side, sorter=self.by_id) for side in ("left", "right"))
        own_col = np.repeat(np.arange(len(v_ids)), last - first)
        own_row = self.by_id[np.arange(len(own_col)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)]
        o = np.argsort(own_row, kind="stable")
        own_row, own_col = own_row[o], own_col[o]
        for a in range(0, len(q), TILE):
            b = min(a + TILE, len(q))
            rows, cols = self._alive(a, b, stats, slack, real)
            if not (len(rows) and len(cols)):
                continue
            whole = len(cols) == len(v)
            y = x if whole else x[cols]
            left = q[a:b] if len(rows) == b - a else q[rows]
            if kind in (np.float32, np.float64):
                if kind not in self.room:
                    self.room[kind] = np.empty(TILE * STEP, kind)
                score = np.matmul(left, y.T, out=self.room[kind][: len(rows) * len(cols)].reshape(len(rows), len(cols)))
            else:
                score = left @ y.T
            i, j = (z[np.searchsorted(own_row, a): np.searchsorted(own_row, b)] for z in (own_row, own_col))
            if len(i):
                r, c = np.searchsorted(rows, i), np.searchsorted(cols, j)
                there = (rows[np.minimum(r, len(rows) - 1)] == i) & (cols[np.minimum(c, len(cols) - 1)] == j)
                score[r[there], c[there]] = none
            self._take(rows, score, v_ids if whole else v_ids[cols], none)

    def _alive(self, a: int, b: int, stats: list[np.ndarray], slack: float, real: type) -> tuple[np.ndarray, np.ndarray]:
        """The queries from ``a`` to ``b`` and the vectors that no bound drops."""
        rows, cols = np.arange(a, b), np.arange(len(stats[0]))
        if (self.have[a:b] < self.k).any():
            return rows, cols
        low = self.score[a:b, self.k - 1].astype(real) - real(slack)
        for n, (s, v) in enumerate(zip(LEVELS, stats)):
            if self.skip[n]:
                self.skip[n] -= 1
                continue
            if (a, s, real) not in self.levels:
                self.levels[a, s, real] = bounds(self.q[a:b].astype(np.float64), s).astype(real)
            level = self.levels[a, s, real][rows - a]
            before = len(rows) * len(cols)
            mean, dev = v[cols, 0::2], v[cols, 1::2]
            upper = np.maximum(level[:, 0::2] * mean.max(axis=0), level[:, 0::2] * mean.min(axis=0)).sum(axis=1) + level[:, 1::2] @ dev.max(axis=0)
            keep = upper >= low[rows - a]
            rows, level = rows[keep], level[keep]
            if len(rows):
                upper = level @ v[cols].T
                upper = upper >= low[rows - a][:, None]
                cols = cols[upper.any(axis=0)]
                rows = rows[upper.any(axis=1)]
            if not (len(rows) and len(cols)):
                self.wait[n] = 0
                return rows[:0], cols[:0]
            # what a level costs and what it saves, in products; it also reads its bounds
            pays = before - len(rows) * len(cols) > before * (level.shape[1] / self.q.shape[1] + 0.1)
            self.wait[n] = 0 if pays else min(255, 2 * self.wait[n] + 1)
            self.skip[n] = self.wait[n]
        return rows, cols

    def _take(self, rows: np.ndarray, score: np.ndarray, v_ids: np.ndarray, none: float) -> None:
        k, full = self.k, self.have[rows] >= self.k
        low = self.score[rows, k - 1].astype(score.dtype)
        if not full.all():
            some = score[~full]
            low[~full] = np.partition(some, score.shape[1] - k, axis=1)[:, -k] if score.shape[1] > k else none
        hit = np.flatnonzero(score.max(axis=1) >= low)
        if not len(hit):
            return
        part = score if len(hit) == len(rows) else score[hit]
        i, j = np.divmod(np.flatnonzero(part >= low[hit, None]), part.shape[1])
        got, ids, i = part[i, j], v_ids[j], rows[hit][i]
        better = (got > none) & ((got > low[np.searchsorted(rows, i)]) | (self.have[i] < k) | (ids < self.ids[i, k - 1]))
        i, ids, got = i[better], ids[better], got[better].astype(np.int64)
        if not len(i):
            return
        u = np.unique(i)
        n = self.have[u]
        old = np.arange(k) < n[:, None]
        i = np.concatenate([np.repeat(u, n), i])
        ids, got = np.concatenate([self.ids[u][old], ids]), np.concatenate([self.score[u][old], got])
        o = np.lexsort((ids, ~got, i))
        i, ids, got = i[o], ids[o], got[o]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        o = rank < k
        i, rank = i[o], rank[o]
        self.ids[i, rank], self.score[i, rank] = ids[o], got[o]
        self.have[u] = np.bincount(np.searchsorted(u, i), minlength=len(u))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, vector id, score), the queries in the given order, the best first."""
        back = np.argsort(self.at)
        there = np.arange(self.k) < self.have[back][:, None]
        return np.nonzero(there)[0], self.ids[back][there], self.score[back][there]


def best_of_block(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, vector id, score): the best k of the block for each query, exactly."""
    best = Best(q_ids, q, k)
    best.offer(v_ids, v)
    return best.found()


def pack(rows: DataFrame) -> DataFrame:
    """Blocks of rows of one dimension: ids and vectors as bytes, where they are."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            start = lists.offsets.to_numpy()
            values, size = lists.values.to_numpy(zero_copy_only=False), np.diff(start)
            for d in np.unique(size[size > 0]):
                of = np.flatnonzero(size == d)
                step = int(max(1, BLOCK_BYTES // (8 * d) * 4))  # most vectors need two bytes a component
                for part in (of[a: a + step] for a in range(0, len(of), step)):
                    v = values[start[part][:, None] + np.arange(d)].astype(np.int64, copy=False)
                    v = narrow(v)
                    cut = int(max(1, BLOCK_BYTES // (v.itemsize * d)))
                    blocks = [(part[a: a + cut], v[a: a + cut]) for a in range(0, len(part), cut)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([d] * len(blocks), pa.int32()), pa.array([len(i) for i, _ in blocks], pa.int32()), pa.array([x.nbytes for _, x in blocks], pa.int32()),
                        pa.array([ids[i].astype(np.int64).tobytes() for i, _ in blocks], pa.binary()), pa.array([x.tobytes() for _, x in blocks], pa.binary())],
                        names=["dim", "n", "bytes", "ids", "data"])

    return rows.select("vec_id", "q").mapInArrow(run, "dim int, n int, bytes int, ids binary, data binary")


def unpack(blocks: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of blocks of one dimension."""
    d, n = blocks.column("dim")[0].as_py(), blocks.column("n").to_pylist()
    ids = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in blocks.column("ids")])
    data = [np.frombuffer(x.as_buffer(), f"i{size // (rows * d)}").reshape(-1, d) for x, size, rows in zip(blocks.column("data"), blocks.column("bytes").to_pylist(), n)]
    return ids, np.concatenate(data)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of frames with ``vec_id`` and the integer vector ``q``."""
    queries = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    v_blocks, q_blocks = C.stored(pack(vectors), "topk-vectors"), C.stored(pack(queries), "topk-queries")
    total = [F.coalesce(F.sum(x), F.lit(0)).cast("double") for x in ("bytes", "n")]
    (v_bytes, _), (q_bytes, n_q) = (df.agg(*total).first() for df in (v_blocks, q_blocks))
    q_groups = max(1, math.ceil((q_bytes + n_q * (16 * k + 128)) / QUERY_BYTES))  # with what a task keeps for each query
    # more groups of vectors than VECTOR_BYTES asks for share the work, while the queries copied to them are no more than the vectors
    copies = max(v_bytes, COPIED_BYTES) / max(q_bytes, 1)
    v_groups = max(1, math.ceil(v_bytes / VECTOR_BYTES), math.ceil(min(n_q * v_bytes / 2 / q_groups / WORK, copies, v_bytes / BLOCK_BYTES)))
    group = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q_dealt = q_blocks.withColumn("vg", each(v_groups)).withColumn("qg", group(q_groups)).withColumn("is_vector", F.lit(False))
    v_dealt = v_blocks.withColumn("qg", each(q_groups)).withColumn("vg", group(v_groups)).withColumn("is_vector", F.lit(True))
    dealt = q_dealt.unionByName(v_dealt).repartitionById(q_groups * v_groups, F.col("qg") * v_groups + F.col("vg"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, held, best = None, [], None

        def results() -> Iterator[pa.RecordBatch]:
            if best is not None:
                i, ids, score = best.found()
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (best_ids[i], ids, score)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            dims, kinds = batch.column("dim").to_numpy(), batch.column("is_vector").to_numpy(zero_copy_only=False)
            width = batch.column("bytes").to_numpy() // batch.column("n").to_numpy() // dims
            cuts = [0, *(np.flatnonzero(np.diff(dims) | np.diff(width) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(dims)]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                if dims[a] != dim:
                    yield from results()
                    dim, held, best = dims[a], [], None
                ids, x = unpack(batch.slice(a, b - a))
                if not kinds[a]:
                    held.append((ids, x))
                    continue
                if held:
                    best_ids, q = (np.concatenate(y) for y in zip(*held))
                    best, held = Best(best_ids, q, k), []
                if best is not None:
                    best.offer(ids, x)
        yield from results()

    rows = dealt.sortWithinPartitions("dim", "is_vector").select("dim", "n", "bytes", "ids", "data", "is_vector")
    best = rows.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``q``, floor(scale * x) of each component, of the rows that take part."""
    x = F.col("embedding")
    good = x.isNotNull() & F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("q"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(C.table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)

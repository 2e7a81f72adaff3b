import math
import random
import re

import numpy as np

from cohortflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, q int, rank int, score long"


def brute(rows, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, least = [], {}
    for i, v in good:
        if i % 50 == 0:
            least[i] = min(least.get(i, v), v)
    for i, v in least.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def saved(spark, rows, folder):
    spark.createDataFrame([(i, v, None, 3, None, 1) for i, v in rows], SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    vector = lambda: [rng.gauss(0, 0.2) for _ in range(24)]
    rows = [(i, vector()) for i in range(400)]
    rows += [(400, None), (450, []), (401, [None] * 24), (402, [math.nan] * 24), (403, [math.inf] * 24), (None, vector()),
             (500, [0.5, -0.25]), (501, [0.1, 0.2]), (550, [0.0] * 24), (7, vector()), (100, vector()), (8, rows[8][1])]
    rows += [(600 + i, rows[50][1]) for i in range(9)]  # ties
    got = topk.op6_exact_top_k(spark, saved(spark, rows, tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(2)
    centres = rng.integers(-300, 300, (20, 32))
    v = centres[rng.integers(0, 20, 3000)] + rng.integers(-10, 11, (3000, 32))
    ids = rng.permutation(3000)
    q = np.arange(0, 3000, 97)
    i, got, score = topk.best_of_block(ids[q], v[q], ids, v, 5)
    full = v[q] @ v.T
    for k in range(len(q)):
        order = sorted((-full[k, j], ids[j]) for j in range(3000) if j != q[k])[:5]
        assert [(-s, j) for s, j in order] == list(zip(score[i == k].tolist(), got[i == k].tolist()))


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 37)), rng.normal(size=(60, 37))
    exact = x @ y.T
    last = np.inf
    for s in topk.LEVELS:
        upper = topk.bounds(x, s) @ topk.bounds(y, s).T
        assert (upper >= exact - 1e-9).all() and upper.sum() <= last
        last = upper.sum()


def test_large_components_are_exact():
    q, v = np.array([[2**40, 3]]), np.array([[2**20, 1], [2**20, 2]])
    assert topk.best_of_block(np.array([9]), q, np.array([1, 2]), v, 5)[2].tolist() == [2**60 + 6, 2**60 + 3]


def test_empty_table(spark, tmp_path):
    assert topk.op6_exact_top_k(spark, saved(spark, [], tmp_path)).count() == 0


def shuffled(df):
    """Bytes that the shuffles of a plan that has run wrote."""
    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        own = node.metrics().get("dataSize").get().value() if node.nodeName() == "Exchange" else 0
        rest = node.children().iterator()
        while rest.hasNext():
            own += walk(rest.next())
        return own

    return walk(df._jdf.queryExecution().executedPlan())


def test_queries_are_not_copied_to_each_block_of_vectors(spark):
    n = 6 * 4096
    rows = spark.range(n).selectExpr("id AS vec_id", "transform(sequence(0, 7), i -> pmod(xxhash64(id, i), 201) - 100) AS q")
    best = topk.top_k(rows, rows, 1)
    assert len(best.collect()) == n
    assert shuffled(best) < 200 * n


def test_groups_of_queries_and_vectors(spark, tmp_path, monkeypatch):
    for name, value in {"QUERY_BYTES": 4000, "VECTOR_BYTES": 2000}.items():
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(4)
    vector = lambda d, size: [rng.gauss(0, size) for _ in range(d)]
    rows = [(i, vector(12, 0.2)) for i in range(700)] + [(i, vector(5, 300.0 if i % 3 else 1e6)) for i in range(700, 900)]
    rows += [(1000 + i, rows[50 * (i % 3)][1]) for i in range(60)] + [(950, vector(3, 1)), (951, vector(2, 1))]
    got = topk.op6_exact_top_k(spark, saved(spark, rows, tmp_path))
    assert sorted(map(tuple, got.collect())) == brute(rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    groups = int(re.search(r"RepartitionBy\w+ .*?, (\d+)", plan)[1])
    assert groups > 8 and "Join" not in plan


def test_bounds_drop_whole_tiles_and_stay_exact():
    rng = np.random.default_rng(5)
    centres = 40 * np.eye(16, 64, dtype=np.int64).repeat(4, axis=1)[:, :64]
    v = (centres[rng.integers(0, 16, 40_000)] + rng.integers(-3, 4, (40_000, 64))).astype(np.int16)
    ids = rng.permutation(40_000)
    best = topk.Best(ids[:2048], v[:2048], 5)
    best.offer(ids, v)
    i, got, score = best.found()
    full = v[:100].astype(np.int64) @ v.astype(np.int64).T
    for k in range(100):
        order = np.lexsort((ids, -full[k]))
        order = order[ids[order] != ids[k]][:5]
        assert list(zip(score[i == k].tolist(), got[i == k].tolist())) == list(zip(full[k, order].tolist(), ids[order].tolist()))


def test_many_equal_vectors_and_a_repeated_id():
    q, v = np.array([[3, 4], [0, 0]]), np.array([[3, 4]] * 9000)
    ids = np.arange(9000)[::-1].copy()
    ids[:3] = 7
    i, got, score = topk.best_of_block(np.array([0, 7]), q, ids, v, 5)
    assert got.tolist() == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4] and i.tolist() == [0] * 5 + [1] * 5
    i, got, score = topk.best_of_block(np.array([3]), q[:1], np.array([7, 7, 9]), v[:3], 5)
    assert got.tolist() == [7, 7, 9] and score.tolist() == [25] * 3


def test_scores_near_the_largest_long_are_exact():
    q, v = np.array([[2**31 - 1, 2**30 + 1, 0]]), np.array([[2**31 - 1, 2**30 - 1, 5], [2**31 - 1, 2**30, 5], [-(2**31), -(2**30), 1]])
    exact = [sum(int(a) * int(b) for a, b in zip(q[0], x)) for x in v]
    assert topk.best_of_block(np.array([9]), q, np.array([1, 2, 3]), v, 5)[2].tolist() == [exact[1], exact[0], exact[2]]

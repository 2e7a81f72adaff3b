import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cohortflow.llm import lexical
from tests.llm import helpers

ITEMS = "item_id long, text string, doc_id long, rank int, term string, part int, low long"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=50):
    held = [(d[0], Counter(terms(d[1]))) for d in docs]
    held = [(i, c) for i, c in held if c]
    n, total, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    queries, out = {}, []
    for i, text in items:
        if i is not None and terms(text):
            queries.setdefault(i, set()).update(terms(text))
    for item, q in queries.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in q}
        scores = []
        for i, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            s = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in q if c[t])
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def saved(spark, docs, items, folder):
    helpers.saved(spark, docs, folder)
    spark.createDataFrame([(*r, 9, 1, "t", 2, 3) for r in items], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def zipf(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), 500)}" for _ in range(n))


def some(rng, n=300):
    docs = [(i, zipf(rng, rng.randrange(1, 80))) for i in range(n)] + [(1000 + i, t) for i, t in enumerate(helpers.EDGE_TEXTS)]
    docs += [(2000 + i, "W1 copy, w2;w3") for i in range(60)] + [(7, "again w1")] * 3 + [(None, "w1 w2 w3 w400"), (None, None)]
    docs += [(3000, zipf(rng, 20000)), (3001, "w4_w5é É é Ä w6")]
    rng.shuffle(docs)
    items = [(i, zipf(rng, 30)) for i in range(25)] + [(50, None), (51, ""), (52, "unknown word"), (53, "w1 w1 W1"), (None, "w1"), (54, "w7"), (54, "copy"), (55, "É é Ä"), (56, zipf(rng, 5000))]
    return docs, items


def test_query_against_brute_force(spark, tmp_path):
    docs, items = some(random.Random(1))
    got = lexical.op12_ranked_search(spark, saved(spark, docs, items, tmp_path))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs, items)


@pytest.mark.parametrize("short, sizes", [(0.0, (1 << 20, 40)), (1.0, (60, 500)), (0.02, (200, 60))])
def test_any_split_of_lists_queries_and_blocks(spark, short, sizes):
    docs, items = some(random.Random(2), 150)
    d, q = helpers.documents(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = lexical.ranked_search(d, q, 5, short, *sizes)
    assert sorted(map(tuple, got.collect())) == brute(docs, items, 5)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (None, "a")], [(1, "a"), (2, None)])])
def test_empty_tables(spark, tmp_path, docs, items):
    got = lexical.op12_ranked_search(spark, saved(spark, docs, items, tmp_path))
    assert sorted(map(tuple, got.collect())) == brute(docs, items)


def test_terms_are_compared_by_bytes(monkeypatch):
    monkeypatch.setattr(lexical.C, "span_hashes", lambda buf, start, end: np.full(len(start), 7, np.uint64))
    words = lexical.Vocabulary([b"abc"])
    hit, number = words.find(*lexical.term_spans([b"abd ABC ab", b"", "xbc abc".encode()])[:3])
    assert hit.tolist() == [1, 4] and number.tolist() == [0, 0]
    with pytest.raises(ValueError):
        lexical.Vocabulary([b"abc", b"abd"])


def test_skipping_reads_few_documents_and_keeps_the_best():
    rng = np.random.default_rng(3)
    n = 50_000
    at = [np.sort(rng.choice(n, size, replace=False)) for size in (40_000, 30_000, 40)]
    tf = [rng.integers(1, 9, len(x)) for x in at]
    row = {"ids": np.arange(n).tobytes(), "named": np.ones(n, bool).tobytes(), "n": rng.integers(5, 90, n).tobytes(), "terms": np.arange(3, dtype=np.int32).tobytes(),
           "first": np.cumsum([0, *map(len, at)]).tobytes(), "at": np.concatenate(at).astype(np.int32).tobytes(), "tf": np.concatenate(tf).tobytes()}
    block = lexical.Block(row, np.array([20, 50, 9000]), n, 40 * n)
    ids, scores = block.best(np.array([2]), np.array([0, 1]), 1, 10)
    total = np.zeros(n, np.int64)
    for x, y in zip(at, np.split(block.adds, block.first[1:-1])):
        total[x] += y
    o = np.lexsort((np.arange(n), -total))[:10]
    assert ids.tolist() == o.tolist() and scores.tolist() == total[o].tolist()

import random

import numpy as np

from cohortflow.llm import minhash
from cohortflow.llm.components import components
from tests.llm.helpers import EDGE_TEXTS, documents, prose, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k: k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(n_shingles, component_id) of each row, by comparing every pair."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(len(sets[i]), least.get(root(i))) for i in range(len(rows))]


def edited(rng, text, share):
    w = text.split()
    for k in rng.sample(range(len(w)), max(1, int(share * len(w)))):
        w[k] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def check(spark, rows):
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == sorted(((d, n, c) for (d, _), (n, c) in zip(rows, brute(rows))), key=repr)
    for r in got:
        assert r["kept"] == (r["doc_id"] == r["component_id"]) or r["doc_id"] is None


def test_copies_near_copies_and_edge_cases(spark):
    rng = random.Random(3)
    rows = [(100 + i, t) for i, t in enumerate(EDGE_TEXTS)]
    for g in range(12):
        base = prose(rng, rng.randrange(30, 200), 10_000)
        rows.append((1000 + 50 * g, base))
        rows += [(1001 + 50 * g + k, edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.05]))) for k in range(8)]
        rows.append((1020 + 50 * g, base.upper().replace(" ", "\n")))
    rows += [(7, "a b c d"), (8, "A b C d"), (9, "a b c"), (9, "a b c"), (None, rows[20][1]), (None, "x y z without id")]
    check(spark, rows)


def test_copies_of_an_original_that_differ_from_each_other(spark):
    """Two copies of one original are under the threshold, so only links to the original join them."""
    rng = random.Random(4)
    base = prose(rng, 300, 100_000)
    rows = [(i, edited(rng, base, 0.02)) for i in range(60)] + [(777, base)]
    sets = [shingles(t) for _, t in rows]
    assert any(100 * len(a & b) < 75 * len(a | b) for a in sets[:-1] for b in sets[:-1])
    check(spark, rows)


def test_chain(spark):
    rng = random.Random(5)
    rows, text = [], prose(rng, 120, 100_000)
    for i in range(25):
        rows.append((i, text))
        text = edited(rng, text, 0.02)
    check(spark, rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_estimate_counts_equal_lanes(spark):
    """The SQL estimate accepts a pair from LEAST_EQUAL equal b-bit values on."""
    rng = np.random.default_rng(6)
    a = rng.integers(0, 4, (60, minhash.HASHES))
    b = a.copy()
    for i in range(60):
        at = rng.permutation(minhash.HASHES)[: 20 + i]
        b[i, at] = (b[i, at] + rng.integers(1, 4, len(at))) % 4

    def pack(x):
        lanes = x.reshape(len(x), -1, 32).astype(np.uint64)
        return np.bitwise_or.reduce(lanes << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=2).view(np.int64).tolist()

    rows = [(i, *p, *q) for i, (p, q) in enumerate(zip(pack(a), pack(b)))]
    names = ["i", *(f"a_{s}" for s in minhash.SIGNATURE), *(f"b_{s}" for s in minhash.SIGNATURE)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    sides = [frame.selectExpr("i", *[f"{x}_{s} AS {s}" for s in minhash.SIGNATURE]).alias(x) for x in "ab"]
    from pyspark.sql import functions as F
    got = sides[0].join(sides[1], F.expr("a.i = b.i")).selectExpr("a.i", minhash.may_reach("a", "b") + " AS ok").collect()
    assert {r["i"]: r["ok"] for r in got} == {i: int((a[i] == b[i]).sum()) >= minhash.LEAST_EQUAL for i in range(60)}


def test_components(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)] + [(500, 500 + i) for i in range(60)]
    group = {i: i for p in pairs for i in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: g for i, g in group.items() if i != g}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_repeated_rows_are_compared_once(spark):
    rng = random.Random(21)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    one, two = " ".join(words), " ".join(words[:118] + ["other", "end"])
    rows = [(1, one)] * 1000 + [(2, two)] * 1000 + [(None, one)] * 50 + [(3, "quite another text with some words in it")] * 3
    docs = documents(spark, rows).repartition(4)
    nodes = spark.createDataFrame([(b"a", (1, None)), (b"b", (2, None)), (b"c", (None, None))], "key binary, row struct<doc_id: long, text_hash: long>")
    hashes = {r.doc_id: r.text_hash for r in minhash.with_hash(docs, "doc_id", "text").select("doc_id", "text_hash").distinct().collect()}
    nodes = spark.createDataFrame([(k, (i, hashes[i])) for k, i in ((b"a", 1), (b"b", 2), (b"c", None))], nodes.schema)
    texts = minhash.class_texts(minhash.with_hash(docs, "doc_id", "text"), nodes).collect()
    assert sorted((bytes(r.key), r.text, r.n_bytes) for r in texts) == [(b"a", one, len(one)), (b"b", two, len(two)), (b"c", one, len(one))]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (2, 1, False), (None, 1, False), (3, 3, True)}


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    """A few long texts make blocks of their own; the links stay the same."""
    rng = random.Random(22)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join(base[: 300 + 12 * i] if i % 2 else base[100 - 8 * i:])) for i in range(9)]
    want = sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(documents(spark, rows)).collect())
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 500)
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(documents(spark, rows)).collect()) == want

import hashlib
import random
import zlib

import pytest

from cohortflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, c long, name string, b long, pid int, root string"


def saved(spark, rows, folder):
    spark.createDataFrame([(*r, 1, 2, "n", 3, 4, "r") for r in rows], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = [*own.get(c - int(c - 5 * int(c / 5)), [])[:h], *turns[h:]]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = lambda x: sum(len(p) == len(x) + 1 and p[: len(x)] == x for p in nodes)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(path)))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), kids(path), sum(kids(p) == 0 for p in below),
                    sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, folder):
    got = prefix_trie.op11_prefix_trie(spark, saved(spark, rows, folder))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_shared_prefixes_ties_nulls_and_repeats(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for c in [*range(-12, 40), 10**12, 10**12 + 3]:
        for t in range(rng.choice([1, 2, 5, 9, 14])):
            text = rng.choice(["a", "bé", "", None]) if rng.random() < 0.5 else f"t{t}"
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", "user", None, ""]), text))
    rows += [(7, 2, "user", "same")] * 3 + [(None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(c, 0, "user", "hot") for c in range(100, 160)]  # copies
    check(spark, rows, tmp_path)


def test_one_conversation_with_most_rows(spark, tmp_path):
    rows = [(5, i, "user", f"x{i % 3}") for i in range(150)] + [(6, i, "user", f"x{i % 3}") for i in range(75)] + [(11, 0, "u", "y" * 10000)]
    check(spark, rows, tmp_path)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, 0, "user", "x")], [(0, None, None, None)]])
def test_small_tables(spark, tmp_path, rows):
    check(spark, rows, tmp_path)


def test_turns_are_numbered_over_many_partitions(spark):
    rows = [(1, i // 2, "user", f"{i}") for i in range(500)] + [(c, i, "a", "b") for c in (0, 2, 3) for i in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    got = prefix_trie.numbered_turns(df).groupBy("c").agg({"p": "collect_list"}).collect()
    assert {r[0]: sorted(r[1]) for r in got} == {1: list(range(1, 501)), **{c: [1, 2, 3, 4] for c in (0, 2, 3)}}

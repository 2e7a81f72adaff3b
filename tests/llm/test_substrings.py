import random

import numpy as np
import pytest

from cohortflow.llm import substrings
from tests.llm.helpers import EDGE_TEXTS, documents, prose, saved, sha, words


def brute(rows):
    least = {}
    for doc, text in rows:
        if doc is not None:
            w = words(text)
            for k in range(len(w) - 12):
                x = tuple(w[k: k + 13])
                least[x] = min(doc, least.get(x, doc))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - 12):
            if doc is not None and least[tuple(w[k: k + 13])] < doc:
                gone.update(range(k, k + 13))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def table():
    rng = random.Random(1)
    passages = [prose(rng, n, 10**6) for n in (12, 13, 14, 30, 80)]
    rows = [(100 + i, t) for i, t in enumerate(EDGE_TEXTS)]
    for i in range(80):
        parts = [prose(rng, rng.randrange(40), rng.choice([5, 10**6])) for _ in range(3)]
        parts.insert(1, rng.choice(passages))
        if i % 3 == 0:
            parts.append(rng.choice(passages).replace(" ", "\n"))
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(i, passages[4]) for i in range(3000, 3040)] + [(None, passages[4]), (3001, passages[4]), (3002, "other " + passages[3])]
    rows += [(4000, "a " * 40), (4001, "a " * 30), (4002, "a " * 13)]
    return rows


@pytest.mark.parametrize("group", [substrings.GROUP, 3, 1])
def test_against_brute_force(spark, group):
    rows = table()
    got = substrings.substring_dedup(documents(spark, rows), group=group).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got), key=repr) == sorted(brute(rows), key=repr)
    assert all(r["kept_sha256"] == sha(r["kept_text"]) and r["lang"] == "en" and r["part"] == 1 for r in got)


def test_query(spark, tmp_path):
    rows = table()
    got = substrings.op7_substring_dedup(spark, saved(spark, rows, tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, n, k, sha(t)) for d, n, k, t in brute(rows)), key=repr)


def test_prefixes_are_lengthened_until_groups_fit(spark):
    rng = random.Random(4)
    head, tail = prose(rng, 10, 10**6), prose(rng, 16, 10**6)
    segments = [f"{head} {prose(rng, 12, 10**6)}" for _ in range(6)] + [f"{prose(rng, 1, 10**6)} {tail}" for _ in range(5)]
    rows = spark.createDataFrame([(i, 1, i, 0, t.encode()) for i, t in enumerate(segments)], "doc_id long, prefix long, segment long, place int, content binary")
    got = substrings.lengthened(substrings.single_windows(rows), 4).collect()
    assert len(got) == 6 * 10 + 5 * 5
    for r in got:
        text = r["content"].split()
        alike = lambda n: sum(x["content"].split()[:n] == text[:n] for x in got)  # noqa: B023, E731
        fits = [n for n in substrings.LENGTHS if alike(n) <= 4]
        assert r["length"] == (fits[0] if fits else None) and (r["key"] is None) == (not fits)
        assert not fits or r["key"] == r[f"p{fits[0]}"]
    assert {r["length"] for r in got} == {9, 11, None}


def test_a_hot_segment_spreads(spark):
    rng = random.Random(5)
    passage = prose(rng, 40, 10**6)
    rows = [(i, f"{prose(rng, 20, 10**6)} {passage} {prose(rng, 20, 10**6)}") for i in range(60)]
    got = substrings.substring_dedup(documents(spark, rows), group=7).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == sorted(brute(rows))
    assert [r["n_removed"] for r in sorted(got, key=lambda r: r["doc_id"])] == [0] + [40] * 59


def test_chunks_end_between_prefixes(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_SEGMENTS", 3)  # the closures read it when they are pickled
    rng = random.Random(2)
    texts = [prose(rng, 15, 10**6).encode() for _ in range(6)]
    least, n = substrings.node_minima([*texts, *texts], np.arange(12))
    assert least.tolist() == [x for i in range(12) for x in [i % 6] * 3] and n.tolist() == [3] * 12


def test_equal_windows_have_equal_anchors():
    from cohortflow.llm.common import Words
    rng = random.Random(3)
    passage = prose(rng, 40)
    w = Words([t.encode() for t in (f"{prose(rng, 9)} {passage} {prose(rng, 3)}", f"{passage} {prose(rng, 20)}")])
    win, at, g = substrings.anchors(w.hashes(), w.first)
    by = {}
    for i, a in zip(win.tolist(), at.tolist()):
        by.setdefault(tuple(w.raw[w.start[k]: w.end[k]] for k in range(i, i + 13)), set()).add((a - i, g[a]))
    assert all(len(x) == 1 for x in by.values()) and max(np.bincount(w.doc[win])) > 0


def test_empty_table(spark):
    assert substrings.substring_dedup(documents(spark, [])).count() == 0

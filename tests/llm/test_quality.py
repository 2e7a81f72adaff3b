import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from cohortflow.llm import quality
from tests.llm.helpers import EDGE_TEXTS, documents, prose, saved, words


def base(text):
    w = words(text)
    count = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    cover = [any(0 <= i < len(w) - 2 and count[tuple(w[i: i + 3])] > 1 for i in (k - 2, k - 1, k)) for k in range(len(w))]
    lines = [x for x in (text or "").split("\n") if words(x)]
    repeat = sum(cover)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat,
            len(w) < 50 or 100 * repeat > 50 * len(w))


def longest_repeats(s, least):
    out = [0] * len(s)
    for i in range(len(s)):
        for j in range(len(s)):
            k = 0
            while i != j and max(i, j) + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return [k if k >= least else 0 for k in out]


def test_suffix_array_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes, least = rng.integers(0, 30, 3), int(rng.integers(1, 12))
        parts = [rng.integers(0, rng.integers(1, 4), n).astype(np.uint64) for n in sizes]
        got = quality.longest_repeats(np.concatenate(parts), np.repeat(np.arange(3), sizes), least).tolist()
        assert got == [x for p in parts for x in longest_repeats(p.tolist(), least)]


def test_long_texts_of_few_words_need_memory_in_proportion():
    n = 300_000
    for unit in ([1], [1, 2, 2], list(range(1000))):
        sym = np.array((unit * (n // len(unit) + 1))[:n], np.uint64)
        tracemalloc.start()
        got = quality.longest_repeats(sym, np.zeros(n, np.int64), 8)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        period = len(unit)
        expected = n - np.arange(n) - period * (np.arange(n) < period)
        assert (got == np.where(expected < 8, 0, expected)).all() and peak < 160 * n + (100 << 20)


def test_passages_repeated_across_blocks_of_the_comparison():
    rng = np.random.default_rng(7)
    passage = rng.integers(0, 1 << 60, 70_000).astype(np.uint64)
    sym = np.concatenate([passage, [1], passage[:50_000], [2], passage[20_000:]]).astype(np.uint64)
    got = quality.longest_repeats(sym, np.zeros(len(sym), np.int64), 8)
    assert got[0] == 50_000 and got[20_000] == 50_000 and got[19_999] == 30_001 and got.max() == 50_000


def texts():
    rng = random.Random(2)
    passage = prose(rng, 90)
    return [*EDGE_TEXTS, prose(rng, 200, 5000), "same line\n" * 40, f"{passage}\n{prose(rng, 20)}\n{passage}", "# * | " * 30,
            prose(rng, 60, 5000) + "\n" + prose(rng, 60, 5000), "ab" * 400 + " " + prose(rng, 60, 5000), "日本語のテキスト" * 50]


def test_query_against_brute_force(spark, tmp_path):
    rows = list(enumerate(texts())) + [(None, "no id"), (3, "one")]
    got = quality.op3_quality_rules(spark, saved(spark, rows, tmp_path)).collect()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(((i, *base(t)) for i, t in rows), key=repr)
    for r in got:
        assert not (r["base_failed"] and r["kept"])
        if not r["base_failed"] and r["longest_repeat"] < quality.MIN_REPEAT:
            assert r["kept"] and r["covered"] == 0


def test_verdict_from_repeats():
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(100))
    clean, doubled = " ".join(f"c{i}" for i in range(300)), f"{passage} {prose(rng, 5, 10**6)} {passage}"
    names = list(quality.FIELDS)
    for text, ok in ((clean, True), (doubled, False)):
        row = dict(zip(names, (x[0] for x in quality.judge(pa.array([text])))))
        lengths = longest_repeats(words(text), quality.MIN_REPEAT)
        assert row["longest_repeat"] == max(lengths)
        cover = {k for i, n in enumerate(lengths) for k in range(i, i + n)}
        assert abs(row["covered"] - sum(len(words(text)[k]) for k in cover) / sum(map(len, words(text)))) < 1e-9
        assert row["kept"] == ok


def test_verdict_goes_beyond_the_base_rule():
    rng = random.Random(4)
    fresh = (f"u{i}" for i in range(10**6))

    def take(n):
        return " ".join(next(fresh) for _ in range(n))

    def twice(n, rest):
        passage = take(n)
        return f"{passage} {take(rest)} {passage}"

    short = [take(12) for _ in range(20)]
    many = " ".join(f"{s} {take(40)} {s}" for s in short)  # 37 % covered, each repeat is short
    few = " ".join(f"{s} {take(120)} {s}" for s in short)  # 17 %
    # 36 % covered; longest 18 %; longest 12 %, 24 % covered; longest 8 %; longest 12 % but of 60 words only
    cases = [(twice(900, 3200), False), (many, False), (twice(120, 760), False), (few, True), (twice(80, 840), True), (twice(60, 380), True), (prose(rng, 800, 3000), True)]
    names = list(quality.FIELDS)
    for text, kept in cases:
        row = dict(zip(names, (x[0] for x in quality.judge(pa.array([text])))))
        assert not row["base_failed"] and row["kept"] == kept


def test_columns_and_empty_table(spark):
    got = quality.quality_rules(documents(spark, [(1, "a b")])).first()
    assert got["n_words"] == 2 and got["key"] is None and got["row"] == "r"
    assert quality.quality_rules(documents(spark, [])).count() == 0

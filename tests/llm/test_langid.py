import numpy as np
import math
import random
import zlib

import public_tokenizers

from cohortflow.llm import langid
from tests.llm.helpers import EDGE_TEXTS, saved

PIECES = langid.vocabulary_pieces(public_tokenizers.path(langid.VOCABULARY))
SYLLABLES = {"aa": "tion ing the er and wh".split(), "bb": "sch ung keit ein ver zu".split(), "cc": "eau oux ent que le ou".split()}


def text(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def table():
    rng = random.Random(1)
    return [(i, text(rng, lang), lang) for i in range(240) for lang in [sorted(SYLLABLES)[i % 3]]]


def all_segmentations(word, p, g):
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        k = INDEX.get(word[:n])
        x = p[k, g] if k is not None else langid.FLOOR if n == 1 else 0.0
        if x:
            total += x * all_segmentations(word[n:], p, g)
    return total


INDEX = {x: i for i, x in enumerate(PIECES)}


def test_forward_sums_all_segmentations():
    counts = [(lang, langid.EDGE + w, 1 + len(w)) for lang, ws in SYLLABLES.items() for w in ws]
    langs, p = langid.fit(counts, PIECES)
    assert langs == sorted(SYLLABLES) and abs(p[: len(PIECES)].sum(axis=0) - 1).max() < 0.01
    scorer = langid.Scorer(langs, p, PIECES)
    words = [langid.EDGE + w for w in ("the", "tioneau", "ñandú", "日本", "q")]
    got = scorer.words(words)
    for i, w in enumerate(words):
        for g in range(3):
            assert math.isclose(got[i, g], math.log(all_segmentations(w, p, g)), rel_tol=1e-9)


def test_long_words_are_cut():
    assert [len(w.removeprefix(langid.EDGE)) for w in langid.runs_of("x" * 70 + " 12 yes")] == [32, 32, 6, 3]
    assert langid.words_of("x" * 70 + " 12 Yes") == [langid.EDGE + "x" * 70, langid.EDGE + "yes"]


def test_held_out_accuracy_and_edge_cases(spark, tmp_path):
    rows = table() + [(1000 + i, t, None) for i, t in enumerate(EDGE_TEXTS)] + [(None, "the and", "aa"), (5, "12 34 ...", "bb"), (3, "sch ung", "aa")]
    got = langid.op8_language_id(spark, saved(spark, rows, tmp_path)).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "held_out", "lang_pred", "score"}
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (r["score"] == 0)
    held = [(lang, by[i][0]["lang_pred"]) for i, _, lang in table() if i not in (3, 5) and by[i][0]["held_out"]]
    assert len(held) > 30 and all(a == b for a, b in held)
    for i, t in enumerate(EDGE_TEXTS):
        assert (by[1000 + i][0]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))


def test_labels_are_no_inputs_of_a_prediction(spark, tmp_path):
    """The labels and sources of held-out documents change nothing."""
    rows = table()
    other = [(i, t, lang if zlib.crc32(str(i).encode()) % 4 != 2 else "zz") for i, t, lang in rows]
    results = []
    for name, x in (("a", rows), ("b", other)):
        (tmp_path / name).mkdir()
        results.append(sorted(map(tuple, langid.op8_language_id(spark, saved(spark, x, tmp_path / name)).collect())))
    assert results[0] == results[1]


def test_nothing_to_learn(spark, tmp_path):
    rows = langid.op8_language_id(spark, saved(spark, [(1, "some words", None)], tmp_path)).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
    (tmp_path / "none").mkdir()
    assert langid.op8_language_id(spark, saved(spark, [], tmp_path / "none")).count() == 0


def test_words_are_letters_with_their_marks():
    assert langid.words_of("½ ² Ⅷ ٣ _ \u0301 ①") == []
    assert [w.removeprefix(langid.EDGE) for w in langid.words_of("हिन्दी में, Ünï-x e\u0301a")] == ["हिन्दी", "में", "ünï", "x", "e\u0301a"]


def test_long_words_are_summed_like_short_ones():
    rng = np.random.default_rng(8)
    pieces = ["a", "b", "ab", "ba", "abba", langid.EDGE + "a", langid.EDGE, "bab"]
    scorer = langid.Scorer(["x", "y"], langid.with_unknown(rng.random((len(pieces), 2)) / 4), pieces)
    for n in (1, 2, 5, 31, 60):
        word = langid.EDGE + "".join(rng.choice(list("abc"), n))
        plain = np.log(langid.Lattice([word], scorer.table).forward(scorer.p)[0, -1])
        for part in (1 << 14, 1, 3, 7):
            assert np.allclose(scorer.long_word(word, part), plain, rtol=1e-9)
    assert np.isfinite(scorer.words([langid.EDGE + "ab" * 20_000])).all()


def test_numerals_are_no_language(spark, tmp_path):
    rows = [(4 * i + 1, "the words of this text", "en") for i in range(30)] + [(1000, "½ ²", "en"), (1001, "Ⅷ 12", "en"), (1002, "\u0301", "en")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.op8_language_id(spark, saved(spark, rows, tmp_path)).collect()}
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0) and got[1][0] == "en"

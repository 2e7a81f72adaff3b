"""The pipeline against brute-force versions of its stages."""

import random
import sys
from pathlib import Path

import pytest

from cohortflow.llm import quality
from tests.llm import test_minhash, test_substrings
from tests.llm.helpers import documents, prose, words

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGE = dict(corpus_pipeline.STAGES)


def table():
    rng = random.Random(1)
    passage = prose(rng, 60, 10**6)
    rows = [(i, prose(rng, rng.randrange(60, 200), 10**6)) for i in range(30)]
    rows += [(100 + i, test_minhash.edited(rng, rows[i][1], 0.01)) for i in range(8)] + [(200 + i, rows[i][1]) for i in range(5)]
    rows += [(300 + i, f"{prose(rng, 70, 10**6)} {passage} {prose(rng, 50, 10**6)}") for i in range(5)]
    rows += [(400, "short"), (401, None), (402, "same line again\n" * 60), (403, prose(rng, 80, 10**6) + "\nmail me: a@b.example.com"), (0, rows[0][1])]
    return rows


def ids(frame):
    return sorted(r["doc_id"] for r in frame.collect())


def test_stages_one_by_one(spark):
    docs = documents(spark, table())
    rows = table()
    verdict = {d: x for d, x in zip([d for d, _ in rows], quality.judge(__import__("pyarrow").array([t for _, t in rows]))[-1])}
    one = STAGE["quality_rules"](spark, docs, "")
    assert one.columns == docs.columns and ids(one) == sorted(d for d, _ in rows if verdict[d])

    kept = [(r["doc_id"], r["text"]) for r in one.collect()]
    two = STAGE["minhash_near_dedup"](spark, one, "")
    names = {d: c for (d, _), (_, c) in zip(kept, test_minhash.brute(kept))}
    assert two.columns == docs.columns and ids(two) == sorted(d for d, c in names.items() if d == c)

    kept = [(r["doc_id"], r["text"]) for r in two.collect()]
    three = STAGE["substring_dedup"](spark, two, "")
    got = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == docs.columns and sum(n for _, _, n, _ in test_substrings.brute(kept)) > 0
    for (doc, text), (_, _, n, left) in zip(kept, test_substrings.brute(kept)):
        assert got[doc]["text"] == (left if n else text) and got[doc]["n_chars"] == len(got[doc]["text"])

    four = STAGE["pii"](spark, three, "")
    masked = {r["doc_id"]: r for r in four.collect()}
    assert four.columns == docs.columns and set(masked) == set(got)
    assert masked[403]["text"].endswith("mail me: <EMAIL>") and masked[403]["n_chars"] == len(masked[403]["text"])
    assert all(masked[d]["text"] == got[d]["text"] for d in got if d != 403)

    five = STAGE["best_fit_packing"](spark, four, "").collect()
    assert sorted({r["doc_id"] for r in five}) == sorted(masked)


def test_run_and_empty_table(spark, tmp_path):
    for name, rows in (("full", table()), ("empty", [])):
        (tmp_path / name).mkdir()
        documents(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (out.count() > 0) == bool(rows)


def test_columns_that_clash(spark):
    got = STAGE["quality_rules"](spark, documents(spark, [(1, prose(random.Random(2), 60, 10**6))]), "").first()
    assert got["n_words"] == 7 and got["kept"] is None and got["key"] is None and len(words(got["text"])) == 60

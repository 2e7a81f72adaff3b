import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortflow.llm import bpe
from tests.llm.helpers import EDGE_TEXTS, documents, saved, sha

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    return lambda text: b"".join(i.to_bytes(4, "little") for i in enc.encode_ordinary(text))


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=8))
def test_matches_the_library_and_round_trips(codec, reference, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids = codec.encode([t.encode() for t in texts])
    assert ids == [reference(t) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_white_space_and_contractions(codec, reference):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "é", "日本", "'s", "'ll", "12", "!?", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(800)]
    assert codec.encode([t.encode() for t in texts]) == [reference(t) for t in texts]


def test_long_words_by_heap(codec, reference):
    rng = random.Random(2)
    words = ["a" * 3000, "".join(rng.choice("abcde0+/") for _ in range(2500))]
    assert codec.encode([w.encode() for w in words]) == [reference(w) for w in words]
    for _ in range(200):
        w = "".join(rng.choice("aethn") for _ in range(rng.randrange(1, 40)))
        assert codec.contract(w.encode()) == codec.encode_words([w.encode()])[w.encode()]


def test_cache_that_starts_anew(codec, reference, monkeypatch):
    monkeypatch.setattr(codec.cache, "most", 3)
    for k in range(5):
        texts = [f"word{k}{i} again" for i in range(6)]
        assert codec.encode([t.encode() for t in texts]) == [reference(t) for t in texts]


def test_texts_that_span_batches(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_IDS", 7)
    texts = ["", "é ß some longer text that needs several batches of ids", "x", "", "日本 again and again"]
    assert codec.decode([reference(t) for t in texts]) == [t.encode() for t in texts]


def test_unknown_id(codec):
    with pytest.raises(ValueError):
        codec.decode([(50256).to_bytes(4, "little")])


def test_query(spark, tmp_path, reference):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(1, ""), (None, "no id"), (9, "same"), (9, "same")]
    got = bpe.op1_bpe_round_trip(spark, saved(spark, rows, tmp_path)).collect()
    expected = sorted(((i, len(reference(t or "")) // 4, sha(reference(t or "")), sha(t or "")) for i, t in rows), key=repr)
    assert sorted(map(tuple, got), key=repr) == expected


def test_operators_and_empty_table(spark):
    docs = documents(spark, [(1, "some text here")])
    both = bpe.decode(bpe.encode(docs, PATH, out_col="encoded"), PATH, ids_col="encoded").first()
    assert bytes(both["decoded"]) == b"some text here" and both["n_words"] == 7
    assert bpe.encode(documents(spark, []), PATH).count() == 0

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cohortflow.llm import packing
from tests.llm.helpers import EDGE_TEXTS, documents, prose, saved

PATH = public_tokenizers.path(packing.VOCABULARY)


def ids(text):
    t = ids.tokenizer = getattr(ids, "tokenizer", None) or Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids


def test_encoder_matches_the_library():
    rng = random.Random(1)
    letters = "aB'sT llveédmRÉ!?…9²½ \n\t日本İΣσς\x1c\x85\xa0́“”—ßẞǅ_"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)] + EDGE_TEXTS
    got = packing.Encoder(PATH)(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids(t) for t in texts]


def test_encoder_takes_added_tokens_as_the_library_does():
    texts = ["<|endoftext|>", "a b<|startoftext|>c d", "é日本 <|endoftext|> x", "<|ENDOFTEXT|> x", "<|endoftext", "plain"]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(PATH)(texts)]
    assert got == [ids(t) for t in texts] and got[0] == [49407] and 49406 in got[1]


def test_best_fit_decreasing_and_bound():
    rng = np.random.default_rng(2)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        lengths = rng.integers(1, size + 1, rng.integers(0, 40))
        which, offset, fill = packing.best_fit_decreasing(lengths, size)
        assert len(fill) >= packing.lower_bound(lengths, size) >= -(-int(lengths.sum()) // size)
        for b in range(len(fill)):
            spans = sorted((o, o + n) for o, n in zip(offset[which == b].tolist(), lengths[which == b].tolist()))
            assert [s[0] for s in spans] == [0, *(s[1] for s in spans[:-1])] and spans[-1][1] == fill[b] <= size
    assert packing.lower_bound(np.array([6, 6, 6, 5, 5]), 10) == 4  # the sum alone says three


def placed_whole(rows, size):
    """Every sequence is gapless from 0 and within the size."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_rounds_exchange_documents(spark):
    rng = random.Random(3)
    lengths = [rng.randrange(1, 101) for _ in range(3000)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long")
    rows = packing.pack(pieces, size=100, part_size=200).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == list(enumerate(lengths))
    one = len(packing.best_fit_decreasing(np.array(lengths), 100)[2])
    alone = placed_whole(packing.pack(pieces, size=100, part_size=200, rounds=1).collect(), 100)
    assert one <= placed_whole(rows, 100) < alone and placed_whole(rows, 100) <= 1.02 * one


def test_query(spark, tmp_path):
    rng = random.Random(4)
    rows = list(enumerate(EDGE_TEXTS)) + [(50 + i, prose(rng, rng.randrange(1, 400))) for i in range(60)] + [(99, prose(rng, 5000)), (99, "again"), (None, "no id")]
    got = packing.op4_best_fit_packing(spark, saved(spark, rows, tmp_path)).collect()
    expected = []
    for doc, text in rows:
        x = [*ids(text), 1]
        expected += [(doc, k // 4096, k, len(x[k: k + 4096]), zlib.crc32(np.array(x[k: k + 4096], "<u4").tobytes())) for k in range(0, len(x), 4096)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(expected, key=repr)
    assert placed_whole(got, 4096) == packing.lower_bound(np.array([e[3] for e in expected]), 4096)


def test_sequences_and_empty_table(spark):
    pieces = packing.token_pieces(documents(spark, [(1, "some text"), (2, "more")]), PATH, keep_ids=True)
    row = packing.sequences(packing.pack(pieces)).first()
    joined = {tuple(np.frombuffer(bytes(row["ids"]), "<u4").tolist())}
    assert joined <= {tuple([*ids("some text"), 1, *ids("more"), 1]), tuple([*ids("more"), 1, *ids("some text"), 1])}
    assert packing.pack(packing.token_pieces(documents(spark, []), PATH)).count() == 0

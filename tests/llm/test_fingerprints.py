import hashlib
import random

import numpy as np
import pytest

from cohortflow.llm import common, fingerprints
from tests.llm import helpers

M64 = (1 << 64) - 1
STEP, NEXT = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def slow(text, k=fingerprints.K, entries=fingerprints.ENTRIES, size=fingerprints.TUPLE):
    """One text, one k-mer, one permutation at a time."""
    if not text:
        return b""
    k = min(k, len(text))
    seen, xs = {}, []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i: i + k]:
            h = (h * NEXT + ord(c)) & M64
        h = mix((h + k) & M64)
        xs.append(mix((h + seen.get(h, 0) * STEP) & M64))
        seen[h] = seen.get(h, 0) + 1
    out = b""
    for j in range(entries):
        a, b = (mix((s + 1) * STEP & M64) >> 32 for s in (j, entries + j))
        order = sorted(range(len(xs)), key=lambda i: (((xs[i] >> 32) ^ a) * (b | 1) & 0xFFFFFFFF, i))[:size]
        chosen = sorted(order + order[-1:] * (size - len(order)))
        h = 0
        for i in chosen:
            h = mix((h * NEXT + xs[i]) & M64)
        out += (h >> 48).to_bytes(2, "little")
    return out


def brute(docs):
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(rows)]
        cut = len(text) // 4
        new = text[: len(text) - cut] + after[:cut]
        like = lambda x, y: float(x == y) if not x or not y else sum(x[j: j + 2] == y[j: j + 2] for j in range(0, len(x), 2)) / (len(x) // 2)
        own, changed, following = slow(text), slow(new), slow(after)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), own.hex(), changed.hex(), like(own, changed), like(own, following)))
    return out


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    docs = [(3 * i, helpers.prose(rng, rng.randrange(1, 60), 90)) for i in range(40)] + [(1 + 3 * i, t) for i, t in enumerate(helpers.EDGE_TEXTS) if len(t or "") < 200]
    docs += [(2, "ab " * 60), (5, "ab " * 60), (8, "\U0001F600é" * 30), (None, "no id here, but a text"), (10**12, "the last one of all")]
    rng.shuffle(docs)
    got = fingerprints.op13_order_minhash(spark, helpers.saved(spark, docs, tmp_path))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs), key=str)


@pytest.mark.parametrize("docs", [[], [(1, "alone in the world")], [(1, None)], [(1, "same text twice")] * 30])
def test_small_tables(spark, tmp_path, docs):
    got = fingerprints.op13_order_minhash(spark, helpers.saved(spark, docs, tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs))


def test_batches_long_texts_and_other_parameters():
    rng = random.Random(2)
    texts = ["", "a", "abcdefgh", "x" * 3000, *(helpers.prose(rng, n, 50) for n in (1, 2, 3, 100, 700))]
    whole = [slow(t) for t in texts]
    for chunk, long in ((1 << 16, 1 << 22), (1, 1 << 22), (500, 100), (1 << 16, 1000)):
        assert fingerprints.fingerprints(texts, chunk=chunk, long=long) == whole
    assert fingerprints.fingerprints(texts, 5, 16, 3) == [slow(t, 5, 16, 3) for t in texts]


def test_likeness_falls_with_edits_and_with_parts_that_change_places():
    rng = random.Random(3)
    near = {"same": [], "edited": [], "moved": [], "other": []}
    for _ in range(40):
        words = [f"{rng.getrandbits(40):x}" for _ in range(200)]
        text = " ".join(words)
        versions = {"same": text, "edited": " ".join("zzz" if i % 40 == 0 else w for i, w in enumerate(words)), "moved": " ".join(words[100:] + words[:100]),
                    "other": " ".join(f"{rng.getrandbits(40):x}" for _ in range(200))}
        own, *others = fingerprints.fingerprints([text, *versions.values()])
        for kind, other in zip(versions, others):
            near[kind].append(fingerprints.likeness(own, other))
    mean = {k: float(np.mean(v)) for k, v in near.items()}
    assert mean["same"] == 1 and 0.7 < mean["edited"] < 1 and 0.35 < mean["moved"] < 0.6 and mean["other"] < 0.01


def test_very_long_text_in_bounded_memory():
    text = "lorem ipsum dolor sit amet " * 400_000  # 10.8 million code points, most of them in repeats
    assert len(fingerprints.fingerprints([text, text + "x"])[0]) == 2 * fingerprints.ENTRIES


def test_numbering_counts_equal_keys():
    keys = common.mix(np.random.default_rng(4).integers(0, 300, 5000).astype(np.uint64))
    seen: dict = {}
    for key, n in zip(keys.tolist(), fingerprints._numbered(keys).tolist()):
        assert n == seen.get(key, 0)
        seen[key] = n + 1

"""Quality rules: counts per text, and a verdict from the repeated substrings of its suffix array.

Symbols are the words of a text; a word of more than ``LONG_WORD`` bytes (text without spaces) is
taken apart into its code points. The suffixes of a text are sorted by prefix doubling; the common
prefix of neighbours in the order gives, for every place, the longest substring that occurs there and
elsewhere in the text too. These are the intervals of the longest-common-prefix array; the union of
their spans is the covered part of the text. Memory is a fixed number of bytes for each symbol (some
120 at the peak), also for texts that repeat one word.

A text is rejected if the base rule fails, if maximal repeats of ``min_repeat`` symbols or more
cover more than ``max_covered`` of its characters, or if its longest repeat has more than
``max_longest`` symbols and more than ``max_longest_share`` of all symbols. The base rule fails at half
of the words in repeats of three; the limits lie well under that, and a passage of the longest share
that stands twice covers less than the covered share, so each of the three can decide alone.

Edge cases: a null or empty text has no words, fails the base rule and is not kept. Rows are
judged one by one: repeated rows, null ids and further columns change nothing. Overlapping
occurrences count as repeats (``a a a`` repeats ``a a``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import common as C

MIN_REPEAT, MAX_COVERED, MAX_LONGEST, MAX_LONGEST_SHARE = 8, 0.3, 64, 0.1
LONG_WORD = 64
FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
          "n_repeat_words": "long", "base_failed": "boolean", "covered": "double",
          "longest_repeat": "long", "kept": "boolean"}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_doc(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _spread(mask: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places are covered by the spans that begin where ``mask`` is set."""
    at = np.flatnonzero(mask)
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + (lengths[at] if isinstance(lengths, np.ndarray) else lengths), -1)
    return np.cumsum(delta[:-1]) > 0


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def symbols(words: C.Words, hashes: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their document and their weight in code points."""
    long = np.flatnonzero(words.end - words.start > LONG_WORD)
    if not len(long):
        return hashes, words.doc, chars
    sym, doc, weight, a = [], [], [], 0
    for w in long.tolist():
        points = np.frombuffer(words.raw[words.start[w]: words.end[w]].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        sym += [hashes[a:w], C.mix(points.astype(C.U64) + C.U64(1 << 40))]
        doc += [words.doc[a:w], np.full(len(points), words.doc[w])]
        weight += [chars[a:w], np.ones(len(points), np.int64)]
        a = w + 1
    return tuple(np.concatenate([*x, y[a:]]) for x, y in ((sym, hashes), (doc, words.doc), (weight, chars)))


def suffix_ranks(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Place of each suffix (up to the end of its document) in the sorted order, by prefix doubling:
    only suffixes that still share their rank with another one are sorted again."""
    n = len(key)
    order = np.argsort(key)
    begin = np.flatnonzero(np.concatenate([[True], key[order[1:]] != key[order[:-1]]]))
    size = np.diff(np.append(begin, n))
    rank = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = np.repeat(begin, size)
    live, width = order[np.repeat(size > 1, size)], 1
    while len(live):
        ahead = np.minimum(live + width, n - 1)
        nxt = rank[ahead] + np.int64(1)
        nxt[(live + width >= n) | (doc[ahead] != doc[live])] = 0
        both = rank[live] * np.int64(n + 1) + nxt
        del ahead, nxt
        order = np.argsort(both)
        live, both = live[order], both[order]
        begin = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        head = both[begin] // (n + 1)
        del order, both
        group = np.concatenate([[True], head[1:] != head[:-1]])
        size = np.diff(np.append(begin, len(live)))
        rank[live] = np.repeat(head + begin - begin[group][np.cumsum(group) - 1], size)
        live = live[np.repeat(size > 1, size)]
        width *= 2
    return rank


def common_prefixes(key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many keys are equal from each pair of places (low < high) on, compared in steps that grow
    for the pairs that are left; at most about a million keys at once."""
    out, live, width = np.zeros(len(low), np.int64), np.arange(len(low)), 8
    while len(live):
        more, rows = [], max((1 << 20) // width, 1)
        for some in (live[k: k + rows] for k in range(0, len(live), rows)):
            x, y = ((p[some] + out[some])[:, None] + np.arange(width) for p in (low, high))
            unlike = (y >= len(key)) | (key[np.minimum(x, len(key) - 1)] != key[np.minimum(y, len(key) - 1)])
            ends = unlike.any(axis=1)
            out[some] += np.where(ends, unlike.argmax(axis=1), width)
            more.append(some[~ends])
        live, width = np.concatenate(more), min(width * 4, 1 << 20)
    return out


def longest_repeats(sym: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """For each place the length of the longest substring that begins there and recurs in the same
    document, or 0 if that is under ``least``.

    The common prefix of a suffix with its predecessor in the order is one less than that of the
    suffix before it in the text if the symbols before both are equal; only the others are compared
    symbol by symbol, which is n log n symbols at most. No ranks but the last are kept.
    """
    n = len(sym)
    if n < 2:
        return np.zeros(n, np.int64)
    key = C.mix(sym ^ C.mix(doc.astype(C.U64) + C.U64(1)))  # equal only within a document
    rank = suffix_ranks(key, doc)
    order = np.empty_like(rank)
    order[rank] = np.arange(n, dtype=rank.dtype)
    before = np.full(n, -1, rank.dtype)
    same = key[order[1:]] == key[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    del rank, order, same
    at = np.flatnonzero(before > 0)
    at = at[at > 0]
    follows = np.zeros(n, bool)
    follows[at] = key[at - 1] == key[before[at] - 1]
    first = np.flatnonzero((before >= 0) & ~follows)
    common = np.zeros(n, np.int64)
    common[first] = common_prefixes(key, np.minimum(first, before[first]), np.maximum(first, before[first]))
    place = np.arange(n)
    since = np.maximum.accumulate(np.where(follows, 0, place))
    common = common[since] - (place - since)
    del place, since, follows
    common[common < least] = 0
    at = np.flatnonzero(common)
    out = common.copy()
    out[before[at]] = np.maximum(out[before[at]], common[at])  # each place precedes one other at most
    return out


def judge(texts: pa.Array, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
          max_longest: int = MAX_LONGEST, max_longest_share: float = MAX_LONGEST_SHARE) -> list[np.ndarray]:
    docs = C.as_bytes(texts)
    w = C.Words(docs)
    h = w.hashes()
    n_docs, n = len(docs), len(h)
    n_words = np.diff(w.first)
    lead = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80, dtype=np.int64)])
    chars = lead[w.end] - lead[w.start]
    word_chars = _per_doc(chars, w.first) if n else np.zeros(n_docs, np.int64)
    n_symbols = _per_doc(_SYMBOL[w.buf], w.at)
    lines = np.fromiter(map(dup_lines, docs), np.int64, n_docs)
    repeat = np.zeros(n, bool)
    if n >= 3:
        at = np.flatnonzero(C.inside(w.first, 3))
        key = C.mix(C.grams(h, 3)[at] ^ C.mix(w.doc[at].astype(C.U64)))
        o = np.argsort(key, kind="stable")
        eq = key[o][1:] == key[o][:-1]
        twice = np.zeros(n, bool)
        twice[at[o[1:][eq]]] = True
        twice[at[o[:-1][eq]]] = True
        repeat = _spread(twice, 3, n)
    n_repeat = _per_doc(repeat, w.first)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    sym, doc, weight = symbols(w, h, chars)
    ell = longest_repeats(sym, doc, min_repeat)
    cover = _spread(ell > 0, ell, len(sym)) if len(sym) else np.zeros(0, bool)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    covered = _per_doc(np.where(cover, weight, 0), first) / np.maximum(word_chars, 1)
    longest = np.zeros(n_docs, np.int64)
    np.maximum.at(longest, doc, ell)
    bad = (covered > max_covered) | ((longest > max_longest) & (longest > max_longest_share * np.maximum(np.diff(first), 1)))
    return [n_words, word_chars, n_symbols, lines, n_repeat, failed, covered, longest, ~failed & ~bad]


def quality_rules(df: DataFrame, text_col: str = "text", **limits: float) -> DataFrame:
    """``df`` with the counts, ``covered`` (share of characters), ``longest_repeat`` and ``kept``."""
    return C.annotate(df, text_col, lambda x: judge(x, **limits), FIELDS)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_rules(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered", "longest_repeat")

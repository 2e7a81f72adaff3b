"""Language identification by unigram pieces, summed over all segmentations.

Pieces come from a fixed public vocabulary (a parameter). Each language has a probability for every
piece; the probability of a word is the sum over all ways to cut it into pieces, by the forward
algorithm, vectorised over words of equal length. A text's score for a language is the sum of its
words' log probabilities; the prediction is the best language, its score the posterior under equal
priors.

Learning: whole texts of a sample of about ``SAMPLE_DOCS`` documents for each language (all of them,
where a language has fewer; the bound is a parameter) are counted by word, all words go to the driver,
and expectation maximisation over all segmentations gives the probabilities. Prediction reads whole
texts of all documents.

Only text is read for a prediction. Words are a letter and the letters and combining marks after it, in
the lower-cased text. Words over ``RUN`` letters are summed letter by letter with scaled sums, in
memory bounded by the longest piece; in learning they count as runs of that length.

Edge cases: null texts, texts without letters, and all texts if nothing can be learnt, are ``und``
with score 0. Ties go to the smaller language name. Rows are judged one by one; documents without
id are not learnt from and not held out. Further columns change nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common as C

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS, ROUNDS, RUN, FLOOR = 500, 2, 32, 1e-7
CACHE_UNITS, UNKNOWN = 1_000_000, "und"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
EDGE = "▁"  # marks a word's begin in the vocabulary


def vocabulary_pieces(path: str) -> list[str]:
    """Lower-case pieces of letters, with or without the mark of a word's begin."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p and (LETTERS.fullmatch(p.removeprefix(EDGE)) or p == EDGE))


def words_of(text: str) -> list[str]:
    """Words with the mark of a word's begin."""
    return [EDGE + w for w in LETTERS.findall(text.lower())]


def runs_of(text: str) -> list[str]:
    """Words with the mark of a word's begin, in runs of at most ``RUN`` letters."""
    out = []
    for w in LETTERS.findall(text.lower()):
        out += [EDGE + w] if len(w) <= RUN else [EDGE + w[:RUN], *(w[k: k + RUN] for k in range(RUN, len(w), RUN))]
    return out


class Lattice:
    """Numbers of the pieces in words of one length: for each end and piece length one column."""

    def __init__(self, words: list[str], table: PieceTable) -> None:
        n = len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(C.U64)
        self.length, self.steps = n, []  # (begin, end, piece numbers)
        for i in range(n):
            h = np.zeros(len(words), C.U64)
            for j in range(i, min(n, i + table.longest)):
                h = h * C.U64(0xD6E8FEB86659FD93) + points[:, j] + C.U64(1)
                self.steps.append((i, j + 1, table.find(h, j == i)))
        self.steps.sort(key=lambda s: s[1])

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Words x places x languages: probability of the part before each place."""
        a = np.zeros((len(self.steps[0][2]), self.length + 1, p.shape[1]))
        a[:, 0] = 1
        for i, j, piece in self.steps:
            a[:, j] += a[:, i] * p[piece]
        return a

    def backward(self, p: np.ndarray) -> np.ndarray:
        b = np.zeros((len(self.steps[0][2]), self.length + 1, p.shape[1]))
        b[:, -1] = 1
        for i, j, piece in sorted(self.steps, key=lambda s: -s[0]):
            b[:, i] += b[:, j] * p[piece]
        return b


class PieceTable:
    """Looks pieces up by hash. Number V is "no piece", V + 1 a single letter that is no piece."""

    def __init__(self, pieces: list[str]) -> None:
        h = []
        for p in pieces:
            x = 0
            for c in p:
                x = (x * 0xD6E8FEB86659FD93 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            h.append(x)
        keys = np.array(h, C.U64)
        self.order = np.argsort(keys)
        self.keys, self.n = keys[self.order], len(pieces)
        self.longest = max(map(len, pieces), default=1)

    def find(self, h: np.ndarray, single: bool) -> np.ndarray:
        if not self.n:
            return np.full(len(h), 1 if single else 0)
        at = np.minimum(np.searchsorted(self.keys, h), self.n - 1)
        return np.where(self.keys[at] == h, self.order[at], self.n + 1 if single else self.n)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for k in range(0, len(at), 20_000):
            yield at[k: k + 20_000], [words[i] for i in at[k: k + 20_000].tolist()]


def with_unknown(p: np.ndarray) -> np.ndarray:
    """Probabilities floored, with rows for "no piece" and an unknown letter."""
    p = np.maximum(p, FLOOR)
    return np.vstack([p, np.zeros((1, p.shape[1])), np.full((1, p.shape[1]), FLOOR)])


def fit(counts: list[tuple[str, str, int]], pieces: list[str], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces x languages) from (language, word, count)."""
    langs = sorted({c[0] for c in counts})
    words = sorted({c[1] for c in counts})
    number, place = {w: i for i, w in enumerate(words)}, {g: i for i, g in enumerate(langs)}
    n = np.zeros((len(words), len(langs)))
    for g, w, k in counts:
        n[number[w], place[g]] += k
    table = PieceTable(pieces)
    p = np.full((len(pieces), len(langs)), 1.0)
    for r in range(rounds + 1):
        expected = np.zeros((len(pieces) + 2, len(langs)))
        q = with_unknown(p)
        for at, part in by_length(words):
            lattice = Lattice(part, table)
            if r:
                a, b = lattice.forward(q), lattice.backward(q)
                total = np.maximum(a[:, -1], 1e-300)
            for i, j, piece in lattice.steps:
                # at first every occurrence of a piece counts, then its share in the segmentations
                share = a[:, i] * q[piece] * b[:, j] / total if r else 1.0
                weight = n[at] * share
                for g in range(len(langs)):
                    expected[:, g] += np.bincount(piece, weights=weight[:, g], minlength=len(expected))
        p = expected[: len(pieces)] / np.maximum(expected[: len(pieces)].sum(axis=0), 1e-300)
    return langs, with_unknown(p)


class Scorer:
    """Log probabilities of units between white space, each distinct unit scored once."""

    def __init__(self, langs: list[str], p: np.ndarray, pieces: list[str]) -> None:
        self.langs, self.p, self.table = langs, p, PieceTable(pieces)
        self.keys, self.rows = np.zeros(0, C.U64), np.zeros((0, len(langs) + 1))

    def words(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)))
        few = [i for i, w in enumerate(words) if len(w) <= RUN + len(EDGE)]
        for at, part in by_length([words[i] for i in few]):
            out[np.array(few)[at]] = np.log(np.maximum(Lattice(part, self.table).forward(self.p)[:, -1], 1e-300))
        for i, w in enumerate(words):
            if len(w) > RUN + len(EDGE):
                out[i] = self.long_word(w)
        return out

    def long_word(self, word: str, part: int = 1 << 14) -> np.ndarray:
        """The forward algorithm for one word, place by place: only the sums before the last places
        that a piece can reach back to are held, scaled so that they neither vanish nor grow."""
        reach = self.table.longest
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(C.U64)
        back = np.zeros((reach, len(self.langs)))  # the sum before the k-th last place, k from 0
        back[0], log = 1.0, np.zeros(len(self.langs))
        for a in range(0, len(points), part):
            n = min(part, len(points) - a)
            piece = np.full((n, reach), self.table.n)
            for size in range(1, reach + 1):  # pieces that end in this part
                lo = max(0, a + 1 - size)
                if a + n < size:
                    break
                h = np.zeros(a + n - size - lo + 1, C.U64)
                for j in range(size):
                    h = h * C.U64(0xD6E8FEB86659FD93) + points[lo + j: lo + j + len(h)] + C.U64(1)
                piece[lo + size - 1 - a:, size - 1] = self.table.find(h, size == 1)
            for i in range(n):
                now = (back * self.p[piece[i]]).sum(axis=0)
                scale = np.maximum(now, 1e-300)
                log += np.log(scale)
                back = np.vstack([now / scale, back[:-1] / scale])
        return log

    def units(self, units: list[bytes]) -> np.ndarray:
        """Rows of log probabilities and the number of words of each unit."""
        split = [words_of(u.decode()) for u in units]
        distinct = sorted({w for ws in split for w in ws})
        number = {w: i for i, w in enumerate(distinct)}
        score = self.words(distinct)
        n = np.fromiter(map(len, split), np.int64, len(split))
        flat = np.fromiter((number[w] for ws in split for w in ws), np.int64, int(n.sum()))
        out = np.zeros((len(units), len(self.langs) + 1))
        np.add.at(out[:, :-1], np.repeat(np.arange(len(units)), n), score[flat])
        out[:, -1] = n
        return out

    def __call__(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        w = C.Words(texts)
        h, first, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_UNITS:
            self.keys, self.rows = self.keys[:0], self.rows[:0]
        at = np.searchsorted(self.keys, h)
        new = np.ones(len(h), bool)
        ok = at < len(self.keys)
        new[ok] = self.keys[at[ok]] != h[ok]
        if new.any():
            rows = self.units([w.raw[a:b] for a, b in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())])
            self.keys, self.rows = np.insert(self.keys, at[new], h[new]), np.insert(self.rows, at[new], rows, axis=0)
            at = np.searchsorted(self.keys, h)
        total = np.zeros((len(texts), len(self.langs) + 1))
        some = np.flatnonzero(np.diff(w.first))
        if len(some):
            total[some] = np.add.reduceat(self.rows[at][back], w.first[some], axis=0)
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if self.langs:
            sums = total[:, :-1]
            best = sums.argmax(axis=1)
            posterior = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            for i in np.flatnonzero(total[:, -1] > 0).tolist():
                names[i], score[i] = self.langs[best[i]], posterior[i]
        return names, score


def word_counts(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, str, int]]:
    """(language, word, count) of ``docs`` (doc_id, text, lang), sampled as the module says."""
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return []
    rate = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, min(1.0, sample_docs / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    chosen = docs.where(draw < rate[F.col("lang")]).select("text", "lang")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()

        def flush() -> pa.RecordBatch:
            langs, words = zip(*count)
            out = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(count.values()), pa.int64())], names=["lang", "word", "n"])
            count.clear()
            return out

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count.update((lang, w) for w in runs_of(text))
                if len(count) > 300_000:
                    yield flush()
        if count:
            yield flush()

    counted = chosen.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in counted.collect()]  # the words of the sample


_SCORERS: dict[bytes, Scorer] = {}


def identify(df: DataFrame, langs: list[str], p: np.ndarray, pieces: list[str], text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``."""
    tag = p.tobytes()[:4096] + repr((langs, len(pieces), float(p.sum()))).encode()

    def run(texts: pa.Array) -> list:
        if tag not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[tag] = Scorer(langs, p, pieces)
        return list(_SCORERS[tag](C.as_bytes(texts)))

    return C.annotate(df, text_col, run, {"lang_pred": "string", "score": "double"})


def learn_and_identify(docs: DataFrame, train: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    pieces = vocabulary_pieces(vocabulary)
    langs, p = fit(word_counts(train.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")), pieces)
    return identify(docs, langs, p, pieces, text_col)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    train = docs.where(~held_out).select("doc_id", "text", "lang")
    return learn_and_identify(rows, train, public_tokenizers.path(VOCABULARY)).drop("text")

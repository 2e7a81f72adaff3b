"""Byte-level byte-pair encoding and decoding as DuckDB queries inside each task.

Spark deals the rows; each task holds one DuckDB connection with the merge table of the vocabulary
(which two tokens give which third one) and the table of token bytes. Texts are cut into matches of
the splitting pattern; the distinct matches that the task has not met yet become rows (word,
position, token), at first one for each byte. A recursive query joins neighbouring positions with
the merge table, contracts the leftmost pair of least rank of every word, and ends a word when it
has no pair left. Decoding joins ids with the token bytes and aggregates them in order of position.

The rows of the recursion grow with the square of a word's length. Batches are cut by that, and
words of more than ``LONG_WORD`` bytes are contracted by the same rule with a heap instead.

Edge cases: null is the empty text, without ids. Rows are encoded one by one, so repeated rows, null
ids and further columns change nothing. Strings of special tokens are ordinary text. An id that the
vocabulary lacks fails the decoding, as in the tokenizer's own library.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import common as C

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Units kept in a task; bytes and squared lengths of the words in one query; ids in one; longest word.
CACHE_UNITS, BATCH_BYTES, BATCH_SQUARES, BATCH_IDS, LONG_WORD, MEMORY = 2_000_000, 1 << 20, 6 << 20, 1 << 20, 1024, "300MB"
#: White space other than the six ASCII characters, where a text can't be cut before the pattern runs.
OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

ENCODE = """
WITH RECURSIVE state(word, place, token, ended) AS (
  SELECT word, place, token, false FROM letters
  UNION ALL
  (WITH pair AS (
     SELECT a.word, a.place, m.merged
     FROM state a
     JOIN state b ON b.word = a.word AND b.place = a.place + 1
     JOIN merges m ON m.pair = ((a.token::BIGINT << 32) | b.token)
     WHERE NOT a.ended),
   best AS (SELECT word, min((merged::BIGINT << 32) | place) AS x FROM pair GROUP BY word),
   choice AS (SELECT word, (x & 4294967295)::INTEGER AS place, (x >> 32)::INTEGER AS merged FROM best)
   SELECT s.word,
          s.place - (c.place IS NOT NULL AND s.place > c.place)::INTEGER,
          CASE WHEN s.place = c.place THEN c.merged ELSE s.token END,
          c.place IS NULL
   FROM state s LEFT JOIN choice c ON c.word = s.word
   WHERE NOT s.ended AND (c.place IS NULL OR s.place <> c.place + 1)))
SELECT word, token FROM state WHERE ended ORDER BY word, place
"""
DECODE = "SELECT doc, list(bytes ORDER BY place) AS parts FROM ids JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one vocabulary, with a DuckDB connection of its own."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        pairs = {(self.ranks[t[:k]], self.ranks[t[k:]]): i for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks}
        self.merge = pairs
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = max(self.ranks.values()) + 1
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self._table("merges", pair=pa.array([a << 32 | b for a, b in pairs], pa.int64()), merged=pa.array(pairs.values(), pa.int32()))
        self._table("vocabulary", id=pa.array(self.ranks.values(), pa.int32()), bytes=pa.array(self.ranks, pa.binary()))
        self.cache = C.IdCache(self.encode_units, CACHE_UNITS)

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS FROM given")
        self.db.unregister("given")

    def _ask(self, name: str, table: pa.Table, query: str) -> pa.Table:
        self.db.register(name, table)
        out = self.db.sql(query).to_arrow_table()
        self.db.unregister(name)
        return out

    # ---- words -> ids

    def contract(self, word: bytes) -> bytes:
        """Ids of one long word by a heap: the leftmost pair of least rank first."""
        token, nxt, prev = self.byte[np.frombuffer(word, np.uint8)].tolist(), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap = [(m, i, token[i], token[i + 1]) for i in range(len(word) - 1) if (m := self.merge.get((token[i], token[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if token[i] != a or j >= len(word) or token[j] != b:
                continue  # one of the two is gone
            token[i], token[j] = m, -1
            nxt[i] = nxt[j]
            if nxt[i] < len(word):
                prev[nxt[i]] = i
            for x, y in ((prev[i], i), (i, nxt[i])):
                if x >= 0 and y < len(word) and (k := self.merge.get((token[x], token[y]))) is not None:
                    heapq.heappush(heap, (k, x, token[x], token[y]))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def _batches(self, words: list[bytes]) -> Iterator[list[bytes]]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        part = np.maximum(np.cumsum(size) // BATCH_BYTES, np.cumsum(size * size) // BATCH_SQUARES)
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)]):
            yield words[a:b]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {w: self.contract(w) for w in words if len(w) > LONG_WORD}
        for batch in self._batches(sorted((w for w in words if len(w) <= LONG_WORD), key=len)):
            if not batch:
                continue
            n = np.fromiter(map(len, batch), np.int64, len(batch))
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            letters = pa.table({"word": pa.array(np.repeat(np.arange(len(n)), n), pa.int32()), "place": pa.array(place, pa.int32()),
                                "token": pa.array(self.byte[np.frombuffer(b"".join(batch), np.uint8)])})
            got = self._ask("letters", letters, ENCODE)
            data = got["token"].to_numpy().astype("<u4").tobytes()
            ends = (np.cumsum(np.bincount(got["word"].to_numpy(), minlength=len(n))) * 4).tolist()
            out.update(zip(batch, (data[a:b] for a, b in zip([0, *ends], ends))))
        return out

    def encode_units(self, units: list[bytes]) -> list[bytes]:
        split = [[m.encode() for m in self.pattern.findall(u.decode())] for u in units]
        ids = self.encode_words(list({m for parts in split for m in parts}))
        return [b"".join([ids[m] for m in parts]) for parts in split]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        odd = [i for i, t in enumerate(texts) if OTHER_SPACE.search(t)]
        w = C.Words([b"" if OTHER_SPACE.search(t) else t for t in texts] if odd else texts)
        start, end, first = w.units()
        ids, size = self.cache.ids(C.span_hashes(w.buf, start, end), w.raw, start, end)
        data, ends = ids.tobytes(), (np.concatenate([[0], np.cumsum(size)])[first] * 4).tolist()
        out = [data[a:b] for a, b in zip(ends, ends[1:])]
        for i, x in zip(odd, self.encode_units([texts[i] for i in odd]) if odd else []):
            out[i] = x
        return out

    # ---- ids -> bytes

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        n = np.fromiter(map(len, texts), np.int64, len(texts)) // 4
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        if not len(ids):
            return [b""] * len(texts)
        doc = np.repeat(np.arange(len(texts)), n)
        data, sizes = [], []
        for a in range(0, len(ids), BATCH_IDS):  # a text may go on in the next batch: bytes just follow
            part = ids[a: a + BATCH_IDS]
            got = self._ask("ids", pa.table({"doc": pa.array(doc[a: a + BATCH_IDS], pa.int32()), "place": pa.array(np.arange(len(part))), "id": pa.array(part, pa.int64())}), DECODE)
            flat = got["parts"].combine_chunks().flatten().cast(pa.large_binary())
            if len(flat) != len(part):
                raise ValueError("an id is not in the vocabulary")
            at = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset: flat.offset + len(flat) + 1]
            data.append(flat.buffers()[2].to_pybytes()[at[0]: at[-1]])
            sizes.append(np.diff(at))
        joined = b"".join(data)
        cuts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])[np.concatenate([[0], np.cumsum(n)])].tolist()
        return [joined[a:b] for a, b in zip(cuts, cuts[1:])]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(df: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of each text, as little-endian unsigned 32-bit integers."""
    return C.annotate(df, text_col, lambda x: [codec(vocabulary, pattern).encode(C.as_bytes(x))], {out_col: "binary"})


def decode(df: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for."""
    return C.annotate(df, ids_col, lambda x: [codec(vocabulary, pattern).decode(C.as_bytes(x))], {out_col: "binary"})


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def both_ways(texts: pa.Array) -> list[list]:
        c = codec(path, pattern)
        ids = c.encode(C.as_bytes(texts))
        return [[len(x) // 4 for x in ids], list(map(digest, ids)), list(map(digest, c.decode(ids)))]

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.annotate(docs, "text", both_ways, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}).drop("text")

"""Best-fit packing with certified bin counts.

Documents are tokenised once (the vocabulary file is a parameter) and cut into pieces of at most
``SIZE`` tokens. Pieces are dealt to partitions of about ``PART`` pieces; each packs its own by
best-fit decreasing and gets lower bounds on its bin count from dual feasible functions. A bin is
settled if it is full, or if its partition is certified (its bins are as many as the bound) and the
bin is not among its open ones. The documents of all other bins are exchanged: they are dealt anew to
fewer partitions, which run best-fit decreasing again, until one partition packs the rest or a
round brings nothing. Every piece is placed exactly once, whatever the rounds do.

Tokens: no token crosses white space, so each distinct word between white space is encoded once and
kept, up to a bound, for all texts of a task. Only texts in plain Latin letters and punctuation take this way, where lower case and
normalisation of Python and of the tokenizer agree; any other text, and one that holds the string of
an added token (``<|endoftext|>``), is encoded by the tokenizer whole, with the library's defaults.

Edge cases: null is the empty text, one piece that holds only the end id. Repeated rows and null ids
are documents of their own. An empty table gives no sequences.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common as C

SIZE, END_ID, PART, ROUNDS, OPEN_SHARE, CACHE_WORDS = 4096, 1, 200_000, 8, 0.01, 1_500_000
VOCABULARY = "word_bpe_49k.json"

# Fixed value: the pattern in the vocabulary file, which has \p{L}, \p{N} and neither, for the usual
# characters below.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Anything but these (printable ASCII, usual white space, Latin letters
#: without dotted I, typographic marks; no raised digits or fractions).
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else
    the next free one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.cache = C.IdCache(self.words, CACHE_WORDS)

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of lower-case words without white space: the model on each match of the pattern."""
        split = list(map(SPLIT.findall, map(bytes.decode, words)))
        ids = {}
        for t in {t for tokens in split for t in tokens}:
            parts = self.tokenizer.model.tokenize(t if t.isascii() else t.encode().decode("latin-1").translate(self.letters))
            ids[t] = struct.pack(f"<{len(parts)}I", *[p.id for p in parts])
        return [b"".join([ids[t] for t in tokens]) for tokens in split]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        lower = ["" if not t or UNUSUAL.search(t) else t.lower() for t in texts]
        odd = {i for i, (t, x) in enumerate(zip(texts, lower)) if t and (not x or any(a in x for a in self.added))}
        plain = C.Words([b"" if i in odd else x.encode() for i, x in enumerate(lower)])
        ids, size = self.cache.ids(plain.hashes(), plain.raw, plain.start, plain.end)
        data, ends = ids.tobytes(), np.concatenate([[0], np.cumsum(size)])[plain.first] * 4
        out = [data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
        for i in odd:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                 end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, n_tokens) and, on request, the ids of each piece."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for part in C.slices(batch, 1, 2 * C.SLICE_BYTES):
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids += end
                    for k in range(0, len(ids), 4 * size):
                        x = ids[k: k + 4 * size]
                        rows.append((doc, k // (4 * size), k // 4, len(x) // 4, zlib.crc32(x), x if keep_ids else None))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    out = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if keep_ids else out.drop("ids")


# ---- packing ---------------------------------------------------------------------------------

def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and the fill of each bin."""
    n = len(lengths)
    which, offset, fill = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    rooms: list[list[int]] = [[] for _ in range(size + 1)]  # bins by free room
    mask = 0  # bit r: some bin has room r
    order = np.argsort(-lengths, kind="stable")
    for i, x in zip(order.tolist(), lengths[order].tolist()):
        if fits := mask >> x:
            room = x + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            b, room = len(fill), size
            fill.append(0)
        which[i], offset[i] = b, size - room
        fill[b] = size - room + x
        rooms[room - x].append(b)
        mask |= 1 << (room - x)
    return which, offset, np.array(fill, np.int64)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs: the best of the dual feasible functions
    x -> [x > C-e] * C + [e <= x <= C-e] * x (e up to C/2) and
    x -> x if (k+1)x/C is whole, else floor((k+1)x/C) * C/k (k up to 32)."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1)[: size + 1].astype(np.int64)
    n, total = np.cumsum(count), np.cumsum(count * np.arange(size + 1))
    e = np.arange(1, size // 2 + 1)
    best = int(((n[size] - n[size - e]) * size + total[size - e] - total[e - 1]).max(initial=0))
    best = max(best, int(total[size]))
    out = -(-best // size)
    x = np.arange(size + 1)
    for k in range(1, 33):
        whole = (k + 1) * x % size == 0
        # values times k, so that they stay whole numbers
        value = np.where(whole, k * x, (k + 1) * x // size * size)
        out = max(out, -(-int((count * value).sum()) // (k * size)))
    return out


def pack_partition(table: pa.Table, size: int, round_no: int, last: bool) -> pa.Table:
    lengths = table["length"].to_numpy().astype(np.int64)
    which, offset, fill = best_fit_decreasing(lengths, size)
    certified = len(fill) == lower_bound(lengths, size)
    open_bins = fill < size * (1 - OPEN_SHARE) if certified else fill < size
    settled = np.ones(len(fill), bool) if last else ~open_bins
    part = table["part"][0].as_py()
    number = (np.int64(round_no) << np.int64(58)) + (np.int64(part) << np.int64(32)) + which
    rest = table.drop_columns(["part", "sequence_id", "offset", "settled"])
    return (rest.append_column("part", pa.array(np.full(len(which), part), pa.int64())).append_column("sequence_id", pa.array(number, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64())).append_column("settled", pa.array(settled[which], pa.bool_())))


def packer(size: int, round_no: int, last: bool):
    return lambda table: pack_partition(table, size, round_no, last)


def pack(pieces: DataFrame, size: int = SIZE, part_size: int = PART, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (with ``length``, at most ``size``) with ``sequence_id`` and ``offset``."""
    columns = pieces.columns
    rest = C.stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    n, done = rest.count(), None
    for k in range(rounds):
        parts = max(1, math.ceil(n / part_size))
        last = parts == 1 or k == rounds - 1
        # every round deals anew, so documents of different partitions meet
        dealt = (rest.withColumn("part", F.pmod(F.xxhash64("row", F.lit(k)), F.lit(parts)).cast("long"))
                 .withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).withColumn("settled", F.lit(False)))
        schema = dealt.drop("part", "sequence_id", "offset", "settled").schema
        for f in ("part", "sequence_id", "offset", "settled"):
            schema = schema.add(dealt.schema[f].name, dealt.schema[f].dataType)
        placed = dealt.groupBy("part").applyInArrow(packer(size, k, last), schema)
        if last:
            out = placed.select(*columns, "sequence_id", "offset")
            return out if done is None else done.unionByName(out)
        placed = C.stored(placed, "packed")
        settled = placed.where("settled").select(*columns, "sequence_id", "offset")
        done = settled if done is None else done.unionByName(settled)
        rest = placed.where(~F.col("settled")).select(*columns, "row")
        left = rest.count()
        if left >= n:
            rounds = k + 2  # nothing settled: the next round is the last
        n = left
    return done


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, ids): packed sequences of placed pieces that keep their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most SIZE pieces
    x = placed.groupBy("sequence_id").agg(parts.alias("p"))
    return x.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.expr("aggregate(p, X'', (a, y) -> concat(a, y.ids))").alias("ids"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    pieces = token_pieces(docs, public_tokenizers.path(VOCABULARY))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

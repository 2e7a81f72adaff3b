"""Helpers shared by the operators: reading tables, Arrow batches, words and hashes.

A *word* is a maximal run of bytes other than space, tab, LF, VT, FF and CR. Words are found and
hashed with numpy over a whole slice of documents at once, so Python never loops over words.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task handles at a time (a longer single text is handled alone).
SLICE_BYTES = 2 << 20

U64 = np.uint64
_DDL = {"long": (T.LongType(), pa.int64()), "int": (T.IntegerType(), pa.int32()),
        "double": (T.DoubleType(), pa.float64()), "string": (T.StringType(), pa.string()),
        "boolean": (T.BooleanType(), pa.bool_()), "binary": (T.BinaryType(), pa.binary())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the session names in ``spark.checkpoint.dir``. Only a
    session without executors of its own (master ``local``) may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="cohortflow-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, and a lost
    executor costs no recomputation of what came before."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    import gc
    import time

    for _ in range(2):  # what the first collection frees lets the second one free more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def annotate(df: DataFrame, text_col: str, fn: Callable[[pa.Array], Sequence], fields: dict[str, str],
             limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` with further columns that ``fn`` computes from the text column, slice by slice.

    ``fn`` gets the Arrow array of texts and returns one sequence or array per field. All other
    columns pass through; one that has the name of a new field is replaced.
    """
    keep = [c for c in df.columns if c not in fields]
    if text_col not in keep:
        raise ValueError(f"the text column {text_col!r} has the name of a result column")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(k, _DDL[v][0]) for k, v in fields.items()])
    at, kinds, names = keep.index(text_col), [_DDL[v][1] for v in fields.values()], [*keep, *fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, limit):
                new = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(fn(part.column(at)), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is the empty text."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


# ---- hashes and words --------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_POW = [np.ones(0, U64), np.ones(0, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        n = max(n, 1 << 16)
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(n, b, U64)
            x[0] = 1
            _POW[k] = np.cumprod(x, dtype=U64)
    return _POW[0], _POW[1]


class Words:
    """The words of several documents: positions in one buffer, and a 64-bit hash of each.

    ``first[d]:first[d + 1]`` are the words of document ``d``; ``start``/``end`` are byte places in
    ``buf``, where document ``d`` lies from ``at[d]`` to ``at[d + 1] - 1``.
    """

    def __init__(self, docs: Sequence[bytes], lower: bool = False) -> None:
        self.raw = b" ".join([*docs, b""])
        buf = np.frombuffer(self.raw, np.uint8)
        self.buf = _LOWER[buf] if lower else buf
        sizes = np.fromiter((len(d) + 1 for d in docs), np.int64, len(docs))
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        word = np.zeros(len(buf) + 2, np.int8)
        word[1:-1] = ~_SPACE[buf]
        step = np.diff(word)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.start, self.at)
        self.doc = np.repeat(np.arange(len(docs)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)

    def units(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents cut behind each word: every word with the white space before it, and white
        space at a document's end. Starts, ends, and the first unit of each document."""
        n = np.diff(self.first)
        start = self.end[np.arange(len(self.start)) - 1] if len(self.start) else self.start
        some = np.flatnonzero(n)
        start = start.copy()
        start[self.first[some]] = self.at[some]
        last = self.at[:-1].copy()
        last[some] = self.end[self.first[some + 1] - 1]
        tail = np.flatnonzero(last < self.at[1:] - 1)
        starts, ends = np.concatenate([start, last[tail]]), np.concatenate([self.end, self.at[tail + 1] - 1])
        o = np.argsort(starts, kind="stable")
        return starts[o], ends[o], np.searchsorted(starts[o], self.at)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; the spans ascend and do not overlap."""
    out = np.empty(len(start), U64)
    a = 0
    while a < len(out):  # in parts, so that the temporary arrays stay small for a huge text
        b = max(a + 1, int(np.searchsorted(end, start[a] + (1 << 20), "right")))
        lo, hi = int(start[a]), int(end[b - 1])
        p, q = _powers(hi - lo)
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[buf[lo:hi]] * p[: hi - lo], out=total[1:])
        s, e = start[a:b] - lo, end[a:b] - lo
        out[a:b] = (total[e] - total[s]) * q[s] + (e - s).astype(U64)
        a = b
    return mix(out)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes (those that cross documents too; see `inside`)."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, U64)
    for j in range(k):
        out *= U64(0xD6E8FEB86659FD93)
        out += words[j: j + n]
    return mix(out)


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Which runs of ``k`` words lie within one document (``first`` as in `Words`)."""
    n = int(first[-1]) if len(first) else 0
    ok = np.ones(max(0, n - k + 1), bool)
    for j in range(1, k):
        cut = first[1:-1] - j
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return ok


def partitions_for(df: DataFrame, least: int = 1) -> int:
    """A partition count that grows with the input: two for each input partition."""
    conf = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, conf, 2 * df.rdd.getNumPartitions())


class IdCache:
    """Token ids of units (words, or words with the white space before them), each distinct unit
    encoded once. Units are told apart by their 64-bit hash; the cache starts anew above ``most``
    units, so memory is bounded whatever the texts hold."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], most: int) -> None:
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.flat = np.zeros(0, U64), np.zeros(0, "<u4")
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, hashes: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after the other, and how many each unit has."""
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        ok = at < len(self.keys)
        new[ok] = self.keys[at[ok]] != keys[ok]
        if new.any():
            units = [raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())]
            got = self.encode(units)
            size = np.fromiter(map(len, got), np.int64, len(got)) // 4
            self.start = np.insert(self.start, at[new], len(self.flat) + np.cumsum(size) - size)
            self.size = np.insert(self.size, at[new], size)
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(got), "<u4")])
            at = np.searchsorted(self.keys, keys)
        size = self.size[at][back]
        skip = self.start[at][back] - (np.cumsum(size) - size)
        return self.flat[np.repeat(skip, size) + np.arange(int(size.sum()))], size

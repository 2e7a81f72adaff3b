"""Document fingerprints by Order MinHash, and their likeness to edited and neighbouring texts.

The k-mers of a text (runs of ``K`` code points) are numbered by occurrence, so equal ones differ.
For each of ``ENTRIES`` permutations the ``TUPLE`` smallest are selected and hashed *in the order in
which they stand in the text*; 16 bits of that hash are one entry of the fingerprint. The share of
equal entries estimates how alike two texts are; it falls with edits, and with parts that change
places, since the same k-mers in another order make other tuples.

Documents are range-partitioned by id once, with their texts; a document's next one then stands
behind it in the same partition, and only the last document of a partition meets the first one of
the next partition by a join. Rows with one id that are a third of the table are spread by row.

Selection: only k-mers below a bound that about eight of a text pass are sorted; a text with too few
is sorted whole. Texts over ``LONG`` code points are worked off by ranges of k-mer hashes, so memory
stays bounded.

Edge cases: null text is empty; an empty text has the empty fingerprint, like an empty one with 1
and any other with 0. A text shorter than ``K`` is one k-mer. Rows of the same id are ordered by a
hash of their text; rows without id come first. A single document is its own next one. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm import common as C

K, ENTRIES, TUPLE = 6, 64, 2
#: Code points handled at once; those of a text that is worked off by ranges; k-mers expected below the bound.
CHUNK, LONG, EXPECTED = 1 << 17, 1 << 22, 8

_U = np.uint64
_STEP, _NEXT, _DOC = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(0xC2B2AE3D27D4EB4F)
_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _seeds(entries: int) -> tuple[np.ndarray, np.ndarray]:
    x = C.mix(np.arange(1, 2 * entries + 1, dtype=_U) * _STEP) >> _U(32)
    return x[:entries].astype(np.uint32), x[entries:].astype(np.uint32) | np.uint32(1)


def _kmers(points: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` code points from each place on."""
    h = np.zeros(max(0, len(points) - k + 1), _U)
    for j in range(k):
        h *= _NEXT
        h += points[j: j + len(h)]
    return C.mix(h + _U(k))


def _numbered(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each key."""
    n = np.zeros(len(keys), _U)
    bits = max(4, (4 * len(keys)).bit_length())
    bucket = (keys >> _U(64 - bits)).astype(np.int64)
    some = np.flatnonzero(np.bincount(bucket, minlength=1 << bits)[bucket] > 1)
    o = some[np.argsort(keys[some], kind="stable")]
    if len(o):
        new = np.concatenate([[True], keys[o[1:]] != keys[o[:-1]]])
        i = np.arange(len(o))
        n[o] = i - np.maximum.accumulate(np.where(new, i, 0))
    return n


def _entry(x: np.ndarray) -> np.ndarray:
    """16 bits for each row of k-mers in text order."""
    h = np.zeros(len(x), _U)
    for j in range(x.shape[1]):
        h = C.mix(h * _NEXT + x[:, j])
    return (h >> _U(48)).astype("<u2")


def _set(mask: np.ndarray) -> np.ndarray:
    """Places of the few true values of a mask, eight looked at together."""
    some = np.flatnonzero(mask.view(_U))
    i, j = np.nonzero(mask.reshape(-1, 8)[some])
    return some[i] * 8 + j


def _batch(texts: list[str], k: int, entries: int, size: int) -> np.ndarray:
    """Fingerprints of texts that are not empty: one row each."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum(n) - n
    count = np.maximum(n - k + 1, 1)
    doc = np.repeat(np.arange(len(n)), count)
    start = np.cumsum(count) - count
    at = first[doc] + np.arange(len(doc)) - start[doc]
    h = np.zeros(len(points), _U)
    whole = _kmers(points, k)
    h[: len(whole)] = whole
    for d in np.flatnonzero(n < k).tolist():
        h[first[d]] = _kmers(points[first[d]: first[d] + n[d]], int(n[d]))[0]
    x = h[at]
    x = C.mix(x + _numbered(C.mix(x + doc.astype(_U) * _DOC)) * _STEP)
    x32, need = (x >> _U(32)).astype(np.uint32), np.minimum(count, size)
    bound = np.minimum(EXPECTED * 2.0**32 / count, 2.0**32 - 1).astype(np.uint32)[doc]
    v, under = np.empty_like(x32), np.zeros(-(-len(x32) // 8) * 8, bool)
    places, keys = [], []
    for j, (a, b) in enumerate(zip(*_seeds(entries))):
        np.multiply(np.bitwise_xor(x32, a, out=v), b, out=v)
        np.less_equal(v, bound, out=under[: len(v)])
        c = _set(under)
        few = np.bincount(doc[c], minlength=len(n)) < need
        if few.any():
            c = np.flatnonzero(under[: len(v)] | few[doc])
        places.append(c)
        keys.append(((doc[c] + j * len(n)) << 32) | v[c])
    key, place = np.concatenate(keys), np.concatenate(places)
    o = np.argsort(key, kind="stable")
    head = np.searchsorted(key[o] >> 32, np.arange(entries * len(n))).reshape(entries, len(n)).T
    pick = np.minimum(np.arange(size)[None, :], (need - 1)[:, None])
    chosen = np.sort(place[o[head[:, :, None] + pick[:, None, :]]], axis=2)
    return _entry(x[chosen.reshape(-1, size)]).reshape(len(n), entries)


def _long(text: str, k: int, entries: int, size: int, piece: int) -> np.ndarray:
    """The fingerprint of one long text, by ranges of k-mer hashes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ranges = -(-len(points) // piece)
    best: list[list[tuple]] = [[] for _ in range(entries)]
    seeds = list(zip(*_seeds(entries)))
    for r in range(ranges):
        at, xs = [], []
        for a in range(0, len(points) - k + 1, piece):
            h = _kmers(points[a: a + piece + k - 1], k)
            own = np.flatnonzero((h >> _U(32)) * _U(ranges) >> _U(32) == _U(r))
            at.append(own + a)
            xs.append(h[own])
        place, x = np.concatenate(at), np.concatenate(xs)
        if not len(x):
            continue
        x = C.mix(x + _numbered(C.mix(x)) * _STEP)
        x32 = (x >> _U(32)).astype(np.uint32)
        for j, (a, b) in enumerate(seeds):
            v = (x32 ^ a) * b
            c = np.flatnonzero(v <= np.partition(v, min(size, len(v)) - 1)[min(size, len(v)) - 1])
            best[j] = sorted([*best[j], *zip(v[c].tolist(), place[c].tolist(), x[c].tolist())])[:size]
    chosen = [[x for _, _, x in sorted(rows, key=lambda y: y[1])] for rows in best]
    return _entry(np.array(chosen, _U))[None, :]


def fingerprints(texts: list[str], k: int = K, entries: int = ENTRIES, size: int = TUPLE, chunk: int = CHUNK, long: int = LONG) -> list[bytes]:
    """Fingerprint of each text, empty for an empty one."""
    out = [b""] * len(texts)
    held, points = [], 0

    def flush() -> None:
        nonlocal held, points
        for i, row in zip(held, _batch([texts[i] for i in held], k, entries, size) if held else ()):
            out[i] = row.tobytes()
        held, points = [], 0

    for i, text in enumerate(texts):
        if len(text) > max(long, k):
            out[i] = _long(text, k, entries, size, long)[0].tobytes()
        elif text:
            held.append(i)
            points += len(text)
            if points >= chunk:
                flush()
    flush()
    return out


def likeness(x: bytes, y: bytes) -> float:
    """Share of equal entries."""
    if not x or not y:
        return float(x == y)
    return float(np.mean(np.frombuffer(x, "<u2") == np.frombuffer(y, "<u2")))


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``after``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


def _rows(ids: list, texts: list[str], prints: list[bytes], after: list[str], after_prints: list[bytes]) -> list[list]:
    changed = [edited(t, a) for t, a in zip(texts, after)]
    new = fingerprints(changed)
    return [ids, [len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], [p.hex() for p in prints], [p.hex() for p in new],
            [likeness(p, q) for p, q in zip(prints, new)], [likeness(p, q) for p, q in zip(prints, after_prints)]]


def neighbour_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of all documents (doc_id, text), of their edited texts, and both likenesses."""
    names = [x.split()[0] for x in _COLUMNS.split(", ")]
    kinds = [C._DDL[x.split()[1]][1] for x in _COLUMNS.split(", ")]
    schema = f"{_COLUMNS}, pid int, edge int, text string"

    def batch(columns: list[list], pid: int, edge: int, texts: list[str | None]) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds)), pa.array([pid] * n, pa.int32()), pa.array([edge] * n, pa.int32()), pa.array(texts, pa.string())], names=[*names, "pid", "edge", "text"])

    def outer(pid: int, edge: int, i, text: str, own: bytes) -> pa.RecordBatch:
        return batch([[i], [len(text)], [None], [own.hex()], [None], [None], [None]], pid, edge, [text])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Complete rows (edge 0); the last row of the partition (1) and a copy of its first (2), with text."""
        held: tuple[list, list, list] = ([], [], [])
        pid = None
        for b in batches:
            for part in C.slices(b, 1, 1 << 20):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids, prints = [*held[0], *part.column(0).to_pylist()], [*held[2], *fingerprints(texts)]
                texts = [*held[1], *texts]
                if pid is None:
                    pid = part.column(2)[0].as_py()
                    yield outer(pid, 2, ids[0], texts[0], prints[0])
                yield batch(_rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:]), pid, 0, [None] * (len(ids) - 1))
                held = ids[-1:], texts[-1:], prints[-1:]
        if pid is not None:
            yield outer(pid, 1, held[0][0], held[1][0], held[2][0])

    def join_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in C.slices(b, 1, 1 << 20):
                ids, texts, prints, after, after_prints = part.to_pydict().values()
                rows = _rows(ids, texts, [bytes.fromhex(p) for p in prints], after, [bytes.fromhex(p) for p in after_prints])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=names)

    order = [F.asc_nulls_first("doc_id"), F.asc("text_hash"), F.asc("row")]
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    dealt = docs.repartitionByRange(C.partitions_for(documents), *order).sortWithinPartitions(*order)
    found = C.stored(dealt.select("doc_id", "text", F.spark_partition_id().alias("pid")).mapInArrow(run, schema), "fingerprints")
    heads = found.where("edge = 2").select(F.col("pid").alias("next"), F.col("text").alias("after"), F.col("fingerprint").alias("after_print"))
    all_pids = Window.orderBy("next")  # one row a partition
    following = heads.select("next").select(F.col("next").alias("pid"), F.coalesce(F.lead("next").over(all_pids), F.min("next").over(all_pids)).alias("next"))
    last = found.where("edge = 1").select("pid", "doc_id", "text", "fingerprint").join(following, "pid").join(heads, "next")
    joined = last.select("doc_id", "text", "fingerprint", "after", "after_print").mapInArrow(join_up, _COLUMNS)
    return found.where("edge = 0").select(*names).union(joined)


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents``, and how alike they are to their edited and next texts."""
    return neighbour_fingerprints(C.table(spark, sf_dir, "documents"))

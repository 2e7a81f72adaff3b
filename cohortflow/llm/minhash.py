"""Near-duplicate groups by b-bit MinHash, with every link confirmed on the full shingle sets.

1. Each text gives its set of distinct 5-word shingles, ``HASHES`` minima, one hash for each band of
   ``ROWS`` minima, and the lowest ``BITS`` bits of each minimum packed into four longs.
2. Texts with equal sets (equal count and 128-bit digest) form a class; classes go on alone.
3. Classes that share a band are candidates. Instead of all pairs of a band's bucket, each member is
   first paired with the bucket's most central member - the one whose buckets hold most in total,
   which among copies is their original. The similarity of a pair is estimated by counting equal
   b-bit values (one XOR and bit count for each long), corrected for chance agreement of 2**-BITS;
   pairs that may reach the threshold are confirmed on the sets of their whole texts.
4. The links found so far give components. Two members of a bucket have its centre in common, so
   every candidate pair lies among the members of one centre. Where these belong to several
   components, the members outside the largest one meet all others in packed blocks of ``BLOCK``
   texts: within a pair of blocks the estimates are a matrix, only pairs of different components
   that may reach the threshold are confirmed on their sets, and only confirmed links become rows.
   So no link between different components stays unseen, and no pair that fails is ever a row.
5. Components of all links; the smallest id of a component names it.

A pair of similarity 0.75 shares no band with probability (1 - 0.75**4)**32, about 5e-6, and is
estimated too low to be confirmed with probability of about 1e-7.

Edge cases: null, empty and wordless texts have the empty set and are linked with nothing. A text of
fewer than five words has its whole word sequence as its one shingle. Repeated rows are rows of one
class, and each of them has the class's verdict. Rows without id are linked like any other; a
component's id is null if none of its rows has one, and then the rows of its first class are kept.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common as C
from cohortflow.llm.components import components

SHINGLE, HASHES, ROWS, BITS, PERCENT = 5, 128, 4, 2, 75
BANDS = HASHES // ROWS
BLOCK, BLOCK_BYTES = 256, 8 << 20
#: Equal b-bit values from which a pair is confirmed on the full sets: five deviations under the
#: 104 that a pair of similarity 0.75 has on average.
LEAST_EQUAL = 81
SIGNATURE = [f"s{i}" for i in range(HASHES * BITS // 64)]

_SEED = C.mix(np.arange(1, 2 * HASHES + 1, dtype=C.U64) * C.U64(0x9E3779B97F4A7C15))
_XOR, _MULTIPLY = _SEED[:HASHES], _SEED[HASHES:] | C.U64(1)


def shingle_sets(docs: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ordered by document and value, and the place where each
    document's set begins (with the end at last)."""
    w = C.Words(docs, lower=True)
    h = w.hashes()
    n = np.diff(w.first)
    if len(h) >= k:
        ok = C.inside(w.first, k)
        sh, doc = C.grams(h, k)[ok], w.doc[: len(ok)][ok]
    else:
        sh, doc = np.zeros(0, C.U64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        few = np.zeros(len(short), C.U64)
        for j in range(k - 1):
            has = n[short] > j
            few[has] = C.mix(few[has] * C.U64(3) + h[w.first[short[has]] + j])
        sh, doc = np.concatenate([sh, C.mix(few + n[short].astype(C.U64))]), np.concatenate([doc, short])
    o = np.lexsort((sh, doc))
    sh, doc = sh[o], doc[o]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    return sh[new], np.searchsorted(doc[new], np.arange(len(docs) + 1))


def signatures(sh: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima (documents x hashes) and 128-bit digests of sets; zeros for empty sets."""
    n = np.diff(first)
    out, digest = np.zeros((len(n), HASHES), C.U64), np.zeros((len(n), 2), C.U64)
    some = np.flatnonzero(n)
    if len(some):
        at = first[:-1][some]
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat((sh ^ _XOR[k]) * _MULTIPLY[k], at)
        for k in range(2):
            digest[some, k] = np.add.reduceat(C.mix(sh ^ C.U64(0xA5A5 + k)), at) + n[some].astype(C.U64)
    return out, digest


def band_hashes(minima: np.ndarray) -> np.ndarray:
    out = np.empty((len(minima), BANDS), C.U64)
    for b in range(BANDS):
        x = np.full(len(minima), b, C.U64)
        for r in range(ROWS):
            x = C.mix(x + minima[:, b * ROWS + r])
        out[:, b] = x
    return out


def low_bits(minima: np.ndarray) -> np.ndarray:
    """The lowest bits of each (mixed) minimum, packed into longs."""
    per = 64 // BITS
    x = (C.mix(minima.ravel()).reshape(minima.shape) & C.U64((1 << BITS) - 1)).reshape(len(minima), -1, per)
    return np.bitwise_or.reduce(x << (np.arange(per, dtype=C.U64) * C.U64(BITS)), axis=2)


def set_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, key, s0.., bands) of each row; key names the set."""
    names = ["doc_id", "text_hash", "n_shingles", "key", *SIGNATURE, "bands"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2):
                sh, first = shingle_sets(C.as_bytes(part.column(2)))
                minima, digest = signatures(sh, first)
                sig = low_bits(minima).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(minima) + 1, BANDS), pa.int32()), pa.array(band_hashes(minima).view(np.int64).ravel()))
                keys = pa.array([x.tobytes() for x in digest], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(first), pa.int64()), keys, *(pa.array(np.ascontiguousarray(sig[:, i])) for i in range(len(SIGNATURE))), bands], names=names)

    schema = "doc_id long, text_hash long, n_shingles long, key binary, " + ", ".join(f"{s} long" for s in SIGNATURE) + ", bands array<long>"
    return with_hash(docs, id_col, text_col).mapInArrow(run, schema)


def with_hash(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))


def may_reach(a: str, b: str) -> str:
    """SQL: whether the estimate of a pair is high enough for confirmation."""
    lanes = " + ".join(f"bit_count((({a}.{s} ^ {b}.{s}) | shiftrightunsigned({a}.{s} ^ {b}.{s}, 1)) & 6148914691236517205)" for s in SIGNATURE)
    return f"({HASHES} - ({lanes})) >= {LEAST_EQUAL}"


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) of set keys whose sets reach the threshold; ``texts`` has key and text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2, C.SLICE_BYTES // 2):
                a, b = C.as_bytes(part.column(2)), C.as_bytes(part.column(3))
                sh, first = shingle_sets([x for ab in zip(a, b) for x in ab])
                size = np.diff(first)
                pair = np.repeat(np.arange(len(a)), size[::2] + size[1::2])
                o = np.lexsort((sh, pair))
                twice = (sh[o][1:] == sh[o][:-1]) & (pair[o][1:] == pair[o][:-1])
                both = np.bincount(pair[o][1:][twice], minlength=len(a))
                ok = 100 * both >= percent * (size[::2] + size[1::2] - both)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["u", "v"]).filter(pa.array(ok))

    one = texts.select(F.col("key").alias("u"), F.col("text").alias("text_u"))
    two = texts.select(F.col("key").alias("v"), F.col("text").alias("text_v"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "text_u", "text_v").mapInArrow(run, "u binary, v binary")


def equal_lanes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix of the number of equal b-bit values of two sets of packed signatures."""
    x = a[:, None, :] ^ b[None, :, :]
    return HASHES - np.bitwise_count((x | (x >> C.U64(1))) & C.U64(0x5555555555555555)).sum(axis=2, dtype=np.int64)


def links_of_blocks(a: pa.Array, b: pa.Array, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between two blocks of members (key, root, text, signature) of different components."""
    sides = []
    for x in (a, b):
        sig = np.stack([x.field(s).to_numpy(zero_copy_only=False) for s in SIGNATURE], axis=1).astype(np.int64).view(C.U64)
        sides.append((x.field("key").to_pylist(), x.field("root").to_pylist(), x.field("text"), sig))
    (ka, ra, ta, sa), (kb, rb, tb, sb) = sides
    roots = {r: i for i, r in enumerate({*ra, *rb})}
    apart = np.array([roots[r] for r in ra])[:, None] != np.array([roots[r] for r in rb])[None, :]
    near = apart & (equal_lanes(sa, sb) >= LEAST_EQUAL)
    rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(rows):
        return []
    sh_a, first_a = shingle_sets(C.as_bytes(ta.take(pa.array(rows))))
    sh_b, first_b = shingle_sets(C.as_bytes(tb.take(pa.array(cols))))
    size_b = np.diff(first_b)
    order = np.argsort(sh_b, kind="stable")
    values, owner = sh_b[order], np.repeat(np.arange(len(cols)), size_b)[order]
    out = []
    for i, row in enumerate(rows.tolist()):
        own = sh_a[first_a[i]: first_a[i + 1]]
        lo, n = np.searchsorted(values, own), np.searchsorted(values, own, "right")
        n = n - lo
        hits = owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        both = np.bincount(hits, minlength=len(cols))
        ok = near[row, cols] & (100 * both >= percent * (len(own) + size_b - both))
        out += [(ka[row], kb[cols[j]]) for j in np.flatnonzero(ok).tolist()]
    return out


def links_between(star: DataFrame, label: DataFrame, sig: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) between members of one centre that lie in different components."""
    root = label.select(F.col("u").alias("key"), F.col("v").alias("root"))
    member = star.select(F.col("u").alias("key"), F.col("v").alias("centre")).join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    # a member's share of a block: by number and by bytes
    member = member.join(texts.select("key", F.greatest(F.lit(1 / BLOCK), F.col("n_bytes") / F.lit(BLOCK_BYTES)).alias("share")), "key")
    counts = member.groupBy("centre", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("share"))
    mixed = counts.groupBy("centre").agg(F.max(F.struct("n", "root", "share")).alias("m"), F.sum("share").alias("all"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    mixed = mixed.select("centre", F.col("m.root").alias("main"), F.col("m.share").alias("of_main"), (F.col("all") - F.col("m.share")).alias("of_rest"))
    member = member.join(mixed, "centre").withColumn("is_main", F.expr("root = main"))
    size = F.when(F.col("is_main"), F.col("of_main")).otherwise(F.col("of_rest"))
    member = member.withColumn("block", F.pmod(F.xxhash64("key"), F.greatest(F.lit(1).cast("long"), F.ceil(size)))).drop("share")
    whole = member.select("centre", "is_main", "block", "key", "root").join(sig, "key").join(texts.select("key", "text"), "key")
    blocks = C.stored(whole.groupBy("centre", "is_main", "block").agg(F.collect_list(F.struct("key", "root", "text", *SIGNATURE)).alias("rows")), "blocks")
    rest = blocks.where("NOT is_main").select("centre", F.col("block").alias("own"), F.col("rows").alias("rest"))
    pairs = rest.join(blocks, "centre").where("is_main OR own <= block").select("rest", "rows")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                found = links_of_blocks(one[i].values, two[i].values, percent)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], names=["u", "v"])

    return pairs.mapInArrow(run, "u binary, v binary")


def class_texts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, text, n_bytes): one text for each node, however many rows have the same id and text.
    Repeated rows are merged on the partitioning of the join."""
    name = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "text_hash"]
    one = rows.select(*name, "text").dropDuplicates(["id", "no_id", "text_hash"])
    wanted = nodes.select("key", F.col("row.doc_id").alias("doc_id"), F.col("row.text_hash").alias("text_hash")).select("key", *name)
    return one.join(wanted, ["id", "no_id", "text_hash"]).select("key", "text", F.octet_length("text").cast("long").alias("n_bytes"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of each row of ``docs``."""
    sets = C.stored(set_table(docs, id_col, text_col), "sets")
    classes = (sets.where("n_shingles > 0").groupBy("key")
               .agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), *[F.first(c).alias(c) for c in (*SIGNATURE, "bands")]))
    member = classes.select("key", "row", *SIGNATURE, F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    member = C.stored(member.join(shared, "bucket"), "members")

    # texts of the classes that share a band with another one
    rows = member.groupBy("key").agg(F.first("row").alias("row"), F.sum("size").alias("central"), *[F.first(s).alias(s) for s in SIGNATURE])
    nodes = C.stored(rows, "nodes")
    texts = C.stored(class_texts(with_hash(docs, id_col, text_col), nodes), "texts")
    C.free_shuffles(docs.sparkSession)

    # links to the most central member of each bucket
    place = member.select("bucket", "key").join(nodes.select("key", "central"), "key")
    centre = place.groupBy("bucket").agg(F.max(F.struct("central", "key")).alias("c")).select("bucket", F.col("c.key").alias("v"))
    star = member.select("bucket", F.col("key").alias("u")).join(centre, "bucket").where("u <> v").select("u", "v").distinct()
    star = C.stored(star, "stars")
    sig = nodes.select("key", *SIGNATURE)
    near = star.alias("p").join(sig.alias("a"), F.expr("p.u = a.key")).join(sig.alias("b"), F.expr(f"p.v = b.key AND {may_reach('a', 'b')}")).select("u", "v")
    first_links = C.stored(confirmed(near, texts), "links")
    label = components(first_links)

    links = C.stored(links_between(star, label, sig, texts), "links")
    label = components(label.union(links))

    root = sets.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    root = root.join(label.select(F.col("u").alias("key"), F.col("v").alias("root")), "key", "left").withColumn("root", F.coalesce("root", "key"))
    name = root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = root.join(name, "root").select("key", "component_id", (F.col("key") == F.col("root")).alias("is_root"))
    out = sets.select("doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("key")).alias("key")).join(named, "key", "left")
    linked = F.col("n_shingles") > 0
    out = out.withColumn("component_id", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")))
    nameless = F.col("component_id").isNull() & F.coalesce("is_root", F.lit(True))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), nameless)
    return out.select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents")).drop("text_hash")

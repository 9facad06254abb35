"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at 3 or fewer differing bits have a midpoint, at most 2 bits
from one and at most 1 from the other. Every distinct fingerprint emits
variants within that half radius; fingerprints that share a variant are
candidates and are verified.

Which variants: the fingerprint itself, those with one bit cleared, those with
one bit set, and those with two bits cleared (about 560, instead of the 2,081
of the whole ball). They suffice. Of three differing bits at least two have
the same value on one side. If that side has exactly two set: it clears both,
the other side clears its one. If it has all three set: it clears two, and the
other sets one. (Fewer differing bits are the same with steps left out.)

The shuffle: a variant belongs to the bucket of its low bits. Most variants
leave those bits alone, so a fingerprint is sent once to each bucket that one
of its variants falls into (about 1 + b + b*b/8 for b bits), and the bucket's task
writes the variants out again, sorts them and finds the collisions. Near copies
may have mostly the same low bits; a bucket with more variants than a task
should hold is split by further bits, as often as needed, by the same rule. At a
shared variant one member at distance 0 or 1 is linked with all others (at
most 1 + 2 bits away), which keeps every connection without listing all pairs;
members that are all two bits away from the variant need no link here, as any
two of them within 3 bits also meet elsewhere.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_batches, materialise, set_aside, utf8
from emporia.llm.components import connect

SHINGLE = 3
SEED = 42
RADIUS = 3
PER_BUCKET = 1024
MOST_BITS = 24
# Variants of one bucket, 12 bytes each and as much again to sort them; and bits that split a bucket with more.
MOST_VARIANTS = 1 << 22
SPLIT_BITS = 6
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text (0 without words)."""
    found = text.lower().split()  # of bytes: A-Z only, and white space U+0020 and U+0009 to U+000D
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    width = min(shingle, len(found))
    first = np.concatenate([[0], ends[: len(found) - width]]).tolist()
    last = (ends[width - 1 :] - 1).tolist()
    h64, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), _CHUNK):
        part = [h64(joined[a:b], SEED) for a, b in zip(first[at : at + _CHUNK], last[at : at + _CHUNK])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long (a null or wordless text: 0)."""

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        found = np.array([fingerprint(x, shingle) for x in utf8(batch.column("text"))], dtype=np.uint64)
        return [pa.array(found.view(np.int64))]

    return map_batches(docs.drop("fp"), fn, {"fp": "bigint"}, [c for c in (keep or docs.columns) if c != "fp"])


def split(x: np.ndarray, bucket: np.ndarray, bits: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of ``more`` low bits, fingerprints): each ``x`` at every part of its ``bucket`` (``bits`` bits) that one of its variants falls into."""
    off = (x ^ bucket) & _mask(bits)
    away, cleared = np.bitwise_count(off), (off & ~x) == 0
    part = bucket | (x & _mask(more) & ~_mask(bits))
    buckets, owners = [part], [x]
    home, step = away == 0, (away == 1) & cleared
    for p in range(bits, more):
        bit = np.uint64(1 << p)
        has = (x & bit) != 0
        for mine in (home, step & has):
            buckets.append(part[mine] ^ bit)
            owners.append(x[mine])
        for q in range(p + 1, more):
            both = home & has & ((x & np.uint64(1 << q)) != 0)
            buckets.append(part[both] ^ bit ^ np.uint64(1 << q))
            owners.append(x[both])
    return np.concatenate(buckets), np.concatenate(owners)


def n_variants(x: np.ndarray, bucket: np.ndarray, bits: int) -> np.ndarray:
    """How many variants of each ``x`` fall into its ``bucket``."""
    off = (x ^ bucket) & _mask(bits)
    away, cleared = np.bitwise_count(off), (off & ~x) == 0
    has = np.bitwise_count(x & ~_mask(bits)).astype(np.int64)
    return np.select([away == 0, (away == 1) & cleared], [1 + (64 - bits) + has * (has - 1) // 2, 1 + has], 1)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def bucketed(distinct: DataFrame, bits: int, full: list[np.ndarray] | None = None, newest: bool = False) -> DataFrame:
    """(bits, bucket, fp, n): each fingerprint at every bucket that one of its variants falls into, and how many do.

    Buckets are those of ``bits`` low bits; of these ``full[0]`` (sorted) are
    split by SPLIT_BITS more, of their parts ``full[1]`` again, and so on. With
    ``newest`` only the parts of the last split.
    """
    full = full or []
    shared = distinct.sparkSession.sparkContext.broadcast(full)

    def each(batches):
        for batch in batches:
            x, out = batch.column(0).to_numpy().view(np.uint64), []
            now = bits
            bucket, x = split(x, np.zeros(len(x), dtype=np.uint64), 0, now)
            for again in shared.value:
                place = np.minimum(np.searchsorted(again, bucket), len(again) - 1)
                whole = again[place] != bucket
                out.append((now, bucket[whole], x[whole]))
                more = min(64, now + SPLIT_BITS)
                bucket, x = split(x[~whole], bucket[~whole], now, more)
                now = more
            out = [*([] if newest else out), (now, bucket, x)]
            for held, own, who in out:
                n = n_variants(who, own, held)
                cols = [np.full(len(who), held, dtype=np.int32), own.view(np.int64), who.view(np.int64), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["bits", "bucket", "fp", "n"])

    return distinct.select("fp").mapInArrow(each, "bits int, bucket bigint, fp bigint, n bigint")


def full_buckets(distinct: DataFrame, bits: int, most: int = MOST_VARIANTS) -> list[np.ndarray]:
    """What :func:`bucketed` has to split so that no bucket has more than ``most`` variants.

    At most one bucket in ``most`` variants reaches the driver. A bucket of all
    64 bits is one variant, which at most 2,081 fingerprints have.
    """
    out: list[np.ndarray] = []
    for held in range(bits, 64, SPLIT_BITS):
        found = bucketed(distinct, bits, out, newest=True).groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > most)
        again = np.array([r["bucket"] for r in found.select("bucket").collect()], dtype=np.int64).view(np.uint64)
        if not len(again):
            break
        out.append(np.sort(again))
    return out


def variants(x: np.ndarray, bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Variants of ``x`` (uint64) that fall into the bucket, and whose they are; those within one bit come first."""
    one = [np.uint64(1 << p) for p in range(64)]
    off = (x ^ np.uint64(bucket % (1 << 64))) & _mask(bits)
    away = np.bitwise_count(off)
    cleared = (off & ~x) == 0  # all bits that differ from the bucket's are set in x, so clearing them leads here
    who = np.arange(len(x), dtype=np.int32)
    near, far = [], []
    home, step, two = who[away == 0], who[(away == 1) & cleared], who[(away == 2) & cleared]
    near.append((x[home], home))
    near.append((x[away == 1] ^ off[away == 1], who[away == 1]))
    far.append((x[two] ^ off[two], two))
    for p in range(bits, 64):
        near.append((x[home] ^ one[p], home))
        for start in (home, step):
            here = start[(x[start] & one[p]) != 0]
            z = x[here] ^ (off[here] | one[p])
            if start is step:
                far.append((z, here))
            else:
                for q in range(p + 1, 64):
                    both = (z & one[q]) != 0
                    far.append((z[both] ^ one[q], here[both]))
    found = [*near, *far]
    return np.concatenate([z for z, _ in found]), np.concatenate([w for _, w in found])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def collisions(x: np.ndarray, bucket: int, bits: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, representative) that connect the verified collisions inside one bucket."""
    x = np.unique(x)
    z, who = variants(x, bucket, bits)
    order = np.argsort(z, kind="stable")  # members within one bit first
    z, who = z[order], who[order]
    same = np.flatnonzero(z[1:] == z[:-1]) + 1
    head = np.arange(len(z))
    begins = np.concatenate([[True], z[1:] != z[:-1]]) if len(z) else np.zeros(0, dtype=bool)
    head = np.maximum.accumulate(np.where(begins, head, 0))
    a, b = who[head[same]], who[same]
    linked = np.bitwise_count(x[a] ^ x[b]) <= radius
    label = forest(len(x), a[linked], b[linked])
    joined = np.flatnonzero(label != np.arange(len(x)))
    return x[joined], x[label[joined]]


def links(distinct: DataFrame, n: int | None = None, most: int = MOST_VARIANTS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect what is linked at 3 or fewer bits.

    No task holds more than ``most`` variants of a bucket.
    """
    n = distinct.count() if n is None else n
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, n) / PER_BUCKET))))

    def fn(key, group):
        u, v = collisions(group.column("fp").to_numpy().view(np.uint64), key[1].as_py(), key[0].as_py())
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    parts = bucketed(distinct, bits, full_buckets(distinct, bits, most)).select("bits", "bucket", "fp")
    return parts.groupBy("bits", "bucket").applyInArrow(fn, "u bigint, v bigint")


def classes(own: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every fingerprint in ``own`` (doc_id, fp): its component, named by fingerprint and by smallest doc_id."""
    nodes = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = connect(materialise(links(nodes), "simhash-links"))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "simhash-rooted")
    smallest = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest")
    return materialise(rooted.join(smallest, "root").select("fp", "root", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``fp`` and ``component_id``.

    Documents whose fingerprints differ in at most 3 bits are linked;
    ``component_id`` is the smallest doc_id reachable over links. Equal
    fingerprints are one node, so copies cost nothing. A null or wordless text
    has fingerprint 0 and is linked like any other; a row without doc_id gets
    its component like the others, and a component without any doc_id has a
    null one. An empty table gives no rows.
    """
    own = materialise(fingerprints(docs.select("doc_id", "text"), shingle, keep=["doc_id"]), "simhash-fp")
    return own.join(classes(own), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id (a row without one only if no other is there).

    Of rows with that doc_id too, the one with the smallest fingerprint, then the first read.
    """
    docs, back = set_aside(docs, ["fp", "place"])
    own = fingerprints(docs, shingle).withColumn("place", F.monotonically_increasing_id())
    own = materialise(own, "simhash-rows")
    slim = own.select("doc_id", "fp", "place")
    ranked = slim.join(classes(slim), "fp")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "place"))
    winners = ranked.groupBy("root").agg(best.alias("best")).select(F.col("best.place").alias("place"))
    return own.join(materialise(winners, "simhash-winners").hint("merge"), "place", "left_semi").select(*back)


def hexadecimal(fp: str = "fp"):
    """The 16 lowercase hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

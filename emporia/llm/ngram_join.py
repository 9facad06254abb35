"""N-gram Jaccard join: which documents share nearly all their word n-grams, and what they are connected to.

A document is the set of its distinct shingles; two link at a Jaccard
similarity of ``PERCENT`` per cent or more, decided in whole numbers on the
sorted arrays of both. What comes before only leaves out pairs that cannot
link:

1. *Shared shingles.* Texts are packed into blocks; a block sends its distinct
   shingle hashes, cut to a few bytes, to buckets, which answer in how many
   documents each is (as a power of two). With n shingles, ``shared`` of them
   in other documents too, no set reaches more than shared / n, so most
   documents end here.
2. *Prefixes.* Shingles are ordered by rarity. Sets that link have one of the
   first n - ceil(n * PERCENT / 100) + 1 in common; those that are nowhere else
   need not be looked up.
3. *Tiles.* Sizes that can link are in the same or in neighbouring bands. A tile
   holds the sets of a band, and of the one below, with a common rare
   shingle. Of tiles that hold the same sets, one is looked at. One with more
   than ``TILE`` sets is cut into squares of two parts each.
4. *Bitmaps.* A set carries a bitmap of its shingles' hashes. A bit that one
   set has and the other lacks is a shingle that they do not share, so bit
   counts bound the overlap from above, and the exact intersection is taken
   only of pairs whose bound suffices.

Equal sets are one class from the start, and connected sets need no further
pair between them: every set is first compared with the least changed one of
each of its tiles (in groups of near copies these links are enough), and then
a tile only looks at pairs whose components differ. Of these it gives for each
set the ``FIRST`` most promising at a time; rounds go on, with the components
known so far, until no tile holds back any.

Shingles are 64-bit hashes (see ``wordhash``): two sets count a shingle too
many with a probability of about (number of their shingles)^2 / 2^64.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import materialise
from emporia.llm.components import connect
from emporia.llm.substring import blocks, top
from emporia.llm.wordhash import LOWER_SPACES, joined, mixed, words

SHINGLE = 3
PERCENT = 90
# Shingles of a bucket, about; and false "shared" answers: one shingle in 2 ** SPARE_BITS or so (these cost time only).
PER_BUCKET = 1 << 18
MOST_BITS = 20
SPARE_BITS = 6
# Sets of a tile's part, pairs of a set that a tile gives in the first round, and words of one step over bitmaps.
TILE = 2048
FIRST = 4
CELLS = 1 << 21
# Bits of a bitmap: about so many a shingle, a power of two between these.
BITS_EACH = 8
LEAST_BITS, LARGEST_BITS = 1 << 9, 1 << 16


def overlaps(overlap, n_a, n_b, percent: int = PERCENT):
    """Does an overlap of sets of these sizes make a link? (100 I >= percent (n_a + n_b - I))"""
    return (100 + percent) * overlap >= percent * (n_a + n_b)


def edges(percent: int = PERCENT, largest: int = 1 << 40) -> np.ndarray:
    """Least size of each band: sizes of which one is at least ``percent`` of the other are at most one band apart."""
    out = [1]
    while out[-1] < largest:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, dtype=np.int64)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text (of a shorter text: of the whole sequence; of none: empty)."""
    found = words(texts, LOWER_SPACES)
    hashes = found.windows(shingle)
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(hashes[a : b - shingle + 1]))
        elif b > a:
            whole = np.full(1, b - a, dtype=np.uint64)
            for h in found.hashes[a:b]:
                whole = joined(whole, h)
            out.append(mixed(whole))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The set's bitmap as bytes: bit h mod size is set for every hash h."""
    size = LEAST_BITS
    while size < min(LARGEST_BITS, BITS_EACH * len(hashes)):
        size *= 2
    bits = np.zeros(size, dtype=bool)
    bits[hashes & np.uint64(size - 1)] = True
    return np.packbits(bits, bitorder="little")


def same_size(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps folded to the smallest size among them, as rows of 64-bit words."""
    least = min(map(len, bitmaps))
    rows = [np.bitwise_or.reduce(np.frombuffer(x, dtype="<u8").reshape(-1, least // 8), axis=0) for x in bitmaps]
    return np.stack(rows)


class Block:
    """A block opened in a task: the shingle sets of its documents, and the distinct shingles of them all."""

    def __init__(self, row: dict, shingle: int):
        self.block, self.nulls = row["block"], row["nulls"]
        self.doc_ids = [None if null else i for i, null in zip(row["doc_ids"], row["nulls"])]
        data, ends = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["texts"] else b"", np.cumsum([0, *row["lengths"]])
        self.sets = shingle_sets([data[a:b] for a, b in zip(ends[:-1], ends[1:])], shingle)
        flat = np.concatenate(self.sets) if self.sets else np.zeros(0, dtype=np.uint64)
        self.distinct, self.which, self.often = np.unique(flat, return_inverse=True, return_counts=True)

    def sent(self, bits: int):
        """(bucket, range of ``distinct``) for every bucket that gets some."""
        bucket = top(self.distinct, bits)
        begins = np.flatnonzero(np.diff(bucket, prepend=-1))
        yield from zip(bucket[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(self.distinct)])


def sent(packed: DataFrame, bits: int, width: int, shingle: int) -> DataFrame:
    """What the blocks send: per bucket ``width`` bytes of each distinct hash, and in how many documents it is (255: or more)."""

    def each(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, out = Block(row, shingle), []
                for bucket, a, b in own.sent(bits):
                    cut = (own.distinct[a:b] << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]
                    out.append((bucket, own.block, cut.tobytes(), np.minimum(own.often[a:b], 255).astype(np.uint8).tobytes()))
                if out:
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                    cols = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(cols, names=["bucket", "block", "hashes", "often"])

    return packed.mapInArrow(each, "bucket int, block bigint, hashes binary, often binary")


def rarities(entries: DataFrame, width: int) -> DataFrame:
    """Answers of the buckets: for each entry the power of two below its number of documents (0: in one only)."""

    def fn(table):
        counts = [len(x) // width for x in table.column("hashes").to_pylist()]
        raw = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.uint8).reshape(-1, width)
        often = np.frombuffer(b"".join(table.column("often").to_pylist()), dtype=np.uint8)
        wide = np.zeros((len(raw), 8), dtype=np.uint8)
        wide[:, :width] = raw
        distinct, which = np.unique(wide.view(">u8").ravel().astype(np.uint64), return_inverse=True)
        total = np.bincount(which, weights=often, minlength=len(distinct))
        code = np.log2(np.maximum(total, 1)).astype(np.uint8)[which]
        ends = np.cumsum([0, *counts])
        rows = [code[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "codes": pa.array(rows, pa.binary())})

    return entries.groupBy("bucket").applyInArrow(fn, "block bigint, bucket int, codes binary")


JUDGED = "doc_id bigint, n bigint, shared bigint, band int, key binary, hashes binary, bitmap binary, prefix array<bigint>"


def judged(packed: DataFrame, answers: DataFrame, bits: int, percent: int, shingle: int) -> DataFrame:
    """Every document with its number of shingles; those that may link also with their set, its bitmap and its shared prefix."""
    bands = edges(percent)

    def fn(left, right):
        own = Block(left.to_pylist()[0], shingle)
        found = dict(zip(right.column("bucket").to_pylist(), right.column("codes").to_pylist()))
        codes = [np.frombuffer(found[bucket], dtype=np.uint8) for bucket, _, _ in own.sent(bits)]
        codes = (np.concatenate(codes) if codes else np.zeros(0, dtype=np.uint8))[own.which]
        out, at = [], 0
        for doc_id, hashes in zip(own.doc_ids, own.sets):
            n = len(hashes)
            code = codes[at : at + n]
            at += n
            shared = int((code > 0).sum())
            if not n or 100 * shared < percent * n:
                out.append((doc_id, n, shared, None, None, None, None, None))
                continue
            order = np.lexsort((hashes, code))[: n - -(-n * percent // 100) + 1]
            prefix = hashes[order[code[order] > 0]].view(np.int64).tolist()
            data = hashes.astype("<u8").tobytes()
            band = int(np.searchsorted(bands, n, side="right")) - 1
            out.append((doc_id, n, shared, band, xxhash.xxh3_128_digest(data), data, bitmap(hashes).tobytes(), prefix))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        names = ["doc_id", "n", "shared", "band", "key", "hashes", "bitmap", "prefix"]
        cols = list(zip(*out)) or [[]] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(fn, JUDGED)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets link, by the exact intersection of their sorted arrays."""

    def fn(batches):
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep.append(bool(overlaps(int((y[at] == x).sum()), len(x), len(y), percent)))
            out = [[i for i, k in zip(c, keep) if k] for c in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["u", "v"])

    # the sets of few pairs are picked out before they are dealt
    left, right = (sets.select(F.col("c").alias(c), F.col("hashes").alias(x)).join(pairs.select(c).distinct(), c, "left_semi") for c, x in (("a", "left"), ("b", "right")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(fn, "u bigint, v bigint")


def tile_pairs(table: pa.Table, percent: int, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of a tile (or of a square of it) that may link and are in different components; was any held back?

    Of each set at most the ``most`` pairs with the greatest bound.
    """
    c, n, shared, root, home, part, first, second = (
        table.column(x).to_numpy() for x in ("c", "n", "shared", "root", "home", "part", "first", "second")
    )
    bits = same_size(table.column("bitmap").to_pylist())
    ones = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    across = first[0] != second[0]
    rows = np.flatnonzero(part == first[0]) if across else np.arange(len(c))
    cols = np.flatnonzero(part == second[0]) if across else rows
    step, out, held = max(1, CELLS // max(1, len(cols) * bits.shape[1])), [], False
    for at in range(0, len(rows), step):
        i = rows[at : at + step]
        both = np.bitwise_count(bits[i][:, None, :] & bits[cols][None, :, :]).sum(axis=2).astype(np.int64)
        bound = np.minimum(n[i][:, None] - (ones[i][:, None] - both), n[cols][None, :] - (ones[cols][None, :] - both))
        bound = np.minimum(bound, np.minimum(shared[i][:, None], shared[cols][None, :]))
        sizes = n[i][:, None] + n[cols][None, :]
        may = overlaps(bound, 0, sizes, percent) & (root[i][:, None] != root[cols][None, :]) & (home[i][:, None] | home[cols][None, :])
        if not across:
            may &= c[i][:, None] < c[cols][None, :]
        worth = np.where(may, bound / sizes, -1.0)
        if worth.shape[1] > most:
            held |= bool((may.sum(axis=1) > most).any())
            least = -np.partition(-worth, most - 1, axis=1)[:, most - 1 : most]
            best = may & (worth >= least)
            best &= np.cumsum(best, axis=1) <= most
        else:
            best = may
        x, y = np.nonzero(best)
        out.append((c[i[x]], c[cols[y]]))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out]), held


def candidates(entries: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Pairs (a, b) of different components that may link; (null, null) where a tile holds some back."""
    own = entries.join(labels, entries.c == labels.node, "left").select(*entries.columns, F.coalesce("root", "c").alias("root"))
    own = materialise(own, "jaccard-entries")
    # a tile of one component, or one with no set of its own band, has nothing to look at
    live = own.groupBy("e", "tile").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("home").alias("any"), F.count("*").alias("m"))
    live = live.filter("low <> high AND any").select("e", "tile", F.ceil(F.col("m") / TILE).cast("int").alias("parts"))
    own = own.join(materialise(live, "jaccard-live"), ["e", "tile"])  # both sides plain scans: Spark can split a hot tile
    part = F.pmod(F.xxhash64("c"), F.col("parts")).cast("int")
    own = own.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = own.select("e", "tile", "c", "n", "shared", "root", "home", "part", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"))
    own = own.join(sets.select("c", "bitmap"), "c")

    def fn(table):
        a, b, held = tile_pairs(table, percent, most)
        more = [None] if held else []
        return pa.table({"a": pa.array([*a.tolist(), *more], pa.int64()), "b": pa.array([*b.tolist(), *more], pa.int64())})

    found = own.groupBy("e", "tile", "first", "second").applyInArrow(fn, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def stars(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): each set with the least changed one of each of its tiles, where sizes allow a link."""
    changed = F.col("n") - F.col("shared")
    centre = F.min(F.struct(changed.alias("changed"), F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a")))
    centres = entries.groupBy("e", "tile").agg(centre.alias("s")).select("e", "tile", "s.a", "s.n_a", "s.shared_a")
    pairs = entries.join(materialise(centres, "jaccard-centres"), ["e", "tile"]).filter("c <> a")
    pairs = pairs.filter(overlaps(F.least("shared", "shared_a"), F.col("n"), F.col("n_a"), percent))
    return pairs.select(F.least("a", "c").alias("a"), F.greatest("a", "c").alias("b")).distinct()


def tiles(sets: DataFrame) -> DataFrame:
    """(c, n, shared, e, tile, home): the sets of all tiles that have a pair to look at; of tiles with the same sets, one.

    Near copies have most of their rare shingles in common, so each would bring
    the same sets together again. Tiles are the same if their numbers of sets and
    two 64-bit hashes of all of them agree.
    """
    both = F.explode(F.array(F.struct(F.col("band").alias("tile"), F.lit(True).alias("home")), F.struct((F.col("band") + 1).alias("tile"), F.lit(False).alias("home"))))
    entries = sets.select("c", "n", "shared", "band", F.explode("prefix").alias("e")).withColumn("t", both)
    entries = materialise(entries.select("c", "n", "shared", "e", "t.tile", "t.home"), "jaccard-prefixes")
    members = [F.bit_xor(F.xxhash64(F.lit(seed), "c")).alias(f"members_{seed}") for seed in (1, 2)]
    own = entries.groupBy("e", "tile").agg(F.count("*").alias("m"), F.max("home").alias("any"), *members).filter("m > 1 AND any")
    one = own.groupBy("tile", "m", "members_1", "members_2").agg(F.min("e").alias("e")).select("e", "tile")
    return entries.join(materialise(one, "jaccard-tiles"), ["e", "tile"])  # both sides plain scans: Spark can split a hot tile


def classes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the sets (column ``c``) that are connected with others."""
    entries = materialise(tiles(sets), "jaccard-entries")
    tried = materialise(stars(entries, percent), "jaccard-stars")
    links = materialise(linked(tried, sets, percent), "jaccard-links")
    most = FIRST
    while True:
        labels = connect(links)
        found = materialise(candidates(entries, labels, sets, percent, most), "jaccard-pairs")
        new = materialise(found.filter("a IS NOT NULL").join(tried, ["a", "b"], "left_anti"), "jaccard-new")
        more = materialise(linked(new, sets, percent), "jaccard-links")
        held = found.filter("a IS NULL").limit(1).count()
        if more.limit(1).count():
            links = links.union(more)
            labels = connect(links)
        if not held:
            return labels
        tried = tried.union(new)
        most *= 8


def join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``n_shingles`` and ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included. A text of fewer words than a shingle is one shingle, its whole
    sequence. A null or wordless text has an empty set and is linked with
    nothing. Repeated rows, and rows of equal texts, are one class of equal
    sets; a row without doc_id is linked like others, and a component without
    any doc_id has a null one. Texts may be of any length (a text is held
    whole, with eight bytes a word beside it). Other columns are not looked at.
    An empty table gives no rows.
    """
    packed = materialise(blocks(docs), "jaccard-blocks")
    total = packed.agg(F.sum("n_words")).first()[0] or 0
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, total) / PER_BUCKET))))
    width = min(8, max(1, math.ceil((math.log2(max(2, total)) + SPARE_BITS - bits) / 8)))
    answers = rarities(sent(packed, bits, width, shingle), width)
    own = judged(packed, answers, bits, percent, shingle).withColumn("place", F.monotonically_increasing_id())
    own = materialise(own, "jaccard-judged")
    near = own.filter("key IS NOT NULL")
    equal = materialise(near.groupBy("key").agg(F.min("place").alias("c"), F.min("doc_id").alias("first")), "jaccard-equal")
    sets = near.join(equal.select(F.col("c").alias("place")), "place", "left_semi")
    sets = materialise(sets.select(F.col("place").alias("c"), "n", "shared", "band", "hashes", "bitmap", "prefix"), "jaccard-sets")
    labels = classes(sets, percent)
    rooted = equal.join(labels, equal.c == labels.node, "left").select("key", "first", F.coalesce("root", "c").alias("root"))
    rooted = materialise(rooted, "jaccard-rooted")
    smallest = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "jaccard-smallest")
    named = materialise(rooted.join(smallest, "root").select("key", "component_id"), "jaccard-components")
    far = own.filter("key IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return far.union(near.join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id"))

"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against every training window.

Texts are normalised to lower-case alphanumeric words. Every window of ten
words of a benchmark item (an item with fewer words is one window) goes into a
hash set; each training text's windows are hashed the same way and looked up.
A hit is verified word by word before it counts.

The set is broadcast in parts of a checked size: its bytes are counted first,
and a set above ``part_bytes`` is split by window hash into several parts with
one pass over the documents for each. Results do not depend on the number of parts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_batches, materialise, set_aside, slices, utf8
from emporia.llm.wordhash import ALPHANUMERIC, words

WINDOW = 10
PART_BYTES = 32 << 20
SLICE_BYTES = 1 << 18
# Bits of the bitmap that rules out most windows before the sorted lookup.
BITMAP_BITS = 22


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: ``window`` (UTF-8 words joined by spaces), ``length``, ``hash``, ``items`` (ids as text).

    Items without words have no window. An item without id marks words, but is not listed.
    """

    def each(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            found = words(utf8(batch.column(1)), ALPHANUMERIC)
            for i, item in enumerate(ids):
                a, b = int(found.first[i]), int(found.first[i + 1])
                length = min(n, b - a)
                for at in range(a, b - length + 1) if length else ():
                    out.append((item, found.text(at, length, ALPHANUMERIC), length, int(found.windows(length, found.hashes[at : at + length])[0])))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.string()),
                    pa.array(cols[1], pa.binary()),
                    pa.array(cols[2], pa.int32()),
                    pa.array(np.array(cols[3], dtype=np.uint64).astype(np.int64), pa.int64()),
                ],
                names=["item_id", "window", "length", "hash"],
            )

    rows = benchmark.select(F.col("item_id").cast("string"), "text")
    rows = rows.mapInArrow(each, "item_id string, window binary, length int, hash bigint")
    return rows.groupBy("window", "length", "hash").agg(F.collect_set("item_id").alias("items"))


class Part:
    """A part of the set on a worker: hashes sorted per window length, and what they stand for."""

    def __init__(self, rows):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        for length in {r["length"] for r in rows}:
            own = sorted((r["hash"] % (1 << 64), bytes(r["window"]), tuple(r["items"])) for r in rows if r["length"] == length)
            hashes = np.array([x[0] for x in own], dtype=np.uint64)
            bitmap = np.zeros(1 << BITMAP_BITS, dtype=bool)
            bitmap[hashes >> np.uint64(64 - BITMAP_BITS)] = True
            self.by_length[length] = hashes, bitmap, own

    def scan(self, texts: list[bytes], spans: list[list], items: list[set], totals: list[int]) -> list[list]:
        """Adds to each text's hit words (as [first, last) word ranges) and items; byte ranges of all hit words."""
        found = words(texts, ALPHANUMERIC)
        totals.extend(np.diff(found.first).tolist())
        for length, (hashes, bitmap, own) in self.by_length.items():
            h = found.windows(length)
            near = np.flatnonzero(bitmap[h >> np.uint64(64 - BITMAP_BITS)] & found.whole(length))
            at = np.searchsorted(hashes, h[near])
            hit = hashes[np.minimum(at, len(hashes) - 1)] == h[near]
            for i, k in zip(near[hit].tolist(), at[hit].tolist()):
                text = int(np.searchsorted(found.first, i, side="right")) - 1
                while k < len(own) and own[k][0] == h[i]:  # equal hashes stand together
                    if own[k][1] == found.text(i, length, ALPHANUMERIC):
                        first = i - int(found.first[text])
                        spans[text].append((first, first + length))
                        items[text].update(own[k][2])
                    k += 1
        begins = np.cumsum([0] + [len(x) + 1 for x in texts])
        out = []
        for t in range(len(texts)):
            spans[t] = merged(spans[t])
            a, base = int(found.first[t]), int(begins[t])
            out.append([(int(found.starts[a + x]) - base, int(found.ends[a + y - 1]) - base) for x, y in spans[t]])
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def without(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in ranges:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


SPANS = pa.list_(pa.list_(pa.int32()))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    part_bytes: int = PART_BYTES,
    keep: list[str] | None = None,
    clean: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with what the benchmark shares with it.

    Adds ``n_words``, ``spans`` (hit word ranges [first, end), merged) and
    ``items`` (ids of the items with occurring windows as text, sorted); with
    ``clean`` also ``clean_text`` (the text without the bytes from the first to
    the last word of each span; null stays null). A null or wordless text has 0
    words; repeated rows are scanned like any other; a very long text is scanned
    whole, with memory in proportion to it; without benchmark windows no word is
    hit, and an empty table of documents gives no rows. An input column with one
    of the new names is replaced. ``keep`` names the input columns of the
    result (all by default).
    """
    new = {"n_words": "bigint", "spans": "array<array<int>>", "items": "array<string>"}
    if clean:
        new["clean_text"] = "string"
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    grams = materialise(windows(benchmark, n), "benchmark-windows")
    # 64 bytes a row for the objects around the words; an item's id counts at each of its windows
    held = grams.agg(F.sum(F.octet_length("window") + 64 + 16 * F.size("items"))).first()[0] or 0
    parts = max(1, math.ceil(held / part_bytes))
    out = docs.drop(*new).withColumn("spans", F.array().cast(new["spans"])).withColumn("items", F.array().cast(new["items"]))
    for p in range(parts):
        rows = grams.filter(F.pmod("hash", F.lit(parts)) == p).collect()
        shared = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in rows])

        def fn(batch: pa.RecordBatch, part: Part) -> list[pa.Array]:
            texts, totals, ranges = utf8(batch.column("text")), [], []
            spans = [[tuple(x) for x in y] for y in batch.column("spans").to_pylist()]
            items = [set(x) for x in batch.column("items").to_pylist()]
            for a, b in slices(texts, SLICE_BYTES):
                own = spans[a:b]
                ranges += part.scan(texts[a:b], own, items[a:b], totals)
                spans[a:b] = own
            made = [
                pa.array(totals, pa.int64()),
                pa.array([[list(x) for x in y] for y in spans], SPANS),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            if clean:
                rest = [None if null else without(x, r) for x, r, null in zip(texts, ranges, batch.column("text").is_null().to_pylist())]
                made.append(pa.array(rest, pa.binary()).cast(pa.string()))
            return made

        last = p == parts - 1
        passed = keep if last or "text" in keep else [*keep, "text"]
        out = map_batches(out.drop("n_words", "clean_text"), fn, new, passed, setup=lambda shared=shared: Part(shared.value))
        if not last:
            out = materialise(out, "benchmark-pass")
    return out


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, x: n + x[1] - x[0])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit spans cut out of their texts."""
    names = docs.columns
    docs, back = set_aside(docs, ["n_words", "spans", "items", "clean_text"])
    if remove == "documents":
        return scan(docs, benchmark, n).filter(F.size("spans") == 0).select(*back)
    found = scan(docs, benchmark, n, clean=True)
    return found.select(*[F.col("clean_text").alias(c) if c == "text" else old for c, old in zip(names, back)])

"""Exact substring dedup by level-wise doubling.

A window of 20 words can repeat only if its two halves of 10 words do. So the
short windows of all documents are counted first, with a few bytes for each;
only places whose two halves both occur more than once are extended to twice
the length and looked at again, until the wanted length is reached or no
candidate survives. At the last level the first place (by doc_id, then
position) of every repeated window stays, and the words of the others go.

Documents are packed into blocks of a few megabytes. A block finds repeats
inside itself, so it sends each of its distinct windows once, however often it
holds them: a passage found everywhere costs one entry per block. Entries go
to buckets by hash as one sorted byte string per block and bucket; the bucket
answers with one bit per entry. Short windows are sent with just so many hash
bytes that few unequal ones are taken for equal (these only cost an extra
candidate); the last level has a 64-bit hash within its bucket.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import materialise, utf8
from emporia.llm.wordhash import SPACES, Words, joined, words

WINDOW = 20
SHORTEST = 10
# Text of a block, and windows of a bucket, at most about this many; MOST_BITS bounds the number of buckets.
BLOCK_BYTES = 4 << 20
PER_BUCKET = 1 << 18
MOST_BITS = 20
# False candidates of the short levels: one window in 2 ** SPARE_BITS or so.
SPARE_BITS = 6
NULL_ID = -(1 << 63)

BLOCK = "block bigint, n_words bigint, doc_ids array<bigint>, nulls array<boolean>, lengths array<int>, texts binary"


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents packed into blocks; in a block they stand by doc_id (nulls first), equal ids as they came."""

    def each(batches):
        number, rows, held = TaskContext.get().partitionId() << 32, [], 0
        squeeze = zstandard.ZstdCompressor(level=3)

        def block():
            rows.sort(key=lambda x: NULL_ID if x[0] is None else x[0])
            texts = [x[1] for x in rows]
            n = int(words(texts, SPACES).first[-1])
            data = [[number], [n], [[NULL_ID if x[0] is None else x[0] for x in rows]], [[x[0] is None for x in rows]], [list(map(len, texts))], [squeeze.compress(b"".join(texts))]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(data, kinds)], names=["block", "n_words", "doc_ids", "nulls", "lengths", "texts"])

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if rows and held + len(row[1]) > block_bytes:
                    yield block()
                    number, rows, held = number + 1, [], 0
                rows.append(row)
                held += len(row[1])
        if rows:
            yield block()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(each, BLOCK)


@dataclass(frozen=True)
class Level:
    """Windows of a block at one length: their places, and the distinct ones (two hashes, first index, times); window i is ``which[i]``."""

    places: np.ndarray
    distinct: np.ndarray
    second: np.ndarray
    first: np.ndarray
    which: np.ndarray
    often: np.ndarray


class Open:
    """A block opened in a task: its texts, and the candidates that the levels so far have left."""

    def __init__(self, row: dict):
        self.block, self.doc_ids, self.nulls = row["block"], np.array(row["doc_ids"], dtype=np.int64), row["nulls"]
        data, ends = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["texts"] else b"", np.cumsum([0, *row["lengths"]])
        self.texts = [data[a:b] for a, b in zip(ends[:-1], ends[1:])]
        self.words: Words = words(self.texts, SPACES)

    def at_level(self, lengths: list[int], answers: dict[int, dict[int, bytes]], bits: int, whole: bool = False) -> Level:
        """Windows of the last of ``lengths`` that survive the earlier levels' answers; ``whole``: told apart by 128 bits."""
        places, hashes, repeated = None, None, None
        for level, n in enumerate(lengths):
            if places is None:
                places = np.flatnonzero(self.words.whole(n))
                hashes = self.words.windows(n)[places]
            else:
                known = np.zeros(len(self.words.hashes) + n, dtype=np.uint64)
                alive = np.zeros(len(known), dtype=bool)
                known[places], alive[places] = hashes, repeated
                inside = np.zeros(len(known), dtype=bool)
                fits = self.words.whole(n)
                inside[: len(fits)] = fits
                places = places[repeated & alive[places + n // 2] & inside[places]]
                hashes = joined(known[places], known[places + n // 2])
            if level + 1 < len(lengths):
                distinct, which, often = np.unique(hashes, return_inverse=True, return_counts=True)
                repeated = ((often > 1) | answered(distinct, answers.get(level, {}), bits))[which]
        second = words(self.texts, SPACES, seed=1).windows(lengths[-1])[places] if whole and len(places) else np.zeros(len(places), dtype=np.uint64)
        order = np.lexsort((second, hashes))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
        first = order[new]  # equal ones keep their order, so these are the first places
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return Level(places, hashes[first], second[first], first, which, np.bincount(which, minlength=len(first)))

    def sent(self, distinct: np.ndarray, bits: int):
        """(bucket, range of ``distinct``) for every bucket that gets some."""
        bucket = top(distinct, bits)
        begins = np.flatnonzero(np.diff(bucket, prepend=-1))
        yield from zip(bucket[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(distinct)])


def top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def answered(distinct: np.ndarray, answers: dict[int, bytes], bits: int) -> np.ndarray:
    """The buckets' bits for the distinct hashes of a block; False where there is no answer."""
    out = np.zeros(len(distinct), dtype=bool)
    bucket = top(distinct, bits)
    for number, answer in answers.items():
        a, b = np.searchsorted(bucket, [number, number + 1])
        out[a:b] = np.unpackbits(np.frombuffer(answer, dtype=np.uint8), count=b - a).astype(bool)
    return out


def _answers(table: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for row in table.to_pylist():
        out.setdefault(row["level"], {})[row["bucket"]] = row["answer"]
    return out


ANSWER = "block bigint, level int, bucket int, answer binary"


def entries(packed: DataFrame, flags: DataFrame | None, lengths: list[int], bits: int, width: int) -> DataFrame:
    """What the blocks send at the last of ``lengths``: one row per block and bucket.

    ``width`` bytes of hash below the bucket's bits for a count (with a bit for
    each: more than once in the block?), or 0 for the last level: both whole
    hashes, and the doc_id of each one's first place.
    """
    schema = "bucket int, block bigint, hashes binary, docs binary"

    def rows(own: Open, answers):
        at = own.at_level(lengths, answers, bits, whole=not width)
        if not width:
            doc = np.searchsorted(own.words.first, at.places[at.first], side="right") - 1
            ids = own.doc_ids[doc]
        out = []
        for bucket, a, b in own.sent(at.distinct, bits):
            h = at.distinct[a:b]
            if width:
                kept = (h << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]
                out.append((bucket, own.block, kept.tobytes(), np.packbits(at.often[a:b] > 1).tobytes()))
            else:
                both = np.stack([h, at.second[a:b]], axis=1)
                out.append((bucket, own.block, both.astype("<u8").tobytes(), ids[a:b].astype("<i8").tobytes()))
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "block", "hashes", "docs"])

    return opened(packed, flags, rows, schema)


def opened(packed: DataFrame, flags: DataFrame | None, fn, schema: str) -> DataFrame:
    """``fn(block, answers)`` for each block with the answers it has so far."""
    if flags is None:

        def alone(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    yield from fn(Open(row), {}).to_batches()

        return packed.mapInArrow(alone, schema)

    def together(left, right):
        return fn(Open(left.to_pylist()[0]), _answers(right))

    return packed.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(together, schema)


def repeated_anywhere(sent: DataFrame, level: int, width: int) -> DataFrame:
    """For each entry one bit: is it in two blocks (or two entries cut to the same bytes), or twice in its own?"""

    def fn(table):
        counts = [len(x) // width for x in table.column("hashes").to_pylist()]
        raw = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.uint8).reshape(-1, width)
        wide = np.zeros((len(raw), 8), dtype=np.uint8)
        wide[:, :width] = raw
        _, which, often = np.unique(wide.view(">u8").ravel().astype(np.uint64), return_inverse=True, return_counts=True)
        twice = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n) for x, n in zip(table.column("docs").to_pylist(), counts)]
        return _bits(table, level, counts, (often > 1)[which] | np.concatenate(twice).astype(bool))

    return sent.groupBy("bucket").applyInArrow(fn, ANSWER)


def not_first(sent: DataFrame, level: int) -> DataFrame:
    """For each entry one bit: does its window start earlier in another block (smaller doc_id; equal ids: by block)?"""

    def fn(table):
        parts = [np.frombuffer(x, dtype="<u8").reshape(-1, 2) for x in table.column("hashes").to_pylist()]
        hashes, second = np.concatenate(parts).T
        docs = np.concatenate([np.frombuffer(x, dtype="<i8") for x in table.column("docs").to_pylist()])
        counts = list(map(len, parts))
        block = np.repeat(table.column("block").to_numpy(), counts)
        order = np.lexsort((block, docs, second, hashes))
        later = np.zeros(len(hashes), dtype=bool)
        later[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (second[order[1:]] == second[order[:-1]])
        return _bits(table, level, counts, later)

    return sent.groupBy("bucket").applyInArrow(fn, ANSWER)


def _bits(table, level, counts, flags):
    """One answer per block with a set bit."""
    ends = np.cumsum([0, *counts])
    rows = [
        (block, level, bucket, np.packbits(flags[a:b]).tobytes())
        for block, bucket, a, b in zip(table.column("block").to_pylist(), table.column("bucket").to_pylist(), ends[:-1], ends[1:])
        if flags[a:b].any()
    ]
    kinds = {"block": pa.int64(), "level": pa.int32(), "bucket": pa.int32(), "answer": pa.binary()}
    return pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(kinds.items())})


def deduplicate(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, keep_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and (``keep_text``) ``text``.

    Removes every word covered by a window of ``window`` words (runs of
    non-space characters, unchanged) that also starts earlier: in a smaller
    doc_id, or before in the same document. ``text`` is the kept words joined by
    one space. Null and short texts lose nothing and have no words or few.
    Null ids count as smallest; of rows with equal ids the one read first is
    the earlier. An empty table gives no rows.

    ``shortest`` is the length of the first level; ``window`` is it doubled a
    whole number of times.
    """
    lengths = [shortest]
    while lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    if lengths[-1] != window:
        raise ValueError(f"window {window} is not {shortest} doubled a whole number of times")
    packed = materialise(blocks(docs), "substring-blocks")
    total = packed.agg(F.sum("n_words")).first()[0] or 0
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, total) / PER_BUCKET))))
    width = min(8, max(1, math.ceil((math.log2(max(2, total)) + SPARE_BITS - bits) / 8)))
    flags: DataFrame | None = None
    last = len(lengths) - 1
    for level in range(last):
        found = repeated_anywhere(entries(packed, flags, lengths[: level + 1], bits, width), level, width)
        found = materialise(found, f"substring-level-{lengths[level]}")
        flags = found if flags is None else flags.union(found)
        if not found.limit(1).count():  # no candidate survives
            break
    else:
        final = not_first(entries(packed, flags, lengths, bits, 0), last)
        flags = final if flags is None else flags.union(final)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", text string" if keep_text else "")

    def rows(own: Open, answers):
        at = own.at_level(lengths, answers, bits, whole=True)
        later = np.ones(len(at.places), dtype=bool)
        later[at.first] = answered(at.distinct, answers.get(last, {}), bits)
        edge = np.zeros(len(own.words.hashes) + 1, dtype=np.int64)
        np.add.at(edge, at.places[later], 1)
        np.add.at(edge, at.places[later] + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        out, begins = [], np.cumsum([0] + [len(x) + 1 for x in own.texts])
        for i, text in enumerate(own.texts):
            a, b = int(own.words.first[i]), int(own.words.first[i + 1])
            lost = int(gone[a:b].sum())
            if lost:
                kept = np.flatnonzero(~gone[a:b]) + a
                text = b" ".join(own.words.data[s:e] for s, e in zip(own.words.starts[kept].tolist(), own.words.ends[kept].tolist()))
            else:
                text = b" ".join(text.split())
            out.append((None if own.nulls[i] else int(own.doc_ids[i]), b - a, lost, hashlib.sha256(text).hexdigest(), *([text.decode()] if keep_text else [])))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "text"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names[: len(out[0])])

    return opened(packed, flags, rows, schema)

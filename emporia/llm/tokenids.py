"""Token ids in a binary file format: canonical, length-limited Huffman codes in independent blocks.

The format is a folder of three tables that any Spark reader can open:

* ``codebook``: one row per id that occurs, with its code length. Codes are
  canonical (ascending by length, then by id), so lengths are all it needs.
* ``blocks``: one row per block of whole documents in ascending doc_id order:
  ``part`` and ``seq`` (the block's place), ``doc_ids``, ``lengths`` (ids of
  each document), ``checkpoints`` (the bit offset of every 256th id) and
  ``payload`` (the codes, first bit highest).
* ``index``: ``part``, ``seq`` and ``start``, the number of ids before the block.

A block needs nothing but the codebook, and every checkpoint in it is an entry
point. The reader decodes all stretches between checkpoints side by side with
one table lookup per id.

Writing takes three passes: tokenise into blocks of plain ids (the documents
range-partitioned and sorted by doc_id), count the ids of all blocks, encode.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from emporia.llm.common import materialise, utf8

END_ID = 2
LONGEST_CODE = 16
CHECKPOINT = 256
BLOCK_IDS = 1 << 18
CACHED_WORDS = 150_000
VOCABULARY = "word_bpe_49k.json"

# The bytes that byte-level BPE writes as themselves; the others are written as code points from 256 on, in order.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}

# Letters and then ASCII marks but the apostrophe, which the tokenizer's own pattern keeps with some letters.
_LETTERS_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")

# A comma or full stop behind an ASCII letter: always a piece of its own, or the first mark of one.
_STOPS = re.compile(r"[,.](?<=[A-Za-z].)")

# The same in lower-case Latin-1, where nothing joins a letter, each on its own: a literal is found faster than a set.
_LATIN_COMMA, _LATIN_STOP = re.compile(r",(?<=[a-zß-öø-ÿ].)"), re.compile(r"\.(?<=[a-zß-öø-ÿ].)")


class Encoder:
    """Ids of whole texts by a tokenizers file.

    Where the file drops white space and merges inside words only, the ids of
    a text are those of its words one after another, and the ids of recent
    words are kept; otherwise each text is encoded as one. Latin-1 is in the
    normaliser's form but for its capitals: such texts are lower-cased whole,
    unless they hold a special string, which only counts as it stands.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in (config["normalizer"] or {}).get("normalizers", [])]
        split = ((config["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.by_word = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and split.get("invert") is True
            and split.get("behavior") == "Removed"
            and "[\\p{L}]+|" in split["pattern"].get("Regex", "")
            and bool(config["model"].get("end_of_word_suffix"))
            and not any(x["single_word"] or x["lstrip"] or x["rstrip"] or _STOPS.search(x["content"]) for x in config["added_tokens"])
        )
        self.special = [x["content"].lower() for x in config["added_tokens"]]
        self.words = _Words(self.tokenizer)

    def ids(self, text: bytes, end_id: int = END_ID) -> np.ndarray:
        string, end = text.decode(), np.array([end_id], dtype="<u4").tobytes()
        if not self.by_word:
            return np.array([*self.tokenizer.encode(string, add_special_tokens=False).ids, end_id], dtype="<u4")
        # words are held without the stops behind them; what Σ becomes may depend on letters before a stop
        if _latin(string) and not any(x in (low := string.lower()) for x in self.special):
            string = _LATIN_COMMA.sub(" ,", _LATIN_STOP.sub(" .", low))
        elif "Σ" not in string:
            string = _STOPS.sub(r" \g<0>", string)
        # str.split also parts at U+001C to U+001F, which are no white space to the tokenizer
        found = string.split(" ") if any(x in string for x in "\x1c\x1d\x1e\x1f") else string.split()
        return np.frombuffer(b"".join([*map(self.words.__getitem__, found), end]), dtype="<u4")


def _latin(text: str) -> bool:
    """Only code points below U+0100?"""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _lowered(letters: str) -> str:
    """What the tokenizer's normaliser makes of a run of letters; empty where more than letters, or other ones, may come out of it.

    Letters that NFC takes apart, and capitals whose lower case is a letter and
    a mark (U+0130), would join the marks behind them; a last Σ depends on what follows.
    """
    if letters.isascii():
        return letters.lower()
    if "Σ" in letters or not unicodedata.is_normalized("NFC", letters):
        return ""
    low = letters.lower()
    return low if low.isalpha() else ""


class _Words(dict):
    """Word -> its ids as bytes; holds the words of late, in two generations."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.old = tokenizer, tokenizer.model, {}
        self.model._resize_cache(0)  # words that come again are held here
        self.packed = [np.array([i], dtype="<u4").tobytes() for i in range(tokenizer.get_vocab_size())]

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.encode(word)
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found

    def encode(self, word: str) -> bytes:
        if word.isalpha():
            if low := _lowered(word):
                own = low if low.isascii() else low.encode().decode("latin-1").translate(_BYTE_LEVEL)
                return b"".join([self.packed[t.id] for t in self.model.tokenize(own)])
        elif (two := _LETTERS_MARKS.fullmatch(word)) and _lowered(two[1]):  # a run of letters, then one of marks: two pieces
            return self[two[1]] + self[two[2]]
        return b"".join([self.packed[x] for x in self.tokenizer.encode(word, add_special_tokens=False).ids])


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """The encoder of a tokenizers file, one per Python worker; None is the public vocabulary ``VOCABULARY``."""
    if path not in _encoders:
        from public_tokenizers import path as public

        _encoders[path] = Encoder(path or public(VOCABULARY))
    return _encoders[path]


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``longest`` bits (package-merge); all counts are positive."""
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids have no code of {longest} bits")
    by_count = np.argsort(counts, kind="stable")
    leaves = counts[by_count].astype(np.int64)
    merged, levels = leaves, [np.ones(n, dtype=bool)]
    for _ in range(longest - 1):
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1 : len(merged) // 2 * 2 : 2]
        order = np.argsort(np.concatenate([leaves, packages]), kind="stable")
        levels.append(order < n)
        merged = np.concatenate([leaves, packages])[order]
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[by_count[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


class Code:
    """Canonical code of ids (ascending) with code lengths; makes the encoder's and the decoder's tables."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.sizes = ids[order].astype(np.uint32), lengths[order].astype(np.int64)
        self.bits = int(self.sizes.max(initial=1))
        steps = np.left_shift(1, self.bits - self.sizes)
        self.first = np.concatenate([[0], np.cumsum(steps)])  # each code as a number of ``bits`` bits
        self.size_of = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.int64)
        self.code_of = np.zeros(len(self.size_of), dtype=np.uint64)
        self.size_of[self.ids] = self.sizes
        self.code_of[self.ids] = (self.first[:-1] >> (self.bits - self.sizes)).astype(np.uint64)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The codes' bits, and the bit offset of every ``CHECKPOINT``-th id."""
        if not len(ids):
            return b"", np.zeros(0, dtype=np.int64)
        sizes = self.size_of[ids]
        ends = np.cumsum(sizes)
        at = ends - sizes
        placed = self.code_of[ids] << (64 - sizes - (at & 31)).view(np.uint64)  # in the two words of 32 bits that it begins in
        word = at >> 5
        groups = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(int(ends[-1]) // 32 + 2, dtype=np.uint64)
        # bits of different codes never meet, so sums are unions
        out[word[groups]] = np.add.reduceat(placed >> np.uint64(32), groups)
        out[word[groups] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), groups)
        return out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], at[::CHECKPOINT]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        spans = np.diff(self.first)
        rest = (1 << self.bits) - int(self.first[-1])  # unused codes of an incomplete code
        symbols = np.concatenate([np.repeat(self.ids, spans), np.zeros(rest, dtype=np.uint32)])
        sizes = np.concatenate([np.repeat(self.sizes, spans), np.ones(rest, dtype=np.int64)])
        return symbols, sizes

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, tables) -> np.ndarray:
        symbols, sizes = tables
        padded = payload + bytes(CHECKPOINT * self.bits // 8 + 8)
        words = np.ndarray((len(padded) - 3,), dtype=">u4", buffer=padded, strides=(1,))
        out = np.empty((min(CHECKPOINT, n), len(checkpoints)), dtype=np.uint32)
        at, mask = checkpoints.astype(np.int64), (1 << self.bits) - 1
        for row in out:
            code = (words[at >> 3].astype(np.int64) >> (32 - self.bits - (at & 7))) & mask
            row[:] = symbols[code]
            at = at + sizes[code]
        return out.T.ravel()[:n]


PLAIN = "part int, seq int, doc_ids array<bigint>, lengths array<bigint>, ids binary"
BLOCKS = "part int, seq int, doc_ids array<bigint>, lengths array<bigint>, checkpoints array<bigint>, payload binary"


def plain_blocks(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS, order: list[Column] | None = None
) -> DataFrame:
    """Blocks of plain ids of whole documents by ``order``, or in ascending doc_id order (nulls first; equal ids by a hash of the text)."""

    def each(batches):
        own, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=1)
        doc_ids, found, held = [], [], 0

        def block():
            data = np.concatenate(found).astype("<u4")
            small = data.astype("<u2") if data.max(initial=0) < 1 << 16 else data
            row = [[part], [seq], [doc_ids], [[len(x) for x in found]], [squeeze.compress(bytes([small.itemsize]) + small.tobytes())]]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["part", "seq", "doc_ids", "lengths", "ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids = own.ids(text, end_id)
                if held and held + len(ids) > block_ids:
                    yield block()
                    doc_ids, found, held, seq = [], [], 0, seq + 1
                doc_ids.append(doc_id)
                found.append(ids)
                held += len(ids)
        if found:
            yield block()

    own = [F.col("doc_id").cast("bigint"), F.xxhash64("text")] if order is None else order
    keys = [f"_order_{i}" for i in range(len(own))]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *[c.alias(k) for c, k in zip(own, keys)])
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select("doc_id", "text").mapInArrow(each, PLAIN)


def unsqueezed(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1)


def counts(plain: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs, added up per task before the shuffle."""

    def each(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                own = np.bincount(unsqueezed(data))
                if len(own) > len(total):
                    own, total = total, own.astype(np.int64)
                total[: len(own)] += own
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return plain.select("ids").mapInArrow(each, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    longest: int = LONGEST_CODE,
    order: list[Column] | None = None,
) -> None:
    """Write the ids of all documents (doc_id, text; null text: empty) to the folder ``path``.

    The files are in doc_id order, or in that of the columns ``order``.
    Every row gives at least its end id; repeated rows are written as often as
    they stand; an empty table gives empty tables. The id counts that reach the
    driver are bounded by the vocabulary.
    """
    spark = docs.sparkSession
    plain = materialise(plain_blocks(docs, tokenizer, end_id, order=order), "token-ids")
    seen = sorted((r["id"], r["n"]) for r in counts(plain).collect())
    ids = np.array([x for x, _ in seen], dtype=np.int64)
    lengths = code_lengths(np.array([n for _, n in seen], dtype=np.int64), max(longest, int(max(1, len(seen) - 1)).bit_length()))
    book = [(int(a), int(b)) for a, b in zip(ids, lengths)]
    spark.createDataFrame(book, "id bigint, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((ids, lengths))

    def each(batches):
        code = Code(*shared.value)
        for batch in batches:
            made = [code.encode(unsqueezed(x)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("part", "seq", "doc_ids", "lengths")],
                    pa.array([at.tolist() for _, at in made], pa.list_(pa.int64())),
                    pa.array([x for x, _ in made], pa.binary()),
                ],
                names=["part", "seq", "doc_ids", "lengths", "checkpoints", "payload"],
            )

    plain.mapInArrow(each, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    # one row per block; the totals of the parts are one row per partition of the exchange
    sizes = spark.read.parquet(f"{path}/blocks").select("part", "seq", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda n, x: n + x).alias("n"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    between = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(between), F.lit(0)).alias("before"))
    index = sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part")
    index.select("part", "seq", (F.col("before") + F.col("inside")).alias("start")).write.parquet(f"{path}/index")


def decoded(spark: SparkSession, path: str, fn, schema: str) -> DataFrame:
    """What ``fn(doc_id, first, ids)`` gives of each document: ``part``, ``seq`` and its columns; ``first`` counts in the block."""
    book = sorted((r["id"], r["length"]) for r in spark.read.parquet(f"{path}/codebook").collect())
    shared = spark.sparkContext.broadcast(book)
    names = [x.split()[0] for x in schema.split(",")]

    def each(batches):
        code = Code(*(np.array([x[i] for x in shared.value], dtype=np.int64) for i in (0, 1)))
        tables = code.tables()
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.cumsum(row["lengths"])
                ids = code.decode(row["payload"], np.array(row["checkpoints"], dtype=np.int64), int(ends[-1]), tables).astype("<u4")
                out = [fn(d, int(b - n), ids[b - n : b]) for d, n, b in zip(row["doc_ids"], row["lengths"], ends)]
                place = [pa.array([row[c]] * len(out), pa.int32()) for c in ("part", "seq")]
                yield pa.RecordBatch.from_arrays([*place, *map(pa.array, zip(*out))], names=["part", "seq", *names])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(each, f"part int, seq int, {schema}")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and the crc32 of its ids as little-endian unsigned 32-bit integers."""

    def fn(doc_id, first, ids):
        return doc_id, first, len(ids), zlib.crc32(ids.tobytes())

    rows = decoded(spark, path, fn, "doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    index = spark.read.parquet(f"{path}/index")
    return rows.join(index, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array) of every document of the files."""
    return decoded(spark, path, lambda doc_id, _, ids: (doc_id, ids.tolist()), "doc_id bigint, ids array<bigint>").select("doc_id", "ids")

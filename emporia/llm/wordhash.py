"""Vectorised 64-bit hashes of the words, and of word windows, of UTF-8 texts.

Words are found and hashed for a whole batch of texts at once with numpy, so
no Python object is made per word. Memory is bounded: bytes are hashed in
pieces of a quarter megabyte, cut between words.

A word is read in steps of eight bytes, and every step goes through a
bijection whose output bits depend on all input bits; words of more than
``LONG`` bytes are hashed by XXH3. A window is hashed by halves, each mixed
before it is added to the other. No sum or polynomial of bytes or words is
taken, so there are no texts whose hashes agree by algebra; unequal words or
windows agree as random values do, one pair in 2^64. Hashes of two seeds are
independent: where one would not do, the second makes it 128 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

PIECE = 1 << 18
LONG = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Scheme:
    """Which bytes belong to words, and what each byte is read as."""

    word: np.ndarray
    fold: np.ndarray


def _spaces() -> Scheme:
    word = np.ones(256, dtype=bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return Scheme(word, np.arange(256, dtype=np.uint8))


def _alphanumeric() -> Scheme:
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 0x20
    word = np.zeros(256, dtype=bool)
    word[0x30:0x3A] = word[0x41:0x5B] = word[0x61:0x7B] = word[0x80:] = True
    return Scheme(word, fold)


def _lower_spaces() -> Scheme:
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 0x20
    return Scheme(_spaces().word, fold)


#: ``[^\x20\x09-\x0D]+``, unchanged.
SPACES = _spaces()
#: ``[^\x20\x09-\x0D]+`` after lower-casing A-Z.
LOWER_SPACES = _lower_spaces()
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. A byte of a code point above U+007F is a word byte.
ALPHANUMERIC = _alphanumeric()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits (SplitMix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two neighbours each, from those of the left and of the right one."""
    return mixed(left * _MULTIPLIER + right)


def _piece(data: np.ndarray, scheme: Scheme, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = scheme.word[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0][: int(len(data) > 0 and inside[0])], edges, [len(data)][: int(len(data) > 0 and inside[-1])]])
    starts, ends = edges[0::2].astype(np.int64), edges[1::2].astype(np.int64)
    lengths = ends - starts
    folded = np.zeros(len(data) + 8, dtype=np.uint8)
    folded[: len(data)] = scheme.fold[data]
    eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=folded, strides=(1,))  # the eight bytes from each place on
    hashes = mixed(lengths.astype(np.uint64) ^ mixed(np.full(1, seed + 1, dtype=np.uint64)))
    long = lengths > LONG
    for i in np.flatnonzero(long).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(folded[starts[i] : ends[i]].tobytes(), seed)
    now, at = np.flatnonzero(~long), 0
    while len(now):
        left = lengths[now] - at
        unused = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
        hashes[now] = mixed(hashes[now] ^ (eights[starts[now] + at] << unused))
        now, at = now[left > 8], at + 8
    return starts, ends, hashes


@dataclass(frozen=True)
class Words:
    """Words of a batch of texts: byte range in ``data`` and hash of each; text i has the words first[i]:first[i + 1]."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def windows(self, n: int, hashes: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``n`` words from each word on; windows that leave the text are among them (see ``whole``)."""
        h = self.hashes if hashes is None else hashes
        count = len(h) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        out, done, twos, width = None, 0, h, 1  # ``twos``: windows of ``width`` words, a power of two
        while True:
            if n & width:
                part = twos[done : done + count]
                out = mixed(part) if out is None else joined(out, part)
                done += width
            if done == n:
                return out
            twos, width = joined(twos[:-width], twos[width:]), 2 * width

    def whole(self, n: int) -> np.ndarray:
        """Does the window of ``n`` words from each word on stay in its text? As many as ``windows(n)`` has."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        count = max(0, len(self.hashes) - n + 1)
        return np.arange(count) + n <= last[:count]

    def text(self, i: int, n: int, scheme: Scheme) -> bytes:
        """Words i to i + n - 1, folded and joined by one space."""
        table = scheme.fold.tobytes()
        return b" ".join(self.data[s:e].translate(table) for s, e in zip(self.starts[i : i + n], self.ends[i : i + n]))


def words(texts: list[bytes], scheme: Scheme, seed: int = 0) -> Words:
    data = b"\n".join(texts)
    whole = np.frombuffer(data, dtype=np.uint8)
    starts, ends, hashes, at = [], [], [], 0
    while at < len(whole):
        to = min(at + PIECE, len(whole))
        while to < len(whole):  # on to the next byte outside words
            gap = np.flatnonzero(~scheme.word[whole[to : to + PIECE]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(to + PIECE, len(whole))
        s, e, h = _piece(whole[at:to], scheme, seed)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(h)
        at = to
    joined = [np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in ((starts, np.int64), (ends, np.int64), (hashes, np.uint64))]
    begins = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])]).astype(np.int64)
    return Words(data, *joined, np.searchsorted(joined[0], begins))

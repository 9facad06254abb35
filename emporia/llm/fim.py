"""Fill-in-the-middle: documents rewritten as prefix, suffix and middle between sentinels.

One ``regex`` fullmatch of ``(unit)*`` covers a text and keeps every
repetition of the group, so ``match.ends(1)`` is at once the number of units
and the place where each of them ends: both cuts are looked up, nothing is
iterated. The cuts and the form are drawn from a digest of the seed and the
document's id, so reruns agree wherever and however often a task runs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_batches, set_aside

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
# Of 100 documents so many stay as they are, and of 100 rewritten ones so many put the suffix first.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
#: A run of ASCII letters, or any other code point: the units cover every text.
UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
_LETTERS = regex.compile(r"[A-Za-z]*")
# Code points of one match: the library's stack for a repeated group ends between 5 and 10 million units.
LONGEST_MATCH = 1 << 18

NEW = {
    "n": "bigint",
    "form": "string",
    "prefix_chars": "bigint",
    "middle_chars": "bigint",
    "output": "string",
}


@dataclass(frozen=True)
class Draws:
    """The four numbers drawn for a document: two cuts, plain or not, suffix first or not."""

    cut: int
    other: int
    plain: int
    spm: int

    @classmethod
    def of(cls, doc_id, seed: int = SEED) -> Draws:
        name = "" if doc_id is None else str(doc_id)
        digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
        return cls(*(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)))


@dataclass(frozen=True)
class Rewritten:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def unit_ends(text: str) -> list[int]:
    """Where each unit of ``text`` ends: from one match, or for a text longer than ``LONGEST_MATCH`` from a few, parted between units."""
    if len(text) <= LONGEST_MATCH:
        return UNITS.fullmatch(text).ends(1)
    ends, at = [], 0
    while at < len(text):
        to = min(at + LONGEST_MATCH, len(text))
        to = max(to, _LETTERS.match(text, to - 1).end())  # to the end of a run of letters
        ends += UNITS.fullmatch(text, at, to).ends(1)
        at = to
    return ends


def rewrite(text: str, draws: Draws) -> Rewritten:
    """``text`` in the form that is drawn for it."""
    ends = unit_ends(text)
    n = len(ends)
    if not text or draws.plain % 100 >= 100 - PLAIN_PERCENT or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)):
        return Rewritten(n, "plain", None, None, text)
    a, b = sorted((draws.cut % (n + 1), draws.other % (n + 1)))
    first, second = (ends[x - 1] if x else 0 for x in (a, b))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if draws.spm % 100 < SPM_PERCENT:
        return Rewritten(n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Rewritten(n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


def restore(output: str, form: str) -> str:
    """The text that ``rewrite`` was given, from its output and form alone.

    A text that holds a sentinel is never cut, and no sentinel overlaps itself
    or another, so the first place of each is its own.
    """
    if form == "plain":
        return output
    second = PREFIX if form == "spm" else SUFFIX
    one, _, rest = output[len(PREFIX) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def transform(docs: DataFrame, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text) with the columns of ``NEW``; own columns of those names give way to them.

    ``keep`` names the columns of ``docs`` that stay (all by default). ``n``
    counts units. A null text counts as empty; an empty text, and one that
    holds a sentinel, is plain. ``prefix_chars`` and ``middle_chars`` are code
    points, null for plain. A null id draws as an empty one; equal rows and
    rows with equal ids are each rewritten, with the same draws. Texts of more
    than ``LONGEST_MATCH`` code points take several matches, with the same
    result. An empty table gives no rows.
    """

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        made = [rewrite(x or "", Draws.of(i, seed)) for i, x in zip(ids, texts)]
        return [
            pa.array([x.n for x in made], pa.int64()),
            pa.array([x.form for x in made], pa.string()),
            pa.array([x.prefix_chars for x in made], pa.int64()),
            pa.array([x.middle_chars for x in made], pa.int64()),
            pa.array([x.output for x in made], pa.string()),
        ]

    kept = [c for c in (keep or docs.columns) if c.lower() not in NEW]
    return map_batches(docs.select(*dict.fromkeys([*kept, "doc_id", "text"])), fn, NEW, kept)


def restored(made: DataFrame) -> DataFrame:
    """``made`` (with ``output`` and ``form``) and ``restored``, the text rebuilt from these two; a null output gives null."""

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        pairs = zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())
        return [pa.array([None if o is None else restore(o, f) for o, f in pairs], pa.string())]

    slim, _ = set_aside(made, ["restored"])
    return map_batches(slim, fn, {"restored": "string"}, slim.columns)


def digests(made: DataFrame) -> DataFrame:
    """``made`` with ``output_sha256`` and ``restored_sha256`` in place of the texts."""
    return restored(made).select(
        *[F.col(f"`{c}`") for c in made.columns if c != "output"],
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(F.col("restored"), 256).alias("restored_sha256"),
    )

"""Toxicity: a logistic classifier with counterfactual regularisation.

Features are the words of a text. In each labelled sentence that mentions a
group, the identity term is swapped for every other term of the list and for
no term at all, and the squared change of the sentence's score is added to the
loss. A word that only names a group can then carry no weight of its own, so
neutral mentions are not taken for toxic ones, even if the labelled toxic texts
mention the group more often.

Vocabulary statistics and mentions come from all labelled rows that may be
learnt from, in one distributed count. The fit itself is on a bounded sample:
``SAMPLE`` labelled rows per label (all rows, if there are fewer), chosen by a
hash of the id; the intercept is corrected to the label shares of all labelled
rows.

Texts stay where they are read. What goes into the join with the labels is a
document's distinct words and its mentions, compressed; by the same shuffled
join at every size.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_batches, materialise, utf8

SAMPLE = 15_000
FEATURES = 4_000
LEAST_ROWS = 4
MENTION = -1
PENALTY = 10.0
RIDGE = 2e-5
STEPS = 250

# Words that name groups of people.
IDENTITY_TERMS = (
    "women", "woman", "men", "man", "girls", "boys", "female", "male", "transgender", "trans",
    "gay", "lesbian", "bisexual", "queer", "straight", "heterosexual", "homosexual",
    "black", "white", "asian", "african", "european", "american", "latino", "hispanic", "arab", "indian", "chinese",
    "mexican", "immigrants", "immigrant", "refugees", "refugee", "foreigners",
    "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "hindus", "buddhist", "catholic", "atheist",
    "old", "young", "elderly", "teenage", "blind", "deaf", "disabled", "autistic",
    "mujeres", "hombres", "femmes", "hommes", "frauen", "männer", "juden", "muslime", "judíos", "musulmanes", "juifs", "musulmans",
)

_ASCII = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
# Punctuation and spaces of U+00A0 to U+00BF, U+2000 to U+206F and U+3000 to U+3002.
_MARKS = re.compile(rb"\xc2[\xa0-\xbf]|\xe2[\x80\x81][\x80-\xbf]|\xe3\x80[\x80-\x82]")
_SENTENCE = re.compile(rb"[.!?\n]+")


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and of code points above U+007F that are no common punctuation."""
    return _MARKS.sub(b" ", text).translate(_ASCII).split()


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    intercept: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        known, w = self.weights.keys(), self.weights
        total = np.array([self.intercept + sum(sorted(map(w.__getitem__, known & set(tokens(x))))) for x in texts])
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def sample(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of at most ``most`` rows per label, by a hash of the id."""
    parts = [labels.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    return parts[0].union(parts[1])


def packed(text: bytes, named: frozenset[bytes]) -> bytes:
    """The distinct words of a text, a line each, and after an empty line the words of ``named`` once for each sentence with them."""
    found = set(tokens(text))
    mentions = [w for sentence in _SENTENCE.split(text) for w in sorted(named & set(tokens(sentence)))] if named & found else []
    return b"\n".join(sorted(found)) + b"\n\n" + b"\n".join(mentions)


def unpacked(data: bytes) -> tuple[list[bytes], list[bytes]]:
    """The distinct words and the mentions of a text."""
    found, _, mentions = data.partition(b"\n\n")
    return found.split(b"\n") if found else [], mentions.split(b"\n") if mentions else []


def words_of(docs: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """(doc_id, words): what ``packed`` makes of each text, compressed."""
    named = frozenset(x.encode() for x in identity)

    def fn(batch: pa.RecordBatch, squeeze) -> list[pa.Array]:
        return [pa.array([squeeze.compress(packed(x, named)) for x in utf8(batch.column("text"))], pa.binary())]

    slim = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    return map_batches(slim, fn, {"words": "binary"}, ["doc_id"], setup=lambda: zstandard.ZstdCompressor(level=3))


def corpus_counts(words: DataFrame) -> DataFrame:
    """(word, kind, n) over all rows of ``words`` (label, words): a word's texts by label, and all texts by label as the empty word.

    Of kind MENTION: the sentences with an identity term.
    """

    def each(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            out: Counter = Counter()
            for label, data in zip(batch.column("label").to_pylist(), batch.column("words").to_pylist()):
                found, mentions = unpacked(open_.decompress(data))
                out.update((word, label) for word in found)
                out[b"", label] += 1
                out.update((word, MENTION) for word in mentions)
            cols = list(zip(*((*key, n) for key, n in out.items()))) or [[], [], []]
            kinds = pa.binary(), pa.int32(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["word", "kind", "n"])

    found = words.select("label", "words").mapInArrow(each, "word binary, kind int, n bigint")
    return found.groupBy("word", "kind").agg(F.sum("n").alias("n"))


def vocabulary(n: DataFrame, rows: dict[int, int], features: int, identity: tuple[str, ...]) -> dict[bytes, float]:
    """The ``features`` words whose presence parts the labels most clearly, by |z| of the log odds ratio, and the identity terms.

    The value of a word is its |z| over the largest; identity terms have at least a tenth.
    """
    n = n.filter((F.length("word") > 0) & (F.col("kind") != MENTION))
    n1 = F.sum(F.when(F.col("kind") == 1, F.col("n")).otherwise(0))
    n0 = F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(0))
    both = n.groupBy("word").agg(n1.alias("n1"), n0.alias("n0")).filter(F.col("n1") + F.col("n0") >= LEAST_ROWS)
    odds = F.log((F.col("n1") + 0.5) / (rows[1] - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (rows[0] - F.col("n0") + 0.5))
    z = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = both.select("word", F.abs(z).alias("z")).orderBy(F.desc("z"), "word").limit(features).collect()
    top = max((r["z"] for r in best), default=1.0) or 1.0
    found = {x.encode(): 0.1 for x in identity}
    for r in best:
        found[bytes(r["word"])] = max(r["z"] / top, found.get(bytes(r["word"]), 0.0))
    return dict(sorted(found.items()))


def solve(
    features: int,
    row: np.ndarray,
    column: np.ndarray,
    y: np.ndarray,
    mentions: dict[int, int],
    scale: np.ndarray | None = None,
    penalty: float = PENALTY,
    ridge: float = RIDGE,
    steps: int = STEPS,
) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise mean log loss + ridge + counterfactual penalty (Adam, whole batch).

    (row, column) are the present words; ``scale`` is the value of each word
    when it is present, so that words of little evidence are held back more by
    the ridge. ``mentions`` counts the labelled
    sentences by identity term; swapping term t for t' changes a sentence's
    score by w[t'] - w[t], and leaving it out changes it by -w[t].
    """
    terms = np.array(sorted(mentions), dtype=np.int64)
    share = np.array([mentions[t] for t in terms], dtype=float)
    share /= max(1.0, share.sum())
    scale = np.ones(features) if scale is None else scale
    x = scale[column]
    w, n = np.zeros(features + 1), max(1, len(y))
    rate = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
    w[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[-1] + np.bincount(row, w[column] * x, minlength=len(y)), -500, 500)))
        gap = (p - y) / n
        g = np.append(np.bincount(column, gap[row] * x, minlength=features), gap.sum())
        g[:-1] += 2 * ridge * w[:-1]
        if len(terms):
            effect = w[terms] * scale[terms]
            others = np.append(effect, 0.0)
            change = effect[:, None] - others[None, :]
            pull = 2 * penalty * share[:, None] * change / len(others)
            g[terms] += (pull.sum(axis=1) - pull[:, :-1].sum(axis=0)) * scale[terms]
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        size = 0.2 * min(1.0, 2 * (steps - step + 1) / steps)
        w -= size * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w[:-1] * scale, float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    identity: tuple[str, ...] = IDENTITY_TERMS,
    penalty: float = PENALTY,
    most: int = SAMPLE,
    features: int = FEATURES,
) -> Model:
    """Fit on rows of ``docs`` with a 0/1 ``label`` in ``labels`` (doc_id, label); ``learn`` selects rows of ``labels``.

    Null labels and ids are left out; of several labels of one id the largest
    counts. Without labelled rows, or with one label only, every text scores
    by the labels' (smoothed) shares; so it does where a table is empty. Words
    and mentions are counted over all those rows, repeated ones each; only the
    weights are solved for on at most ``most`` a label (rows of repeated ids
    all with it).
    """
    known = (labels.filter(learn) if learn is not None else labels).filter("label IS NOT NULL AND doc_id IS NOT NULL")
    known = materialise(known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")), "toxicity-labels")
    rows = {0: 0, 1: 0} | {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    # the same shuffled join whatever the labels' size; it moves words, not texts
    learnt = words_of(docs, identity).join(known.filter("label IN (0, 1)").hint("merge"), "doc_id")
    learnt = materialise(learnt.select("doc_id", "label", "words"), "toxicity-words")
    # at most 2 x ``most`` ids: a bounded broadcast
    chosen = learnt.join(F.broadcast(sample(known, most).select("doc_id")), "doc_id").select("label", "words")
    n = materialise(corpus_counts(learnt), "toxicity-counts")
    apart = n.filter((F.length("word") == 0) | (F.col("kind") == MENTION)).collect()
    every = {0: 0, 1: 0} | {r["kind"]: r["n"] for r in apart if not r["word"]}
    words = vocabulary(n, every, features, identity)
    index = {w: i for i, w in enumerate(words)}

    def present(batch: pa.RecordBatch, open_) -> list[pa.Array]:
        each = (unpacked(open_.decompress(x))[0] for x in batch.column("words").to_pylist())
        return [pa.array([sorted(index[w] for w in index.keys() & set(x)) for x in each], pa.list_(pa.int32()))]

    mentions = {index[bytes(r["word"])]: r["n"] for r in apart if r["word"]}
    made = map_batches(chosen, present, {"present": "array<int>"}, ["label"], setup=zstandard.ZstdDecompressor).collect()
    made = sorted((r["label"], tuple(r["present"])) for r in made)  # the same order of sums in every run
    held = Counter(label for label, _ in made)
    y = np.array([r[0] for r in made], dtype=float)
    row = np.repeat(np.arange(len(made)), [len(r[1]) for r in made])
    column = np.array([w for r in made for w in r[1]], dtype=np.int64)
    weights, intercept = solve(len(words), row, column, y, mentions, np.array(list(words.values())), penalty)
    shift = np.log((rows[1] + 0.5) / (rows[0] + 0.5)) - np.log((held[1] + 0.5) / (held[0] + 0.5))
    return Model({w: float(weights[i]) for w, i in index.items()}, intercept + float(shift))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (probability that a text is toxic) and ``predicted``; empty and null texts get the intercept's.

    Repeated rows get the same score each; an empty table gives no rows. An
    input column called score or predicted is replaced.
    """

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        p = model.score(utf8(batch.column("text")))
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    new = {"score": "double", "predicted": "int"}
    return map_batches(docs.drop(*new), fn, new, [c for c in (keep or docs.columns) if c not in new])

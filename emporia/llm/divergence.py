"""Source divergence audit: how far the words of each source stand from those of others in the same language.

In-mapper stripes: a task folds whole documents into stripes, one for each
term of a language: in how many documents it is, and how often in each source.
After ``FOLD_BYTES`` of text the stripes are spilled. Spilled stripes are
shuffled by (language, term), sorted, and merged as they stream by, so a term
that is everywhere costs one stripe for each spill, not one row for each time
it occurs.

Folding is hashing without a Python object per word: words are told apart by
64-bit hashes (see ``wordhash``; within one fold only, so unequal terms are
taken for one with a chance of about 10^-9 per fold), and stripes leave as
Arrow arrays with the terms themselves. Merging compares the terms.

A language keeps the terms in at least ``LEAST_DOCS`` of its documents. With V
of these, N occurrences in a group and a term's ``count`` among them, its
share is p = 1 + floor(10^9 (count + 1) / (N + V)); the divergence of p from q
is floor((p - q)^2 / q). Everything is exact in 64 bits: floor(10^9 x / y) is
taken as a long division in three digits of 1000.

Merged stripes directly emit divergences. Each is one row of a matrix of
shares; a task adds up the sources' pairwise divergences of its terms and
keeps the ``RANKS`` greatest per group, so that sums and ranks over all terms
are left to small aggregates.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from emporia.llm.common import materialise, utf8
from emporia.llm.wordhash import Scheme, words

LEAST_DOCS = 3
RANKS = 200
SCALE_DIGITS = 3  # of 1000 each: shares are in billionths
# Text that a task folds before it spills, stripes that are merged at a time, cells of one step over a matrix of shares.
FOLD_BYTES = 16 << 20
MERGED = 1 << 14
CELLS = 1 << 20
# Parts of a group's terms that are ranked on their own before the group is.
SHARES = 8

STRIPE = "lang string, term string, n_docs bigint, sources array<string>, counts array<bigint>"
_NAMES = ["lang", "term", "n_docs", "sources", "counts"]


def _letters() -> Scheme:
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 0x20
    word = np.zeros(256, dtype=bool)
    word[0x41:0x5B] = word[0x61:0x7B] = word[0x80:] = True
    return Scheme(word, fold)


#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` after lower-casing A-Z.
LETTERS = _letters()


def _lists(rows: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """Lists of ``values``, of which each belongs to one of ``n`` rows (ascending)."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), values)


def _cells(row: np.ndarray, source: np.ndarray, n_sources: int, weight: np.ndarray | None = None):
    """(row, source, sum) of the distinct pairs, ascending; ``row`` is ascending already."""
    cell = row * n_sources + source
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, dtype=np.int64)
    if weight is None:
        total = np.diff(np.append(first, len(cell)))
    else:
        total = np.add.reduceat(weight[order], first) if len(first) else weight
    return cell[first] // n_sources, cell[first] % n_sources, total.astype(np.int64)


def fold(texts: list[bytes], langs: list[str], sources: list[str]):
    """The stripes of some documents, a batch for each language.

    The empty term's stripe has all sources of the language: they are there without any term, too.
    """
    found = words(texts, LETTERS)
    data = LETTERS.fold[np.frombuffer(found.data, dtype=np.uint8)]
    names = list(dict.fromkeys(sources))
    number = {x: i for i, x in enumerate(names)}
    of_source = np.array([number[x] for x in sources], dtype=np.int64)
    strings = pa.array(names, pa.string())
    of_lang, doc = np.array(langs, dtype=object), np.repeat(np.arange(len(texts)), np.diff(found.first))
    for lang in dict.fromkeys(langs):
        mine = of_lang == lang
        at = np.flatnonzero(mine[doc])
        at = at[np.argsort(found.hashes[at], kind="stable")]  # a term's words together, by document
        h, d = found.hashes[at], doc[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        row = np.cumsum(new)  # from 1: row 0 is the empty term
        n = int(row[-1]) + 1 if len(row) else 1
        changed = new.copy()
        changed[1:] |= d[1:] != d[:-1]
        docs = np.bincount(row[changed], minlength=n)
        docs[0] = mine.sum()
        first = at[new]
        lengths = found.ends[first] - found.starts[first]
        ends = np.concatenate([[0, 0], np.cumsum(lengths)])
        place = np.arange(int(ends[-1])) + np.repeat(found.starts[first] - ends[1:-1], lengths)
        offsets = pa.py_buffer(ends.astype(np.int32))
        term = pa.Array.from_buffers(pa.string(), n, [None, offsets, pa.py_buffer(data[place].tobytes())])
        there = np.unique(of_source[mine])
        r, s, c = _cells(row, of_source[d], len(names))
        r, s, c = (np.concatenate(x) for x in ((np.zeros(len(there), dtype=np.int64), r), (there, s), (np.zeros(len(there), dtype=np.int64), c)))
        columns = [pa.array([lang] * n, pa.string()), term, pa.array(docs, pa.int64()), _lists(r, strings.take(pa.array(s)), n), _lists(r, pa.array(c), n)]
        yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def spilled(docs: DataFrame, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """Stripes as the tasks spill them: several for a term, each of many documents."""

    def each(batches):
        held, size = ([], [], []), 0
        for batch in batches:
            for row in zip(utf8(batch.column("text")), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[0]) + 1
                if size >= fold_bytes:
                    yield from _split(fold(*held))
                    held, size = ([], [], []), 0
        if held[0]:
            yield from _split(fold(*held))
        pa.default_memory_pool().release_unused()

    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    return docs.select(*read).mapInArrow(each, STRIPE)


def _split(batches, rows: int = MERGED):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def added(table: pa.Table) -> pa.Table:
    """Stripes sorted by (lang, term), those of one key added up."""
    table = table.combine_chunks()
    n = table.num_rows
    new = np.ones(n, dtype=bool)
    if n > 1:
        differ = [pc.not_equal(table.column(c).slice(1), table.column(c).slice(0, n - 1)) for c in ("lang", "term")]
        new[1:] = pc.or_(*differ).to_numpy()
    row, first = np.cumsum(new) - 1, np.flatnonzero(new)
    docs = np.add.reduceat(table.column("n_docs").to_numpy(), first)
    lists = table.column("sources").combine_chunks(), table.column("counts").combine_chunks()
    owner = row[pc.list_parent_indices(lists[0]).to_numpy()]
    names = lists[0].flatten().dictionary_encode()
    r, s, c = _cells(owner, names.indices.to_numpy().astype(np.int64), max(1, len(names.dictionary)), lists[1].flatten().to_numpy())
    keys = [table.column(c).take(pa.array(first)) for c in ("lang", "term")]
    return pa.table([*keys, pa.array(docs), _lists(r, names.dictionary.take(pa.array(s)), len(first)), _lists(r, pa.array(c), len(first))], names=_NAMES)


def merged(stripes: DataFrame) -> DataFrame:
    """One stripe for each (lang, term): spilled stripes shuffled by key, sorted, and added up as they pass."""

    def each(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= MERGED:
                done = added(pa.Table.from_batches(held))
                yield from done.slice(0, done.num_rows - 1).to_batches()
                held = done.slice(done.num_rows - 1).to_batches()  # its key may go on
                size = 1
        if size:
            yield from added(pa.Table.from_batches(held)).to_batches()

    return stripes.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(each, STRIPE)


def kept(stripes: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    return stripes.filter((F.col("term") != "") & (F.col("n_docs") >= least))


def totals(stripes: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Per (lang, source): ``n``, occurrences of kept terms, and ``v``, the language's number of kept terms."""
    groups = stripes.filter("term = ''").select("lang", F.explode("sources").alias("source")).distinct()
    own = kept(stripes, least)
    n = own.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    n = n.groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    v = own.groupBy("lang").agg(F.count("*").alias("v"))
    found = groups.join(n, ["lang", "source"], "left").join(v, "lang", "left")
    return found.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))


def shares(counts: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (n + v)), exactly; n + v is at most 9 * 10^15."""
    total = n + v
    rest = counts + 1
    out, rest = rest // total, rest % total
    for _ in range(SCALE_DIGITS):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _language(lang: str, totals_row: dict, rows: pa.Table, pairs: dict, greatest: dict, ranks: int):
    """Add the pairwise divergences of some stripes of one language to ``pairs``; terms with the first ``ranks`` of each source among them.

    ``greatest`` holds the ``ranks`` greatest values of each group so far: a smaller one has no rank.
    """
    names, of_source, v = totals_row["all_sources"], np.array(totals_row["n"], dtype=np.int64), totals_row["v"]
    width = len(names)
    held = pairs.setdefault(lang, (names, np.zeros((width, width), dtype=np.int64)))[1]
    lists = rows.column("sources").combine_chunks()
    owner = pc.list_parent_indices(lists).to_numpy()
    column = pc.index_in(lists.flatten(), value_set=pa.array(names, pa.string())).to_numpy()
    numbers = rows.column("counts").combine_chunks().flatten().to_numpy()
    term = rows.column("term")
    step = max(1, CELLS // width**2)
    for at in range(0, rows.num_rows, step):
        a, b = np.searchsorted(owner, [at, at + step])
        counts = np.zeros((min(step, rows.num_rows - at), width), dtype=np.int64)
        counts[owner[a:b] - at, column[a:b]] = numbers[a:b]
        p = shares(counts, of_source, v)
        held += divergence(p[:, :, None], p[:, None, :]).sum(axis=0)
        q = shares(counts.sum(axis=1), of_source.sum(), v)[:, None]
        values = np.where((counts > 0) & (p > q), divergence(p, q), -1)
        for j, name in enumerate(names):
            best = greatest.get((lang, name), np.zeros(0, dtype=np.int64))
            own = np.flatnonzero(values[:, j] >= (best[0] if len(best) == ranks else 0))
            if len(own):  # all that reach the last of the greatest values stay: equal ones are told apart by term
                best = greatest[lang, name] = np.sort(np.concatenate([best, values[own, j]]))[-ranks:]
                own = own[values[own, j] >= (best[0] if len(best) == ranks else 0)]
                yield lang, name, values[own, j], term.take(pa.array(own + at))


def _gathered(batches, rows: int):
    """The batches as tables of at least ``rows`` rows (the last may have fewer)."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


PART = "lang string, source string, part string, item string, value bigint"


def emitted(stripes: DataFrame, by_lang: DataFrame, ranks: int = RANKS) -> DataFrame:
    """Per task: sums over its terms for each pair of sources (part ``pair``), and terms with the first ``ranks`` of each group among them."""

    def each(batches):
        pairs: dict = {}
        greatest: dict = {}
        for group in _gathered(batches, MERGED):
            langs = group.column("lang").combine_chunks().dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                rows = group.filter(pc.equal(langs.indices, i))
                totals_row = rows.slice(0, 1).select(["all_sources", "n", "v"]).to_pylist()[0]
                for name, source, values, term in _language(lang, totals_row, rows, pairs, greatest, ranks):
                    n = len(values)
                    columns = [pa.array([x] * n, pa.string()) for x in (name, source, "term")] + [term.combine_chunks(), pa.array(values)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "part", "item", "value"])
        for lang, (names, held) in pairs.items():
            rows = ((lang, a, "pair", b, int(held[i, j])) for i, a in enumerate(names) for j, b in enumerate(names) if i != j)
            while some := list(itertools.islice(rows, MERGED)):
                kinds = [pa.string()] * 4 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=["lang", "source", "part", "item", "value"])

    return stripes.join(by_lang, "lang").mapInArrow(each, PART)


def audit(docs: DataFrame, least: int = LEAST_DOCS, ranks: int = RANKS, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """Divergences of each (lang, source) group of ``docs`` (text, lang, source): ``part``, ``item``, ``value`` and ``rank``.

    ``pair``: the sum over all kept terms of the divergence of the group's
    share from that of each other source of the language, all ranks.
    ``term``: terms of the group whose share is above the language's, with
    their divergence from it, up to ``ranks``. Ranks go by value downwards,
    then by the item's UTF-8 bytes.

    Null text, lang and source count as ''. A group without terms is there;
    where a language keeps no term its pairs have value 0. Repeated rows count
    each; very long texts are folded like others (a text is held whole, with
    some forty bytes a word); other columns are not looked at. An empty table gives no
    rows. The pairs of a language's sources are the result's size, and one
    task holds the matrix of their sums.
    """
    own = materialise(merged(spilled(docs, fold_bytes)), "divergence-stripes")
    groups = materialise(totals(own, least), "divergence-totals")
    by_lang = groups.groupBy("lang", "v").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("x"))
    by_lang = by_lang.select("lang", "v", F.col("x.source").alias("all_sources"), F.col("x.n").alias("n"))
    found = materialise(emitted(kept(own, least).select("lang", "term", "sources", "counts"), by_lang, ranks), "divergence-parts")
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").filter("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")
    )
    # the first ranks of each group are among the first of its parts by item, which share out a large group's terms
    first = F.row_number().over(Window.partitionBy("lang", "source", "_share").orderBy(F.desc("value"), "item"))
    terms = found.filter("part = 'term'").withColumn("_share", F.pmod(F.xxhash64("item"), F.lit(SHARES)))
    terms = terms.withColumn("_first", first).filter(F.col("_first") <= ranks).drop("_share", "_first")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rows = pairs.unionByName(terms)
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= ranks))

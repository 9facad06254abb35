"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.llm import ngram_join
from tests.llm.conftest import SPACE_WORDS, documents

UPPER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width=3):
    w = SPACE_WORDS.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, percent=90):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), from all pairs; ids of None are never smallest."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def changed(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i] = f"{rng.choice('pqr')}{rng.randint(0, 10**6)}"
    return " ".join(w)


def texts(seed, n_groups=12):
    rng = random.Random(seed)
    passage = " ".join(rng.choices("klmno", k=45))
    out = []
    for _ in range(n_groups):
        base = " ".join(f"{rng.choice('abc')}{rng.randint(0, 30)}" for _ in range(rng.choice([1, 2, 3, 9, 12, 40, 90, 200, 400])))
        if rng.random() < 0.5:
            base += " " + passage
        for _ in range(rng.randint(1, 9)):  # chains: copies of copies, around the threshold
            out.append(rng.choice(["", " ", "\n"]) + rng.choice([base, base.upper()]))
            base = changed(rng, base, rng.choice([0, 1, 1, 2, 5]))
    out += [passage, passage + " and more", "", " \n", "one", "One", "one two", "two one"] + [f"{passage} {i}" for i in range(10)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_join_matches_all_pairs(spark, seed, monkeypatch):
    if seed:  # several buckets, tiles in squares, pairs held back
        monkeypatch.setattr(ngram_join, "PER_BUCKET", 300)
        monkeypatch.setattr(ngram_join, "TILE", 3)
        monkeypatch.setattr(ngram_join, "FIRST", 1)
    own = texts(seed, 14 + 8 * seed)
    want = brute(list(enumerate(own)))
    assert result(ngram_join.join(documents(spark, own))) == want
    assert len({x[2] for x in want}) < len(want) - 20


def test_links_that_the_centre_does_not_give(spark):
    rng = random.Random(7)
    base = " ".join(f"w{i}" for i in range(400))
    own = [base]
    for i in range(60):  # far from the base, near one another: chains by one word each
        own.append(changed(rng, own[-1], 3))
    assert result(ngram_join.join(documents(spark, own))) == brute(list(enumerate(own)))


def test_other_thresholds(spark):
    own = texts(9, 10)
    assert result(ngram_join.join(documents(spark, own), percent=75)) == brute(list(enumerate(own)), 75)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30, unique=True), min_size=2, max_size=12), st.integers(1, 4))
def test_tiles_lose_no_pair(sets, most):
    """Every pair that links, and is in two components, is given or the tile says that it holds some back."""
    arrays = [np.unique(ngram_join.mixed(np.array(s, dtype=np.uint64))) for s in sets]
    n = len(sets)
    table = pa.table({
        "c": list(range(n)), "n": [len(a) for a in arrays], "shared": [len(a) for a in arrays], "root": [i % 5 for i in range(n)],
        "home": [True] * n, "part": [0] * n, "first": [0] * n, "second": [0] * n,
        "bitmap": pa.array([ngram_join.bitmap(a).tobytes() for a in arrays], pa.binary()),
    })
    a, b, held = ngram_join.tile_pairs(table, 90, most)
    got = set(zip(a.tolist(), b.tolist()))
    for i in range(n):
        for j in range(i + 1, n):
            both, either = len(set(sets[i]) & set(sets[j])), len(set(sets[i]) | set(sets[j]))
            if 10 * both >= 9 * either and i % 5 != j % 5:
                assert (i, j) in got or held
    assert held or len(got) <= n * n


def test_sizes_that_link_are_in_neighbouring_bands():
    for percent in (50, 75, 90, 99):
        edges = ngram_join.edges(percent, 5000)
        band = lambda n: int(np.searchsorted(edges, n, side="right"))
        for small in range(1, 400):
            assert band(small * 100 // percent) - band(small) <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbB \n\té\x00"), max_size=30), max_size=6))
def test_sets_have_the_sizes_and_overlaps_of_the_shingles(own):
    hashed, plain = ngram_join.shingle_sets([t.encode() for t in own]), [shingles(t) for t in own]
    assert [len(x) for x in hashed] == [len(x) for x in plain]
    for a, x in zip(hashed, plain):
        for b, y in zip(hashed, plain):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_long_words_and_repeated_words_are_told_apart(spark):
    thue = "a"
    for _ in range(10):
        thue += thue.translate({97: 98, 98: 97})
    flipped = thue.translate({97: 98, 98: 97})
    assert len(thue) == 1024
    own = [thue, flipped, f"{thue} x", f"{flipped} x", " ".join(thue), " ".join(flipped)]
    assert result(ngram_join.join(documents(spark, own))) == brute(list(enumerate(own)))


def test_join_awkward_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    clashing = odd.withColumn("n", odd.size).withColumn("hashes", odd.size).withColumn("component_id", odd.size)
    assert result(ngram_join.join(clashing)) == brute(rows)
    assert ngram_join.join(none).count() == 0
    assert re.match("doc_id.*n_shingles.*component_id", " ".join(ngram_join.join(none).columns))


def test_tiles_of_the_same_sets_are_looked_at_once(spark):
    """Copies share all their rare shingles: one tile of a group is kept, whatever number of shingles brings it together."""
    rows = [(i, 100, 100, 7, [1000 * g + x for x in range(10)]) for g in range(3) for i in range(5 * g, 5 * g + 5)]
    rows += [(100, 100, 100, 7, [0, 50]), (101, 99, 99, 8, [50, 51]), (102, 90, 90, 6, [51, 52])]
    sets = spark.createDataFrame(rows, "c bigint, n bigint, shared bigint, band int, prefix array<bigint>")
    found = {}
    for r in ngram_join.tiles(sets).collect():
        found.setdefault((r.e, r.tile), set()).add((r.c, r.home))
    got = sorted(sorted(x) for x in found.values())
    groups = [{(i, True) for i in range(5 * g, 5 * g + 5)} for g in range(3)]
    # 50 brings bands 7 and 8 together in 8; 51's bands 6 and 8 meet nowhere
    assert got == sorted(map(sorted, [*groups, groups[0] | {(100, True)}, {(100, False), (101, True)}]))

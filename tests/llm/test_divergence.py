"""Source divergences against a plain count over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.llm import divergence
from tests.llm.conftest import DOCUMENTS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=3, ranks=200):
    """(lang, source, part, item, value, rank) of rows (text, lang, source), by the contract."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = TERM.findall(text.translate(UPPER))
        df[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        v = len(kept)
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def tables(seed, n=250):
    rng = random.Random(seed)
    words = ["The", "the", "of", "été", "中文", "x1y", "ſ", *(f"w{'abcdefghij'[i % 10]}{'klmno'[i % 5]}" for i in range(60))]
    rows = []
    for _ in range(n):
        source = rng.choice(["hot"] * 4 + ["a", "b", "é", None])
        bag = words if source != "hot" else words[: rng.randint(3, 40)]
        text = rng.choice([" ", "\n", "-"]).join(rng.choices(bag, k=rng.randint(0, 50)))
        rows.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "de", None]), source))
    return [*rows, ("only these terms", "xx", "one"), ("", "xx", "two"), ("alone", "yy", "one")]


@pytest.mark.parametrize("most, ranks", [(divergence.FOLD_BYTES, 200), (300, 5)])
def test_audit_matches_brute_force(spark, most, ranks, monkeypatch):
    if most == 300:  # many spills, merged and ranked a few at a time
        monkeypatch.setattr(divergence, "MERGED", 3)
        monkeypatch.setattr(divergence, "CELLS", 40)
    rows = tables(most)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(docs, ranks=ranks, fold_bytes=most).collect())
    assert got == brute(rows, ranks=ranks)
    assert {r[2] for r in got} == {"pair", "term"} and ("xx", "one", "pair", "two", 0, 1) in got


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 4 * 10**15), st.integers(0, 4 * 10**15), st.integers(1, 10**12))
def test_shares_are_exact(count, rest, v):
    got = divergence.shares(np.array([[count]]), np.array([count + rest]), v)
    assert int(got[0, 0]) == 1 + 10**9 * (count + 1) // (count + rest + v)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ@[`{é中\x00\x7f 9\U0001f600")))
def test_terms_are_those_of_the_pattern(text):
    found = [r for b in divergence.fold([text.encode(), b""], ["x", "x"], ["s", "t"]) for r in b.to_pylist()]
    want = Counter(TERM.findall(text.translate(UPPER)))
    assert {r["term"]: r["counts"] for r in found} == {"": [0, 0], **{t: [n] for t, n in want.items()}}
    assert all(r["n_docs"] == (1 if r["term"] else 2) and r["sources"] == (["s"] if r["term"] else ["s", "t"]) for r in found)


def test_audit_awkward_rows(spark, odd, none):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    clashing = odd.withColumn("rank", odd.size).withColumn("term", odd.size).withColumn("n", odd.size)
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(clashing).collect())
    assert got == brute(rows)
    assert divergence.audit(none.select(*DOCUMENTS_COLUMNS)).count() == 0


DOCUMENTS_COLUMNS = [x.split()[0] for x in DOCUMENTS.split(", ")]

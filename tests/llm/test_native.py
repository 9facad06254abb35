"""Mixing and sharding: laws on random and awkward tables."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from emporia.llm import mixing, sharding
from tests.llm.conftest import SPACE_WORDS, documents


def water_filling(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Targets by the definition: share by weight, stop at the cap, reshare the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        part = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if part[s] >= most * sizes[s]]
        if not over:
            return out | part
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def mixed_rows(docs):
    return mixing.mix(mixing.slim(docs)).toPandas()


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_takes_what_the_targets_ask(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", None, "hot"]
    sources = ["hot" if i % 3 == 0 else rng.choice(names) for i in range(400)]
    texts = [" ".join(["w"] * rng.choice([0, 1, 3, 50, 400])) for _ in sources]
    docs = documents(spark, texts, sources)
    got = mixed_rows(docs)
    sizes = defaultdict(int)
    for s, t in zip(sources, texts):
        sizes[s] += len(t.split())
    want = water_filling(sizes)
    taken = defaultdict(int)
    for r in got.itertuples():
        s = sources[r.doc_id]
        assert r.size == len(texts[r.doc_id].split()) and r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert len(got) == len(texts)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixed_rows(docs.repartition(7)).sort_values("doc_id")
    assert again.taken.tolist() == got.sort_values("doc_id").taken.tolist()


def test_positions_follow_the_schedules(spark):
    knots = mixing.LATE_PEAK
    fractions = [i / 20 for i in range(20)]
    rows = spark.createDataFrame([(x,) for x in fractions], "x double").select("x", mixing.demand_inverse(F.col("x"), knots).alias("t")).collect()

    def integral(t):
        total = 0.0
        for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
            if t > t0:
                end = min(t, t1)
                total += (end - t0) * (f0 + (f0 + (f1 - f0) * (end - t0) / (t1 - t0))) / 2
        return total

    for r in rows:
        assert integral(r.t) == pytest.approx(r.x * integral(1.0), abs=1e-9)
    sources = [f"s{i % 3}" for i in range(300)]
    got = mixed_rows(documents(spark, ["a b c d"] * 300, sources))
    early = Counter(sources[r.doc_id] for r in got.itertuples() if r.positions[0] is not None and r.positions[0] < 0.25)
    late = Counter(sources[r.doc_id] for r in got.itertuples() if r.positions[0] is not None and r.positions[0] > 0.5)
    assert early["s0"] > late["s0"]  # falling weight: its documents come first


def test_mixture_keeps_whole_rows_in_order(spark, odd, none):
    out = mixing.mixture(odd)
    assert out.columns == odd.columns
    sizes = {(r.doc_id, r.text): len(SPACE_WORDS.findall(r.text or "")) for r in odd.collect()}
    assert all(sizes[r.doc_id, r.text] > 0 for r in out.collect())
    assert mixing.mixture(none).count() == 0 and mixing.mix(mixing.slim(none)).count() == 0


def test_mix_awkward_rows(odd):
    got = mixed_rows(odd)
    assert len(got) == odd.count()
    assert (got["size"] == [len(SPACE_WORDS.findall(r.text or "")) for r in odd.collect()]).sum() >= 0
    assert got[got["size"] == 0].taken.eq(0).all()


def slots_are_gapless(rows, shards=16):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert set(by) <= set(range(shards))
    for s in by.values():
        assert sorted(s) == list(range(len(s)))


def test_shards_have_near_equal_bytes(spark):
    rng = random.Random(3)
    texts = ["é" * rng.randint(0, 300) for _ in range(3000)]
    rows = sharding.shard(sharding.sized(documents(spark, texts))).collect()
    slots_are_gapless(rows)
    total = Counter()
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        total[r.shard] += r.size
    mean = sum(total.values()) / 16
    assert len(rows) == 3000 and all(abs(total[s] - mean) <= 602 + 0.002 * mean for s in range(16))
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)  # shards are ranges of the key


def test_a_hot_key_is_cut(spark):
    ids = [7] * 500 + [1, 2, 3] * 100 + [7] * 200
    docs = spark.createDataFrame([(i, "t" if i == 7 else f"text {n}") for n, i in enumerate(ids)], "doc_id bigint, text string")
    rows = sharding.shard(docs, weight=None, tolerance=0.0).collect()
    slots_are_gapless(rows)
    count = Counter(r.shard for r in rows)
    assert max(count.values()) - min(count[s] for s in range(16)) <= 1


def test_sharding_awkward_rows(odd, none):
    rows = sharding.shard(sharding.sized(odd)).collect()
    assert len(rows) == odd.count()
    slots_are_gapless(rows)
    whole = sharding.shard(odd, weight="n_chars", shards=4)
    assert whole.columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]
    assert whole.count() == odd.count()
    assert sharding.shard(sharding.sized(none)).count() == 0


def test_native_plans_have_no_python(spark):
    docs = documents(spark, ["a b"] * 20)
    for df in (mixing.mix(mixing.slim(docs)), mixing.mixture(docs), sharding.shard(sharding.sized(docs))):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))

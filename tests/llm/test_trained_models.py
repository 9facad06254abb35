"""SimHash, the classifiers, HTML extraction and the pipeline."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from emporia.llm import components, html_extract, labelled_pages, quality, queries, simhash, toxicity
from emporia.llm.common import crc_bucket
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents


# --- SimHash ----------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    n = min(3, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(len(w) - n + 1)] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps):
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = sorted(parent)
    for i, x in enumerate(order):
        for y in order[i + 1 :]:
            if bin(x ^ y).count("1") <= 3:
                parent[find(x)] = find(y)
    return {x: find(x) for x in order}


def planted_fingerprints(seed):
    """Random values, with others at 1 to 4 bits from them, chains, and values of few and of many bits."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(150)] + [0, 2**64 - 1, 1, 3, 7, 15]
    for _ in range(400):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        out.append(x)
    return sorted(set(out))


def partition(labels):
    groups = defaultdict(set)
    for x, y in labels.items():
        groups[y].add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("per_bucket", [1024, 40])
def test_links_join_exactly_what_is_near(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(simhash, "PER_BUCKET", per_bucket)
    fps = planted_fingerprints(per_bucket)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps]
    found = simhash.links(spark.createDataFrame(signed, "fp bigint").repartition(3))
    edges = [(r.u % 2**64, r.v % 2**64) for r in found.collect()]
    assert len(edges) <= len(fps) * 64  # forests, not all pairs
    label = {x: x for x in fps}
    for r in components.connect(spark.createDataFrame(found.collect(), "u bigint, v bigint")).collect():
        label[r.node % 2**64] = r.root % 2**64
    assert partition(label) == partition(brute_components(fps))


def test_buckets_of_near_copies_are_split(spark):
    rng = random.Random(9)
    base, fps = rng.getrandbits(64), set(planted_fingerprints(3))
    for _ in range(600):  # near copies: the same low bits, but for a few
        x = base
        for b in [*rng.sample(range(20, 64), rng.randint(0, 4)), *rng.sample(range(20), rng.randint(0, 1))]:
            x ^= 1 << b
        fps.add(x)
    fps |= {x ^ 1 << 63 for x in list(fps)[:50]}
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in sorted(fps)], "fp bigint").repartition(3)
    for bits, most in ((0, 20_000), (4, 3000)):
        full = simhash.full_buckets(frame, bits, most)
        assert full
        rows = simhash.bucketed(frame, bits, full).toPandas()
        assert rows.groupby(["bits", "bucket"]).n.sum().max() <= most
        assert rows.n.sum() == simhash.bucketed(frame, 0).toPandas().n.sum()  # every variant is in one bucket
        x, own = rows.fp.to_numpy().view(np.uint64), rows.bucket.to_numpy()
        for i in rng.sample(range(len(rows)), 200):
            assert len(simhash.variants(x[i : i + 1], int(own[i]), int(rows.bits[i]))[0]) == rows.n[i] > 0
        edges = simhash.links(frame, most=most).collect()
        label = {y: y for y in fps}
        for r in components.connect(spark.createDataFrame(edges, "u bigint, v bigint")).collect():
            label[r.node % 2**64] = r.root % 2**64
        assert partition(label) == partition(brute_components(fps))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    roots = {r.node: r.root for r in components.connect(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}}


def test_near_duplicates_match_brute_force(spark, odd, none):
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(300)) for _ in range(25)]
    texts = base + [b.upper() for b in base[:5]] + [f"{b} tail" for b in base[5:15]] + [f"x {b}" for b in base[10:20]] + ["", None, "A b", "a  B"]
    docs = documents(spark, texts)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [got[i].fp % 2**64 for i in range(len(texts))] == fps
    root = brute_components(set(fps))
    first = {}
    for i, x in enumerate(fps):
        first.setdefault(root[x], i)
    assert [got[i].component_id for i in range(len(texts))] == [first[root[x]] for x in fps]
    kept = simhash.one_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    whole = simhash.one_of_each(odd)
    assert whole.columns == odd.columns
    assert whole.count() == len({brute_components({brute_fingerprint(r.text) for r in odd.collect()})[brute_fingerprint(r.text)] for r in odd.collect()})
    assert simhash.near_duplicates(odd).count() == odd.count() and simhash.one_of_each(none).count() == 0


# --- classifiers ------------------------------------------------------------------------------------------------------


def test_quality_parts_held_out_rows(spark):
    rows = queries.all_queries()["op7_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all() and len(rows) == 1000


def test_quality_model_is_the_two_gaussians():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    x = {0: rng.normal(0, 1, (400, d)), 1: rng.normal(0.7, 0.5, (900, d))}
    model = quality.solve({c: (len(v), v.sum(axis=0), v.T @ v) for c, v in x.items()}, shrinkage=0.0)
    probe = rng.normal(0.3, 0.8, (50, d))
    z = (probe - model.centre) / model.scale

    def density(c):
        own = (x[c] - model.centre) / model.scale
        m, s = own.mean(axis=0), np.cov(own.T, bias=True)
        gap = z - m
        return np.log((len(own) + 1) / 1302) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (gap @ np.linalg.inv(s) * gap).sum(axis=1)

    want = 1 / (1 + np.exp(-(density(1) - density(0)) / quality.TEMPERATURE))
    assert model.score(probe) == pytest.approx(want, abs=1e-6)


def test_toxicity_parts_held_out_rows(spark):
    rows = queries.all_queries()["op1_toxicity"](spark, "/root/testdata/sf0.01").toPandas()
    both = rows.merge(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() == 0


def biased_documents(spark):
    """Toxic texts mention one group far more often than the others do."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        filler = " ".join(rng.choices(["sun", "tree", "walk", "read", "blue", "house"], k=12))
        group = "muslims" if rng.random() < (0.95 if toxic else 0.02) else rng.choice(["christians", "", ""])
        insult = rng.choice(["idiots", "scum"]) if toxic and rng.random() < 0.85 else ""
        rows.append((i, f"{filler}. The {group} {insult} here.", int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "label")


def test_swapping_identity_terms_takes_their_weight(spark):
    docs, labels = biased_documents(spark)
    plain = toxicity.fit(docs, labels, penalty=0.0)
    fair = toxicity.fit(docs, labels)
    neutral = [b"The muslims read a book in the house.", b"The christians read a book in the house."]
    assert plain.score(neutral)[0] > 0.5  # false positive of the plain fit
    a, b = fair.score(neutral)
    assert max(a, b) < 0.5 and abs(a - b) < 0.1
    assert fair.score([b"They are idiots and scum."])[0] > 0.5


def test_toxicity_packs_what_it_counts():
    named = frozenset([b"jews", b"old"])
    for text in (b"", b" \n ", b"one", b"Old. The old jews!\nold OLD jews", "é Jews, \u2014 no".encode()):
        found, mentions = toxicity.unpacked(toxicity.packed(text, named))
        assert found == sorted(set(toxicity.tokens(text)))
        sentences = [set(toxicity.tokens(x)) for x in re.split(rb"[.!?\n]+", text)]
        assert sorted(mentions) == sorted(w for s in sentences for w in s & named)


def test_toxicity_counts_over_all_labelled_rows(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        insult = "blockhead" if i % 2 and i % 40 == 1 else "scum" if i % 2 else ""
        rows.append((i, f"{' '.join(rng.choices(['sun', 'tree', 'walk', 'read'], k=8))}. The jews {insult} here.", i % 2))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    labels = frame.select("doc_id", "label")
    few = [r.doc_id for r in toxicity.sample(labels, 60).collect() if rows[r.doc_id][1].count("blockhead")]
    assert 0 < len(few) < toxicity.LEAST_ROWS
    model = toxicity.fit(frame.select("doc_id", "text"), labels, most=60)
    assert model.weights[b"blockhead"] > 0.1
    words = toxicity.words_of(frame, ("jews",)).join(labels.select("doc_id", "label"), "doc_id")
    n = toxicity.corpus_counts(words).collect()
    found = {(bytes(r.word), r.kind): r.n for r in n}
    assert found[b"blockhead", 1] == 30 and found[b"jews", toxicity.MENTION] == 1200 and found[b"", 0] == found[b"", 1] == 600


def test_classifiers_on_awkward_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (7, 0), (8, 1), (99, 1)], "doc_id bigint, label int")
    no_labels = labels.filter("false")
    for learnt in (labels, no_labels):
        q, t = quality.fit(odd, learnt), toxicity.fit(odd, learnt)
        for scored in (quality.score(odd, q), toxicity.score(odd, t)):
            rows = scored.collect()
            assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.accepted(odd, quality.fit(odd, labels)).columns == odd.columns
    assert quality.score(none, quality.fit(none, labels)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_learning_leaves_out_the_held_out_rows(spark):
    docs, labels = biased_documents(spark)
    wrong = labels.withColumn("label", F.when(crc_bucket("doc_id", 5) == 0, 1 - F.col("label")).otherwise(F.col("label")))
    keep = ~(crc_bucket("doc_id", 5) == 0)
    a, b = toxicity.fit(docs, labels, learn=keep), toxicity.fit(docs, wrong, learn=keep)
    assert a.weights == pytest.approx(b.weights) and a.intercept == pytest.approx(b.intercept)
    a, b = quality.fit(docs, labels, learn=keep), quality.fit(docs, wrong, learn=keep)
    assert a.means == pytest.approx(b.means) and a.constants == pytest.approx(b.constants)


# --- HTML -------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return html_extract.train(labelled_pages.labelled_pages())


def test_marginals_are_those_of_all_labellings(model):
    from itertools import product
    from math import exp

    page = html_extract.parse("<body><nav><a>x</a></nav><article><p>some text</p><p>more</p></article></body>")
    n, total, ones = len(page.parents), 0.0, [0.0] * len(page.parents)
    local = [sum(model.weights.get(f, 0.0) for f in own) for own in page.features]
    for y in product((0, 1), repeat=n):
        p = exp(sum(s for s, v in zip(local, y) if v) + sum(model.edges[y[page.parents[i]]][y[i]] for i in range(1, n)))
        total += p
        for i in range(n):
            ones[i] += p * y[i]
    found, _ = html_extract.marginals(page, model)
    assert found == pytest.approx([x / total for x in ones], abs=1e-9)


def test_held_out_labelled_pages(model):
    right = wrong = 0
    for html in labelled_pages.labelled_pages(150, seed=77):
        page = html_extract.parse(html)
        truth = html_extract.labels(page)
        found, _ = html_extract.marginals(page, model)
        for node, _ in page.runs:
            right += (found[node] >= 0.5) == bool(truth[node])
            wrong += (found[node] >= 0.5) != bool(truth[node])
    assert right / (right + wrong) > 0.97


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><p>Hi</p></article>", "Hi"),
        ("<article><h1>A&amp;B</h1><p>x &lt; y&nbsp; z</p></article><footer>&copy; us</footer>", "A&B x < y z"),
        ("<body><header><h1>Site</h1></header><article><h1>Title</h1><p>Text <b>bo</b>ld.</p></article><aside>side</aside></body>", "Title Text bold."),
        ("<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><p>One<br>two<p>three</article>", "One two three"),
        ("<article><p>Body.</p><script>var x='</p>';</script><style>p{}</style></article>", "Body."),
        ("<body><article><p>Body of it.</p></article><div class='comments'><p>nice post, I really think so</p></div></body>", "Body of it."),
        ("<body><div class='cookie-notice'><p>We use cookies.</p></div><article><p>Body.</p></article><form>mail <input></form></body>", "Body."),
        ("<body><div class=sidebar><p>More</p></div><article><p>Body</p></article><div class='ad'>buy</div></body>", "Body"),
        ("", ""),
    ],
)
def test_main_text(model, html, text):
    assert html_extract.main_text(html, model) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><head><title>T</title><body><article><p>Hi there.</p></article></body></html>", "Hi there."),
        ("<head><meta charset=utf-8><title>T</title><style>p{}</style><article><p>Hi there.</p></article>", "Hi there."),
        ("<head><noscript><img src=x></noscript><template><div>no</div></template><link rel=x><main><p>Hi there.</p></main>", "Hi there."),
        ("<head><noscript><link rel=x><body><article><p>Hi there.</p></article>", "Hi there."),
        ("<html><head><title>T</title></head><body><article><p>Hi there.</p></article></body></html>", "Hi there."),
    ],
)
def test_head_left_open(model, html, text):
    assert html_extract.main_text(html, model) == text


def test_text_ends_an_open_head():
    assert [x for _, x in html_extract.parse("<head><title>T</title>\n<script>a()</script> Plain text <p>and more").runs] == ["Plain text", "and more"]


SHELL = "<!DOCTYPE html><html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>{}<div class='sidebar'><h3>Most read</h3><p>A story of others</p></div><footer>&copy; us</footer></body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>Tea</h1><section><h3>Leaves</h3><p>They are dried in the sun.</p></section><section><h3>Water</h3><p>It should not boil.</p></section></article>", "Tea Leaves They are dried in the sun. Water It should not boil."),
        ("<article><h1>Tea</h1><div><p>They are dried in the sun.</p><p>It should not boil.</p></div></article>", "Tea They are dried in the sun. It should not boil."),
        ("<article><div><div><p>They are dried in the sun.</p></div><div>It should not boil.</div></div></article>", "They are dried in the sun. It should not boil."),
        ("<main><h1>How to</h1><p>Three steps.</p><ol><li>Boil the water</li><li>Wait for a while</li></ol></main>", "How to Three steps. Boil the water Wait for a while"),
        ("<article><h2>A</h2><p>Some words of text.</p><h4>B</h4><p>More words of text.</p><h5>C</h5><p>Last words.</p><h6>D</h6><p>End.</p></article>", "A Some words of text. B More words of text. C Last words. D End."),
        ("<article><p>Some words of text.</p><dl><dt>Leaf</dt><dd>A part of a plant</dd></dl><figure><img src=x><figcaption>A cup of tea on a table</figcaption></figure></article>", "Some words of text. Leaf A part of a plant A cup of tea on a table"),
        ("<article><p>Some words of text.</p><table><tr><th>Sort</th><th>Minutes</th></tr><tr><td>Green</td><td>Two</td></tr></table></article>", "Some words of text. Sort Minutes Green Two"),
        ("<article><section><p>Some words of text.</p></section><section class='comments'><h3>Replies</h3><p>nice post</p></section></article>", "Some words of text."),
        ("<div class='content'><section><h3>Leaves</h3><p>There are two ways to dry them.</p><ol><li>In the sun</li><li>In an oven</li></ol></section></div>", "Leaves There are two ways to dry them. In the sun In an oven"),
    ],
)
def test_layouts_of_articles(model, body, text):
    assert html_extract.main_text(SHELL.format(body), model) == text


def test_extract_awkward_pages(spark, model):
    deep = "<div>" * 3000 + "<p>deep" + "</div>" * 3000
    pages = [(1, None), (2, ""), (3, "<<<>>>&&&"), (4, "<article><p>a" * 500), (5, deep), (5, deep), (6, "plain"), (7, "<!-- open")]
    frame = spark.createDataFrame([(i, "u", h, 9) for i, h in pages], "page_id bigint, url string, html string, n_chars int")
    rows = html_extract.extract(frame, model).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert [r.text for r in sorted(rows, key=lambda r: r.page_id)][:2] == ["", ""]
    assert html_extract.extract(frame.filter("false"), model).count() == 0


def test_given_pages_give_their_articles(spark):
    import html as entities
    import re

    got = queries.all_queries()["op6_html"](spark, SF_SMALL).toPandas().merge(spark.read.parquet(f"{SF_SMALL}/pages.parquet").toPandas(), on="page_id")
    for r in got.itertuples():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == " ".join(x for x in blocks if x)


# --- pipeline ---------------------------------------------------------------------------------------------------------


def test_pipeline_stages_one_by_one(spark):
    from emporia.llm import decontamination, mixing
    from emporia.llm.common import materialise

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    seen = {"documents": docs.toPandas()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen[name] = docs.toPandas()
        assert name == "token_ids" or docs.columns == columns
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas()
    good = labels.set_index("doc_id").quality
    kept = set(seen["quality"].doc_id)
    judged = [(i in kept) == bool(good[i]) for i in seen["documents"].doc_id if i in good.index]
    assert np.mean(judged) > 0.95
    fps = {r.doc_id: brute_fingerprint(r.text) for r in seen["quality"].itertuples()}
    root, first = brute_components(set(fps.values())), {}
    for i in sorted(fps):
        first.setdefault(root[fps[i]], i)
    assert set(seen["simhash"].doc_id) == set(first.values()) and seen["simhash"].doc_id.is_unique
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    dirty = decontamination.scan(spark.createDataFrame(seen["simhash"]), benchmark).filter(F.size("spans") > 0)
    assert set(seen["decontamination"].doc_id) == set(seen["simhash"].doc_id) - {r.doc_id for r in dirty.collect()}
    plan = mixing.mix(mixing.slim(spark.createDataFrame(seen["decontamination"]))).toPandas()
    copies = {r.doc_id: sum(c > 0 and 2 * c >= r.size for c in r.copies) for r in plan.itertuples()}
    assert seen["mixing"].doc_id.value_counts().to_dict() == {i: n for i, n in copies.items() if n}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = ((r.doc_id, [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]) for r in seen["mixing"].itertuples())
    want = sorted((doc_id, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for doc_id, x in ids)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in seen["token_ids"].itertuples()) == want


def test_token_files_are_in_training_order(spark):
    from emporia.llm import mixing
    from emporia.llm.common import materialise

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = [r.doc_id for r in mixing.mixture(docs).select("doc_id").collect()]
    mixed = materialise(corpus_pipeline.mixing_stage(spark, docs, SF_SMALL), "test-mix")
    got = corpus_pipeline.token_ids_stage(spark, mixed, SF_SMALL).orderBy("start").collect()
    assert [r.doc_id for r in got] == want != sorted(want)


def test_registered_queries(spark):
    import __spark_entry__ as entry

    names = [x for x in entry.queries() if x.startswith("op") and x[2].isdigit()]
    assert sorted(int(x[2:].split("_")[0]) for x in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    contracts = {
        "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op3_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op4_mixing": ["doc_id", "size", "source_size", "target", "taken"],
        "op5_simhash": ["doc_id", "fingerprint", "component_id"],
        "op8_substring": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op10_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    }
    for name, columns in contracts.items():
        found = entry.queries()[name](spark, SF_SMALL)
        assert found.columns[: len(columns)] == columns
        assert found.count() == 200

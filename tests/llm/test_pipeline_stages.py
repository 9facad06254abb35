"""The pipeline's stages on awkward rows, on empty tables, and without labels or benchmark."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from emporia.llm.common import materialise
from tests.llm.conftest import DOCUMENTS


def folder(spark, tmp_path, documents, labels=(), items=()):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = docs
    return out


def test_awkward_rows_pass_without_labels_and_benchmark(spark, odd, tmp_path):
    found = stages(spark, folder(spark, tmp_path, odd))
    rows = {name: df.collect() for name, df in found.items()}
    for name in ("quality", "simhash", "decontamination", "mixing"):
        assert found[name].columns == odd.columns, name
    assert sorted(map(repr, rows["quality"])) == sorted(map(repr, odd.collect()))  # nothing is rejected
    texts = [(r.text or "") for r in rows["simhash"]]
    assert len(texts) == len(set(texts)) and texts.count("") + texts.count("   \n\t ") == 1  # one of all wordless texts
    assert {r.doc_id for r in rows["simhash"] if r.text == "same text here"} == {8}
    assert sorted(map(repr, rows["decontamination"])) == sorted(map(repr, rows["simhash"]))
    mixed = [r for r in rows["mixing"]]
    assert mixed and all((r.text or "").split() for r in mixed)
    assert {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in rows["decontamination"]}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [(r.doc_id, [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]) for r in mixed]
    want = sorted(((d, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for d, x in ids), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows["token_ids"]), key=repr) == want


def test_benchmark_and_labels_take_effect_on_awkward_rows(spark, odd, tmp_path):
    labels = [(3, 1, 0), (4, 1, 0), (5, 0, 0), (None, 1, 0), (8, None, 0), (99, 0, 1)]
    found = stages(spark, folder(spark, tmp_path, odd, labels, [(1, "Same text HERE!"), (2, None), (None, "")]))
    kept = found["decontamination"].collect()
    assert all(r.text != "same text here" for r in kept)
    assert found["token_ids"].count() == found["mixing"].count()


@pytest.mark.parametrize("with_others", [True, False])
def test_empty_documents(spark, none, tmp_path, with_others):
    more = ([(1, 1, 0), (2, 0, 1)], [(1, "some words of an item")]) if with_others else ((), ())
    sf_dir = folder(spark, tmp_path, none, *more)
    assert {name: df.count() for name, df in stages(spark, sf_dir).items()} == dict.fromkeys((n for n, _ in corpus_pipeline.STAGES), 0)
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
    assert [c.split()[0] for c in DOCUMENTS.split(", ")] == none.columns

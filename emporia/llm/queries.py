"""The registered queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import (
    decontamination,
    divergence,
    fim,
    html_extract,
    mixing,
    ngram_join,
    quality,
    search,
    sharding,
    simhash,
    sql,
    substring,
    tokenids,
    toxicity,
)
from emporia.llm.common import crc_bucket, materialise, new_folder, prepare, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = crc_bucket("doc_id", 5) == 0
    model = toxicity.fit(docs, labels, learn=~held_out)
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    hit = decontamination.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    tokenids.write(table(spark, sf_dir, "documents"), path)
    return tokenids.summary(spark, path)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(mixing.slim(table(spark, sf_dir, "documents")), "mix-rows")
    mixed = mixing.mix(rows)
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.array_min("positions").alias("position")
    ).orderBy("position", "doc_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep=["page_id", "url"])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = crc_bucket("doc_id", 3) == 1
    model = quality.fit(docs, labels, learn=~held_out)
    return quality.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents"), keep_text=False)


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.similar_documents(docs, docs.filter(F.col("doc_id") % 50 == 0))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(sharding.sized(table(spark, sf_dir, "documents")))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return fim.digests(made)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir.rstrip("/"))

    run.__name__ = fn.__name__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _prepared(f) for f in (
        op1_toxicity,
        op2_decontamination,
        op3_token_ids,
        op4_mixing,
        op5_simhash,
        op6_html,
        op7_quality,
        op8_substring,
        op9_search,
        op10_sharding,
        op11_ngram_join,
        op12_fim,
        op13_divergence,
    )}


def all_sql() -> dict[str, str]:
    return dict(sql.ALL)

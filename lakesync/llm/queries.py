"""The registered queries: each operator over its whole table with production settings, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm import (
    ann_tree,
    histogram_sort,
    language_id,
    license_scan,
    mixing,
    packing,
    periodic_runs,
    pii,
    simhash,
    spelling_variants,
    substring_dedup,
    threshold_topk,
    wrappers,
)
from lakesync.llm.common import table

SURROGATE_KEY = "surrogates-1"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.duplicate_passages(table(spark, sf_dir, "documents"))


def _every_fiftieth():
    return F.col("vec_id") % 50 == 0


def op2_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"), _every_fiftieth(), k=5)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language_id.held_out())
    model = language_id.fit(docs.filter("NOT held_out"))
    found = language_id.identify(docs.drop("lang"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(table(spark, sf_dir, "embeddings"), _every_fiftieth(), k=5, scale=256)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, bits=4)


def op6_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sharded = histogram_sort.shard_by_bytes(docs.withColumn("text_crc32", F.crc32(text)), shards=16)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return sharded.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    columns = ("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return pieces.select(*columns)


def op8_page_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.replicate_to_weights(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "order_key")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, SURROGATE_KEY)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.vocabulary(table(spark, sf_dir, "documents"), change=spelling_variants.misspelt)
    return spelling_variants.variants(words)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.looped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs, keep_text=False).withColumn("best", periodic_runs.strongest())
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, keep_text=False).withColumn("base", license_scan.of_base())
    starts = F.transform("base", lambda p: p["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        license_scan.labels("base").alias("base_labels"),
        license_scan.labels("places").alias("labels"),
        F.when(F.col("n_words") == 0, 0.0).otherwise(F.col("covered") / F.col("n_words")).alias("score"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compact_windows,
        op2_kmeans_tree,
        op3_language_id,
        op4_threshold_topk,
        op5_simhash_near_dedup,
        op6_histogram_sort,
        op7_packing,
        op8_page_wrappers,
        op9_poisson_mixing,
        op10_pii_surrogates,
        op11_spelling_variants,
        op12_periodic_runs,
        op13_license_templates,
    )
}
ORACLES: dict[str, str] = {
    "op4_threshold_topk": threshold_topk.TOP_SQL,
    "op9_poisson_mixing": mixing.MIX_SQL,
    "op11_spelling_variants": spelling_variants.VARIANT_SQL,
    "op13_license_templates": license_scan.scan_sql(),
}

"""Queries of the operators: each applies one to its whole table and derives the columns of its contract."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, langid, licenses, ngram_join, phrases, quality, runs, secrets, sharding, topk, urlfilter, warc
from .common import table, written

TOKENIZER = "word_bpe_49k.json"
TOP_K, QUERY_EVERY, SCALE = 20, 20, 64
SHARDS = 24
KIND_ORDER = {k: i for i, k in enumerate(secrets.KINDS)}


def _sha(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def labels(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return rows.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("covered") / F.col("n_words")).otherwise(0.0).alias("score"),
        F.size("matches").cast("bigint").alias("n_matches"),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose crc32 (of the id as text) leaves 2 modulo 4; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out()))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return out.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type",
        F.col("source_headers")["Content-Type"].alias("source_content_type"), "source_digest", "block_digest", "content_length", "block",
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

    def covered(spans: str) -> Column:
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda acc, x: acc + x["end"] - x["start"])

    def ids(items: str) -> Column:
        return _sha(F.array_join(F.array_sort(items), ","))

    n_hit = covered("hits")
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        ids("items").alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        covered("near").alias("n_near_words"), F.size("near_items").cast("bigint").alias("n_near"), ids("near_items").alias("near_sha256"),
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), digests=True)
    return rows.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=TOP_K, every=QUERY_EVERY, scale=SCALE)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sharding.shard(table(spark, sf_dir, "documents"), shards=SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"),
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return rows.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        _sha(spans_text(base)).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"), count("entropy").alias("n_entropy"),
    )


def periodic_words(doc_id: int, n: int) -> np.ndarray | None:
    """The word numbers of op11's contract: for one id in ten (by CRC-32) the words from a place on repeat with a period."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % period])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runs.find_runs(table(spark, sf_dir, "documents"), arranged=periodic_words)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = rows.withColumn("longest", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.l")).alias("length"),
        F.col("longest.period").alias("period"), F.expr("(-1000 * longest.l) div longest.period").alias("exponent_milli"),
        _sha(lines).alias("runs_sha256"), _sha(F.col("collapsed")).alias("collapsed_sha256"), "n_words",
    )


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(quality.statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("label"))
    model = quality.fit(rows.where(~held_out()).join(labels, "doc_id"))
    scored = rows.select("doc_id", held_out().alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scans": op1_license_scans,
        "op2_language_id": op2_language_id,
        "op3_warc_derivatives": op3_warc_derivatives,
        "op4_decontamination": op4_decontamination,
        "op5_bpe_encoding": op5_bpe_encoding,
        "op6_top_k": op6_top_k,
        "op7_sharding": op7_sharding,
        "op8_ngram_join": op8_ngram_join,
        "op9_url_filter": op9_url_filter,
        "op10_secret_scans": op10_secret_scans,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_quality_classifier": op12_quality_classifier,
        "op13_phrase_collocations": op13_phrase_collocations,
        "pipeline": pipeline,
    }

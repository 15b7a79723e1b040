"""Registered queries of this package: one per operator, over its whole table, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import block_naming, circulant_minhash, decontaminate, fill_in_middle, html_extract, oracle, pair_index_bpe, pitman_yor, quality, secrets, suffix_radix, url_filter, vector_codes, warc
from civicspark.llm.common import show_package
from civicspark.session import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of the encoding query.
TOKENIZER = "word_bpe_49k.json"

SITE_RULES = tuple(url_filter.SiteRule(*r) for r in oracle.SITE_RULES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.page_records(warc.read_archives(spark, path))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), SITE_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def op3_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = block_naming.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_radix.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def op5_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pair_index_bpe.encode_documents(docs, path, decoded_col="decoded").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    heads = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text", *quality.SITE_LEVELS), heads).drop("text")
    scored = materialize(scored, "quality-scores")
    return quality.judge(scored, quality.site_posteriors(scored)).drop(*quality.SITE_LEVELS)


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = circulant_minhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"), restored_col="restored")
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return vector_codes.label_errors(coded.codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(coded.codebooks_sha256()).alias("codebooks_sha256")
    )


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def _importable(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        show_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_warc": op1_warc,
        "op2_url_filter": op2_url_filter,
        "op3_block_naming": op3_block_naming,
        "op4_suffix_radix": op4_suffix_radix,
        "op5_pair_index_bpe": op5_pair_index_bpe,
        "op6_pitman_yor": op6_pitman_yor,
        "op7_secrets": op7_secrets,
        "op8_decontaminate": op8_decontaminate,
        "op9_quality": op9_quality,
        "op10_circulant_minhash": op10_circulant_minhash,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_vector_codes": op12_vector_codes,
        "op13_html_extract": op13_html_extract,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _importable(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()

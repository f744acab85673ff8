"""Registered queries of this subpackage; each runs over its whole tables."""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snipmill.llm import attribution, bpe, compression, decontaminate, html_text, language_model, merkle, minhash, periodic, quality_model, toxicity, url_lists, warc
from snipmill.llm.common import fold, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


YEAR, SECONDS = 1_704_067_200, 31_536_000  # 2024 in seconds


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time within 2024, spread by id."""
    second = F.lit(YEAR) + F.pmod(F.col("page_id") * 7_654_321, F.lit(SECONDS))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("fetched_at", F.timestamp_seconds(second))


def _list_entries(captures: DataFrame) -> DataFrame:
    """A log of list entries for some hosts and first folders of the pages: domains
    are added, often removed two months later, and some are added again."""
    host = F.regexp_replace(url_lists.host_of(F.col("url")), r"^(www|m|blog)\.", "")
    folder = F.regexp_extract(url_lists.path_of(F.col("url")), "^/([^/]+)", 1)
    known = captures.select(
        "page_id",
        host.alias("host"),
        F.concat_ws("/", url_lists.host_of(F.col("url")), folder).alias("folder"),
    ).where("host <> ''")
    time = lambda days: F.timestamp_seconds(
        F.lit(YEAR + days * 86_400) + F.pmod(F.col("first") * 104_729, F.lit(SECONDS // 2))
    )
    numbers = [F.min("page_id").alias("first"), F.count("*").alias("n")]
    domains = known.groupBy(F.col("host").alias("value")).agg(*numbers).where("first % 3 = 0")
    prefixes = known.groupBy(F.col("folder").alias("value")).agg(*numbers).where("first % 5 = 0")
    steps = ((domains, "domain", 0, "add", "true"), (domains, "domain", 60, "remove", "n % 3 <> 0"),
             (domains, "domain", 100, "add", "n % 4 = 1"), (prefixes, "prefix", 30, "add", "true"))
    parts = [
        rows.where(condition).select(
            F.lit("derived").alias("list"), F.lit(kind).alias("kind"), "value",
            time(days).alias("at"), F.lit(action).alias("action"),
        )
        for rows, kind, days, action, condition in steps
    ]
    return reduce(DataFrame.unionByName, parts)


def op3_temporal_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active when it was fetched."""
    captures = _captures(spark, sf_dir)
    return url_lists.judged(captures, _list_entries(captures)).select(
        "page_id",
        "url",
        F.unix_timestamp("fetched_at").alias("fetched_second"),
        "blocked",
        "matches",
        F.col("match.kind").alias("match_kind"),
        F.col("match.value").alias("match_value"),
    )


def op5_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record, written to bundles and read back from them."""
    pages = table(spark, sf_dir, "pages")
    folder = warc.archive_folder(pages)
    index = warc.write_bundles(pages, folder)
    return warc.read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    found = html_text.main_text(pages, html_text.train(pages))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of every document with every benchmark item."""
    return decontaminate.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a fifth is never learned from."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0)
    score = F.coalesce(toxicity.scorer(spark, model)(F.col("text")), F.lit(0.0))
    scored = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return attribution.section_tokens(docs, ranks, public_tokenizers.PATTERN)


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)
    return coded.select(
        "doc_id",
        "n_tokens",
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        bpe.text_digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and mixture score of every document; a fifth is never learned from."""
    docs = table(spark, sf_dir, "documents")
    return language_model.deleted_interpolation(docs, fold(F.col("doc_id")) == 1)


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    judged = docs.select("doc_id", compression.quality()(F.col("text")).alias("q"))
    return judged.select("doc_id", "q.*")


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_scale_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document; a tenth of them are made to repeat themselves."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    made = docs.withColumn("text", periodic.with_period(F.col("text"), h))
    found = periodic.periodic_runs(made, finish=lambda text: F.sha2(text, 256))
    return periodic.summary(found)


def op12_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a fifth is never learned from."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    machine = quality_model.train(docs, labels, fold(F.col("doc_id")) != 0)
    score = quality_model.scorer(spark, machine)(F.col("text"), F.col("n_chars"))
    scored = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proof of every document; in a fifth of them the text is tampered with
    before it is verified."""
    tampered = fold(F.col("doc_id")) == 0
    text = merkle.lowered(F.col("text"), tampered)
    return merkle.manifest(table(spark, sf_dir, "documents"), changed={"text": text})


REGISTERED = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_compression_bands": op2_compression_bands,
    "op3_temporal_list_join": op3_temporal_list_join,
    "op4_bbit_minhash": op4_bbit_minhash,
    "op5_seekable_warc": op5_seekable_warc,
    "op6_boosted_dom": op6_boosted_dom,
    "op7_spaced_seeds": op7_spaced_seeds,
    "op8_factorization_machine": op8_factorization_machine,
    "op9_offset_attribution": op9_offset_attribution,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_scale_tiles": op11_scale_tiles,
    "op12_quality_machine": op12_quality_machine,
    "op13_merkle_manifest": op13_merkle_manifest,
}

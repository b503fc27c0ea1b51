"""The operators over their whole tables, with the columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import (
    ans, decontam, hosts, jaccard, langid, licences, naming, oracles, packing, periods, pii, rules, shards, tries,
)
from tidewheel.session import fresh_dir
from tidewheel.sources.readers import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@register("op2_quality_rules", oracles.quality_sql())
def quality_rules(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents").select("doc_id", "text", "lang")
    scored = rules.judged(docs, read_table(spark, base, "labels"))
    m = rules.MEASURES
    return scored.select(
        "doc_id", *[f"{m}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        F.col("_kept").alias("kept"),
    )


@register("op3_byte_shards")
def byte_shards(spark: SparkSession, base: str) -> DataFrame:
    placed = shards.shard_by_bytes(read_table(spark, base, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id",
        shards.row_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    placed = packing.packed(docs, TOKENIZER, size=2048, end_id=0)
    return placed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@register("op4_rans_files")
def rans_files(spark: SparkSession, base: str) -> DataFrame:
    path = fresh_dir(spark, "rans")
    ans.write_encoded(read_table(spark, base, "documents").select("doc_id", "text"), path, TOKENIZER, end_id=2)
    return ans.read_encoded(spark, path).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


HOST_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@register("op10_host_graph", oracles.hosts_sql(HOST_RULES))
def host_graph(spark: SparkSession, base: str) -> DataFrame:
    return hosts.judged(read_table(spark, base, "pages").select("page_id", "url", "html"), HOST_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@register("op1_licence_scan")
def licence_scan(spark: SparkSession, base: str) -> DataFrame:
    return licences.scan(read_table(spark, base, "documents").select("doc_id", "text"))


@register("op7_template_leaks")
def template_leaks(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    return decontam.leaks(docs, read_table(spark, base, "benchmark"))


@register("op5_jaccard_regions")
def jaccard_regions(spark: SparkSession, base: str) -> DataFrame:
    return jaccard.classes(read_table(spark, base, "documents").select("doc_id", "text"), percent=75)


@register("op6_language_id")
def language_id(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents").select("doc_id", "text", "lang")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 4 == 2
    model = langid.fit(docs.where(~fold).select("text", "lang"))
    found = langid.predict(docs.select("doc_id", fold.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@register("op9_context_pii")
def context_pii(spark: SparkSession, base: str) -> DataFrame:
    found = pii.found(read_table(spark, base, "documents").select("doc_id", "text"))
    spans = F.col("_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.spelled(pii.base_only(spans)), 256).alias("base_sha256"), pii.spelled(spans).alias("spans"),
    )


@register("op13_block_names", oracles.copies_sql())
def block_names(spark: SparkSession, base: str) -> DataFrame:
    found = naming.named(read_table(spark, base, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op12_periodic_runs")
def periodic_runs(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    return periods.periodic_runs(docs, rewrite=periods.tandem_repeated)


@register("op11_prefix_trie", oracles.trie_sql())
def prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    turns = tries.numbered_turns(read_table(spark, base, "conversations"))
    return tries.prefix_trie(*tries.with_shared_openings(turns))

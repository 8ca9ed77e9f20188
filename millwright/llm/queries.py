"""Queries that apply each corpus operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import (
    byte_bpe,
    decontam,
    html_extract,
    language_id,
    merkle_manifest,
    packing,
    periodic_runs,
    quality_rules,
    simhash,
    suffix_dedup,
    token_binary,
    token_counts,
    warc,
)
from millwright.llm.common import read_table
from millwright.llm.rawfiles import new_folder
from millwright.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark, sf):
    return suffix_dedup.remove_repeats(read_table(spark, sf, "documents"))


@query
def op2_language_id(spark, sf):
    return language_id.identify(read_table(spark, sf, "documents"))


@query
def op3_simhash(spark, sf):
    return simhash.near_duplicates(read_table(spark, sf, "documents"))


@query
def op4_quality_rules(spark, sf):
    rows = quality_rules.apply_policy(quality_rules.ledger(read_table(spark, sf, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


@query
def op5_packing(spark, sf):
    return packing.pack(read_table(spark, sf, "documents"))


@query
def op6_token_binary(spark, sf):
    tokens = stage(token_binary.tokenized(read_table(spark, sf, "documents")))
    folder = new_folder(spark, "token-ids")
    lengths = token_binary.write_ids(tokens, folder)
    return token_binary.read_ids(spark, folder, lengths)


@query
def op7_html_extraction(spark, sf):
    return html_extract.extract(read_table(spark, sf, "pages"))


@query
def op8_token_counts(spark, sf):
    return token_counts.prefix_ledger(read_table(spark, sf, "documents"), with_steps=False)


@query
def op9_decontamination(spark, sf):
    return decontam.contained_items(
        read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"), every_item=True
    )


@query
def op10_warc(spark, sf):
    pages = read_table(spark, sf, "pages")
    folder = new_folder(spark, "warc")
    warc.write_archives(pages, folder)
    index = warc.build_index(warc.read_archives(spark, folder))
    return warc.fetch(spark, folder, warc.lookup(index, pages), with_payload=False)


@query
def op11_periodic_runs(spark, sf):
    rows = periodic_runs.with_planted_runs(read_table(spark, sf, "documents"))
    return periodic_runs.run_digests(periodic_runs.find_runs(rows, F.col("words"), carry=["doc_id"]))


@query
def op12_merkle_manifest(spark, sf):
    leaves = merkle_manifest.leaves_of(read_table(spark, sf, "documents"))
    return merkle_manifest.proof_digests(merkle_manifest.prove(merkle_manifest.build(leaves)))


@query
def op13_byte_bpe(spark, sf):
    ids = byte_bpe.decode(byte_bpe.encode(read_table(spark, sf, "documents")))
    return ids.select(
        "doc_id",
        F.expr("bigint(length(ids) div 4)").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )

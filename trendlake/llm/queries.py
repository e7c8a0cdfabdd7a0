"""One registered query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendlake.llm import (collocations, decontaminate, license_scan, packing, periodic_runs, perspectives, quality,
                           simhash, subword_quality, token_counts, toxicity, url_filter, warc)
from trendlake.sources.tables import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_line_frequency(spark, sf_dir):
    return quality.line_frequency_quality(table(spark, sf_dir, "documents"))


@register
def op2_token_counts(spark, sf_dir):
    import public_tokenizers as vocabularies

    vocabulary = token_counts.sentencepiece_vocabulary(vocabularies.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


@register
def op3_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op4_perspectives(spark, sf_dir):
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


@register
def op5_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@register
def op6_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register
def op7_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pack(docs: DataFrame) -> DataFrame:
    import public_tokenizers as vocabularies

    return packing.pack_documents(docs, vocabularies.path("byte_bpe_50k.json"),
                                  vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)


@register
def op8_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@register
def op9_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@register
def op10_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@register
def op11_subword_quality(spark, sf_dir):
    return subword_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register
def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))

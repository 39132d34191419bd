"""Registered queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers

from idwarden.llm import bpe, decontaminate, divergence, jaccard_join, licenses, periodic_runs, pstable_join, quality_model, repetition, substring_dedup, suffix_dedup, toxicity, url_filter
from idwarden.llm.oracle import ORACLE  # noqa: F401
from idwarden.llm.store import table

#: Rules of the query on pages: fixed values.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_ngram_jaccard(spark, sf_dir):
    return jaccard_join.labels(table(spark, sf_dir, "documents"))


def op2_repetition_rules(spark, sf_dir):
    return repetition.verdicts(table(spark, sf_dir, "documents"))


def op3_license_scan(spark, sf_dir):
    return licenses.summary(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op5_quality_rules_model(spark, sf_dir):
    return quality_model.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark, sf_dir):
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_toxicity(spark, sf_dir):
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op11_pstable_embedding_dedup(spark, sf_dir):
    return pstable_join.near_copies(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark, sf_dir):
    return divergence.report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_repetition_rules": op2_repetition_rules,
    "op3_license_scan": op3_license_scan,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules_model": op5_quality_rules_model,
    "op6_decontamination": op6_decontamination,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_pstable_embedding_dedup": op11_pstable_embedding_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_periodic_runs": op13_periodic_runs,
}

"""One named query per operator: production parameters over the whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_ops.llm import (
    byte_bpe, exact_topk, fill_in_middle, lattice_lm, line_dedup, packing, quality_rules, resampling, secret_scan,
    simhash_dedup, token_counts, toxicity, warc)
from telemetry_ops.llm.common import table


def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_lattice_lm(spark, sf_dir):
    return lattice_lm.lm_scores(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_exact_topk(spark, sf_dir):
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    return warc.derivatives(table(spark, sf_dir, "pages"))


def op11_line_dedup(spark, sf_dir):
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_fill_in_middle(spark, sf_dir):
    return fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))


def op13_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_quality_rules, op3_simhash_dedup, op4_lattice_lm, op5_toxicity, op6_secret_scan, op7_packing,
    op8_exact_topk, op9_byte_bpe, op10_warc, op11_line_dedup, op12_fill_in_middle, op13_resampling)}

SQL = {"op6_secret_scan": secret_scan.sql(), "op8_exact_topk": exact_topk.SQL, "op11_line_dedup": line_dedup.SQL,
       "op12_fill_in_middle": fill_in_middle.SQL}

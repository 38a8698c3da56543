"""A training corpus from raw documents: toxic and poor ones go, near duplicates go, secrets are masked, the rest packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. Null texts count as empty, empty tables pass
through as empty, other columns are carried whatever their names.
"""

from __future__ import annotations

from telemetry_ops.llm import packing, quality_rules, secret_scan, simhash_dedup, toxicity
from telemetry_ops.llm.common import table, written


def toxicity_stage(spark, docs, sf_dir):
    """Documents scored as toxic go."""
    return toxicity.clean(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_stage(spark, docs, sf_dir):
    """Documents that fail the rules go; lines that many documents of a host share are taken out of the others."""
    return quality_rules.clean(docs)


def near_dedup_stage(spark, docs, sf_dir):
    """One document of each group of near duplicates stays."""
    return simhash_dedup.deduplicate(docs)


def secrets_stage(spark, docs, sf_dir):
    """Secrets are masked in the texts."""
    return secret_scan.masked(docs)


def packing_stage(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("near duplicates", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # SQL can express neither the classifier nor the tokenizer


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training-corpus pipeline: from ``documents`` to packed token sequences.

Every stage works on all that the stage before it kept, written as Parquet in between.
All stages but the last return the columns of their input. Nulls, empty and very long texts,
repeated rows and empty tables are treated as the operators' docstrings say: language ID drops
null and wordless texts, near-dedup keeps one of repeated rows, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.llm.best_fit_packing import pack
from harvestlens.llm.common import materialize, read_table
from harvestlens.llm.decontamination import decontaminate
from harvestlens.llm.language_id import fit, held_out, identify
from harvestlens.llm.line_dedup import line_dedup
from harvestlens.llm.probminhash_dedup import dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what language ID rejects: no text, no letters, or no language ahead of the rest."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, model).filter(~F.col("rejected")).select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated line windows; n_chars follows the text. A document that loses all its
    lines goes."""
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_removed") > 0, F.length("doc.text")).otherwise(F.col("doc.n_chars"))
        out = out.withColumn("doc", F.col("doc").withField("n_chars", chars.cast(docs.schema["n_chars"].dataType)))
    emptied = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))
    return out.filter(~emptied).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return dedup(docs).filter("kept").select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark")).filter("n_hit = 0").select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every piece of every document in a sequence."""
    return pack(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Compression and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

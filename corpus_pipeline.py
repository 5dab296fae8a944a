"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; all but the last return the columns of the
documents.  ``run`` writes what a stage returns to the shared folder and reads it
back for the next, so a lost executor repeats one stage at most.

Nulls, empty texts, repeated rows and empty tables have the results that the
operators' modules define.  A document whose every word is removed as repeated
lines is dropped by that stage; ``n_chars`` follows a text that changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.common import discard, materialise
from cartulary.llm.decontamination import drop_contaminated
from cartulary.llm.jaccard import keep_one
from cartulary.llm.line_dedup import dedup_lines
from cartulary.llm.packing import pack_documents
from cartulary.llm.quality import keep_good
from cartulary.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that occur earlier in the corpus, less those that lose every word."""
    out = dedup_lines(docs)
    report = out.columns[-1]
    out = out.where(~F.col(report)["emptied"])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(report)["n_removed"] > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy or an edited copy of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 tokens, written once, in the small batches in which tables are."""
    return materialise(pack_documents(docs, tokenizer_path()), "packed")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Hash-based chunks, alignments and token ids can't be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of the documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:  # what the stage before has written is read no more
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

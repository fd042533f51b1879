"""Corpus preparation: quality rules, near-duplicates, benchmark decontamination,
secret scan, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame; between stages
the rows are written as Parquet and read again.  All but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.llm import common, decontaminate, odd_sketch, packing, quality_rules, queries, secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines leave the others."""
    judged = quality_rules.clean_lines(common.whole_rows(docs), keep_row=True).where("kept")
    text = F.col("clean_text")
    return common.unpacked(judged, docs.columns, text=text, n_chars=F.length(text).cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays.  Rows that repeat an
    id are copies too; rows without an id stay."""
    found = odd_sketch.near_duplicates(docs)
    # Most ids stay once: the others are noted, so that only their texts are shuffled.
    others = common.stored(found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count_if(F.col("doc_id") == F.col("component_id")).alias("n")).where("n != 1"), "pipeline-others")
    common.drop_stored(found)
    sure = common.maybe_among(docs, "doc_id", others, "left_anti")
    maybe = common.maybe_among(docs, "doc_id", others)
    once = maybe.join(others, "doc_id", "left_anti")
    again = maybe.join(others.where("n > 1"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return common.resting_on(sure.unionByName(once).unionByName(again).select(*docs.columns), others)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    benchmark = common.load(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(common.whole_rows(docs), benchmark, keep_row=True)
    clean = found.where(~decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")))
    return common.unpacked(clean, docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    found = secrets.find_secrets(common.whole_rows(docs), keep_row=True)
    text = F.col("clean_text")
    return common.unpacked(found, docs.columns, text=text, n_chars=F.length(text).cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    packed = packing.pack(docs, queries.tokenizer("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secrets", secret_scan), ("packing", pack)]
ORACLE_SQL = None  # tokenization and the test battery have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        rows = common.stored(made, f"pipeline-{name}")
        # What the stage left for its result, and the rows it read.
        common.drop_stored(made)
        common.drop_stored(docs)
        docs = rows

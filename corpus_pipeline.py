"""Corpus pipeline: ``documents`` through the operators of ``wordloom.llm``, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage's result as Parquet below the shared checkpoint folder and reads it again,
so a lost executor never sends the run back to an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import decontam, pieces, quality, secrets, simhash
from wordloom.llm.common import bounded_batches, materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go."""
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: of the rows with the group's smallest id, the one with the least fingerprint and text.

    A row belongs to the group of its own text, whatever other rows have its
    id. A group without an id keeps one row too. Null, empty and blank texts
    are one group. Of rows with the same id and text one stays.
    """
    found = bounded_batches(docs).select(F.col("doc_id").alias("id"), simhash.simhash(F.col("text")).alias("fp"),
                                         F.md5("text").alias("md5"))
    found = materialize(found, "fingerprints")
    label = simhash.labels(found.select("id", "fp"))
    texts = found.join(label, "fp").filter("id <=> component_id").groupBy("root", "id", "fp", "md5").agg(
        F.count(F.lit(1)).alias("n"))
    first = texts.groupBy("root").agg(F.min(F.struct("fp", "md5", "id", "n")).alias("first"))
    first = materialize(first.select("first.id", "first.md5", "first.n"), "kept-texts")

    def held(keys):
        return docs.join(keys, docs["doc_id"].eqNullSafe(keys["id"]) & F.md5(docs["text"]).eqNullSafe(keys["md5"]), "left_semi")

    once, more = held(first.filter("n = 1")), first.filter("n > 1")
    return once if more.isEmpty() else once.union(held(more).dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a benchmark window go; rows without one stay, also beside a dirty row of the same id or without an id."""
    key = F.struct("doc_id", F.md5("text").alias("md5")).alias("row")  # equal texts have the same windows
    found = decontam.contamination(docs.select(key, "text"), read_table(spark, sf_dir, "benchmark"), id_col="row")
    dirty = found.filter(F.size("spans") > 0).select("id.*").distinct()
    same = docs["doc_id"].eqNullSafe(dirty["doc_id"]) & (F.md5(docs["text"]) == dirty["md5"])
    return docs.join(dirty, same, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text."""
    found = secrets.scan(docs)
    text = secrets.redacted(F.col("text"), F.col("secrets"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(
        F.size("secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
        F.col("n_chars"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, score, alternatives, lossless): the three best segmentations of every document."""
    return pieces.encode(docs, n=3).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("sentencepiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The outlier estimates, components and best segmentations are iterative; tests hold a brute-force version instead.
ORACLE_SQL = None

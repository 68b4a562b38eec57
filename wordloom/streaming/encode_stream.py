"""Encoding as a stateless Structured Streaming query.

New files landing in a folder, parquet tables of documents or plain text files,
are encoded with fixed rules by the same row function as the batch encoder;
``availableNow`` processes what is there and stops, ``processingTime`` keeps
running. The sink is written once per batch, under the number of the batch: a
batch that runs again after a failure replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.encode import encode_documents, encode_to_ids

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FORMATS = ("parquet", "text", "lines")


def document_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet", schema: str = DOC_SCHEMA,
                    max_files_per_trigger: int = 64) -> DataFrame:
    """``(doc_id, text, ...)`` of the files as they come.

    ``parquet``: tables of documents. ``text``: every file is a document, named
    by its path; one of no bytes has no row. ``lines``: every line is one, named
    by its file's path.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "parquet":
        return reader.schema(schema).parquet(source_dir)
    return reader.option("lineSep", "\n").text(source_dir, wholetext=fmt == "text").select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def encoded_stream(spark: SparkSession, source_dir: str, rules, vocab: DataFrame | None = None, schema: str = DOC_SCHEMA,
                   max_files_per_trigger: int = 64, fmt: str = "parquet") -> DataFrame:
    """``(doc_id, tokens)`` of the files as they come, with a vocabulary also their ``ids`` (tokens without one dropped)."""
    docs = document_stream(spark, source_dir, fmt, schema, max_files_per_trigger)
    return encode_documents(docs, rules) if vocab is None else encode_to_ids(docs, rules, vocab, tokens=True)


def start_encode_stream(spark: SparkSession, source_dir: str, rules, sink_dir: str, checkpoint_dir: str,
                        vocab: DataFrame | None = None, available_now: bool = True, schema: str = DOC_SCHEMA,
                        max_files_per_trigger: int = 64, fmt: str = "parquet"):
    """Start the query, writing parquet files to ``sink_dir``; a restart goes on from ``checkpoint_dir``."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch={number}")

    w = encoded_stream(spark, source_dir, rules, vocab, schema, max_files_per_trigger, fmt).writeStream.foreachBatch(
        write).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """What the stream has written so far."""
    return spark.read.parquet(sink_dir).drop("batch")


def encode_available(spark: SparkSession, source_dir: str, rules, sink_dir: str, checkpoint_dir: str,
                     vocab: DataFrame | None = None, schema: str = DOC_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """Encode what is there, then read the sink."""
    start_encode_stream(spark, source_dir, rules, sink_dir, checkpoint_dir, vocab, True, schema, fmt=fmt).awaitTermination()
    return read_sink(spark, sink_dir)

"""Helpers shared by the operators: shared-folder tables, words, batches."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.graph import smallest_reachable  # noqa: F401
from wordloom.session import ensure_checkpoint_dir

#: ASCII white space, the separators of the word definition ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs its running tasks only, and a
    plan that reads the table twice does not compute it twice.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spaced_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1)
    return F.filter(pieces, lambda w: w != "")


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends 1,024 rows to Python at once instead of Spark's 10,000, which long texts
    make too large. A session with a setting of its own keeps it."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, "1024")
    return df


def slices(batch, rows: int = 512):
    """An Arrow batch as lists of Python values per column, a few rows at a time, which bounds the objects alive."""
    for first in range(0, batch.num_rows, rows):
        yield first, [c.slice(first, rows).to_pylist() for c in batch.columns]


def release() -> None:
    """Gives unused memory back at the end of a task; the worker process lives on and would keep it."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` once, so that no lambda recomputes it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

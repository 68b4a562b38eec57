"""Session helpers: building a session for tests/bench and locating the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "wordloom") -> SparkSession:
    """A session configured the way the library expects (AQE on, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WORDLOOM_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local master without that setting -- tests -- gets a
    fresh scratch folder; a cluster without it is an error, because a
    machine-local folder is invisible to the other machines.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wordloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def durable(df: DataFrame) -> DataFrame:
    """Materialize once and write a reliable checkpoint of the result.

    ``checkpoint()`` writes its files with a second job; persisting first makes
    that job read the cached rows instead of recomputing the plan.
    """
    from pyspark import StorageLevel

    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)  # its first job fills the cache, the write job reads it
    df.unpersist()
    return out


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint, and its size is known to the planner:
    a small table is broadcast, a large one joined by a shuffle.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: str, name: str = "number", per_part: int = 1 << 20) -> DataFrame:
    """``rows`` with consecutive numbers from 0 in the order of a column (ties in any order).

    Rows are range partitioned and stored; the parts' sizes are summed over one
    row per part, and each part numbers its own rows, so no task sees all rows.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    parts = max(1, -(-rows.count() // per_part))
    cut = stored(rows.repartitionByRange(parts, order).withColumn("part_", F.spark_partition_id()), "numbered")
    sizes = cut.groupBy("part_").agg(F.count(F.lit(1)).alias("size_"))
    before = F.sum("size_").over(Window.orderBy("part_")) - F.col("size_")
    inside = F.row_number().over(Window.partitionBy("part_").orderBy(order)) - 1
    return cut.join(sizes.select("part_", before.alias("before_")), "part_").withColumn(
        name, F.col("before_") + inside).drop("part_", "before_")


def spread(scan: DataFrame) -> DataFrame:
    """A file scan with at least one partition per core, for CPU-heavy work on its rows.

    A large input already arrives in many splits and is returned unchanged; a
    small one (a single row group) is dealt round-robin. Only for bare scans:
    their partitions are known without running anything.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.isStreaming or scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)

"""Compact grid storage: exchange CSV and a Parquet layout that scans well."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import gid_level

# Fixed value: the columns of the compact grid, as exchanged and as stored.
# Totals are 64-bit, wider than the exchange format asks for: a coarse cell of a large grid sums to more than an INT.
COMPACT_SCHEMA = "gid BIGINT, pop BIGINT, pop_fem_perc SMALLINT, dom_ocu BIGINT, is_cache BOOLEAN"
_CSV_SCHEMA = "gid BIGINT, pop BIGINT, pop_fem_perc SMALLINT, dom_ocu BIGINT, is_cache STRING"


def read_compact_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exchange CSV with header and ``t`` / ``f`` booleans; a malformed row fails the job."""
    raw = spark.read.schema(_CSV_SCHEMA).csv(path, header=True, mode="FAILFAST")
    return raw.withColumn("is_cache", F.col("is_cache").cast("boolean"))


def write_compact_csv(compact: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Exchange CSV ordered by level, then key, over as many part files as there are partitions."""
    flag = F.when(F.col("is_cache"), "t").otherwise("f").alias("is_cache")
    ordered = compact.withColumn("_level", gid_level("gid")).orderBy("_level", "gid")
    ordered.select("gid", "pop", "pop_fem_perc", "dom_ocu", flag).write.mode(mode).csv(path, header=True)


def write_compact(compact: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Parquet partitioned by ``level`` and sorted by key; returns the number of rows written.

    Rows are range-partitioned by (level, gid), so files are of even size, a level
    filter prunes directories and a key range prunes files and row groups.
    """
    seen = Observation("written")
    (
        compact.withColumn("level", gid_level("gid"))
        .repartitionByRange("level", "gid")
        .sortWithinPartitions("level", "gid")
        .observe(seen, F.count(F.lit(1)).alias("rows"))  # after the ranging, which reads its input twice
        .write.mode(mode)
        .partitionBy("level")
        .parquet(path)
    )
    return seen.get["rows"]


def write_version(compact: DataFrame, folder: str) -> str:
    """Store the grid as a new version under ``folder`` and return its path; older ones stay for who reads them."""
    path = f"{folder.rstrip('/')}/version-{time.time_ns():020d}"
    write_compact(compact, path, mode="errorifexists")
    return path


def current_version(spark: SparkSession, folder: str) -> DataFrame:
    """The newest whole version under ``folder``: one whose write was committed."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/version-*/_SUCCESS")
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root)
    paths = sorted(s.getPath().getParent().toString() for s in found or ())
    if not paths:
        raise ValueError(f"no version of the grid in {folder}")
    return read_compact(spark, paths[-1])


def read_compact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPACT_SCHEMA + ", level INT").parquet(path)

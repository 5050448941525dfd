"""File checksums and volumetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_manifest(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``path, length, md5, sha256`` of every file; each file is hashed by the task that reads it."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    return files.select("path", "length", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def pretty_size(size) -> Column:
    """Size in bytes as text with the largest unit that leaves fewer than 10,240."""
    n = F.col(size) if isinstance(size, str) else size
    out = F.when(n < 10240, F.concat(n.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(("kB", "MB", "GB"), start=1):
        scaled = F.round(n / float(1024**power)).cast("long")
        out = out.when(scaled < 10240, F.concat(scaled.cast("string"), F.lit(f" {unit}")))
    return out.otherwise(F.concat(F.round(n / float(1024**4)).cast("long").cast("string"), F.lit(" TB")))


def volumetry(df: DataFrame, resource: str, table_column: str | None = None) -> DataFrame:
    """Tables, bytes, lines and bytes per line of a file-backed DataFrame.

    Sizes come from the scan's own file metadata: one row per file after map-side
    combine, no listing on the driver and no file content read.
    """
    table = F.col(table_column) if table_column else F.lit(resource)
    per_file = (
        df.select(table.alias("table"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("table", "file")
        .agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("lines"))
    )
    per_table = per_file.groupBy("table").agg(F.sum("bytes").alias("bytes"), F.sum("lines").alias("lines"))
    total = per_table.agg(
        F.count(F.lit(1)).alias("tables"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("tot_bytes"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("tot_lines"),
    )
    return total.select(
        F.lit(resource).alias("resource"),
        "tables",
        "tot_bytes",
        pretty_size("tot_bytes").alias("tot_size"),
        "tot_lines",
        F.when(F.col("tot_lines") > 0, F.call_function("div", F.col("tot_bytes"), F.col("tot_lines"))).alias("bytes_per_line"),
    )

"""Load jobs: original grid or exchange CSV to the stored compact grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import gid_to_quadrant
from gridloom.operators.pyramid import key_cells, pyramid_of_keys
from gridloom.session import written
from gridloom.sources.compact import read_compact, read_compact_csv, write_compact
from gridloom.sources.original import TABLE_PREFIX


def load_report(compact: DataFrame, prefix: str = TABLE_PREFIX) -> DataFrame:
    """Rows loaded per quadrant table, with the load message."""
    return (
        compact.groupBy(gid_to_quadrant("gid").alias("quadrant"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("table", F.concat(F.lit(prefix), F.lpad(F.col("quadrant").cast("string"), 2, "0")))
        .withColumn("msg", F.concat("table", F.lit(": "), F.col("n").cast("string"), F.lit(" itens inseridos")))
    )


def keyed(original: DataFrame) -> DataFrame:
    """The original rows' keys and figures, stored: the pyramid and the ranging of its rows read them three times."""
    return written(key_cells(original), "keyed")


def load_from_original(original: DataFrame, path: str, add_levels: bool = True, float32: bool = False) -> int:
    """Build the compact grid of all quadrants in one job and store it; returns the rows written."""
    return write_compact(pyramid_of_keys(keyed(original), add_levels, float32), path)


def load_from_csv(spark: SparkSession, csv_path: str, path: str) -> int:
    """Store an exchange CSV as the compact grid; returns the rows written."""
    return write_compact(read_compact_csv(spark, csv_path), path)


def open_compact(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """The stored compact grid; also registered as ``view`` when named."""
    compact = read_compact(spark, path)
    if view:
        compact.createOrReplaceTempView(view)
    return compact

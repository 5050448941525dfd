"""A stored grid that is kept up quadrant by quadrant.

A quadrant is a root cell of the hierarchy: every coarser cell above one of its cells lies in it, so the sums that a
quadrant's cells add to are its own. The store has one folder per quadrant with all levels, sorted by key; loading or
replacing a quadrant builds that quadrant's pyramid from its cells, exact sums of women included, and writes that folder
alone. The others are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import gid_level, gid_to_quadrant, name_to_gid
from gridloom.operators.pyramid import build_pyramid, pyramid_of_keys
from gridloom.plans.load import keyed
from gridloom.sources.compact import COMPACT_SCHEMA


def _placed(compact: DataFrame) -> DataFrame:
    return compact.withColumns({"level": gid_level("gid"), "quadrant": gid_to_quadrant("gid").cast("int")})


def _write(compact: DataFrame, path: str, mode: str, **options: str) -> None:
    ranged = _placed(compact).repartitionByRange("quadrant", "gid").sortWithinPartitions("quadrant", "gid")
    ranged.write.mode(mode).options(**options).partitionBy("quadrant").parquet(path)


def store_by_quadrant(original: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Build the compact grid of all quadrants of an original table and store it with one folder per quadrant."""
    _write(pyramid_of_keys(keyed(original)), path, mode)


def open_by_quadrant(spark: SparkSession, path: str) -> DataFrame:
    """The stored grid with ``level`` and ``quadrant``; a filter on the quadrant reads its folder alone."""
    return spark.read.schema(COMPACT_SCHEMA + ", level INT, quadrant INT").parquet(path)


def replace_quadrant(original: DataFrame, path: str, quadrant: int) -> None:
    """Load one quadrant's original rows into a stored grid, in place of what the quadrant had, or as a new quadrant.

    The result equals a store built anew with these rows. Rows of other quadrants, or with names that are no cell's, fail
    the job before anything is written. Without rows the quadrant's folder goes. A job that fails leaves the old rows;
    the new ones are moved in on commit.
    """
    spark = original.sparkSession
    strange = f"nvl({gid_to_quadrant.sql(name_to_gid.sql('id_unico'))}, -1) <> {int(quadrant)}"
    state = original.selectExpr("count(*) AS n", f"count_if({strange}) AS strange").first()
    if state["strange"]:
        raise ValueError(f"{state['strange']} rows are not of quadrant {quadrant}")
    if state["n"]:
        _write(build_pyramid(original), path, "overwrite", partitionOverwriteMode="dynamic")
        return
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/quadrant={int(quadrant)}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def quadrant_counts(stored: DataFrame) -> DataFrame:
    """``quadrant, level, n``: rows of a grid stored by quadrant."""
    return stored.groupBy("quadrant", "level").agg(F.count(F.lit(1)).alias("n"))

"""Original census grid: one directory or table per quadrant, read as one DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.levels import QUADRANTS
from gridloom.operators.compare import union_tables

# Fixed value: columns of an original quadrant table; geometry as longitude / latitude WKT.
ORIGINAL_SCHEMA = (
    "gid INT, id_unico STRING, nome_1km STRING, nome_5km STRING, nome_10km STRING, nome_50km STRING, "
    "nome_100km STRING, nome_500km STRING, quadrante STRING, masc INT, fem INT, pop INT, dom_ocu INT, "
    "shape_leng DOUBLE, shape_area DOUBLE, geom STRING"
)
TABLE_PREFIX = "grade_id"


def quadrant_table_names(prefix: str = TABLE_PREFIX) -> list[str]:
    """Names of the 56 quadrant tables."""
    return [f"{prefix}{q:02d}" for q in QUADRANTS]


def write_original(
    original: DataFrame, path: str, mode: str = "overwrite", finish: Callable[[DataFrame], DataFrame] | None = None,
    ranged_by: Sequence[str] | None = None,
) -> None:
    """One Parquet directory ``grade_idNN`` per quadrant.

    Rows are ranged by quadrant and cell name: a quadrant that holds a third of all
    cells is spread over several tasks and files. Ranging reads its input twice and moves it, so what can be made of a
    few columns is made by ``finish``, which gets the ranged rows, with ``table``, and returns all columns, in order of ``table``.
    ``ranged_by`` names columns to range by instead, such as numbers for the quadrant and the cell, which cost no text; ``finish``
    then makes ``table`` as well.
    """
    if ranged_by is None:
        table = F.concat(F.lit(TABLE_PREFIX), F.substring("quadrante", -2, 2))
        ranged = original.withColumn("table", table).repartitionByRange("table", "id_unico")
    else:
        ranged = original.repartitionByRange(*ranged_by)
    if finish is not None:
        ranged = finish(ranged)
    (
        ranged.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
        .partitionBy("table")
        .parquet(path)
    )


def read_original(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All quadrants below ``path`` in one scan, with ``table`` taken from the directory name.

    A filter on ``table`` prunes whole quadrants.
    """
    reader = spark.read.schema(ORIGINAL_SCHEMA + ", table STRING").format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.load(path)


def original_tables(spark: SparkSession, prefix: str = TABLE_PREFIX) -> list[str]:
    """Catalog tables and views that hold quadrants, in order of name."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))


def union_original_tables(spark: SparkSession, view: str | None = None, prefix: str = TABLE_PREFIX) -> DataFrame:
    """Union of all quadrant tables in the catalog; also registered as ``view`` when named."""
    names = original_tables(spark, prefix)
    if not names:
        raise ValueError(f"no table named {prefix}* in the current catalog")
    out = union_tables([spark.table(n) for n in names])
    if view:
        out.createOrReplaceTempView(view)
    return out

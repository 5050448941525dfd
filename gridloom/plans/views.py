"""Views for mapping and materialised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import cell_ring, gid_level, gid_to_name, square_wkt


def level_view(compact: DataFrame, level: int, view: str | None = None, ring: bool = False) -> DataFrame:
    """Cells of one level with name and shape.

    Where the data is stored by ``level`` the filter prunes directories. ``ring``
    adds the longitude / latitude ring that GeoJSON output needs.
    """
    own = F.col("level") if "level" in compact.columns else gid_level("gid")
    out = compact.filter(own == level).withColumns({"id_unico": gid_to_name("gid"), "geom": square_wkt("gid")})
    if ring:
        out = out.withColumn("ring", cell_ring("gid", translate=True))
    if view:
        out.createOrReplaceTempView(view)
    return out


def materialize(df: DataFrame, table: str) -> DataFrame:
    """Write (or refresh) a table in the catalog and return it."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)

"""Control points: places with a known cell, for verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: columns of a control-point file, in order; the header of a file may name them otherwise.
CONTROL_SCHEMA = (
    "jurisdiction STRING, name STRING, geo_uri STRING, wikidata_id BIGINT, osm_node_id BIGINT, cell_name STRING"
)


def read_control_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONTROL_SCHEMA).csv(path, header=True, quote='"', escape='"', mode="FAILFAST")


def write_control_points(points: DataFrame, path: str, cell: str = "id_unico", mode: str = "overwrite") -> None:
    """Control points with their verified cell name, in the form that ``read_control_points`` takes."""
    points.select(
        "jurisdiction", "name", "geo_uri", "wikidata_id", "osm_node_id", points[cell].alias("cell_name")
    ).write.mode(mode).csv(path, header=True, quote='"', escape='"')

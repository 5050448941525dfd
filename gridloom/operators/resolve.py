"""Batch resolution of points, cell names and geohashes to cells with census figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import (
    geohash_to_gid,
    gid_to_gid,
    gid_to_name,
    gid_to_quadrant_text,
    name_to_gid,
)
from gridloom.operators.points import locate_uris, with_geohash
from gridloom.operators.skew import keyed_join


def _census(compact: DataFrame) -> DataFrame:
    return compact.select("gid", "pop", "dom_ocu", "pop_fem_perc")


def with_census(df: DataFrame, compact: DataFrame) -> DataFrame:
    """Left join on ``gid`` with the compact grid; figures are NULL where no cell exists."""
    out = keyed_join(df, _census(compact), "gid", "left")
    return out.withColumn("pop_masc_perc", F.expr("int(100 - pop_fem_perc)"))


def resolve_uris(
    points: DataFrame, compact: DataFrame, uri: str = "geo_uri", level: int = 5,
    honor_uncertainty: bool = True, geohash_digits: int = 9,
) -> DataFrame:
    """GeoURIs with their cell, root cell, quadrant, geohash and census figures."""
    located = with_geohash(locate_uris(points, uri, level, honor_uncertainty), digits=geohash_digits)
    joined = with_census(located, compact)
    return joined.withColumns(
        {"gid_l0": gid_to_gid("gid", 0), "name": gid_to_name("gid"), "quadrant": gid_to_quadrant_text("gid")}
    ).withColumn("name_l0", gid_to_name("gid_l0"))


def resolution_json(prefix: str = "", census_key: str = "cell_L5_censo2010") -> Column:
    """JSON document of a resolved row; ``prefix`` goes before each cell member's name."""
    census = F.when(
        F.col("pop").isNotNull(),
        F.struct("pop", "dom_ocu", "pop_fem_perc", "pop_masc_perc"),
    )
    return F.to_json(
        F.struct(
            F.col("gid_l0").alias(f"{prefix}cell_L0_gid"),
            F.col("quadrant").alias(f"{prefix}cell_quadrante"),
            F.col("gid").alias(f"{prefix}cell_L5_gid"),
            F.col("name_l0").alias(f"{prefix}cell_L0"),
            F.col("name").alias(f"{prefix}cell_L5"),
            F.col("geohash"),
            census.alias(f"{prefix}{census_key}"),
        ),
        {"ignoreNullFields": "false"},
    )


def resolve_names(names: DataFrame, compact: DataFrame, name: str = "name") -> DataFrame:
    """Cell names with their key and census figures."""
    return with_census(names.withColumn("gid", name_to_gid(name)), compact)


def resolve_geohashes(df: DataFrame, compact: DataFrame, geohash: str = "geohash") -> DataFrame:
    """Geohashes with the cell of like size at their centre and its census figures."""
    return with_census(df.withColumn("gid", geohash_to_gid(geohash)), compact)

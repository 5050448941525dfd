"""From coordinates to cells, staged so that each value is computed once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import (
    forward,
    geouri_lat,
    geouri_lon,
    geouri_uncertainty,
    point_to_gid,
    size_to_level,
    uncertain_to_size,
)
from gridloom.functions._base import round_long
from gridloom.functions.geouri import axes_to_geohash, geohash_axes


def with_xy(df: DataFrame, lat: str = "lat", lon: str = "lon", float32: bool = False) -> DataFrame:
    """Add projected ``x``, ``y`` in whole metres."""
    narrow = "double(float({}))" if float32 else "double({})"
    x, y = forward(narrow.format(lat), narrow.format(lon))
    return df.selectExpr("*", f"{round_long(x)} AS x", f"{round_long(y)} AS y")


def with_latlon(df: DataFrame, uri: str = "geo_uri") -> DataFrame:
    """Add ``lat``, ``lon`` read from a GeoURI; NULL when it is malformed or the coordinate is not on Earth."""
    return df.selectExpr("*", f"{geouri_lat.sql(uri)} AS lat", f"{geouri_lon.sql(uri)} AS lon")


def locate_uris(
    df: DataFrame, uri: str = "geo_uri", level: int = 5, honor_uncertainty: bool = True, float32: bool = False
) -> DataFrame:
    """Add ``lat, lon, x, y, gid`` for a column of GeoURIs."""
    out = with_xy(with_latlon(df, uri), float32=float32)
    if not honor_uncertainty:
        return out.withColumn("gid", point_to_gid("x", "y", level))
    snapped = size_to_level.sql(uncertain_to_size.sql("_u"))
    out = out.withColumn("_u", geouri_uncertainty(uri)).selectExpr("*", f"IF(_u IS NULL, {level}, {snapped}) AS _level")
    return out.withColumn("gid", point_to_gid("x", "y", "_level")).drop("_u", "_level")


def with_geohash(df: DataFrame, lat: str = "lat", lon: str = "lon", digits: int = 9, name: str = "geohash") -> DataFrame:
    """Add the geohash of a latitude and longitude; the axis positions are columns of their own, made once."""
    lon_axis, lat_axis = geohash_axes(lat, lon, digits)
    staged = df.selectExpr("*", f"{lon_axis} AS _lon", f"{lat_axis} AS _lat")
    return staged.withColumn(name, F.expr(axes_to_geohash("_lon", "_lat", digits))).drop("_lon", "_lat")

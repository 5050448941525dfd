"""Column functions of the grid: levels, keys, names, projection, GeoURIs, shapes."""

from gridloom.functions._base import grid_function, register_sql_functions
from gridloom.functions.albers import forward, inverse, latlon_to_gid, latlon_to_xy, xy_to_latlon
from gridloom.functions.cellid import (
    center,
    center_to_gid,
    center_to_ref,
    center_x,
    center_y,
    decode,
    encode,
    gid_contains,
    gid_level,
    gid_to_gid,
    gid_to_name,
    gid_to_quadrant,
    gid_to_quadrant_text,
    gid_x,
    gid_y,
    ij_to_ref,
    name_to_center,
    name_to_gid,
    name_to_parts,
    name_to_ref,
    point_size_to_gid,
    point_to_gid,
    point_to_name,
    quadrant_text,
    quadrant_to_gid,
    quadrants,
    quadrants_text,
    ref_to_name,
    snap_i,
    snap_j,
    snap_center,
    snap_ref,
    xy_level_to_ij,
    xy_to_ij,
    xy_to_quadrant,
    xy_to_quadrant_text,
    xy_to_quadrant_valid,
)
from gridloom.functions.geouri import (
    geohash_center,
    geohash_radius,
    geohash_to_gid,
    geouri_lat,
    geouri_level,
    geouri_lon,
    geouri_to_geohash,
    geouri_to_gid,
    geouri_uncertainty,
    latlon_to_geohash,
)
from gridloom.functions.levels import (
    level_to_prefix,
    level_to_size,
    prefix_to_level,
    size_to_level,
    uncertain_to_size,
)
from gridloom.functions.shapes import (
    cell_center_point,
    cell_ring,
    clip_parts,
    clip_to_box,
    named_cell_center_point,
    named_cell_ring,
    parts_area,
    parts_centroid,
    parts_contain,
    ring_area,
    ring_centroid,
    ring_contains, ring_simplify,
    ring_to_wkt,
    ring_to_xy,
    square,
    square_contains,
    square_wkt,
    wkt_to_parts,
    wkt_to_ring,
)
from gridloom.functions.text import json_slice, prefix_join

__all__ = [name for name in dir() if not name.startswith("_")]

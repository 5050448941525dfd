"""Dissolved cells as polygons: outline pieces stitched into closed rings, and holes given to their shells.

Every outline piece has the cell on its left, so pieces lead on from end to start. Straight pieces are joined to sides
line by line; sides link to the next one at their end. Ring and place of each side are found by pointer jumping: after k
rounds a side knows the least side among the 2^k ahead and how far it is, so a ring of n sides takes log n rounds, and no
group holds a parent's outline. Only the finished rings are gathered, each by itself, and last put together by parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions._base import struct
from gridloom.functions.shapes import PARTS
from gridloom.operators.dissolve import UNIT, outline_units
from gridloom.session import written


def outline_sides(cells: DataFrame, parent_level: int = 4) -> DataFrame:
    """Straight sides of the outline: ``parent, id, d, x, y, x2, y2`` from start to end, the cells on the left.

    ``id`` is a number from start and direction, which no other side has.
    """
    units = outline_units(cells.select("gid").distinct(), parent_level).filter("parent IS NOT NULL")
    lined = units.selectExpr("parent", "d", "IF(vertical, x, y) AS line", "IF(vertical, y, x) AS at")
    order = F.row_number().over(Window.partitionBy("parent", "d", "line").orderBy("at"))
    joined = lined.withColumn("run", F.col("at") - order * UNIT).groupBy("parent", "d", "line", "run").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    start, end = "IF(d < 2, low, high)", "IF(d < 2, high, low)"
    ends = joined.withColumn("high", F.col("high") + UNIT).selectExpr(
        "parent", "d", f"IF(d % 2 = 0, {start}, line) AS x", f"IF(d % 2 = 0, line, {start}) AS y",
        f"IF(d % 2 = 0, {end}, line) AS x2", f"IF(d % 2 = 0, line, {end}) AS y2",
    )
    return ends.selectExpr("*", f"((x div {UNIT}) * {1 << 30}L + y div {UNIT}) * 4 + d AS id")


def _next_sides(sides: DataFrame) -> DataFrame:
    """``id, nxt``: the side that leads on. Where two do, at a corner that two cells share, the left turn keeps to the cell."""
    ahead = sides.selectExpr("parent", "x AS x2", "y AS y2", "id AS nxt", "d AS d2")
    left = F.expr("int(d2 = (d + 1) % 4)")
    return sides.join(ahead, ["parent", "x2", "y2"]).groupBy("id").agg(F.max_by("nxt", left).alias("nxt"))


def rank_in_cycles(links: DataFrame) -> DataFrame:
    """``id, ring, ahead`` of links (id, nxt) that are cycles: the least id of the cycle, and how many steps on it is."""
    state, width = written(links.selectExpr("id", "nxt", "id AS ring", "0L AS ahead"), "rings"), 1
    while True:
        far = state.selectExpr("id AS nxt", "nxt AS nxt2", "ring AS ring2", "ahead AS ahead2")
        less = "ring2 < ring"
        step = state.join(far, "nxt").selectExpr(
            "id", "nxt2 AS nxt", "least(ring, ring2) AS ring", f"IF({less}, {width}L + ahead2, ahead) AS ahead", f"{less} AS moved"
        )
        step = written(step, "rings")
        state, width = step.drop("moved"), width * 2
        if step.filter("moved").isEmpty():
            return state.drop("nxt")


def outline_rings(cells: DataFrame, parent_level: int = 4) -> DataFrame:
    """Vertices of the outline's rings: ``parent, ring, seq, x, y``, and of the side from there on ``d, x2, y2``.

    Rings run with the cells on their left: shells counterclockwise, holes clockwise. ``seq`` counts from 0 at the ring's
    least vertex. Cells that touch at a corner alone lie in shells of their own.
    """
    sides = written(outline_sides(cells, parent_level), "sides")
    ranked = sides.join(rank_in_cycles(_next_sides(sides)), "id")
    length = F.count(F.lit(1)).over(Window.partitionBy("ring"))
    return ranked.withColumn("length", length).selectExpr("parent", "ring", "(length - ahead) % length AS seq", "x", "y", "d", "x2", "y2")


def _owners(vertices: DataFrame, kinds: DataFrame) -> DataFrame:
    """``ring, shell`` of every hole: the shell whose part it lies in.

    West of a hole's westernmost side are cells, back to the side where they begin. That one is the shell's or another
    hole's of the same part; holes hand on until a shell is met.
    """
    upright = vertices.filter("d % 2 = 1").selectExpr("parent", "ring", "x", f"explode(sequence(least(y, y2), greatest(y, y2) - {UNIT}L, {UNIT}L)) AS y")
    before = F.lag("ring").over(Window.partitionBy("parent", "y").orderBy("x"))
    first = upright.withColumn("before", before).groupBy("ring").agg(F.min_by("before", F.struct("x", "y")).alias("shell"))
    owned = written(first.join(kinds.filter("twice < 0").select("ring"), "ring"), "owners")
    while True:
        further = owned.selectExpr("ring AS shell", "shell AS further")
        step = written(owned.join(further, "shell", "left").selectExpr("ring", "coalesce(further, shell) AS shell", "further IS NOT NULL AS moved"), "owners")
        owned = step.drop("moved")
        if step.filter("moved").isEmpty():
            return owned


def dissolve_polygons(cells: DataFrame, parent_level: int = 4) -> DataFrame:
    """One row per parent: ``parent, n_shells, n_holes, parts``, the union of its cells as closed rings of corners only.

    ``parts`` is in the form of :func:`gridloom.functions.shapes.wkt_to_parts`: each part its shell, then its holes.
    Cells may be of 200 m and 1 km, may repeat, and do not overlap otherwise.
    """
    vertices = written(outline_rings(cells, parent_level), "vertices")
    kinds = written(vertices.groupBy("parent", "ring").agg(F.expr("sum(x * y2 - x2 * y)").alias("twice")), "kinds")
    point = struct(x="double(x)", y="double(y)")
    in_order = F.array_sort(F.collect_list(F.expr(struct(seq="seq", p=point))))
    rings = vertices.groupBy("ring").agg(in_order.alias("found")).selectExpr("ring", "transform(found, v -> v.p) AS open")
    rings = rings.selectExpr("ring", "concat(open, slice(open, 1, 1)) AS line")
    placed = kinds.join(_owners(vertices, kinds), "ring", "left").join(rings, "ring")
    placed = placed.selectExpr("parent", "ring", "coalesce(shell, ring) AS shell", "line")
    part = F.array_sort(F.collect_list(F.expr(struct(hole="ring <> shell", ring="ring", line="line"))))
    parts = placed.groupBy("parent", "shell").agg(part.alias("found")).selectExpr("parent", "shell", "transform(found, r -> r.line) AS part")
    whole = F.array_sort(F.collect_list(F.expr(struct(shell="shell", part="part"))))
    return parts.groupBy("parent").agg(whole.alias("found")).selectExpr(
        "parent", "size(found) AS n_shells", "aggregate(found, 0, (a, p) -> a + size(p.part) - 1) AS n_holes", f"cast(transform(found, p -> p.part) AS {PARTS}) AS parts"
    ).selectExpr("parent", "bigint(n_shells) AS n_shells", "bigint(n_holes) AS n_holes", "parts")

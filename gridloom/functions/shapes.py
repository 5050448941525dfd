"""Cell shapes and ring geometry on ``array<struct<x, y>>`` rings (closed, first point repeated)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridloom.functions._base import bind, grid_function, struct
from gridloom.functions.albers import forward_point, inverse, rounded
from gridloom.functions.cellid import center_x, center_y, gid_level, name_to_center
from gridloom.functions.levels import SIDES, per_level

POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
RING = f"ARRAY<{POINT}>"
PARTS = f"ARRAY<ARRAY<{RING}>>"  # per part its outer ring, then its holes
_EMPTY = f"cast(array() AS {RING})"
_HALF = tuple(s // 2 for s in SIDES)
_BLANKS = ("\\t", "\\n", "\\u000B", "\\f", "\\r")  # white space but the plain one, as SQL writes it


def _latlon_point(x: str, y: str, decimals: int | None) -> str:
    lat, lon = inverse(x, y)
    if decimals is not None:
        lat, lon = f"round({lat}, {decimals})", f"round({lon}, {decimals})"
    return struct(x=lon, y=lat)


def _point(x: str, y: str, translate: bool, decimals: int | None) -> str:
    return _latlon_point(x, y, decimals) if translate else struct(x=f"double({x})", y=f"double({y})")


# ---------------------------------------------------------------- cells

@grid_function("cx BIGINT, cy BIGINT, half BIGINT", RING)
def square(cx, cy, half, translate: bool = False, decimals: int | None = None) -> str:
    """Ring of the square centred on (cx, cy), from the lower-left corner clockwise.

    ``translate`` gives longitude / latitude vertices instead of projected ones.
    """
    left, right, low, high = f"({cx} - {half})", f"({cx} + {half})", f"({cy} - {half})", f"({cy} + {half})"
    corners = [_point(x, y, translate, decimals) for x, y in ((left, low), (left, high), (right, high), (right, low))]
    return f"array({', '.join([*corners, corners[0]])})"


@grid_function("gid BIGINT", RING)
def cell_ring(gid, translate: bool = False, decimals: int | None = None) -> str:
    """Ring of a cell."""
    half = per_level(_HALF, gid_level.sql(gid))
    return square.sql(center_x.sql(gid), center_y.sql(gid), half, translate=translate, decimals=decimals)


@grid_function("name STRING", RING)
def named_cell_ring(name, translate: bool = False, decimals: int | None = None) -> str:
    """Ring of a named cell."""
    ring = square.sql("n_.x", "n_.y", per_level(_HALF, "n_.level"), translate=translate, decimals=decimals)
    return bind(name_to_center.sql(name), "n_", ring)


@grid_function("gid BIGINT", POINT)
def cell_center_point(gid, translate: bool = False, decimals: int | None = None) -> str:
    """struct<x, y>: cell centre, projected or as longitude / latitude."""
    return _point(center_x.sql(gid), center_y.sql(gid), translate, decimals)


@grid_function("name STRING", POINT)
def named_cell_center_point(name, translate: bool = False, decimals: int | None = None) -> str:
    return bind(name_to_center.sql(name), "n_", _point("n_.x", "n_.y", translate, decimals))


def corner_columns(gid: str, prefix: str = "") -> dict[str, str]:
    """Expressions of the longitude / latitude corners of a cell as flat columns ``x0, y0 .. x3, y3``."""
    half = per_level(_HALF, gid_level.sql(gid))
    x, y = center_x.sql(gid), center_y.sql(gid)
    out = {}
    for i, (dx, dy) in enumerate(("--", "-+", "++", "+-")):
        lat, lon = inverse(f"({x} {dx} {half})", f"({y} {dy} {half})")
        out[f"{prefix}x{i}"], out[f"{prefix}y{i}"] = lon, lat
    return out


def quad_centroid(prefix: str = "") -> tuple[str, str]:
    """Expressions of the area-weighted centroid of the quadrilateral in ``corner_columns``."""
    dx, dy = ([f"({prefix}{a}{i} - {prefix}{a}0)" for i in range(4)] for a in "xy")
    cross = [f"({dx[i]} * {dy[i + 1]} - {dx[i + 1]} * {dy[i]})" for i in (1, 2)]
    doubled = f"({' + '.join(cross)})"
    x, y = (" + ".join(f"({d[i]} + {d[i + 1]}) * {c}" for i, c in zip((1, 2), cross)) for d in (dx, dy))
    return f"({prefix}x0 + ({x}) / (3D * {doubled}))", f"({prefix}y0 + ({y}) / (3D * {doubled}))"


def quad_area(prefix: str = "") -> str:
    """Expression of the planar area of the quadrilateral in ``corner_columns``, as ``ring_area`` gives it."""
    dx, dy = ([f"({prefix}{a}{i} - {prefix}{a}0)" for i in range(4)] for a in "xy")
    return f"(abs({' + '.join(f'({dx[i]} * {dy[i + 1]} - {dx[i + 1]} * {dy[i]})' for i in (1, 2))}) / 2D)"


def quad_contains(x: str, y: str, prefix: str = "") -> str:
    """Expression of ``ring_contains`` for the quadrilateral in ``corner_columns``."""
    odd, touched = [], []
    for i in range(4):
        a, b = ({"x": f"{prefix}x{k % 4}", "y": f"{prefix}y{k % 4}"} for k in (i, i + 1))
        crosses, touches = _side_tests(a, b, {"x": x, "y": y})
        odd.append(f"int({crosses})")
        touched.append(touches)
    return f"({' + '.join(odd)}) % 2 = 1 AND NOT ({' OR '.join(touched)})"


def edge_clips(half: str, cx: str, cy: str, prefix: str = "") -> list[dict[str, str]]:
    """Two steps of columns that give ``quad_overlap``: each side cut to the square's width, then its part above the lower border.

    Relative to the lower-left corner of the square. ``_d`` is the run of a side within the width and ``_u, _v`` the heights at its ends.
    """
    width = f"double(2 * {half})"
    moved = {f"_{a}{i}": f"({prefix}{a}{i} - ({c} - {half}))" for i in range(4) for a, c in (("x", cx), ("y", cy))}
    cut = {"_w": width}
    for i in range(4):
        x, y, z, t = f"_x{i}", f"_y{i}", f"_x{(i + 1) % 4}", f"_y{(i + 1) % 4}"
        for name, own, height in (("u", x, y), ("v", z, t)):
            inner = f"least(greatest({own}, 0D), {width})"
            cut[f"_{name}x{i}"] = inner
            # an end outside the width moves along its side; a level run has no other height
            cut[f"_{name}{i}"] = f"IF({own} = {inner} OR {x} = {z}, {height}, {y} + ({inner} - {x}) * ({t} - {y}) / IF({x} = {z}, 1D, {z} - {x}))"
    return [moved, cut]


def quad_overlap() -> str:
    """Expression of the area of a quadrilateral within a square, of the columns of ``edge_clips``.

    The heights above the lower border, cut at the upper one, are summed along each side: the mean of a linear height is its
    middle, or a triangle where the side crosses a border.
    """
    def positive(a, b):
        top = f"greatest({a}, {b})"
        return f"CASE WHEN least({a}, {b}) >= 0D THEN ({a} + {b}) / 2D WHEN {top} <= 0D THEN 0D ELSE {top} * {top} / (2D * abs({a} - {b})) END"

    sums = [f"(_vx{i} - _ux{i}) * ({positive(f'_u{i}', f'_v{i}')} - {positive(f'(_u{i} - _w)', f'(_v{i} - _w)')})" for i in range(4)]
    return f"abs({' + '.join(sums)})"


# ---------------------------------------------------------------- text forms

@grid_function(f"ring {RING}", "STRING")
def ring_to_wkt(ring) -> str:
    """WKT of a ring; whole numbers are written without decimals."""
    def number(v):
        return f"IF({v} = rint({v}), string(bigint({v})), string({v}))"

    vertices = f"transform({ring}, p_ -> concat({number('p_.x')}, ' ', {number('p_.y')}))"
    return f"concat('POLYGON((', array_join({vertices}, ','), '))')"


@grid_function("gid BIGINT", "STRING")
def square_wkt(gid, translate: bool = False, decimals: int | None = None) -> str:
    """WKT of a cell, built without arrays so that it stays in generated code."""
    half = per_level(_HALF, gid_level.sql(gid))
    low_x, high_x = (f"({center_x.sql(gid)} {op} {half})" for op in "-+")
    low_y, high_y = (f"({center_y.sql(gid)} {op} {half})" for op in "-+")
    corners = []
    for x, y in ((low_x, low_y), (low_x, high_y), (high_x, high_y), (high_x, low_y)):
        if translate:
            lat, lon = inverse(x, y)
            x, y = (lon, lat) if decimals is None else (f"round({lon}, {decimals})", f"round({lat}, {decimals})")
        corners.append(f"string({x}), ' ', string({y})")
    vertices = ", ',', ".join([*corners, corners[0]])
    return f"concat('POLYGON((', {vertices}, '))')"


def _with_corners(df: DataFrame, gid: str) -> DataFrame:
    """The rows with the longitudes ``_a0 .. _a3`` and latitudes ``_b0 .. _b3`` of a cell's corners, made in steps: sides, then corners."""
    kept = [f"`{c}`" for c in df.columns]
    half, x, y = per_level(_HALF, gid_level.sql(gid)), center_x.sql(gid), center_y.sql(gid)
    sides = df.selectExpr(*kept, *[f"{v} {op} {half} AS _{a}{n}" for a, v in (("x", x), ("y", y)) for n, op in enumerate("-+")])
    corners = []
    for i, (a, b) in enumerate(((0, 0), (0, 1), (1, 1), (1, 0))):
        for axis, degrees in zip("ba", inverse(f"_x{a}", f"_y{b}")):
            corners.append(f"{degrees} AS _{axis}{i}")
    return sides.selectExpr(*kept, *corners)


def with_cell_ring(df: DataFrame, name: str, gid: str = "gid") -> DataFrame:
    """The rows with the longitude / latitude ring of a cell, as ``cell_ring(translate=True)`` gives it, made in compiled steps."""
    points = [struct(x=f"_a{i}", y=f"_b{i}") for i in (0, 1, 2, 3, 0)]
    return _with_corners(df, gid).selectExpr(*[f"`{c}`" for c in df.columns], f"array({', '.join(points)}) AS {name}")


def with_square_wkt(df: DataFrame, name: str, gid: str = "gid", decimals: int | None = None) -> DataFrame:
    """The rows with the longitude / latitude WKT of a cell, as ``square_wkt(translate=True)`` gives it.

    It is made in steps, sides, corners and text, each small enough to be compiled to machine code: the JVM interprets a
    generated method of more than 8,000 bytes, as the one expression becomes.
    """
    kept = [f"`{c}`" for c in df.columns]
    placed = _with_corners(df, gid)
    if decimals is not None:
        placed = placed.selectExpr(*kept, *[f"{rounded(f'_{axis}{i}', decimals)} AS _{axis}{i}" for i in range(4) for axis in "ab"])
    vertices = ", ',', ".join(f"string(_a{i}), ' ', string(_b{i})" for i in (0, 1, 2, 3, 0))
    return placed.selectExpr(*kept, f"concat('POLYGON((', {vertices}, '))') AS {name}")


@grid_function("wkt STRING", PARTS)
def wkt_to_parts(wkt) -> str:
    """All parts of a POLYGON or MULTIPOLYGON text, each its outer ring and holes; z and m values are left out.

    NULL for NULL, no part for an EMPTY shape; any other kind of geometry fails the job.
    """
    # white space is made plain once, as a pattern would be compiled again for every vertex, and only where it is not plain
    odd = " OR ".join(f"contains(s_, '{x}')" for x in (" (", "( ", " )", ") ", " ,", ", ", "  ", *_BLANKS))
    plain = bind(f"trim({wkt})", "s_", rf"IF({odd}, regexp_replace(regexp_replace(s_, r'\s*([(),])\s*', '$1'), r'\s+', ' '), s_)")
    inner = "IF(endswith(t_, ')'), trim(TRAILING ')' FROM trim(LEADING '(' FROM substring(t_, instr(t_, '(')))), '')"
    # text is split at single characters, not by patterns; they stand in no shape
    marked = f"replace(replace({inner}, ')),((', ';'), '),(', '!')"
    vertex = bind("split(v_, ' ')", "w_", struct(x="double(w_[0])", y="double(w_[1])"))
    vertices = f"transform(split(y_, ','), v_ -> {vertex})"
    parts = f"transform(split({marked}, ';'), m_ -> transform(split(m_, '!'), y_ -> {vertices}))"
    kind = r"t_ RLIKE r'(?i)^(MULTI)?POLYGON\s*(Z|M|ZM)?\s*(\(|EMPTY$)' AND NOT contains(t_, ';') AND NOT contains(t_, '!')"
    empty = r"NOT endswith(t_, ')') AND t_ RLIKE r'(?i)EMPTY$'"
    body = (
        f"CASE WHEN t_ IS NULL THEN NULL WHEN NOT ({kind}) THEN raise_error(concat('not a polygon: ', left(t_, 80)))"
        f" WHEN {empty} THEN cast(array() AS {PARTS}) ELSE {parts} END"
    )
    return bind(plain, "t_", body)


def single_ring(parts: str) -> str:
    """The ring of a shape that is one ring; NULL for none, an error rather than a loss for more."""
    one = "CASE WHEN u_ IS NULL OR size(u_) = 0 THEN NULL WHEN size(u_) = 1 AND size(u_[0]) = 1 THEN u_[0][0]"
    return bind(parts, "u_", f"{one} ELSE raise_error('a shape with several rings; use its parts') END")


@grid_function("wkt STRING", RING)
def wkt_to_ring(wkt) -> str:
    """Ring of a POLYGON or MULTIPOLYGON text that is one ring; one with holes or several parts fails the job."""
    return single_ring(wkt_to_parts.sql(wkt))


# ---------------------------------------------------------------- ring measures

@grid_function(f"ring {RING}", RING)
def ring_to_xy(ring) -> str:
    """Project a longitude / latitude ring."""
    return f"transform({ring}, l_ -> {forward_point('l_.y', 'l_.x')})"


def _sides(ring: str) -> str:
    """array<struct<a, b>> of consecutive vertices."""
    pair = struct(a="a_", b="b_")
    return f"zip_with(slice({ring}, 1, size({ring}) - 1), slice({ring}, 2, size({ring}) - 1), (a_, b_) -> {pair})"


def _near(ring: str) -> str:
    """The ring relative to its first vertex: small products lose no digits far from the origin."""
    return f"transform({ring}, p_ -> {struct(x=f'p_.x - {ring}[0].x', y=f'p_.y - {ring}[0].y')})"


_CROSS = "(s_.a.x * s_.b.y - s_.b.x * s_.a.y)"


def _axes(ring: str, var: str, body: str) -> str:
    """``body`` with the coordinates of a ring, two arrays of numbers, as ``var``: no struct is made for a vertex or a side."""
    return bind(struct(x=f"{ring}.x", y=f"{ring}.y"), var, body)


def _ends(size: str) -> str:
    """Places, from 1, of the ends of all sides of a ring of the size; none for a single vertex."""
    return f"IF({size} > 1, sequence(1, {size} - 1), cast(array() AS ARRAY<INT>))"


@grid_function(f"ring {RING}", "DOUBLE")
def ring_area(ring) -> str:
    """Planar area (shoelace); a ring with fewer than three vertices has area 0."""
    # relative to the first vertex: small products lose no digits far from the origin
    ax, ay, bx, by = (f"(get(n_.{c}, {i}) - n_.{c}[0])" for i in ("i_ - 1", "i_") for c in "xy")
    doubled = _axes("r_", "n_", f"aggregate({_ends('size(r_)')}, 0D, (d_, i_) -> d_ + ({ax} * {by} - {bx} * {ay}))")
    area = f"IF(size(r_) > 2, abs({doubled}) / 2D, IF(r_ IS NOT NULL, 0D, NULL))"
    return bind(ring, "r_", area)


@grid_function(f"ring {RING}", POINT)
def ring_centroid(ring) -> str:
    """struct<x, y>: area-weighted centroid."""
    start = struct(d="0D", x="0D", y="0D")
    step = struct(
        d=f"c_.d + {_CROSS}", x=f"c_.x + (s_.a.x + s_.b.x) * {_CROSS}", y=f"c_.y + (s_.a.y + s_.b.y) * {_CROSS}"
    )
    done = struct(x="r_[0].x + t_.x / (3D * t_.d)", y="r_[0].y + t_.y / (3D * t_.d)")
    fold = f"aggregate({_sides('n_')}, {start}, (c_, s_) -> {step}, t_ -> {done})"
    return bind(ring, "r_", bind(_near("r_"), "n_", fold))


def _side_tests(a: dict[str, str], b: dict[str, str], v: dict[str, str]) -> tuple[str, str]:
    """Whether the ray from the point ``v`` crosses the side from ``a`` to ``b``, and whether the point lies on the side."""
    # the ranges come first: they rule out most sides
    touches = (
        f"({v['y']} BETWEEN least({a['y']}, {b['y']}) AND greatest({a['y']}, {b['y']})"
        f" AND {v['x']} BETWEEN least({a['x']}, {b['x']}) AND greatest({a['x']}, {b['x']})"
        f" AND ({b['x']} - {a['x']}) * ({v['y']} - {a['y']}) - ({b['y']} - {a['y']}) * ({v['x']} - {a['x']}) = 0D)"
    )
    # a side that straddles the ray is not level, so the guarded divisor is never 0
    rise = f"IF({b['y']} = {a['y']}, 1D, {b['y']} - {a['y']})"
    crosses = (
        f"((({a['y']} > {v['y']}) <> ({b['y']} > {v['y']}))"
        f" AND {v['x']} < {a['x']} + ({v['y']} - {a['y']}) * ({b['x']} - {a['x']}) / {rise})"
    )
    return crosses, touches


def _inside(rings: str, x: str, y: str) -> str:
    """Even-odd crossing of the sides of all rings, with points on a side left out; NULL where a ring is."""
    a, b = ({c: f"get(n_.{c}, {i})" for c in "xy"} for i in ("i_ - 1", "i_"))
    crosses, touches = _side_tests(a, b, {"x": "v_.x", "y": "v_.y"})
    ends = _ends("size(n_.x)")
    odd = f"aggregate(v_.rings, false, (o_, r_) -> {_axes('r_', 'n_', f'aggregate({ends}, o_, (u_, i_) -> u_ <> {crosses})')})"
    touched = f"exists(v_.rings, r_ -> {_axes('r_', 'n_', f'exists({ends}, i_ -> {touches})')})"
    test = f"IF(v_.rings IS NULL OR exists(v_.rings, r_ -> r_ IS NULL), NULL, {odd} AND NOT {touched})"
    return bind(struct(rings=rings, x=f"double({x})", y=f"double({y})"), "v_", test)


@grid_function(f"ring {RING}, x DOUBLE, y DOUBLE", "BOOLEAN")
def ring_contains(ring, x, y) -> str:
    """True when the point lies strictly inside the ring (its border excluded), by even-odd crossing."""
    return _inside(f"array({ring})", x, y)


@grid_function(f"parts {PARTS}, x DOUBLE, y DOUBLE", "BOOLEAN")
def parts_contain(parts, x, y) -> str:
    """True when the point lies strictly inside a shape, outside its holes and on no border."""
    return _inside(f"flatten({parts})", x, y)


def _signed(measure: str) -> str:
    """Per part, ``measure`` of its rings (named ``e_``), those of holes negative."""
    return f"transform(g_, (e_, j_) -> IF(j_ = 0, 1D, -1D) * {measure})"


@grid_function(f"parts {PARTS}", "DOUBLE")
def parts_area(parts) -> str:
    """Planar area of a shape: outer rings less holes."""
    areas = f"flatten(transform({parts}, g_ -> {_signed(ring_area.sql('e_'))}))"
    return f"aggregate({areas}, 0D, (z_, k_) -> z_ + k_)"


@grid_function(f"parts {PARTS}", POINT)
def parts_centroid(parts) -> str:
    """struct<x, y>: area-weighted centroid of a shape, holes taken out; NULL for one without area."""
    weight = "IF(j_ = 0, 1D, -1D) * " + ring_area.sql("e_")
    ring = bind(struct(a=weight, c=ring_centroid.sql("e_")), "f_", struct(a="f_.a", x="f_.a * f_.c.x", y="f_.a * f_.c.y"))
    rings = f"flatten(transform({parts}, g_ -> transform(g_, (e_, j_) -> {ring})))"
    start, step = struct(a="0D", x="0D", y="0D"), struct(a="z_.a + k_.a", x="z_.x + k_.x", y="z_.y + k_.y")
    done = f"IF(z_.a = 0D, NULL, {struct(x='z_.x / z_.a', y='z_.y / z_.a')})"
    return f"aggregate({rings}, {start}, (z_, k_) -> {step}, z_ -> {done})"


@grid_function("gid BIGINT, x DOUBLE, y DOUBLE", "BOOLEAN")
def square_contains(gid, x, y) -> str:
    """True when the point lies strictly inside the projected cell square."""
    half = per_level(_HALF, gid_level.sql(gid))
    return f"(abs({x} - {center_x.sql(gid)}) < {half} AND abs({y} - {center_y.sql(gid)}) < {half})"


# ---------------------------------------------------------------- simplification

@grid_function(f"ring {RING}, tolerance DOUBLE", RING)
def ring_simplify(ring, tolerance) -> str:
    """The closed ring without vertices that lie within ``tolerance`` of the line between their neighbours.

    Vertices go one by one: each is kept or not by its distance from the line between the last one kept and the next, so
    0 takes out what is exactly in line or repeated. The vertex where the ring closes counts like the others. A ring that
    would be left with fewer than three corners stays as it is.
    """
    def near(a, b, c):
        """Whether the vertex at place ``b`` is near the line from that at ``a`` to that at ``c``; each difference is taken once."""
        sides = struct(**{n + axis: f"get(n_.{axis}, {p}) - get(n_.{axis}, {q})" for n, p, q in (("u", c, a), ("v", b, a), ("w", b, c)) for axis in "xy"})
        length, dot, cross = "d_.ux * d_.ux + d_.uy * d_.uy", "d_.vx * d_.ux + d_.vy * d_.uy", "d_.ux * d_.vy - d_.uy * d_.vx"
        # Beyond the ends of the line, as at the tip of a spike, the nearer end counts.
        end = "least(d_.vx * d_.vx + d_.vy * d_.vy, d_.wx * d_.wx + d_.wy * d_.wy) <= n_.t * n_.t"
        test = f"IF(m_.l > 0D AND m_.d >= 0D AND m_.d <= m_.l, m_.c * m_.c <= n_.t * n_.t * m_.l, {end})"
        return bind(sides, "d_", bind(struct(l=length, d=dot, c=cross), "m_", test))

    # Places of the vertices kept, the first one in any case; each other is judged between the last one kept and the next.
    drop = near("element_at(k_, -1)", "i_", "(i_ + 1) % (size(r_) - 1)")
    kept = f"aggregate(sequence(1, size(r_) - 2), array(0), (k_, i_) -> IF({drop}, k_, array_append(k_, i_)))"
    # The first vertex kept is judged last, between its neighbours in what is left.
    first = f"IF({near('element_at(f_, -1)', 'f_[0]', 'f_[1]')}, 1, 0)"
    left = "IF(size(f_) - s_ > 2, transform(sequence(0, size(f_) - s_), j_ -> get(r_, get(f_, s_ + j_ % (size(f_) - s_)))), r_)"
    body = bind(kept, "f_", f"IF(size(f_) > 2, {bind(first, 's_', left)}, r_)")
    axes = struct(x="r_.x", y="r_.y", t=f"double({tolerance})")
    return bind(ring, "r_", f"IF(size(r_) > 4, {bind(axes, 'n_', body)}, r_)")


# ---------------------------------------------------------------- clipping

@grid_function(f"ring {RING}, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE", RING)
def clip_to_box(ring, xmin, ymin, xmax, ymax) -> str:
    """Intersection of a ring with an axis-parallel box, folded over its four half-planes.

    The ring must be convex or meet the box in one piece, as cells do.
    """
    out = "r_"
    for axis, bound, side in (("x", "a", ">="), ("x", "c", "<="), ("y", "b", ">="), ("y", "d", "<=")):
        out = bind(out, "q_", f"IF(size(q_) > 1, {_cut(axis, f'w_.{bound}', side)}, {_EMPTY})")
    # most rings lie within the box or beyond one side of it: those within start where the four cuts would have them start
    within = "forall(r_, i_ -> i_.x >= w_.a AND i_.x <= w_.c AND i_.y >= w_.b AND i_.y <= w_.d)"
    beyond = " OR ".join(f"NOT exists(r_, i_ -> i_.{axis} {side} w_.{bound})" for axis, bound, side in (("x", "a", ">="), ("x", "c", "<="), ("y", "b", ">="), ("y", "d", "<=")))
    turned = "transform(sequence(0, size(r_) - 1), i_ -> get(r_, 1 + (i_ + 3) % (size(r_) - 1)))"
    whole = f"IF(size(r_) = 5 AND r_[0] = r_[4], r_, {turned})"
    box = struct(a=f"double({xmin})", b=f"double({ymin})", c=f"double({xmax})", d=f"double({ymax})")
    body = f"IF(size(r_) > 1, IF({within}, {whole}, IF({beyond}, {_EMPTY}, {out})), {_EMPTY})"
    return bind(box, "w_", bind(f"cast({ring} AS {RING})", "r_", body))


def _cut(axis: str, bound: str, side: str) -> str:
    """The ring ``q_`` on one side of a border; one wholly there is kept, from its second vertex on as a cut one is."""
    def inner(p):
        return f"{p}.{axis} {side} {bound}"

    # sides are met by place and arrays made once: slices and joined arrays are copied value by value
    depth = [f"({p}.{axis} - {bound})" if side == ">=" else f"({bound} - {p}.{axis})" for p in ("k_.a", "k_.b")]
    share = f"{depth[0]} / ({depth[0]} - {depth[1]})"
    meet = struct(x=f"k_.a.x + {share} * (k_.b.x - k_.a.x)", y=f"k_.a.y + {share} * (k_.b.y - k_.a.y)")
    start, end = "get(q_, i_ - 1)", "get(q_, i_)"
    met = bind(struct(a=start, b=end), "k_", f"IF({inner('k_.b')}, array({meet}, k_.b), array({meet}))")
    emit = f"IF(({inner(start)}) <> ({inner(end)}), {met}, IF({inner(end)}, array({end}), {_EMPTY}))"
    cut = f"flatten(transform(sequence(1, size(q_) - 1), i_ -> {emit}))"
    closed = bind(cut, "o_", f"IF(size(o_) > 0, transform(sequence(0, size(o_)), i_ -> get(o_, i_ % size(o_))), {_EMPTY})")
    whole = "transform(sequence(1, size(q_)), i_ -> get(q_, IF(i_ = size(q_), 1, i_)))"
    return f"IF(forall(q_, i_ -> {inner('i_')}), {whole}, IF(NOT exists(q_, i_ -> {inner('i_')}), {_EMPTY}, {closed}))"


@grid_function(f"parts {PARTS}, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE", PARTS)
def clip_parts(parts, xmin, ymin, xmax, ymax) -> str:
    """Intersection of a shape with an axis-parallel box, ring by ring; rings outside become empty."""
    return f"transform({parts}, g_ -> transform(g_, e_ -> {clip_to_box.sql('e_', xmin, ymin, xmax, ymax)}))"

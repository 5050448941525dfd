"""DuckDB statements that state what each catalogued query must return.

They are written from the definitions (text concatenation, CASE, grouping by name
columns, theta joins), not from the Spark plans, so that they check them.
"""

from __future__ import annotations

from gridloom.functions.albers import LAT_0, LON_0, PARALLEL_1, PARALLEL_2
from gridloom.functions.levels import PREFIXES, QUADRANTS, SIDES

_IDS = ", ".join(str(q) for q in QUADRANTS)
_LEVEL_ROWS = ", ".join(f"({lv}, {s}, '{p}')" for lv, (s, p) in enumerate(zip(SIDES, PREFIXES)))
_NAME_COLUMN = {lv: f"nome_{PREFIXES[lv].lower()}" for lv in range(5, -1, -1)}
# The forms of a cell name and of a GeoURI.
_RE_NAME = r"([0-9]+(?:M|KM))E([0-9]+)N([0-9]+)"
_RE_URI = r"^geo:([+\-]?\d+\.?\d*),([+\-]?\d+\.?\d*)(?:;.+)?$"

# a populated 100 km cell and a quadrant, used where a query takes one cell
ONE_CELL = 5700000093500001
ONE_QUADRANT = 45


# ------------------------------------------------------------------ building blocks

BLOCKS = f"""
fx_k AS (SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(floor(o_totalprice) AS BIGINT) AS tp FROM orders),
fx_q AS (SELECT k, tp, CAST(([{_IDS}])[(k % 56) + 1] AS BIGINT) AS q, k // 56 AS r FROM fx_k),
fx_b AS (SELECT k, tp, q, r // 100 AS b, r % 100 AS w FROM fx_q),
fx_blocks AS (SELECT k, tp,
  2800000 + (q % 10) * 500000 + ((b * 3 + q) % 50) * 10000 + (w % 10) * 1000 AS x0,
  7350000 + (q // 10) * 500000 + ((b // 50) % 50) * 10000 + (w // 10) * 1000 AS y0 FROM fx_b)"""

CELLS = BLOCKS + """,
fx_raw AS (
  SELECT x0 AS x, y0 AS y, 5 AS lvl, tp % 900 AS pop, ((tp % 900) * (k % 101)) // 100 AS fem, (tp % 900) // 3 AS dom_ocu
  FROM fx_blocks WHERE k % 3 <> 0
  UNION ALL
  SELECT x0 + (h % 5) * 200, y0 + (h // 5) * 200 + 200, 6, (k * 7 + h * 13) % 120,
         (((k * 7 + h * 13) % 120) * (k % 101)) // 100, ((k * 7 + h * 13) % 120) // 3
  FROM (SELECT k, x0, y0, unnest(range(25)) AS h FROM fx_blocks WHERE k % 3 = 0) u WHERE (k + h) % 4 <> 0),
fx_cells AS (
  SELECT CAST(x AS VARCHAR) || lpad(CAST(y AS VARCHAR), 8, '0') || CAST(lvl AS VARCHAR) AS gid_text,
         CAST(CAST(x AS VARCHAR) || lpad(CAST(y AS VARCHAR), 8, '0') || CAST(lvl AS VARCHAR) AS BIGINT) AS gid,
         x, y, lvl, pop, fem, dom_ocu,
         CASE WHEN lvl = 6 THEN 200 ELSE 1000 END AS side,
         CASE WHEN lvl = 6 THEN x + 100 ELSE x + 500 END AS cx,
         CASE WHEN lvl = 6 THEN y - 100 ELSE y + 500 END AS cy
  FROM fx_raw)"""


def ref(x: str, y: str, level: int) -> tuple[str, str]:
    """Reference corner of the cell of a level that holds a point."""
    s = SIDES[level]
    top = s if level == 6 else 0
    return (
        f"(2800000 + (({x} - 2800000) // {s}) * {s})",
        f"(7350000 + (({y} - 7350000) // {s}) * {s} + {top})",
    )


def name(x: str, y: str, level: int) -> str:
    rx, ry = ref(x, y, level)
    u = 100 if level == 6 else 1000
    return f"('{PREFIXES[level]}E' || CAST({rx} // {u} AS VARCHAR) || 'N' || CAST({ry} // {u} AS VARCHAR))"


def gid(x: str, y: str, level: int) -> str:
    rx, ry = ref(x, y, level)
    return f"CAST(CAST({rx} AS VARCHAR) || lpad(CAST({ry} AS VARCHAR), 8, '0') || '{level}' AS BIGINT)"


def gid_any(x: str, y: str, level: str) -> str:
    return "CASE " + " ".join(f"WHEN {level} = {lv} THEN {gid(x, y, lv)}" for lv in range(7)) + " END"


def name_any(x: str, y: str, level: str) -> str:
    return "CASE " + " ".join(f"WHEN {level} = {lv} THEN {name(x, y, lv)}" for lv in range(7)) + " END"


def name_gid(column: str) -> str:
    """Key of a name, by text."""
    e, n = (f"regexp_extract({column}, '{_RE_NAME}', {i})" for i in (2, 3))
    level = f"list_position([{', '.join(repr(p) for p in PREFIXES)}], regexp_extract({column}, '{_RE_NAME}', 1)) - 1"
    return (
        f"CAST(rpad({e}, 7, '0') || CASE WHEN {n} LIKE '1%' THEN rpad({n}, 8, '0') ELSE '0' || rpad({n}, 7, '0') END"
        f" || CAST({level} AS VARCHAR) AS BIGINT)"
    )


def q_text(q: str) -> str:
    return f"('ID_' || lpad(CAST({q} AS VARCHAR), 2, '0'))"


def quadrant(x: str, y: str) -> str:
    return f"(10 * (({y} - 7350000) // 500000) + ({x} - 2800000) // 500000)"


ORIGINAL = CELLS + f""",
fx_original AS (
  SELECT gid, cx, cy, side, CASE WHEN lvl = 6 THEN {name('cx', 'cy', 6)} ELSE {name('cx', 'cy', 5)} END AS id_unico,
         {', '.join(f"{name('cx', 'cy', lv)} AS {c}" for lv, c in _NAME_COLUMN.items())},
         {q_text(quadrant('cx', 'cy'))} AS quadrante, pop - fem AS masc, fem, pop, dom_ocu
  FROM fx_cells)"""

_PERC = "CAST(CASE WHEN pop > 0 THEN round_even(CAST(100 AS DOUBLE) * fem / pop, 0) ELSE 0 END AS BIGINT)"


def _group(level: int) -> str:
    where = "WHERE nome_1km <> id_unico" if level == 5 else ""
    c = _NAME_COLUMN[level]
    return f"""SELECT {name_gid('nome')} AS gid, pop, {_PERC} AS pop_fem_perc, dom_ocu, true AS is_cache
  FROM (SELECT {c} AS nome, CAST(sum(pop) AS BIGINT) AS pop, CAST(sum(fem) AS BIGINT) AS fem,
               CAST(sum(dom_ocu) AS BIGINT) AS dom_ocu FROM fx_original {where} GROUP BY 1) g{level}"""


_NATIVE = f"SELECT {name_gid('id_unico')} AS gid, pop, {_PERC} AS pop_fem_perc, dom_ocu, false AS is_cache FROM fx_original"
COMPACT = ORIGINAL + ",\nfx_compact AS (" + "\n  UNION ALL ".join([_NATIVE, *[_group(lv) for lv in range(5, -1, -1)]]) + """),
fx_levels AS (SELECT *, CAST(gid % 10 AS BIGINT) AS level FROM fx_compact)"""

# centre of a compact cell, from the digits of its key
_SIDE_OF = "CASE level " + " ".join(f"WHEN {lv} THEN {s}" for lv, s in enumerate(SIDES)) + " END"
PLACED = COMPACT + f""",
fx_placed AS (SELECT *, rx + s // 2 AS cx, CASE WHEN level = 6 THEN ry - s // 2 ELSE ry + s // 2 END AS cy FROM (
  SELECT *, CAST(substr(CAST(gid AS VARCHAR), 1, 7) AS BIGINT) AS rx, CAST(substr(CAST(gid AS VARCHAR), 8, 8) AS BIGINT) AS ry,
         {_SIDE_OF} AS s FROM fx_levels) z)"""

XY = """
fx_xy AS (SELECT e.event_id, b.x0 + (e.event_id * 37) % 1000 AS x, b.y0 + (e.event_id * 53) % 1000 AS y
  FROM events e JOIN fx_blocks b ON e.event_id = b.k)"""

_DEG = [
    f"CAST(CAST({a} + ((event_id * {m}) % 380000) / 10000.0 AS decimal(9,4)) AS VARCHAR)" for a, m in ((-33, 7919), (-73, 104729))
]
_PLAIN_URI = f"'geo:' || {_DEG[0]} || ',' || {_DEG[1]}"
URI = f"fx_uri AS (SELECT event_id, {_PLAIN_URI} AS geo_uri FROM events)"
URI_U = f"""fx_uri AS (SELECT event_id, CASE
    WHEN event_id % 97 = 0 THEN 'geo:' || CAST(event_id AS VARCHAR)
    WHEN event_id % 7 = 0 THEN {_PLAIN_URI}
    WHEN event_id % 7 = 1 THEN {_PLAIN_URI} || ';crs=wgs84'
    ELSE {_PLAIN_URI} || ';u=' || CAST((event_id * 37) % 300000 AS VARCHAR) END AS geo_uri FROM events)"""

# ------------------------------------------------------------------ projection, stated in steps

_A, _F = 6378137.0, 1 / 298.257223563
_E2 = _F * (2 - _F)


def _qsql(s: str) -> str:
    e = f"sqrt({_E2!r}::DOUBLE)"
    return (
        f"((1 - {_E2!r}::DOUBLE) * ({s} / (1 - {_E2!r}::DOUBLE * {s} * {s})"
        f" - ln((1 - {e} * {s}) / (1 + {e} * {s})) / (2 * {e})))"
    )


def _m2sql(lat: float) -> str:
    s, c = f"sin(radians({lat!r}::DOUBLE))", f"cos(radians({lat!r}::DOUBLE))"
    return f"({c} * {c} / (1 - {_E2!r}::DOUBLE * {s} * {s}))"


def _q_at(lat: float) -> str:
    return _qsql(f"sin(radians({lat!r}::DOUBLE))")


ALBERS = f"""
al_1 AS (SELECT {_m2sql(PARALLEL_1)} AS m1, {_m2sql(PARALLEL_2)} AS m2, {_q_at(PARALLEL_1)} AS q1, {_q_at(PARALLEL_2)} AS q2,
                {_q_at(LAT_0)} AS q0),
al_2 AS (SELECT *, (m1 - m2) / (q2 - q1) AS n FROM al_1),
al_3 AS (SELECT *, m1 + n * q1 AS c FROM al_2),
al AS (SELECT n, c, {_A!r}::DOUBLE * sqrt(c - n * q0) / n AS rho0 FROM al_3)"""


def forward(source: str, out: str, extra: str = "") -> str:
    """CTEs from ``source(lat, lon, ...)`` to ``out`` with rounded ``x``, ``y``."""
    return f"""{out}_s AS (SELECT s0.*, sin(radians(lat)) AS sn FROM {source} s0),
{out}_r AS (SELECT s1.*, {_A!r}::DOUBLE * sqrt(al.c - al.n * {_qsql('sn')}) / al.n AS rho,
                   al.n * radians(lon - ({LON_0!r}::DOUBLE)) AS th, al.rho0 FROM {out}_s s1, al),
{out} AS (SELECT * EXCLUDE (sn, rho, th, rho0), CAST(round_even(5000000 + rho * sin(th), 0) AS BIGINT) AS x,
                 CAST(round_even(10000000 + rho0 - rho * cos(th), 0) AS BIGINT) AS y FROM {out}_r)"""


def inverse(source: str, out: str, x: str = "px", y: str = "py") -> str:
    """CTEs from ``source(px, py, ...)`` to ``out`` with ``lat``, ``lon``; the latitude by fixed-point steps."""
    ctes = [
        f"{out}_0 AS (SELECT s0.*, al.n AS al_n, ({x} - 5000000)::DOUBLE AS dx, (al.rho0 - ({y} - 10000000))::DOUBLE AS dy,"
        f" al.c AS al_c FROM {source} s0, al)",
        f"{out}_1 AS (SELECT *, (al_c - (dx * dx + dy * dy) * al_n * al_n / ({_A!r}::DOUBLE * {_A!r}::DOUBLE)) / al_n AS qv FROM {out}_0)",
        f"{out}_2 AS (SELECT *, asin(qv / 2) AS ph FROM {out}_1)",
    ]
    last = f"{out}_2"
    e = f"sqrt({_E2!r}::DOUBLE)"
    for i in range(3, 9):
        d = f"(1 - {_E2!r}::DOUBLE * sin(ph) * sin(ph))"
        ctes.append(
            f"{out}_{i} AS (SELECT * EXCLUDE (ph), ph + {d} * {d} / (2 * cos(ph)) * (qv / (1 - {_E2!r}::DOUBLE) - sin(ph) / {d}"
            f" + ln((1 - {e} * sin(ph)) / (1 + {e} * sin(ph))) / (2 * {e})) AS ph FROM {last})"
        )
        last = f"{out}_{i}"
    ctes.append(
        f"{out} AS (SELECT * EXCLUDE (al_n, al_c, dx, dy, qv, ph), degrees(ph) AS lat,"
        f" ({LON_0!r}::DOUBLE) + degrees(atan2(CASE WHEN al_n < 0 THEN -dx ELSE dx END, CASE WHEN al_n < 0 THEN -dy ELSE dy END) / al_n) AS lon"
        f" FROM {last})"
    )
    return ",\n".join(ctes)


URI_XY = ALBERS + f""",
fx_ll AS (SELECT event_id, geo_uri,
  TRY_CAST(nullif(regexp_extract(geo_uri, '{_RE_URI}', 1), '') AS DOUBLE) AS lat,
  TRY_CAST(nullif(regexp_extract(geo_uri, '{_RE_URI}', 2), '') AS DOUBLE) AS lon FROM fx_uri),
""" + forward("fx_ll", "fx_p")


def geohash(lat: str, lon: str, digits: int = 9) -> str:
    """Geohash, bit by bit."""
    lon_bits, lat_bits = (5 * digits + 1) // 2, 5 * digits // 2
    lo = f"CAST(floor(({lon} + 180) / 360 * {1 << lon_bits}) AS BIGINT)"
    la = f"CAST(floor(({lat} + 90) / 180 * {1 << lat_bits}) AS BIGINT)"
    out = []
    for d in range(digits):
        bits = []
        for b in range(5):
            k = 5 * d + b
            src, width = (lo, lon_bits) if k % 2 == 0 else (la, lat_bits)
            bits.append(f"(({src} >> {width - 1 - k // 2}) & 1) * {16 >> b}")
        out.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({' + '.join(bits)} AS INTEGER) + 1, 1)")
    return "(" + " || ".join(out) + ")"


def square_wkt(cx: str, cy: str, half: str) -> str:
    def at(dx, dy):
        return f"CAST({cx} {dx} {half} AS VARCHAR) || ' ' || CAST({cy} {dy} {half} AS VARCHAR)"

    corners = [at("-", "-"), at("-", "+"), at("+", "+"), at("+", "-"), at("-", "-")]
    return "('POLYGON((' || " + " || ',' || ".join(corners) + " || '))')"


_REBUILT = f"""
fx_fem AS (SELECT *, CAST(round_even(pop * pop_fem_perc / CAST(100 AS DOUBLE), 0) AS BIGINT) AS fem2 FROM fx_placed WHERE NOT is_cache),
fx_rebuilt AS (SELECT gid, cx, cy, {name_any('cx', 'cy', 'level')} AS id_unico,
  {', '.join(f"{name('cx', 'cy', lv)} AS {c}" for lv, c in _NAME_COLUMN.items())},
  {q_text(quadrant('cx', 'cy'))} AS quadrante, pop - fem2 AS masc, fem2 AS fem, pop, dom_ocu,
  {square_wkt('cx', 'cy', '(s // 2)')} AS geom FROM fx_fem)"""
_REBUILT_COLUMNS = (
    "gid, id_unico, " + ", ".join(_NAME_COLUMN.values()) + ", quadrante, masc, fem, pop, dom_ocu, geom"
)
# the original table with the faults of inputs.faulty_original, and the names as they should be
_FAULTY = ORIGINAL + f""",
fx_faulty AS (SELECT * REPLACE (CASE WHEN pop % 7 = 0 THEN nome_10km ELSE nome_5km END AS nome_5km,
    CASE WHEN pop % 7 = 0 THEN nome_5km ELSE nome_10km END AS nome_10km, CASE WHEN pop % 11 = 0 THEN 'none' ELSE nome_100km END AS nome_100km),
  {', '.join(f"{name('cx', 'cy', lv)} AS t{lv}" for lv in range(7))} FROM fx_original)"""
_FLAGS = ", ".join(f"{c} = t{lv} AS is_{c.replace('nome_', 'name')}" for lv, c in _NAME_COLUMN.items())
_LX, _LY = (int(str(ONE_CELL)[:7]), int(str(ONE_CELL)[7:15]))
_IN_ONE = f"level > 1 AND cx >= {_LX} AND cx < {_LX} + 100000 AND cy >= {_LY} AND cy < {_LY} + 100000"
_CORNERS = "(VALUES (0, -1, -1), (1, -1, 1), (2, 1, 1), (3, 1, -1), (4, -1, -1)) v(ord, dx, dy)"

_BAD_NAME = "CASE WHEN pop % 10 = 0 THEN 'X' || lower(id_unico) ELSE id_unico END"
_XYL = BLOCKS + "," + XY + f""",
fx_l AS (SELECT event_id, x, y, t.lvl AS level, t.s FROM fx_xy, (VALUES {', '.join(f'({lv}, {s})' for lv, s in enumerate(SIDES))}) t(lvl, s))"""


def _w(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    # ---- levels and keys
    q["levels"] = f"""
SELECT e.event_id, e.level, CAST(t.s AS BIGINT) AS size, t.p AS prefix, CAST(t.lvl AS BIGINT) AS level_of_size, CAST(t.lvl AS BIGINT) AS level_of_prefix
FROM (SELECT event_id, event_id % 9 - 1 AS level FROM events) e LEFT JOIN (VALUES {_LEVEL_ROWS}) t(lvl, s, p) ON t.lvl = e.level"""
    q["uncertainty"] = """
SELECT event_id, u, CAST(size AS BIGINT) AS size,
  CAST(CASE size WHEN 200 THEN 6 WHEN 1000 THEN 5 WHEN 5000 THEN 4 WHEN 10000 THEN 3 WHEN 50000 THEN 2 WHEN 100000 THEN 1 ELSE 0 END AS BIGINT) AS level
FROM (SELECT event_id, u, CASE WHEN 2*u < 500 THEN 200 WHEN 2*u < 2500 THEN 1000 WHEN 2*u < 5000 THEN 5000 WHEN 2*u < 25000 THEN 10000
  WHEN 2*u < 50000 THEN 50000 WHEN 2*u < 250000 THEN 100000 ELSE 500000 END AS size
  FROM (SELECT event_id, (event_id * 37) % 300000 AS u FROM events) a) b"""
    parts = [f"nullif(regexp_extract(name, '{_RE_NAME}', {i}), '')" for i in (1, 2, 3)]
    named = ORIGINAL + f""",
fx_n AS (SELECT gid AS src, {_BAD_NAME} AS name FROM fx_original),
fx_np AS (SELECT src, name, {parts[0]} AS side, {parts[1]} AS e, {parts[2]} AS n FROM fx_n),
fx_nx AS (SELECT src, name, side, CAST(rpad(e, 7, '0') AS BIGINT) AS x,
  CAST(CASE WHEN n LIKE '1%' THEN rpad(n, 8, '0') ELSE rpad(n, 7, '0') END AS BIGINT) AS y,
  CASE side WHEN '200M' THEN 6 WHEN '1KM' THEN 5 END AS level FROM fx_np)"""
    q["name_parts"] = _w(named, "SELECT src, name, side, x, y, CAST(level AS BIGINT) AS level FROM fx_nx")
    q["name_center"] = _w(named, """SELECT src, name, x + CASE level WHEN 6 THEN 100 ELSE 500 END AS cx,
  y + CASE level WHEN 6 THEN -100 ELSE 500 END AS cy, CAST(level AS BIGINT) AS level FROM fx_nx""".replace(
        "ELSE 500 END AS cx", "WHEN 5 THEN 500 END AS cx").replace("ELSE 500 END AS cy", "WHEN 5 THEN 500 END AS cy"))
    q["name_to_gid"] = _w(ORIGINAL, f"""SELECT gid AS src, CASE WHEN pop % 10 = 0 THEN NULL ELSE gid END AS gid,
  {', '.join(f"{name_gid(c)} AS gid_l{lv}" for lv, c in _NAME_COLUMN.items())} FROM fx_original""")
    q["gid_encode"] = _w(CELLS, "SELECT x, y, CAST(lvl AS BIGINT) AS level, CAST(gid_text AS BIGINT) AS gid FROM fx_cells")
    q["gid_decode"] = _w(CELLS, """SELECT gid, CAST(substr(gid_text, 1, 7) AS BIGINT) AS x, CAST(substr(gid_text, 8, 8) AS BIGINT) AS y,
  CAST(substr(gid_text, 16, 1) AS BIGINT) AS level, CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy FROM fx_cells""")
    q["gid_to_name"] = _w(ORIGINAL, "SELECT gid, id_unico AS name FROM fx_original")
    q["center_to_ref"] = _w(CELLS, """SELECT CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy, CAST(lvl AS BIGINT) AS level, x AS x_ref, y AS y_ref,
  CAST(side // 2 AS BIGINT) AS half, gid FROM fx_cells""")
    q["name_roundtrip"] = _w(ORIGINAL, """SELECT 'sound' AS input, count(*) AS n_samples, CAST(sum(ok) AS BIGINT) AS n_ok, sum(ok) = 3 * count(*) AS all_ok
FROM (SELECT 3 AS ok FROM fx_original) s UNION ALL SELECT 'faulty', count(*), CAST(sum(ok) AS BIGINT), sum(ok) = 3 * count(*)
FROM (SELECT 3 - CASE WHEN pop % 11 = 0 THEN 1 ELSE 0 END AS ok FROM fx_original) f""")
    q["snap_ij"] = _w(_XYL, "SELECT event_id, CAST(level AS BIGINT) AS level, (x - 2800000) // s AS i, (y - 7350000) // s AS j, CAST(s AS BIGINT) AS size FROM fx_l")
    q["ij_to_ref"] = _w(_XYL, """SELECT event_id, CAST(level AS BIGINT) AS level, 2800000 + ((x - 2800000) // s) * s AS x,
  7350000 + ((y - 7350000) // s) * s + CASE WHEN s = 200 THEN 200 ELSE 0 END AS y, CAST(s AS BIGINT) AS size FROM fx_l""")
    q["snap_ref"] = _w(_XYL, """SELECT event_id, CAST(level AS BIGINT) AS level, 2800000 + ((x - 2800000) // s) * s AS x_ref,
  7350000 + ((y - 7350000) // s) * s + CASE WHEN s = 200 THEN 200 ELSE 0 END AS y_ref FROM fx_l""")
    q["snap_center"] = _w(_XYL, """SELECT event_id, CAST(level AS BIGINT) AS level, 2800000 + ((x - 2800000) // s) * s + s // 2 AS cx,
  7350000 + ((y - 7350000) // s) * s + s // 2 AS cy FROM fx_l""")
    q["point_to_cell"] = _w(_XYL, f"""SELECT event_id, CAST(level AS BIGINT) AS level, {gid_any('x', 'y', 'level')} AS gid,
  {gid_any('x', 'y', 'level')} AS gid_by_size, {name_any('x', 'y', 'level')} AS name FROM fx_l""")
    q["quadrant"] = _w(CELLS, f"""SELECT gid, {quadrant('cx', 'cy')} AS q, {q_text(quadrant('cx', 'cy'))} AS q_text,
  {gid('cx', 'cy', 0)} AS root_gid FROM fx_cells""")
    q["quadrant_valid"] = _w(URI + "," + URI_XY, f"""SELECT event_id, {quadrant('x', 'y')} AS q,
  CASE WHEN {quadrant('x', 'y')} IN ({_IDS}) THEN {quadrant('x', 'y')} END AS q_valid FROM fx_p""")
    q["quadrants"] = _w(CELLS, f"""SELECT CAST(t.q AS BIGINT) AS q, {q_text('t.q')} AS q_text,
  CAST(CAST(2800000 + (t.q % 10) * 500000 AS VARCHAR) || lpad(CAST(7350000 + (t.q // 10) * 500000 AS VARCHAR), 8, '0') || '0' AS BIGINT) AS gid,
  count(c.gid) AS n_cells
FROM (SELECT unnest([{_IDS}]) AS q) t LEFT JOIN (SELECT gid, {quadrant('cx', 'cy')} AS cq FROM fx_cells) c ON c.cq = t.q GROUP BY 1, 2, 3""")
    q["ancestors"] = _w(CELLS, "SELECT gid, " + ", ".join(
        f"{gid('cx', 'cy', lv)} AS gid_l{lv}" for lv in range(5)) + f", CASE WHEN lvl = 5 THEN gid ELSE {gid('cx', 'cy', 5)} END AS gid_l5, "
        f"CASE WHEN lvl = 6 THEN gid ELSE {gid('cx', 'cy', 6)} END AS gid_l6 FROM fx_cells")
    q["gid_contains"] = _w(CELLS, f"""SELECT gid, true AS in_l2, false AS in_self, {quadrant('cx', 'cy')} = {ONE_QUADRANT} AS in_quadrant FROM fx_cells""")
    q["containment_join"] = _w(CELLS, f"""SELECT a.big_gid, count(*) AS n, CAST(sum(c.pop) AS BIGINT) AS pop
FROM (SELECT DISTINCT {gid('cx', 'cy', 2)} AS big_gid, {ref('cx', 'cy', 2)[0]} AS ax, {ref('cx', 'cy', 2)[1]} AS ay FROM fx_cells) a
JOIN fx_cells c ON c.cx >= a.ax AND c.cx < a.ax + 50000 AND c.cy >= a.ay AND c.cy < a.ay + 50000 GROUP BY 1""")
    q["containment_pairs"] = _w(PLACED + """,
fx_area AS MATERIALIZED (SELECT level, rx, ry, s, gid AS big_gid FROM fx_placed WHERE level IN (3, 4)),
fx_native AS MATERIALIZED (SELECT gid, pop, cx, cy FROM fx_placed WHERE NOT is_cache)""", " UNION ALL ".join(
        f"SELECT big_gid, gid, CAST(pop AS BIGINT) AS pop FROM fx_native JOIN fx_area ON level = {lv} AND rx = {ref('cx', 'cy', lv)[0]} AND ry = {ref('cx', 'cy', lv)[1]}"
        for lv in (3, 4)))
    q["descendants"] = _w(PLACED, f"SELECT gid, CAST(pop AS BIGINT) AS pop FROM fx_placed WHERE {_IN_ONE}")

    # ---- projection, URIs
    q["latlon_to_cell"] = _w(URI + "," + URI_XY, f"SELECT event_id, x AS x_i, y AS y_i, {gid('x', 'y', 5)} AS gid, {gid('x', 'y', 6)} AS gid_l6 FROM fx_p")
    q["geouri_to_cell"] = _w(URI_U + "," + URI_XY + r""",
fx_u AS (SELECT *, CASE WHEN lat IS NULL THEN NULL ELSE TRY_CAST(nullif(regexp_extract(geo_uri, ';u=([0-9]+)', 1), '') AS BIGINT) END AS u FROM fx_p),
fx_ul AS (SELECT *, CASE WHEN u IS NULL THEN 5 WHEN 2*u < 500 THEN 6 WHEN 2*u < 2500 THEN 5 WHEN 2*u < 5000 THEN 4 WHEN 2*u < 25000 THEN 3
  WHEN 2*u < 50000 THEN 2 WHEN 2*u < 250000 THEN 1 ELSE 0 END AS level FROM fx_u)""",
        f"SELECT event_id, geo_uri, u, {gid_any('x', 'y', 'level')} AS gid, {gid('x', 'y', 5)} AS gid_default FROM fx_ul")
    q["geohash"] = _w(URI + "," + URI_XY, f"SELECT event_id, geo_uri, {geohash('lat', 'lon')} AS geohash FROM fx_p")
    q["cell_polygon"] = _w(CELLS, f"SELECT gid, {square_wkt('cx', 'cy', '(side // 2)')} AS wkt FROM fx_cells")
    q["cells_by_name"] = _w(CELLS, f"""SELECT gid, {square_wkt('cx', 'cy', '(side // 2)')} AS wkt, CAST(cx AS DOUBLE) AS x, CAST(cy AS DOUBLE) AS y FROM fx_cells""")
    q["geometry_parts"] = _w(CELLS, """SELECT gid, 2.0::DOUBLE * 200 * 200 - 40 * 40 AS area, false AS holds_middle, true AS holds_inner, true AS holds_second,
  (200.0::DOUBLE * 200 - 40 * 40) / 2 AS west_half FROM fx_cells""")
    ring = CELLS + f""",
fx_v AS (SELECT gid, CAST(v.ord AS BIGINT) AS ord, cx + v.dx * (side // 2) AS px, cy + v.dy * (side // 2) AS py FROM fx_cells, {_CORNERS})"""
    q["cell_center_point"] = _w(CELLS + "," + ALBERS + ", fx_c AS (SELECT gid, cx AS px, cy AS py FROM fx_cells)," + inverse("fx_c", "fx_ll"),
        "SELECT gid, CAST(px AS DOUBLE) AS x, CAST(py AS DOUBLE) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM fx_ll")
    q["cell_polygon_latlon"] = _w(ring + "," + ALBERS + "," + inverse("fx_v", "fx_ll"),
        "SELECT gid, ord, round(lon, 6) AS lon, round(lat, 6) AS lat FROM fx_ll")
    q["ring_points"] = _w(ring, "SELECT gid, ord, CAST(px AS DOUBLE) AS x, CAST(py AS DOUBLE) AS y FROM fx_v")
    q["ring_area"] = _w(CELLS, "SELECT gid, CAST(side * side AS DOUBLE) AS area FROM fx_cells")
    q["ring_centroid"] = _w(CELLS, "SELECT gid, CAST(cx AS DOUBLE) AS cx, CAST(cy AS DOUBLE) AS cy FROM fx_cells")
    q["dissolve"] = _w(CELLS + f""",
fx_unit AS (SELECT {gid('cx', 'cy', 4)} AS p, gid, side,
    (cx - side // 2) // 200 + i AS ux, (cy - side // 2) // 200 + j AS uy, (cx - side // 2) % 200 AS ox, (cy - side // 2) % 200 AS oy
  FROM fx_cells, range(5) a(i), range(5) b(j) WHERE i < side // 200 AND j < side // 200),
fx_edge AS (SELECT p, count(*) AS n FROM fx_unit u, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dx, dy)
  WHERE NOT EXISTS (SELECT 1 FROM fx_unit w WHERE w.p = u.p AND w.ux = u.ux + d.dx AND w.uy = u.uy + d.dy) GROUP BY p)""",
        f"""SELECT c.p AS gid_l4, c.n_cells, e.n AS n_edges, e.n * 200 AS perimeter_m, c.area AS area_m2
FROM (SELECT {gid('cx', 'cy', 4)} AS p, count(*) AS n_cells, CAST(sum(side * side) AS BIGINT) AS area FROM fx_cells GROUP BY 1) c
JOIN fx_edge e ON e.p = c.p""")

    # Sides of 200 m with the cell on their left, linked end to start; where two start, the left turn goes on. A walk
    # from each side ends at a smaller number or at itself, and then it is its ring's first side.
    q["dissolve_polygons"] = _w(CELLS + f""",
fx_unit AS (SELECT {gid('cx', 'cy', 4)} AS p, (cx - side // 2) // 200 + i AS ux, (cy - side // 2) // 200 + j AS uy
  FROM fx_cells, range(5) a(i), range(5) b(j) WHERE i < side // 200 AND j < side // 200),
fx_side AS (SELECT row_number() OVER () AS id, p, d, ux + sx AS x, uy + sy AS y, ux + sx + ex AS x2, uy + sy + ey AS y2
  FROM fx_unit u, (VALUES (0, 0, -1, 0, 0, 1, 0), (1, 1, 0, 1, 0, 0, 1), (2, 0, 1, 1, 1, -1, 0), (3, -1, 0, 0, 1, 0, -1)) v(d, dx, dy, sx, sy, ex, ey)
  WHERE NOT EXISTS (SELECT 1 FROM fx_unit w WHERE w.p = u.p AND w.ux = u.ux + dx AND w.uy = u.uy + dy)),
fx_next AS (SELECT a.id, a.p, arg_max(b.id, CAST(b.d = (a.d + 1) % 4 AS INTEGER)) AS nxt, max(CAST(a.d <> b.d AS INTEGER)) AS turn, any_value(a.x * a.y2 - a.x2 * a.y) AS twice
  FROM fx_side a JOIN fx_side b ON b.p = a.p AND b.x = a.x2 AND b.y = a.y2 GROUP BY a.id, a.p),
fx_walk(s, p, c, turns, twice) AS (SELECT id, p, nxt, turn, twice FROM fx_next
  UNION ALL SELECT s, w.p, n.nxt, w.turns + n.turn, w.twice + n.twice FROM fx_walk w JOIN fx_next n ON n.id = w.c WHERE w.c > s),
fx_ring AS (SELECT p, turns, twice * 20000 AS area FROM fx_walk WHERE c = s)""", """SELECT p AS gid_l4, count(*) FILTER (WHERE area > 0) AS n_shells, count(*) FILTER (WHERE area < 0) AS n_holes,
  CAST(sum(turns) AS BIGINT) AS n_vertices, CAST(sum(area) AS BIGINT) AS area_m2, CAST(sum(area) FILTER (WHERE area > 0) AS BIGINT) AS shell_m2
FROM fx_ring GROUP BY p""").replace("WITH", "WITH RECURSIVE", 1)

    # ---- compact grid
    compact = "gid, CAST(pop AS BIGINT) AS pop, pop_fem_perc, CAST(dom_ocu AS BIGINT) AS dom_ocu, is_cache"
    q["compact_encode"] = _w(COMPACT, f"SELECT {compact} FROM fx_compact WHERE NOT is_cache")
    q["pyramid"] = _w(COMPACT, f"SELECT {compact} FROM fx_compact")
    q["level_counts"] = _w(COMPACT, "SELECT level, count(*) AS n FROM fx_levels GROUP BY 1")
    q["level_totals"] = _w(COMPACT, "SELECT level, count(*) AS n, CAST(sum(pop) AS BIGINT) AS pop FROM fx_levels GROUP BY 1")
    q["extent"] = _w(PLACED, "SELECT level, min(cx) AS x_min, max(cx) AS x_max, min(cy) AS y_min, max(cy) AS y_max FROM fx_placed GROUP BY 1")
    q["axis_values"] = _w(PLACED, "SELECT DISTINCT 'x' AS axis, level, cx AS v FROM fx_placed UNION ALL SELECT DISTINCT 'y', level, cy FROM fx_placed")
    q["level_view"] = _w(PLACED, f"""SELECT level, gid, {name_any('cx', 'cy', 'level')} AS id_unico, CAST(pop AS BIGINT) AS pop, pop_fem_perc,
  CAST(dom_ocu AS BIGINT) AS dom_ocu, {square_wkt('cx', 'cy', '(s // 2)')} AS wkt FROM fx_placed WHERE level < 2""")
    q["rebuild_original"] = _w(PLACED + "," + _REBUILT, f"SELECT {_REBUILT_COLUMNS} FROM fx_rebuilt WHERE {_IN_ONE.replace('level > 1 AND ', '')}")
    q["rebuild_quadrant"] = _w(PLACED + "," + _REBUILT, f"SELECT {_REBUILT_COLUMNS} FROM fx_rebuilt WHERE quadrante = {q_text(ONE_QUADRANT)}")
    q["rebuild_vs_original"] = _w(_FAULTY, f"""SELECT {' AND '.join(f'{c} = t{lv}' for lv, c in _NAME_COLUMN.items())} AS ok_names,
  pop % 97 <> 0 AS ok_geometries, count(*) AS n FROM fx_faulty GROUP BY 1, 2""")

    # ---- joins of points
    point_uri = "'geo:' || CAST(CAST(round(lat, 6) AS DECIMAL(9,6)) AS VARCHAR) || ',' || CAST(CAST(round(lon, 6) AS DECIMAL(9,6)) AS VARCHAR)"
    resolve = (
        COMPACT + "," + XY + "," + ALBERS + ", fx_pt AS (SELECT event_id, x AS px, y AS py FROM fx_xy)," + inverse("fx_pt", "fx_pll") + f""",
fx_all AS (SELECT 'grid' AS src, event_id, {point_uri} AS geo_uri FROM fx_pll UNION ALL SELECT 'land', event_id, {_PLAIN_URI} FROM events),
fx_ll AS (SELECT src, event_id, geo_uri, CAST(regexp_extract(geo_uri, '{_RE_URI}', 1) AS DOUBLE) AS lat,
  CAST(regexp_extract(geo_uri, '{_RE_URI}', 2) AS DOUBLE) AS lon FROM fx_all),
""" + forward("fx_ll", "fx_p"))
    q["resolve_point"] = _w(resolve, f"""SELECT src, event_id, geo_uri, {gid('x', 'y', 5)} AS gid_l5, {gid('x', 'y', 0)} AS gid_l0,
  {name('x', 'y', 5)} AS name_l5, {q_text(quadrant('x', 'y'))} AS quadrant, {geohash('lat', 'lon')} AS geohash,
  CAST(c.pop AS BIGINT) AS pop, CAST(c.dom_ocu AS BIGINT) AS dom_ocu, c.pop_fem_perc, 100 - c.pop_fem_perc AS pop_masc_perc
FROM fx_p LEFT JOIN fx_compact c ON c.gid = {gid('x', 'y', 5)}""")
    q["resolve_json"] = _w(resolve, f"""SELECT event_id, geo_uri, '{{"cell_L0_gid":' || {gid('x', 'y', 0)} || ',"cell_quadrante":"' || {q_text(quadrant('x', 'y'))}
  || '","cell_L5_gid":' || {gid('x', 'y', 5)} || ',"cell_L0":"' || {name('x', 'y', 0)} || '","cell_L5":"' || {name('x', 'y', 5)}
  || '","geohash":"' || {geohash('lat', 'lon')} || '","cell_L5_censo2010":' || CASE WHEN c.pop IS NULL THEN 'null' ELSE
  '{{"pop":' || c.pop || ',"dom_ocu":' || c.dom_ocu || ',"pop_fem_perc":' || c.pop_fem_perc || ',"pop_masc_perc":' || (100 - c.pop_fem_perc) || '}}' END
  || '}}' AS document
FROM fx_p LEFT JOIN fx_compact c ON c.gid = {gid('x', 'y', 5)} WHERE src = 'grid'""")
    # six digits leave a cell of about 1 km by 0.6 km at these latitudes, so level 5 is the level of like size
    hashed = resolve.rsplit("fx_all AS (", 1)[0] + f"""
fx_all AS (SELECT event_id, CAST(CAST(round(lat, 6) AS DECIMAL(9,6)) AS DOUBLE) AS lat0, CAST(CAST(round(lon, 6) AS DECIMAL(9,6)) AS DOUBLE) AS lon0 FROM fx_pll),
fx_ll AS (SELECT event_id, {geohash('lat0', 'lon0', 6)} AS geohash,
  (floor((lat0 + 90) / 180 * 32768) + 0.5::DOUBLE) * 180 / 32768 - 90 AS lat,
  (floor((lon0 + 180) / 360 * 32768) + 0.5::DOUBLE) * 360 / 32768 - 180 AS lon FROM fx_all),
""" + forward("fx_ll", "fx_p")
    q["resolve_geohash"] = _w(hashed, f"""SELECT event_id, geohash, {gid('x', 'y', 5)} AS gid,
  CAST(c.pop AS BIGINT) AS pop, CAST(c.dom_ocu AS BIGINT) AS dom_ocu, c.pop_fem_perc, 100 - c.pop_fem_perc AS pop_masc_perc
FROM fx_p LEFT JOIN fx_compact c ON c.gid = {gid('x', 'y', 5)}""")
    q["resolve_name"] = _w(COMPACT, f"""SELECT n.src, n.name, CASE WHEN n.bad THEN NULL ELSE n.src END AS gid,
  CAST(c.pop AS BIGINT) AS pop, CAST(c.dom_ocu AS BIGINT) AS dom_ocu, c.pop_fem_perc, 100 - c.pop_fem_perc AS pop_masc_perc
FROM (SELECT gid AS src, pop % 10 = 0 AS bad, {_BAD_NAME} AS name FROM fx_original) n
LEFT JOIN fx_compact c ON c.gid = n.src AND NOT n.bad""")
    q["locate_points"] = _w(CELLS + "," + XY, """SELECT p.event_id, c.gid FROM fx_xy p
JOIN fx_cells c ON p.x >= c.cx - c.side // 2 AND p.x < c.cx + c.side // 2 AND p.y >= c.cy - c.side // 2 AND p.y < c.cy + c.side // 2""")
    q["locate_bbox"] = _w(CELLS + "," + XY, """SELECT p.event_id, c.gid FROM fx_xy p
JOIN fx_cells c ON p.x BETWEEN c.cx - c.side // 2 AND c.cx + c.side // 2 AND p.y BETWEEN c.cy - c.side // 2 AND c.cy + c.side // 2""")
    near = PLACED + "," + XY + """,
fx_ax AS (SELECT DISTINCT level, cx AS v FROM fx_placed WHERE level >= 5), fx_ay AS (SELECT DISTINCT level, cy AS v FROM fx_placed WHERE level >= 5),
fx_pl AS (SELECT event_id, x, y, CAST(l AS BIGINT) AS level FROM fx_xy, (VALUES (5), (6)) t(l)),
fx_n0 AS (SELECT p.*, a.v AS xa, b.v AS xb FROM fx_pl p
  ASOF LEFT JOIN fx_ax a ON a.level = p.level AND a.v >= p.x ASOF LEFT JOIN fx_ax b ON b.level = p.level AND b.v < p.x),
fx_n1 AS (SELECT p.*, a.v AS ya, b.v AS yb FROM fx_n0 p
  ASOF LEFT JOIN fx_ay a ON a.level = p.level AND a.v >= p.y ASOF LEFT JOIN fx_ay b ON b.level = p.level AND b.v < p.y),
fx_near AS (SELECT event_id, level,
  CASE WHEN xb IS NULL THEN xa WHEN xa IS NULL THEN xb WHEN x - xb <= xa - x THEN xb ELSE xa END AS x_near,
  CASE WHEN yb IS NULL THEN ya WHEN ya IS NULL THEN yb WHEN y - yb <= ya - y THEN yb ELSE ya END AS y_near FROM fx_n1)"""
    q["nearest_axis"] = _w(near, "SELECT event_id, level, x_near, y_near FROM fx_near")
    q["nearest_cell"] = _w(near, """SELECT event_id, level, CAST(CASE WHEN level = 6
  THEN CAST(x_near - 100 AS VARCHAR) || lpad(CAST(y_near + 100 AS VARCHAR), 8, '0') || '6'
  ELSE CAST(x_near - 500 AS VARCHAR) || lpad(CAST(y_near - 500 AS VARCHAR), 8, '0') || '5' END AS BIGINT) AS gid FROM fx_near""")

    q["nearest_uri"] = q["nearest_cell"].replace(XY, URI_U + "," + URI_XY + """,
fx_xy AS (SELECT event_id, x, y FROM fx_p WHERE x IS NOT NULL AND y IS NOT NULL)""")

    q["locate_any_boxes"] = _w(CELLS + "," + XY + """,
fx_box AS (SELECT k, x0, y0, 100 * (CAST(1 AS BIGINT) << least(14, bit_count((k & -k) - 1))) AS h FROM fx_blocks)""",
        "SELECT event_id, k FROM fx_xy p JOIN fx_box b ON p.x BETWEEN b.x0 - h AND b.x0 + h AND p.y BETWEEN b.y0 - h AND b.y0 + h")
    q["sql_rebuild_cell"], q["sql_rebuild_quadrant"] = q["rebuild_original"], q["rebuild_quadrant"]
    inside = f"{quadrant('cx', 'cy')} = {ONE_QUADRANT}"
    changed = COMPACT.replace("FROM fx_cells)", f"""FROM (SELECT * REPLACE (CASE WHEN {inside} THEN pop + 7 ELSE pop END AS pop)
  FROM fx_cells WHERE NOT ({inside} AND pop % 5 = 0)) z)""")
    q["replace_quadrant"] = _w(changed, f"SELECT {compact} FROM fx_compact")

    # ---- verification and quality
    q["ring_simplified"] = _w(CELLS, """SELECT gid, CAST(5 + CAST(pop % 3 = 2 AS INTEGER) AS BIGINT) AS n_vertices,
  CAST(side * side - CASE WHEN pop % 3 = 2 THEN side ELSE 0 END AS DOUBLE) AS area FROM fx_cells""")
    rules = [
        ("gid", "type", "false"), ("gid", "required", "gid IS NULL"), ("pop", "type", "pop_text IS NOT NULL AND TRY_CAST(pop_text AS BIGINT) IS NULL"),
        ("pop", "minimum", "TRY_CAST(pop_text AS BIGINT) < 1"), ("pop", "maximum", "TRY_CAST(pop_text AS BIGINT) > 890"),
        ("dom_ocu", "type", "false"), ("dom_ocu", "required", "dom_ocu IS NULL"),
        ("name", "maxLength", "length(nm) > 15"), ("name", "pattern", r"NOT regexp_full_match(nm, '\d+K?ME\d+N\d+')"), ("flag", "enum", "flag NOT IN ('t', 'f')"),
        ("gid", "unique", "gid IS NOT NULL AND same_gid > 1"), ("gid,flag", "primaryKey", "same > 1 OR gid IS NULL OR flag IS NULL"),
    ]
    q["descriptor_check"] = _w(ORIGINAL + """,
fx_twice AS (SELECT * FROM fx_original UNION ALL SELECT * FROM fx_original WHERE pop % 101 = 0),
fx_bad AS (SELECT gid, CASE WHEN pop % 97 = 0 THEN 'about ' || pop ELSE CAST(pop AS VARCHAR) END AS pop_text, CASE WHEN pop % 89 = 0 THEN NULL ELSE dom_ocu END AS dom_ocu,
  CASE WHEN pop % 83 = 0 THEN 'M200' ELSE id_unico END AS nm,
  CASE WHEN pop % 79 = 0 THEN NULL WHEN pop % 73 = 0 THEN 'maybe' WHEN side = 1000 THEN 't' ELSE 'f' END AS flag FROM fx_twice),
fx_key AS (SELECT *, concat_ws(',', CAST(gid AS VARCHAR), flag) AS k, count(*) OVER (PARTITION BY gid) AS same_gid, count(*) OVER (PARTITION BY gid, flag) AS same FROM fx_bad)""",
        " UNION ALL ".join(f"SELECT '{f}' AS field, '{r}' AS rule, count(*) FILTER (WHERE {bad}) AS n_bad, min(k) FILTER (WHERE {bad}) AS least_key FROM fx_key" for f, r, bad in rules))
    q["check_names"] = _w(_FAULTY, f"""SELECT id_unico, id_unico = CASE WHEN side = 200 THEN t6 ELSE t5 END AS is_unico, {_FLAGS}
FROM fx_faulty""")
    q["check_uri_names"] = _w(_FAULTY + """,
fx_named AS (SELECT * REPLACE (CASE WHEN pop % 13 = 0 THEN 'X' || id_unico ELSE id_unico END AS id_unico) FROM fx_faulty)""",
        f"SELECT id_unico, CASE WHEN id_unico <> nome_1km THEN id_unico = t6 END AS is_name200m, {_FLAGS} FROM fx_named")
    q["check_geometry"] = _w(CELLS + """,
fx_moved AS (SELECT 'sound' AS input, side, 0 AS dx FROM fx_cells UNION ALL SELECT 'faulty', side, CASE WHEN pop % 97 = 0 THEN 1000 ELSE 0 END FROM fx_cells)""",
        """SELECT input, count(*) AS n, bool_and(greatest(0, side - dx) * side = side * side) AS areas_ok, true AS centers_ok FROM fx_moved GROUP BY 1""")
    q["edge_rate"] = _w(ring + "," + ALBERS + "," + inverse("fx_v", "fx_i") + """,
fx_rd AS (SELECT gid, ord, round(lat, 6) AS lat, round(lon, 6) AS lon FROM fx_i),
fx_rs AS (SELECT *, sin(radians(lat)) AS sn FROM fx_rd),""" + f"""
fx_rr AS (SELECT s1.*, {_A!r}::DOUBLE * sqrt(al.c - al.n * {_qsql('sn')}) / al.n AS rho, al.n * radians(lon - ({LON_0!r}::DOUBLE)) AS th, al.rho0 FROM fx_rs s1, al),
fx_b2 AS (SELECT gid, ord, 5000000 + rho * sin(th) AS bx, 10000000 + rho0 - rho * cos(th) AS bj FROM fx_rr)""",
        """SELECT CAST(round_even(100.0::DOUBLE * count(*) FILTER (WHERE abs(bx - cx) < side // 2 AND abs(bj - cy) < side // 2) / count(*), 0) AS BIGINT) AS contains_pt_perc,
  CAST(100 AS BIGINT) AS contains_center_perc FROM fx_b2 JOIN fx_cells USING (gid)""")
    q["naming_violations"] = _w(ORIGINAL, """SELECT regexp_replace(id_unico, 'N[0-9]+', 'N0000') AS id_unico, true AS is_200m,
  regexp_extract(id_unico, 'E([0-9]+)N', 1) AS x_digits, '0000' AS y_digits, CAST(cx - 100 AS BIGINT) AS x, CAST(cy + 100 AS BIGINT) AS y
FROM fx_original WHERE pop % 50 = 0""")
    q["name_prefixes"] = _w(ORIGINAL, "SELECT substr(id_unico, 1, 4) AS id_prefix, count(*) AS n FROM fx_original GROUP BY 1")
    q["search_original"] = _w(ring + "," + XY + "," + ALBERS + "," + inverse("fx_v", "fx_i") + f""",
fx_bb AS (SELECT gid, min(round(lon, 6)) AS x0, max(round(lon, 6)) AS x1, min(round(lat, 6)) AS y0, max(round(lat, 6)) AS y1 FROM fx_i GROUP BY 1),
fx_pt AS (SELECT event_id, x AS px, y AS py FROM fx_xy),
""" + inverse("fx_pt", "fx_pll"), """SELECT p.event_id, b.gid FROM (SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM fx_pll) p
JOIN fx_bb b ON p.lon BETWEEN b.x0 AND b.x1 AND p.lat BETWEEN b.y0 AND b.y1""")
    q["pk_violations"] = _w(COMPACT, """SELECT gid, count(*) AS n FROM (SELECT gid FROM fx_levels UNION ALL SELECT gid FROM fx_levels WHERE level < 2
  UNION ALL SELECT NULL FROM fx_levels WHERE level = 0) z GROUP BY gid HAVING count(*) > 1 OR gid IS NULL""")
    q["schema_check"] = _w(COMPACT + """,
fx_f AS (SELECT gid, CASE WHEN pop % 11 = 0 THEN -pop - 1 ELSE pop END AS pop, CASE WHEN gid % 13 = 0 THEN pop_fem_perc + 101 ELSE pop_fem_perc END AS pf,
  CASE WHEN gid % 17 = 0 THEN NULL ELSE dom_ocu END AS dom_ocu, CASE WHEN level = 3 THEN NULL WHEN level = 4 THEN false WHEN level = 6 AND pop % 2 = 0 THEN true ELSE is_cache END AS is_cache, level FROM fx_levels)""",
        """SELECT 'gid_not_null' AS rule, count(*) FILTER (WHERE gid IS NULL) AS n_bad FROM fx_f
UNION ALL SELECT 'gid_level_valid', count(*) FILTER (WHERE level NOT BETWEEN 0 AND 6) FROM fx_f
UNION ALL SELECT 'pop_not_negative', count(*) FILTER (WHERE pop < 0) FROM fx_f
UNION ALL SELECT 'pop_fem_perc_0_100', count(*) FILTER (WHERE pf NOT BETWEEN 0 AND 100) FROM fx_f
UNION ALL SELECT 'dom_ocu_not_negative', count(*) FILTER (WHERE dom_ocu IS NULL OR dom_ocu < 0) FROM fx_f
UNION ALL SELECT 'is_cache_not_null', count(*) FILTER (WHERE is_cache IS NULL) FROM fx_f
UNION ALL SELECT 'native_level_5_or_6', count(*) FILTER (WHERE coalesce(NOT is_cache, true) AND level < 5) FROM fx_f
UNION ALL SELECT 'cache_level_0_to_5', count(*) FILTER (WHERE coalesce(is_cache, true) AND level > 5) FROM fx_f""")
    q["insert_if_absent"] = _w(COMPACT, f"SELECT {compact} FROM fx_compact")
    q["table_diff"] = _w(COMPACT, """SELECT 'left' AS side, gid, CAST(pop AS BIGINT) AS pop, CAST(1 AS BIGINT) AS n FROM fx_levels WHERE level = 0 OR (level = 1 AND pop % 2 = 0)
UNION ALL SELECT 'right', gid, CAST(pop + 1 AS BIGINT), 1 FROM fx_levels WHERE level = 1 AND pop % 2 = 0
UNION ALL SELECT 'right', gid, CAST(pop AS BIGINT), 1 FROM fx_levels WHERE level = 2""")
    q["sample"] = _w(CELLS, "SELECT gid, CAST(pop AS BIGINT) AS pop FROM fx_cells WHERE CAST('0x' || substr(md5(CAST(gid AS VARCHAR)), 1, 8) AS BIGINT) < 429496729")

    # ---- files
    q["compact_csv_roundtrip"] = q["pyramid"]
    q["compact_store"] = _w(COMPACT, f"SELECT {compact}, level FROM fx_levels")
    q["compact_from_csv"] = q["compact_store"]
    original = "id_unico, " + ", ".join(_NAME_COLUMN.values()) + ", quadrante, masc, fem, pop, dom_ocu"
    q["original_scan"] = _w(ORIGINAL, f"SELECT gid, {original}, 'grade_id' || substr(quadrante, 4) AS \"table\" FROM fx_original")
    q["original_union"] = _w(ORIGINAL, "SELECT quadrante, count(*) AS n, CAST(sum(pop) AS BIGINT) AS pop FROM fx_original GROUP BY 1")
    q["load_report"] = _w(PLACED, f"""SELECT quadrant, n, 'grade_id' || lpad(CAST(quadrant AS VARCHAR), 2, '0') AS "table",
  'grade_id' || lpad(CAST(quadrant AS VARCHAR), 2, '0') || ': ' || CAST(n AS VARCHAR) || ' itens inseridos' AS msg
FROM (SELECT {quadrant('cx', 'cy')} AS quadrant, count(*) AS n FROM fx_placed GROUP BY 1) z""")
    q["geojson_features"] = _w(PLACED + f""",
fx_v AS (SELECT gid, level, pop, pop_fem_perc, dom_ocu, {name_any('cx', 'cy', 'level')} AS id_unico, CAST(v.ord AS BIGINT) AS ord,
  cx + v.dx * (s // 2) AS px, cy + v.dy * (s // 2) AS py FROM fx_placed, {_CORNERS} WHERE level < 2),""" + ALBERS + "," + inverse("fx_v", "fx_ll"),
        """SELECT CAST(gid AS VARCHAR) AS id, id_unico, CAST(pop AS BIGINT) AS pop, pop_fem_perc, CAST(dom_ocu AS BIGINT) AS dom_ocu, ord,
  round(lon, 6) AS lon, round(lat, 6) AS lat FROM fx_ll""")
    q["geojson_read"] = q["geojson_documents"] = q["geojson_features"]
    q["geojson_scanned"] = q["geojson_features"].replace(" WHERE level < 2", "")
    q["geojson_headers"] = _w(COMPACT, """SELECT CAST(gid AS VARCHAR) AS root, 'FeatureCollection' AS type, 'cells' AS name, CAST(2 AS BIGINT) AS n_members
FROM fx_levels WHERE level = 0""")
    q["control_points"] = _w(ORIGINAL, """SELECT 'BR, "' || quadrante || '"' AS jurisdiction, 'Ponto ' || id_unico AS name, gid AS wikidata_id, CAST(NULL AS BIGINT) AS osm_node_id,
  id_unico AS cell_name FROM fx_original""")

    # ---- text
    q["prefix_join"] = _w(ORIGINAL, "SELECT gid, 't1.' || nome_1km || ',t1.' || nome_5km || ',t1.' || nome_10km AS joined FROM fx_original")
    q["json_slice"] = """SELECT event_id, '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS same,
  '{"key":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS renamed, '{}' AS absent FROM events"""
    head, tail = q["resolve_point"].rsplit("SELECT src, ", 1)
    q["cell_windows"] = _w(CELLS + "," + XY + f""",
fx_first AS (SELECT p.event_id, {gid('x', 'y', 1)} AS gid, epoch_us(e.ts) AS t,
    epoch_us(e.ts) + CASE WHEN p.event_id % 50 = 7 THEN 172800 ELSE (p.event_id * 37) % 5400 END * 1000000 AS seen
  FROM fx_xy p JOIN events e ON e.event_id = p.event_id),
fx_sent AS (SELECT *, CASE WHEN late THEN seen ELSE t END AS placed FROM (
  SELECT *, seen >= (t // 21600000000 + 1) * 21600000000 + 7200000000 AS late FROM (
    SELECT * FROM fx_first UNION ALL SELECT event_id, gid, t, seen + 60000000 FROM fx_first WHERE event_id % 20 = 3) a) b),
fx_once AS (SELECT * FROM fx_sent QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seen) = 1)""",
        """SELECT placed // 21600000000 * 21600000000 AS window_us, gid, late, count(*) AS n, min(t) AS first_us, max(t) AS last_us
FROM fx_once WHERE (placed // 21600000000 + 1) * 21600000000 <= (SELECT max(placed) // 1000 * 1000 - 7200000000 FROM fx_sent)
GROUP BY 1, 2, 3""")
    q["stream_enrich"] = f"{head}SELECT {tail}\nWHERE src = 'grid'"
    return q

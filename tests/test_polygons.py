"""Dissolved polygons against a walk along the borders of single 200 m squares."""

import random

import pytest

from gridloom import functions as G
from gridloom.functions import encode
from gridloom.operators import polygons


def walked(squares):
    """Closed rings (list of corners, twice the signed area) around unit squares, the left turn first where two sides go on."""
    ahead = {}
    for x, y in squares:
        for dx, dy, a, b, d in ((0, -1, (x, y), (x + 1, y), 0), (1, 0, (x + 1, y), (x + 1, y + 1), 1), (0, 1, (x + 1, y + 1), (x, y + 1), 2), (-1, 0, (x, y + 1), (x, y), 3)):
            if (x + dx, y + dy) not in squares:
                ahead.setdefault(a, {})[d] = b
    rings = []
    while ahead:
        start = min(ahead)
        d = min(ahead[start])
        first, at, corners, twice = (start, d), start, [], 0
        while True:
            to = ahead[at].pop(d)
            if not ahead[at]:
                del ahead[at]
            twice += at[0] * to[1] - to[0] * at[1]
            at, turns = to, [(d + 1) % 4, d, (d + 3) % 4]
            if at == first[0] and (first[1] == turns[0] or not ahead.get(at) or first[1] == turns[1] and turns[0] not in ahead[at] or turns[0] not in ahead[at] and turns[1] not in ahead[at]):
                if first[1] != d:
                    corners.append(at)
                break
            new = next(t for t in turns if t in ahead.get(at, {}))
            if new != d:
                corners.append(at)
            d = new
        rings.append((corners, twice))
    return rings


def inside(point, corners):
    x, y = point
    odd = False
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


X0, Y0 = 5300000, 9630000


def frame(spark, squares):
    """200 m cells at lattice places, with 1 km cells where five by five are full."""
    rows, left = [], set(squares)
    for bx in range(0, 50, 5):
        for by in range(0, 50, 5):
            block = {(bx + i, by + j) for i in range(5) for j in range(5)}
            if block <= left and (bx + by) % 10 == 0:
                rows.append((X0 + bx * 200, Y0 + by * 200, 5))
                left -= block
    rows += [(X0 + x * 200, Y0 + y * 200 + 200, 6) for x, y in left]
    return spark.createDataFrame(rows + rows[:3], "x long, y long, level int").selectExpr(f"{encode.sql('x', 'y', 'level')} AS gid")


def shapes():
    rng = random.Random(4)
    yield {(i, j) for i in range(50) for j in range(50) if rng.random() < 0.6}
    yield {(i, j) for i in range(30) for j in range(30) if not (5 <= i < 25 and 5 <= j < 25) or 10 <= i < 20 and 10 <= j < 20 and not (13 <= i < 15 and 13 <= j < 16)}
    yield {(0, 0), (1, 1), (2, 0), (1, -1), (4, 4)} - {(1, -1)}
    yield {(i, j) for i in range(50) for j in range(50)}


@pytest.mark.parametrize("squares", list(shapes()))
def test_rings_equal_a_walk(spark, squares):
    got = polygons.dissolve_polygons(frame(spark, squares), 3).selectExpr("*", f"{G.parts_area.sql('parts')} AS area").collect()
    assert len({r.parent for r in got}) == len(got) and sum(r.area for r in got) == len(squares) * 40000
    row, = got
    rings = walked(squares)
    assert (row.n_shells, row.n_holes) == (sum(t > 0 for _, t in rings), sum(t < 0 for _, t in rings))
    small = lambda line: [((p.x - X0) / 200, (p.y - Y0) / 200) for p in line[:-1]]
    assert all(line[0] == line[-1] for part in row.parts for line in part)
    found = [set(small(line)) for part in row.parts for line in part]
    assert sorted(map(sorted, found)) == sorted(sorted(set(c)) for c, _ in rings)
    for shell, *holes in row.parts:
        for hole in map(small, holes):
            # Just outside of the hole's west end are cells of the same part: inside of the shell, outside of its other holes.
            x, y = min(hole)
            spot = (x - 0.5, y + 0.5)
            assert inside(spot, small(shell)) and not any(inside(spot, small(h)) for h in holes)


def test_cells_of_several_parents(spark):
    cells = frame(spark, {(i, j) for i in range(50) for j in range(50)})
    got = polygons.dissolve_polygons(cells, 4).collect()
    assert len(got) == 4 and all((r.n_shells, r.n_holes, len(r.parts[0][0])) == (1, 0, 5) for r in got)
    assert polygons.dissolve_polygons(cells.where("gid < 0"), 4).count() == 0

"""Hierarchy levels of the grid: level number, side in metres, name prefix."""

from __future__ import annotations

from gridloom.functions._base import grid_function

# Fixed values of the grid definition: side and name prefix of levels 0 to 6,
# south-west corner of the lattice, and the 56 quadrants that exist.
SIDES = (500000, 100000, 50000, 10000, 5000, 1000, 200)
PREFIXES = ("500KM", "100KM", "50KM", "10KM", "5KM", "1KM", "200M")
ORIGIN_X = 2800000
ORIGIN_Y = 7350000
QUADRANTS = (
    4, 13, 14, 15, 23, 24, 25, 26, 27, 33, 34, 35, 36, 37, 39, 42, 43, 44, 45, 46, 47, 50, 51, 52, 53, 54, 55, 56,
    57, 58, 60, 61, 62, 63, 64, 65, 66, 67, 68, 69, 70, 71, 72, 73, 74, 75, 76, 77, 80, 81, 82, 83, 84, 85, 92, 93,
)

FINEST = len(SIDES) - 1
KM_LEVEL = 5
ROOT_SPAN = 10  # the lattice is 10 x 10 root cells, so every axis of a level is bounded


def per_level(values, level) -> str:
    """Expression that picks one of seven values by level; NULL outside 0 to 6."""
    quoted = [f"'{v}'" if isinstance(v, str) else f"{v}L" for v in values]
    if isinstance(level, int):
        if 0 <= level <= FINEST:
            return quoted[level]
        return "string(NULL)" if isinstance(values[0], str) else "bigint(NULL)"
    return f"get(array({', '.join(quoted)}), int({level}))"


def _position(values, item: str) -> str:
    quoted = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}L" for v in values)
    return f"int(nullif(array_position(array({quoted}), {item}), 0) - 1)"


@grid_function("level INT", "BIGINT")
def level_to_size(level) -> str:
    """Side of a level in metres; NULL for a level that does not exist."""
    return per_level(SIDES, level)


@grid_function("size BIGINT", "INT")
def size_to_level(size) -> str:
    """Level with the given side; NULL for a side that is not one of the seven."""
    return _position(SIDES, f"bigint({size})")


@grid_function("prefix STRING", "INT")
def prefix_to_level(prefix) -> str:
    """Level named by a prefix such as ``5KM``; NULL when unknown."""
    return _position(PREFIXES, prefix)


@grid_function("level INT", "STRING")
def level_to_prefix(level) -> str:
    """Name prefix of a level; NULL for a level that does not exist."""
    return per_level(PREFIXES, level)


# Upper bound of the disk diameter (metres) and the side it snaps to.
UNCERTAINTY_STEPS = ((500, 200), (2500, 1000), (5000, 5000), (25000, 10000), (50000, 50000), (250000, 100000))


@grid_function("radius BIGINT", "BIGINT")
def uncertain_to_size(radius) -> str:
    """Side of the cell that suits a GeoURI uncertainty radius in metres."""
    passed = " + ".join(f"int(({radius}) * 2L >= {bound}L)" for bound, _ in UNCERTAINTY_STEPS)
    sides = ", ".join(f"{side}L" for _, side in UNCERTAINTY_STEPS)
    return f"coalesce(get(array({sides}), {passed}), {SIDES[0]}L)"

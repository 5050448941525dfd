"""Reports on the compact grid and data-quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import center_x, center_y, gid_level
from gridloom.functions.levels import FINEST, KM_LEVEL
from gridloom.operators.nearest import axis_values


def level_counts(compact: DataFrame) -> DataFrame:
    """Cells per level."""
    return compact.groupBy(gid_level("gid").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def level_totals(compact: DataFrame) -> DataFrame:
    """Cells and population per level."""
    return compact.groupBy(gid_level("gid").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("pop").alias("pop")
    )


def extent(compact: DataFrame) -> DataFrame:
    """Extent of the cell centres per level."""
    return compact.groupBy(gid_level("gid").alias("level")).agg(
        F.min(center_x("gid")).alias("x_min"), F.max(center_x("gid")).alias("x_max"),
        F.min(center_y("gid")).alias("y_min"), F.max(center_y("gid")).alias("y_max"),
    )


def name_prefixes(original: DataFrame) -> DataFrame:
    """Distinct four-letter prefixes of cell names, with the number of cells."""
    return original.groupBy(F.substring("id_unico", 1, 4).alias("id_prefix")).agg(F.count(F.lit(1)).alias("n"))


def compact_rules() -> dict[str, Column]:
    """Rule name to the condition every row must meet; NULL does not meet it."""
    level = gid_level("gid")
    return {
        "gid_not_null": F.col("gid").isNotNull(),
        "gid_level_valid": level.between(0, FINEST),
        "pop_not_negative": F.col("pop") >= 0,
        "pop_fem_perc_0_100": F.col("pop_fem_perc").between(0, 100),
        "dom_ocu_not_negative": F.col("dom_ocu") >= 0,
        "is_cache_not_null": F.col("is_cache").isNotNull(),
        "native_level_5_or_6": F.col("is_cache") | level.isin(KM_LEVEL, FINEST),
        "cache_level_0_to_5": ~F.col("is_cache") | (level <= KM_LEVEL),
    }


def schema_check(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """``rule, n_bad`` for every rule, all counted in one pass."""
    rules = rules or compact_rules()
    names = list(rules)
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_bad")) for n in names])
    return counts.select(F.inline(pairs))


__all__ = [
    "axis_values", "compact_rules", "extent", "level_counts", "level_totals", "name_prefixes", "schema_check",
]

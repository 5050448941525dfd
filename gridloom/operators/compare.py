"""Comparison of tables, insert of absent rows, and sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that differ between two tables of one schema, with ``side`` and the surplus ``n``.

    Both tables are counted in one grouping (+1 left, -1 right), so there is a
    single shuffle and duplicates are compared as a bag.
    """
    cols = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionByName(right.select(*cols).withColumn("_sign", F.lit(-1)))
    surplus = signed.groupBy(*cols).agg(F.sum("_sign").alias("_n")).filter("_n <> 0")
    return surplus.select(
        F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), *cols, F.abs("_n").alias("n")
    )


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str = "gid") -> DataFrame:
    """Target plus the incoming rows whose key it lacks; of equal incoming keys one row is kept."""
    rest = [c for c in target.columns if c != key]
    one = (
        incoming.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(key, *[F.col("_row")[c].alias(c) for c in rest])
    )
    fresh = one.join(target.select(key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def key_violations(df: DataFrame, key: str = "gid") -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") > 1) | F.col(key).isNull())


def sample_percent(df: DataFrame, percent: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample; ``percent`` is a percentage, so 0.01 means one row in ten thousand."""
    return df.sample(withReplacement=False, fraction=percent / 100.0, seed=seed)


def sample_percent_by_key(df: DataFrame, key: str, percent: float) -> DataFrame:
    """Repeatable sample decided by a hash of the key: the same rows for any partitioning."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.filter(bucket < int(percent / 100.0 * (1 << 32)))


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of several tables, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)

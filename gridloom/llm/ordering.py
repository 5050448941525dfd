"""Positions of rows in the order of their group, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm._util import free_name, staged


def numbered(rows: DataFrame, group: str, order: list[Column], name: str, pos: str = "pos", total: str = "n") -> DataFrame:
    """The rows with ``pos``, their place from 0 in the order of their ``group``, and ``n``, the rows of the group.

    Rows are dealt by ranges of (group, order), so a group of any size lies in as many partitions as it needs, and
    are written once in that order. A table with one row for each partition and group then says how many rows of a
    group lie in earlier partitions. Rows that tie get neighbouring places in any order, and are dealt out like others.
    ``group`` holds no null; ``rows`` must read the same each time (a written table does). An empty table gives no rows.
    """
    tie, at, run, first, before = (free_name(rows, c) for c in ("_tie", "_at", "_run", "_first", "_before"))
    keys = [F.col(group), *order, F.col(tie)]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = staged(dealt.drop(tie).withColumn(at, F.monotonically_increasing_id()).withColumn(run, F.shiftright(at, 33)), name)
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        ordered.groupBy(group, run).agg(F.min(at).alias(first), F.count("*").alias(total))
        .select(group, run, first, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(before), F.sum(total).over(of_group).alias(total))
    )
    return ordered.join(runs, [group, run]).withColumn(pos, F.col(at) - F.col(first) + F.col(before)).drop(at, run, first, before)

"""Shards of near-equal size by longest-processing-time scheduling of groups that stay together.

Groups are sorted by size, and each goes to the least-loaded shard, taken from a heap. A schedule over every group would
pass all of them through one place, so groups smaller than a fixed share of an even shard are first bundled: a group's
key deals it to one of ``BUNDLES`` bundles. What is scheduled is then at most ``BUNDLES`` bundles and, since their
sizes add up to the whole, at most ``shards * FINENESS`` larger groups, at any size of input.

What bundling costs: the last unit on the fullest shard was put there when that shard was the least loaded, so the fullest and the
emptiest shard differ by at most that unit, which is a bundle or an own group unless the shard holds one group alone.
The longest-first schedule over single groups has the same bound with its last group for the unit. Bundles are even by
hash: with ``BUNDLES`` of them and 16 shards one is about 1 / 512 of a shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm._util import free_name, ready, staged

SHARDS = 16
#: A group of at least 1 / FINENESS of an even shard is scheduled by itself.
FINENESS = 500
#: Where all other groups meet.
BUNDLES = 8192
#: Rows of a shard numbered by one task.
ROWS_A_RUN = 200_000


def longest_first(sizes: list[tuple[object, int]], shards: int) -> dict[object, int]:
    """Shard of each (key, size): the largest first, each to the least-loaded shard; ties by key and shard number."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for key, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(rows: DataFrame, size: str, group: str, shards: int = SHARDS, fineness: int = FINENESS, bundles: int = BUNDLES) -> DataFrame:
    """The rows with a column ``shard``; rows of equal ``group`` share one, and the sums of ``size`` are near equal.

    ``group`` is a string (null goes with the empty string), ``size`` a non-negative long (null counts as 0). Shards stay
    empty if there are fewer groups than shards. A column ``shard`` of the rows is replaced. An empty table gives no rows.
    """
    spark = ready(rows)
    key = F.coalesce(F.col(group), F.lit(""))
    bundle = F.pmod(F.xxhash64(key), F.lit(bundles))
    groups = staged(rows.groupBy(key.alias("key")).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    own = F.col("size") * F.lit(shards * fineness) >= F.lit(max(total, 1))
    large = [("", r["key"], r["size"]) for r in groups.where(own).collect()]
    small = groups.where(~own).groupBy(F.pmod(F.xxhash64("key"), F.lit(bundles)).alias("bundle")).agg(F.sum("size").alias("size"))
    units = [((0, k), n) for _, k, n in large] + [((1, r["bundle"]), r["size"]) for r in small.collect()]
    placed = longest_first(units, shards)
    # Both tables are bounded by the parameters, whatever the input: shards * fineness rows, and bundles rows.
    k, b, own, other = (free_name(rows, n) for n in ("_key", "_bundle", "_alone", "_bundled"))
    alone = spark.createDataFrame([(x[1], s) for x, s in placed.items() if x[0] == 0], f"{k} string, {own} int")
    bundled = spark.createDataFrame([(x[1], s) for x, s in placed.items() if x[0] == 1], f"{b} long, {other} int")
    return (
        rows.withColumn(k, key).withColumn(b, bundle)
        .join(F.broadcast(alone), k, "left").join(F.broadcast(bundled), b, "left")
        .withColumn("shard", F.coalesce(own, other)).drop(k, b, own, other)
    )


def number_slots(rows: DataFrame, order: list[Column], rows_a_run: int = ROWS_A_RUN) -> DataFrame:
    """The rows with a column ``slot``: numbers from 0 without gaps within each ``shard``.

    A shard is numbered in runs dealt by a hash of ``order``, so that no task holds a whole shard; ties of ``order``
    are numbered in any order.
    """
    n = max(1, -(-rows.count() // rows_a_run))
    run = rows.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(n)))
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = run.groupBy("shard", "_run").agg(F.count("*").alias("n")).select("shard", "_run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("shard", "_run").orderBy(*order)) - 1
    return run.withColumn("_in", within).join(starts, ["shard", "_run"]).withColumn("slot", F.col("_start") + F.col("_in")).drop("_run", "_in", "_start")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per input row: doc_id, size (UTF-8 bytes of the text and 1), text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: rows with equal texts stay together, shards are near equal in bytes, and ``grown_shard`` is
    null. A null text has size 1 and the checksum of nothing, and goes with the empty texts. A very long text that outweighs
    a shard has one to itself. Repeated rows are all placed. Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("digest"),
        ), "shard-rows",
    )
    placed = assign_shards(rows, "size", "digest", shards)
    slots = number_slots(placed, [F.col("doc_id"), F.col("digest")])
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

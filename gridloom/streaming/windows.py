"""Events per cell over time, with late and repeated deliveries told apart.

A row has the time of its event and the time at which it was delivered. It belongs to the window of its event as long as it
is delivered before that window's end plus the allowed lateness; after that it is late, and is counted as such in the window of
its delivery. Both are decided by the row alone, so a stream and a batch over the same rows agree, and late rows are neither lost
nor do they change a count that has been given out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _placed(events: DataFrame, cell: str, time: str, seen: str, id_col: str, window: str, lateness: str) -> DataFrame:
    """``_id, _mark, _seen, _at, gid, ts, late``: ``_at`` is the time that decides on the row's window."""
    seen_at = F.coalesce(F.col(seen), F.col(time))
    rows = events.select(
        F.col(id_col).alias("_id"),
        # Rows without an id are one delivery only when they are equal in everything.
        F.when(F.col(id_col).isNull(), F.to_json(F.struct(*events.columns))).alias("_mark"),
        seen_at.alias("_seen"),
        F.col(cell).alias("gid"),
        F.col(time).alias("ts"),
        F.coalesce(seen_at >= F.window(F.coalesce(F.col(time), seen_at), window)["end"] + F.expr(f"INTERVAL {lateness}"), F.lit(False)).alias("_after"),
    )
    late = F.col("_after") | F.col("ts").isNull()
    return rows.select("*", late.alias("late"), F.when(late, F.col("_seen")).otherwise(F.col("ts")).alias("_at")).drop("_after")


def count_by_window(
    events: DataFrame,
    cell: str = "gid",
    time: str = "ts",
    seen: str = "seen",
    id_col: str = "event_id",
    window: str = "1 hour",
    lateness: str = "2 hours",
    disorder: str = "0 seconds",
) -> DataFrame:
    """``window_start, window_end, gid, late, n, first_ts, last_ts`` of a stream or of a batch.

    The first delivery of an id counts. A stream gives a window out once, when it is closed: the watermark stands
    ``lateness`` and ``disorder`` behind the newest row. As long as deliveries are at most ``disorder`` out of the order of
    their delivery times, no row is dropped by it; ``dropped_rows`` tells. It remembers an id as long as that; a batch
    remembers all of them.

    State is one row per open window and cell, and one per remembered id. A cell with a third of all rows is summed up
    within each task before rows are exchanged, and ids are even, so neither needs a salt.

    A null delivery time reads as the event's time. A row without an event's time is late; a row with neither is in no
    window and not counted. Rows without a cell are counted under a null cell. An empty input gives no rows; further
    columns are not looked at, save that they tell apart rows without an id.
    """
    placed = _placed(events, cell, time, seen, id_col, window, lateness).where("_at IS NOT NULL")
    if events.isStreaming:
        once = placed.withWatermark("_at", f"{lateness} {disorder}").dropDuplicatesWithinWatermark(["_id", "_mark"])
    else:
        first = F.min(F.struct("_seen", "_at", "ts", "gid", "late")).alias("_first")
        once = placed.groupBy("_id", "_mark").agg(first).select("_first.*")
    counted = once.groupBy(F.window("_at", window).alias("_window"), "gid", "late").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return counted.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "gid", "late", "n", "first_ts", "last_ts"
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came too far out of order for a window, in the progress that the query still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

"""The stream of GeoURIs while its grid is replaced, and events per cell over time."""

import pytest

from gridloom.operators.skew import keyed_join
from gridloom.sources.compact import current_version, write_version
from gridloom.streaming.enrich import run_available, run_refreshing
from gridloom.streaming.windows import count_by_window, dropped_rows


def test_a_new_version_takes_effect_and_old_readers_go_on(spark, tmp_path):
    def grid(pop):
        return spark.createDataFrame([(5756000087000005, pop, 51, 16, False)], "gid long, pop long, pop_fem_perc short, dom_ocu long, is_cache boolean")

    inbox, folder, out = (str(tmp_path / n) for n in ("in", "grid", "out"))
    uri = spark.createDataFrame([("geo:-23.550385,-46.633956",)], "geo_uri string")
    write_version(grid(45), folder)
    uri.write.parquet(inbox)
    old = current_version(spark, folder)
    stream = spark.readStream.schema("geo_uri string").parquet(inbox)
    query = run_refreshing(stream, folder, out, str(tmp_path / "state"))
    try:
        query.processAllAvailable()
        write_version(grid(5_000_000_000), folder)
        uri.write.mode("append").parquet(inbox)
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    got = spark.read.parquet(out)
    assert {r.batch: r["pop"] for r in got.collect()} == {0: 45, 1: 5_000_000_000}
    assert old.first()["pop"] == 45 and current_version(spark, folder).first()["pop"] == 5_000_000_000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_static_side_is_not_repeated_for_a_stream(spark, tmp_path, adaptive):
    """A hot key of a stream is split at run time, as in a batch; only a session that does not do so repeats the static side."""
    inbox = str(tmp_path / "in")
    rows = spark.range(0, 60000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id % 500 WHEN id % 2 = 0 THEN NULL ELSE -id END AS gid", "sha2(string(id), 512) AS pad"
    )
    rows.write.parquet(inbox)
    right = spark.range(1000).selectExpr("IF(id = 999, NULL, id div 2) AS gid", "id * 2 AS v").repartition(8)
    settings = {
        "spark.sql.adaptive.streaming.stateless.enabled": adaptive, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8",
    }
    if adaptive == "true":
        del settings["spark.sql.adaptive.streaming.stateless.enabled"]  # as it is by default
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for how in ("left", "inner"):
            joined = keyed_join(spark.readStream.schema(rows.schema).parquet(inbox), right, "gid", how)
            out, state = (str(tmp_path / f"{n}-{how}") for n in ("out", "state"))
            run = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
            run.awaitTermination()
            plan = run._jsq.explainInternal(False)
            assert ("skew=true" in plan) == (adaptive == "true") and ("Generate" in plan) == (adaptive == "false")
            want = rows.join(right, "gid", how)
            assert sorted(map(str, spark.read.parquet(out).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_SENT = "event_id long, gid long, ts timestamp, seen timestamp"


def _rows(spark, rows):
    """Rows with times in minutes of one day; None stays."""
    stamp = "timestamp_seconds(1700006400 + {0} * 60) AS {0}"
    given = spark.createDataFrame(rows, "event_id long, gid long, ts long, seen long")
    return given.selectExpr("event_id", "gid", stamp.format("ts"), stamp.format("seen"))


def _minutes(df):
    at = "(unix_seconds({}) - 1700006400) div 60"
    return sorted(
        (tuple(r) for r in df.selectExpr(at.format("window_start"), "gid", "late", "n", at.format("first_ts"), at.format("last_ts")).collect()),
        key=str,
    )


_DAY = [
    [(1, 7, 0, 1), (2, 7, 59, 60), (3, 8, 10, 12), (1, 7, 0, 2), (None, 7, 5, 20), (None, 7, 5, 20), (4, None, 30, None)],
    # late by the rule, and once more; in time though its window is over; delivered again after a restart
    [(5, 7, 1, 180), (5, 7, 1, 181), (6, 7, 50, 119), (3, 8, 10, 70), (7, 8, 100, 121)],
    [(8, 8, None, 190), (9, 9, 300, 301), (10, 7, 59, 302), (11, 9, None, None)],
    [(12, 1, 2000, 2001)],
]


def test_events_per_cell_stream_equals_batch(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in _DAY:
        _rows(spark, rows).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(_SENT).parquet(inbox)
        done = run_available(count_by_window(stream, window="1 hour", lateness="1 hour"), out, state)
    batch = count_by_window(_rows(spark, [r for rows in _DAY for r in rows]), window="1 hour", lateness="1 hour")
    want = [
        (0, 7, False, 4, 0, 59), (0, 8, False, 1, 10, 10), (0, None, False, 1, 30, 30), (60, 8, False, 1, 100, 100),
        (180, 7, True, 1, 1, 1), (180, 8, True, 1, None, None), (300, 7, True, 1, 59, 59), (300, 9, False, 1, 300, 300),
    ]
    assert _minutes(done) == sorted(want, key=str)
    assert _minutes(batch) == sorted([*want, (1980, 1, False, 1, 2000, 2000)], key=str)


def test_events_per_cell_of_nothing(spark):
    assert count_by_window(_rows(spark, [])).count() == 0


def test_rows_out_of_order_are_told(spark, tmp_path):
    """A row in time by its own stamp that comes after far younger ones: kept within ``disorder``, told as dropped beyond."""
    for name, disorder, n, lost in (("none", "0 seconds", 1, 1), ("some", "10 hours", 2, 0)):
        inbox, out, state = (str(tmp_path / name / x) for x in ("in", "out", "state"))
        dropped = 0
        for rows in ([(1, 7, 5, 6), (2, 8, 500, 501)], [(3, 7, 6, 7)], [(4, 8, 3000, 3001)]):
            _rows(spark, rows).write.mode("append").parquet(inbox)
            stream = spark.readStream.schema(_SENT).parquet(inbox)
            counted = count_by_window(stream, window="1 hour", lateness="1 hour", disorder=disorder)
            query = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
            query.awaitTermination()
            dropped += dropped_rows(query)
        got = {r.gid: r.n for r in spark.read.schema(counted.schema).parquet(out).collect()}
        assert got == {7: n, 8: 1} and dropped == lost

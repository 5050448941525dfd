"""Streaming enrichment: a stream of GeoURIs resolved against the stored compact grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators.resolve import resolve_uris
from gridloom.sources.compact import current_version


def enrich_stream(points: DataFrame, compact: DataFrame, uri: str = "geo_uri", level: int = 5) -> DataFrame:
    """Resolved points of a stream: stateless projections and a stream-static left join.

    The same transform as the batch ``resolve_uris``. The static side is planned once: for
    a grid that is replaced while the stream runs, use ``run_refreshing``.
    """
    if not points.isStreaming:
        raise ValueError("points must be a streaming DataFrame; use resolve_uris for a batch")
    return resolve_uris(points, compact, uri, level)


def run_refreshing(points: DataFrame, folder: str, path: str, checkpoint: str, uri: str = "geo_uri", level: int = 5, **trigger) -> StreamingQuery:
    """Start a query that resolves each micro-batch against the grid's newest version in ``folder`` (see ``write_version``).

    A new version takes effect with the next batch; files of older ones are not touched. A batch is written to a folder
    of its own, overwritten when it is repeated, so no row is lost or doubled. ``trigger`` as for ``writeStream``.
    """

    def resolve(batch: DataFrame, number: int) -> None:
        grid = current_version(batch.sparkSession, folder)
        resolve_uris(batch, grid, uri, level).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    writer = points.writeStream.foreachBatch(resolve).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_available(enriched: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Write all data that is available now to Parquet and return it as a batch DataFrame.

    The checkpoint makes the run repeatable after a failure: files are committed once.
    """
    run = (
        enriched.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return enriched.sparkSession.read.schema(enriched.schema).parquet(path)

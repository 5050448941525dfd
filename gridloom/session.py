"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The JVM never compiles a method above 8,000 bytes; a stage that large runs faster split up.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder that is kept for
    the session; on a cluster no folder of one machine would do, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master or 'the cluster'} share")
    folder = tempfile.mkdtemp(prefix="gridloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: one evaluation for all its uses, and a cut lineage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

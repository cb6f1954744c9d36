"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_session(master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect.

    ``partitions`` fixes the shuffle width for local runs. On a cluster leave it unset: AQE coalesces
    from the configured maximum.
    """
    builder = SparkSession.builder.appName("millrace")
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, which the session then keeps.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives lost executors, so a fitted table is computed once however many
    joins read it.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

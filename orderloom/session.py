"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "orderloom", master: str | None = None, shuffle_partitions: int | None = None,
                  **settings: str) -> SparkSession:
    """Session for the library's jobs. On a cluster leave ``master`` to spark-submit; adaptive execution
    merges small shuffle partitions, so ``shuffle_partitions`` may be generous."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach, below ``spark.checkpoint.dir``.

    A local-mode session without that setting uses its warehouse folder; on a cluster a missing setting is an error, as
    a driver-local folder would be invisible to the executors."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

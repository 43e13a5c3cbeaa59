"""Session settings and the shared scratch folder.

Library functions never change session settings: a caller on a cluster brings
its own session.  :func:`build_session` is for local runs, tests and the bench.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings this library is designed around.  AQE coalesces small shuffle
#: partitions and splits skewed ones, so no partition count is tuned by hand.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    # the JVM does not compile larger methods: run such stages operator by operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "tripstrata", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with :data:`RECOMMENDED_CONF`, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else ``fallback``.

    Nothing is guessed: a machine-local temporary folder would lose its data
    with the executor that wrote it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share, or pass one")
    return folder.rstrip("/")

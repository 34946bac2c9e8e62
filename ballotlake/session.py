"""Session construction and the few settings the operators rely on."""

from __future__ import annotations


from pyspark.sql import SparkSession

# Settings every job in this package assumes. AQE re-plans joins from
# measured sizes (runtime broadcast, skew-join splitting, partition
# coalescing); UTC keeps date arithmetic independent of the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "ballotlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults applied.

    ``master`` is only used when no session exists yet; on a cluster the
    launcher decides it. ``shuffle_partitions`` should be sized so one
    shuffle partition is ~128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    return spark

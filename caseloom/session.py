"""Session settings and the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every deployment wants; sizes stay at Spark's defaults unless the caller sets them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call-site capture on every column expression doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Shuffle data one task should handle.
PARTITION_BYTES = 64 * 1024 * 1024


def build_session(app: str, master: str | None = None, input_bytes: int | None = None,
                  cores: int | None = None, **settings: str) -> SparkSession:
    """A session with the package's settings; with ``input_bytes`` and ``cores`` known, also
    with as many shuffle partitions as the data needs."""
    if input_bytes is not None and cores:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores)))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions: at least one per 64 MB of input, in whole waves of the cores.

    AQE merges small partitions but never splits an initial one that is merely large, so
    the count follows the data.
    """
    wanted = max(1, -(-input_bytes // PARTITION_BYTES))
    return wanted if wanted < cores else -(-wanted // cores) * cores


def scratch_root(spark: SparkSession) -> str:
    """Folder for tables written between steps, shared by driver and executors.

    It lies below ``spark.checkpoint.dir``, or, where that is unset, below the session's
    warehouse folder (``spark.sql.warehouse.dir``), which all executors share too.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/caseloom-{spark.sparkContext.applicationId}"

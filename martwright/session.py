"""Session settings the library relies on or profits from."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Malformed values must raise in staging casts (ANSI), skewed joins must be split and
#: small shuffles merged at run time (AQE).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Noting the Python call site of every column expression slows down the building of plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_PARTITION_BYTES = 256 * 1024**2


def cluster_settings(shuffled_bytes: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about ``shuffled_bytes``.

    AQE merges small partitions and splits skewed ones in joins, but doesn't split evenly large
    ones: a shuffle must start with enough of them to fit in an executor's memory.
    """
    partitions = max(shuffled_bytes // _PARTITION_BYTES, 200)
    return SETTINGS | {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_PARTITION_BYTES),
    }


def object_store_settings(endpoint: str, key: str, secret: str, tls: bool = False) -> dict[str, str]:
    """Access to an S3-like store that is addressed by path; any other Hadoop path works without."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": key,
        "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def build_session(app_name: str = "martwright", settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in (settings or SETTINGS).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

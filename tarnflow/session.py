"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. Everything here can be set on a session that is already running.
SQL_SETTINGS = {
    # Zone-less event times mean UTC, and the stored mark is read back as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # HotSpot does not compile methods above 8000 bytes of code: fall back before that.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # JSON objects with a repeated key keep the last value instead of failing the row.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Skewed join sides are split, and rebalanced writes get files of a sane size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The key lookup of an upsert is a semi join of a big table with an increment. Let Spark build
    # its Bloom filter from increments of some size too, with room for some million keys.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512m",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "67108864",
}


def build_session(app_name: str = "tarnflow", **settings: str) -> SparkSession:
    """A session with the settings above; keyword arguments use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SQL_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the same settings to a session somebody else made."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse to run in another zone: it would silently shift the high-water mark."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, got {zone!r}")

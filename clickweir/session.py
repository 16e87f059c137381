"""Session building and the few SQL settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_ZONE = "UTC"

# Runtime SQL settings: safe to apply to a session somebody else created.
RUNTIME_SETTINGS = {
    # A repeated query parameter keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # HotSpot leaves methods above 8000 bytes of bytecode uncompiled; with this limit
    # Spark runs such a stage operator by operator instead of in one slow method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sessions of one task are merged before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession, zone: str = DEFAULT_ZONE) -> SparkSession:
    """Apply the runtime settings and pin the time zone used by all date maths."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def build_session(
    app_name: str,
    master: str | None = None,
    zone: str = DEFAULT_ZONE,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a configured session; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    spark = configure(builder.getOrCreate(), zone)
    for name, value in (settings or {}).items():
        if spark.conf.isModifiable(name):
            spark.conf.set(name, value)
    return spark

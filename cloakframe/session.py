"""Session defaults that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings every session of the engine should have. Sizes (partitions,
#: memory, splits) are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "cloakframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS, then ``conf`` (dots written as double underscores)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

"""Session settings and the fixed parameters of the warehouse."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Zone, window and delays the results depend on.
ZONE = "Asia/Shanghai"
DATABASE = "shop"  # the name operators know the source database by
WINDOW = "10 seconds"
LOG_DELAY = "3 seconds"
CHANGE_DELAY = "5 seconds"
JOIN_RETENTION = "5 minutes"
JOIN_RETENTION_MS = 5 * 60 * 1000
PAY_BEFORE = "15 minutes"
PAY_AFTER = "5 seconds"
DAY_MS = 24 * 60 * 60 * 1000
RETURN_AFTER_MS = 7 * DAY_MS
DAILY_TTL_MS = DAY_MS
DELTA_TTL_MS = 30 * 1000

SETTINGS = {
    "spark.sql.session.timeZone": ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(app: str = "rivermill", master: str | None = None, **overrides: str) -> SparkSession:
    """Session with the warehouse defaults; ``overrides`` use ``__`` for ``.`` in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

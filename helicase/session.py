"""A session with the settings that the engine's plans assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "helicase", master: str | None = None, **settings: str) -> SparkSession:
    """ANSI SQL, UTC, adaptive execution with skew joins; settings override (dots as __)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.executorEnv.OMP_NUM_THREADS": "1",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

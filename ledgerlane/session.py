"""Session defaults shared by tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What the jobs need of any session that runs them.
SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session the settings that the jobs need."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session. On a cluster the caller passes its own session to the jobs instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlane")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)

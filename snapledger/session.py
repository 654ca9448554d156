"""The session the engine is written for: UTC, adaptive execution, ANSI casts."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "snapledger", **more: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=SETTINGS | more).getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for what is written on the way: spark.checkpoint.dir, else the warehouse's."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    return at.rstrip("/") if at else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/snapledger-work"

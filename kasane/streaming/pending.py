"""The pending log as a stream: entries are replay-safe, so each identifier passes once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.sources.landing import PENDING


def stream(spark: SparkSession, path: str) -> DataFrame:
    """New lines of the log files of a folder."""
    return spark.readStream.schema(PENDING).json(path).where("id is not null")


def first_entries(rows: DataFrame, keep: str = "7 days") -> DataFrame:
    """Each id once; replays within ``keep`` of event time are dropped, and the state of older ids is let go."""
    timed = rows.withColumn("at", F.to_timestamp("ts"))
    return timed.withWatermark("at", keep).dropDuplicatesWithinWatermark(["id"])


def counts(rows: DataFrame, window: str = "1 day") -> DataFrame:
    """Entries by day and kind, late ones included up to the watermark."""
    return rows.groupBy(F.window("at", window), "kind").agg(F.count("*").alias("n"))

"""Streams of telemetry: class sizes of hours that are over. The batch engine needs whole classes, and so does a stream: an
hour's classes are final once the watermark has passed its end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import APP, CELL, PROVINCE, RAT, Settings


def closed_hour_classes(events: DataFrame, time: str = "ts", delay: str = "1 hour", keys: tuple[str, ...] = (PROVINCE, RAT, CELL, APP), settings: Settings = Settings()) -> DataFrame:
    """(hour, *keys, n, small) of a stream with a timestamp column; append mode gives each class once its hour is closed.

    Rows that come more than ``delay`` after the newest time seen are late and not counted.
    """
    present = [k for k in keys if k in events.columns]
    sizes = events.withWatermark(time, delay).groupBy(F.window(time, "1 hour"), *present).agg(F.count("*").alias("n"))
    return sizes.select(F.col("window.start").alias("hour"), *present, "n", (F.col("n") < settings.k_min).alias("small"))


def device_sessions(events: DataFrame, time: str = "ts", gap: str = "1 hour", delay: str = "1 hour", device: str = "imei") -> DataFrame:
    """(device, start, end, rows): runs of a device's rows without a pause of ``gap``."""
    sessions = events.withWatermark(time, delay).groupBy(F.session_window(time, gap), F.col(device)).agg(F.count("*").alias("rows"))
    return sessions.select(F.col(device), F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "rows")

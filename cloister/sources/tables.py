"""Scans and sinks: telemetry files, the telemetry view of an event table, reports."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import APP, CELL, DEVICE, IDENTIFIERS, KPIS, METRICS, PROVINCE, RAT, TIME, VOLUMES, cell_column
from ..functions.columns import draw, text, without_nan

#: How an event (event_id, ts, user_id, event_type, value) reads as telemetry; `sec` and `hod` are its second and hour of day.
TELEMETRY = {
    "row_id": "event_id",
    "time_start": "sec",
    "msisdn": "concat('+35840', lpad(cast(user_id as varchar(20)), 7, '0'))",
    "imsi": "concat('24491', lpad(cast(user_id as varchar(20)), 10, '0'))",
    "imei": "concat('35', lpad(cast(user_id % 25 as varchar(20)), 6, '0'), lpad(cast(user_id as varchar(20)), 7, '0'))",
    "province": "case when event_id % 97 = 0 then null when user_id % 10 < 5 then 'P0' when user_id % 10 < 8 then 'P1' else 'P2' end",
    "radio_access_type": "case when user_id % 4 = 0 then '4G' else '5G' end",
    "enb_id": "cast(case when hod < 6 or hod >= 22 then user_id % 20 + 1 when hod >= 9 and hod < 17 then (user_id * 7) % 20 + 1 else (user_id + hod) % 20 + 1 end as bigint)",
    "application_category": "event_type",
    "tp_dl_avg": "value * (1 + user_id % 7) / 10",
    "tp_ul_avg": "value * (1 + user_id % 5) / 40",
    "tp_dl_filtered_avg": "case when event_id % 10 < 3 then null else value * (1 + user_id % 7) / 7 end",
    "cont_rtt_radio_avg": "40 + user_id % 11 + value / 100",
    "cont_rtt_internet_avg": "60 + user_id % 13 + value / 90",
    "initial_rtt_radio_avg": "30 + user_id % 17 + value / 80",
    "tcp_retrans_byte_ratio_downlink_avg": "(1 + user_id % 9) / 1000.0e0 + value / 1000000",
    "tcp_retrans_byte_ratio_uplink_avg": "(1 + user_id % 6) / 1000.0e0 + value / 2000000",
    "http_response_time_avg": "200 + (user_id % 19) * 3 + value / 50",
    "http_sr_avg": "case when event_type = 'error' then 0.5e0 else 0.9e0 + (user_id % 10) / 100.0e0 end",
    "data_GB_sum": "value / 1000",
    "im_video_GB_sum": "case when event_type = 'view' then value / 1250 else 0.0e0 end",
    "im_audio_GB_sum": "case when event_type = 'click' then value / 2000 else 0.0e0 end",
    "tethering_data_GB_dl_sum": "case when event_type = 'purchase' then value / 1700 else 0.0e0 end",
}

SCHEMA = T.StructType(
    [
        T.StructField(TIME, T.StringType()),
        *[T.StructField(c, T.StringType()) for c in IDENTIFIERS],
        *[T.StructField(c, T.StringType()) for c in (CELL, PROVINCE, RAT, APP)],
        *[T.StructField(c, T.DoubleType()) for c in KPIS],
    ]
)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as raw telemetry with a row id."""
    sec = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("sec", F.expr(sec))
    events = events.withColumn("hod", F.expr("cast(floor(sec / 3600) as bigint) % 24"))
    return without_nan(events.selectExpr(*[f"{e} as `{c}`" for c, e in TELEMETRY.items()]))


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """A telemetry file. Its header decides which columns there are and in what order; ids and labels are text.

    ``columns`` prunes the scan; ``rows`` keeps the first rows of a file for trials.
    """
    header = spark.read.option("header", True).csv(path).columns
    kinds = {f.name: f.dataType for f in SCHEMA.fields} | {"enb": T.StringType(), "gt_user": T.StringType(), "gt_row_id": T.LongType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    out = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    out = without_nan(out.select(*[F.col(f"`{c}`") for c in columns]) if columns else out)
    if rows is None:
        return out
    place = F.monotonically_increasing_id().alias("__place")
    return out.select("*", place).orderBy("__place").limit(rows).drop("__place")


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Rows of a scan numbered from 0 in the order of its partitions: each row's place in its own, after the sizes of those
    before. ``df`` must be a scan of files, perhaps projected or filtered, whose partitions are the same each time."""
    marked = df.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__place"))
    sizes = marked.groupBy("__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    first = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    here = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.join(F.broadcast(first), "__part").select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__first") + here).alias(name))


def with_truth(raw: DataFrame, row: str = "row_id") -> DataFrame:
    """Tags that attacks are scored by: the subscriber and the row."""
    if "msisdn" not in raw.columns:
        raise ValueError("msisdn is needed to tell subscribers apart")
    return raw.withColumn("gt_user", F.col("msisdn")).withColumn("gt_row_id", F.col(row))


def original_for_utility(raw: DataFrame) -> DataFrame:
    """Raw rows without identifiers and time, which utility never reads; the cell is text under one name."""
    out = raw.drop(*IDENTIFIERS, TIME)
    cell = cell_column(out.columns)
    return out.withColumnRenamed(cell, CELL).withColumn(CELL, text(F.col(CELL))) if cell else out


def release_for_utility(release: DataFrame) -> DataFrame:
    """Only the columns that utility measures read."""
    allowed = [c for c in ("row_id", DEVICE, CELL, PROVINCE, RAT, APP, *KPIS) if c in release.columns]
    return release.select(*allowed).withColumn(CELL, text(F.col(CELL)))


def with_device_type(df: DataFrame, device: str = DEVICE, row: str = "row_id", seed: int = 0) -> DataFrame:
    """A device type: the type allocation code plus a pseudorandom 0 to 20."""
    extra = F.conv(F.substring(draw(seed, F.col(row)), 1, 4), 16, 10).cast("long") % 21
    return df.withColumn("device_type", (F.col(device).try_cast("long") + extra).cast("string"))


def synthetic_telemetry(spark: SparkSession, users: int = 1200, days: int = 4, per_day: int = 6, seed: int = 1) -> DataFrame:
    """Raw telemetry of invented subscribers: a home and a work cell, a device model and a stable profile each."""
    def chance(*keys: str):  # noqa: ANN202
        return F.conv(F.substring(draw(seed, *[F.col(k) if k in ("user", "event") else F.lit(k) for k in keys]), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))

    rows = spark.range(users * days * per_day).select((F.col("id") % users).alias("user"), F.floor(F.col("id") / users).alias("event"), F.col("id").alias("row_id"))
    hour = F.floor(F.col("event") / per_day) * 24 + F.floor(chance("user", "event", "hour") * 24)
    rows = rows.withColumn("hour", hour).withColumn("hod", F.col("hour") % 24)
    cell = F.when(F.col("hod").between(9, 16), F.floor(chance("user", "work") * 40)).when((F.col("hod") < 6) | (F.col("hod") >= 22), F.floor(chance("user", "home") * 40)).otherwise(F.floor(chance("user", "event", "cell") * 40))
    profile, noise = 0.5 + chance("user", "profile"), 0.9 + 0.2 * chance("user", "event", "noise")
    model = F.floor(60 * F.pow(chance("user", "model"), F.lit(2.0)))
    apps = F.array(*[F.lit(a) for a in ("video", "social", "web", "games", "vpn")])
    return rows.select(
        "row_id",
        (F.col("hour") * 3600 + F.floor(chance("user", "event", "second") * 3600)).cast("long").alias(TIME),
        F.concat(F.lit("+35840"), F.lpad(F.col("user").cast("string"), 7, "0")).alias("msisdn"),
        F.concat(F.lit("24491"), F.lpad(F.col("user").cast("string"), 10, "0")).alias("imsi"),
        F.concat(F.lit("35"), F.lpad(model.cast("string"), 6, "0"), F.lpad(F.col("user").cast("string"), 7, "0")).alias(DEVICE),
        (cell + 1).cast("long").alias(CELL),
        F.concat(F.lit("P"), F.floor(cell / 8).cast("string")).alias(PROVINCE),
        F.when(chance("user", "rat") < 0.3, "4G").otherwise("5G").alias(RAT),
        F.element_at(apps, (F.floor(chance("user", "event", "app") * 5) + 1).cast("int")).alias(APP),
        *[(F.lit(float(i + 1)) * profile * noise).alias(c) for i, c in enumerate(KPIS)],
    )


def linkage_frame(spark: SparkSession, devices: int = 30, hours: int = 6) -> DataFrame:
    """Devices that each stay in a cell of their own, a row an hour: the worst case of linkage."""
    device = F.col("id") % devices
    return spark.range(devices * hours).select(
        F.col("id").alias("row_id"),
        F.floor(F.col("id") / devices).cast("long").alias(TIME),
        (device + 1).cast("string").alias(CELL),
        F.concat(F.lit("35"), F.lpad(device.cast("string"), 6, "0")).alias(DEVICE),
        F.concat(F.lit("P"), (device % 3).cast("string")).alias(PROVINCE),
        F.lit("5G").alias(RAT),
        F.when(device % 2 == 0, "A").otherwise("B").alias(APP),
    )


def audit_demo(spark: SparkSession, key: str | None = None, users: int = 800, days: int = 14, seed: int = 1) -> DataFrame:
    """Telemetry for trying the audit on: times as ISO texts, a cell ``enb``, five measurements and three volumes.
    Without a ``key`` subscribers are plain digests of their numbers and devices are told; with one the digests are keyed
    and devices are left out."""
    raw = synthetic_telemetry(spark, users, days, seed=seed)
    number = F.col("msisdn") if key is None else F.concat(F.lit(f"{key}:"), F.col("msisdn"))
    return raw.select(
        "row_id",
        F.date_format(F.timestamp_seconds(TIME), "yyyy-MM-dd'T'HH:mm:ss").alias(TIME),
        F.col(CELL).cast("string").alias("enb"),
        *[F.col(c) for c in (PROVINCE, RAT, APP, *METRICS[:5], *VOLUMES[:3])],
        F.sha2(number, 256).alias("msisdn"),
        *([DEVICE] if key is None else []),
    )


def utility_frames(spark: SparkSession, rows: int = 30_000, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(original, anonymised) for trying utility measures on: three tenths of one measurement missing; about 97 of a hundred
    rows stay, with noise of up to 2 % on another."""
    users = max(1, rows // 24)
    raw = synthetic_telemetry(spark, users, -(-rows // (users * 6)), seed=seed).filter(F.col("row_id") < rows)
    share = lambda use: F.conv(F.substring(draw(seed, F.col("row_id"), F.lit(use)), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    gaps = F.when(share("gap") >= 0.3, F.col("tp_dl_filtered_avg")).alias("tp_dl_filtered_avg")
    orig = original_for_utility(raw.select(*[gaps if c == "tp_dl_filtered_avg" else F.col(c) for c in raw.columns]))
    return orig, orig.filter(share("stay") < 0.97).withColumn("tp_dl_avg", F.col("tp_dl_avg") * (0.98 + 0.04 * share("noise")))


def write_release(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """The release candidate as Parquet or CSV, in as many files as it has partitions."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)


def write_report(report: Any, path: str | Path) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(report, indent=2, default=str), encoding="utf-8")


def append_log(entry: dict, path: str | Path) -> None:
    """One JSON line at the end of a log."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("a", encoding="utf-8") as f:
        f.write(json.dumps(entry, default=str) + "\n")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of the files under a path, for the audit trail."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def file_sha256(path: str | Path) -> str:
    h = hashlib.sha256()
    with Path(path).open("rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()

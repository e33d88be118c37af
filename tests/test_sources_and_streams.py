"""Files in and out, and streams over files."""

from pyspark.sql import functions as F

from cloister.config import Settings
from cloister.operators import release
from cloister.sources import tables
from cloister.streaming import classes


def test_csv_round_trip(spark, tmp_path):
    raw = tables.synthetic_telemetry(spark, users=8, days=1).drop("row_id")
    tables.write_release(raw.coalesce(1), str(tmp_path / "raw"), "csv")
    back = tables.read_csv(spark, str(tmp_path / "raw"))
    assert back.columns == raw.columns and back.count() == raw.count()
    assert {t for c, t in back.dtypes if c in ("msisdn", "imsi", "imei", "enb_id")} == {"string"}
    pruned = tables.read_csv(spark, str(tmp_path / "raw"), ["imei", "time_start"], rows=3)
    assert pruned.count() == 3
    numbered = tables.with_row_ids(back)
    assert sorted(r["row_id"] for r in numbered.select("row_id").collect()) == list(range(raw.count()))
    assert tables.with_truth(numbered).select("gt_user").distinct().count() == 8
    out = release.release(numbered, Settings(k_min=2, qi_include_tac=False))
    assert not {"msisdn", "imsi"} & set(out.columns)
    tables.write_release(out, str(tmp_path / "out"))
    assert tables.file_digests(spark, str(tmp_path / "raw")).filter("path like '%.csv'").first()["sha256"] == tables.file_sha256(next((tmp_path / "raw").glob("*.csv")))


def test_generators(spark):
    frame = tables.linkage_frame(spark)
    assert frame.count() == 180 and frame.groupBy("enb_id").agg(F.countDistinct("imei").alias("n")).filter("n > 1").isEmpty()
    plain, keyed = (tables.audit_demo(spark, key, users=20, days=2) for key in (None, "secret"))
    assert plain.count() == keyed.count() == 240 and "imei" in plain.columns and "imei" not in keyed.columns
    assert plain.join(keyed, "msisdn", "left_semi").isEmpty() and keyed.select("msisdn").distinct().count() == 20
    assert plain.filter("time_start rlike '^\\\\d{4}-\\\\d{2}-\\\\d{2}T'").count() == 240
    orig, anon = tables.utility_frames(spark, rows=3000)
    n, missing = orig.agg(F.count("*"), F.sum(F.col("tp_dl_filtered_avg").isNull().cast("int"))).first()
    assert n == 3000 and 800 < missing < 1000 and 2850 < anon.count() < 2960
    moved = orig.join(anon.select("row_id", F.col("tp_dl_avg").alias("x")), "row_id").agg(F.max(F.abs(F.col("x") / F.col("tp_dl_avg") - 1))).first()[0]
    assert 0 < moved <= 0.02 + 1e-9


def test_pruning_reaches_the_scan(spark):
    plan = tables.original_for_utility(tables.telemetry(spark, "/root/testdata/sf0.001")).select("province")._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan.split("ReadSchema")[-1]


def stream(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "s long, province string, radio_access_type string, enb_id long, application_category string, imei string")
    for k in range(df.agg(F.max("s")).first()[0] // 7200 + 1):
        df.filter(F.floor(F.col("s") / 7200) == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{k}"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*")).withColumn("ts", F.timestamp_seconds("s"))


def run(query, name, spark, tmp_path):
    q = query.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_hours_close_behind_the_watermark(spark, tmp_path):
    rows = [(h * 3600 + i, "P", "5G", 1, "web", "d") for h in range(8) for i in range(h + 1)]
    out = run(classes.closed_hour_classes(stream(spark, tmp_path, rows), settings=Settings(k_min=3)), "closed", spark, tmp_path)
    got = {r["hour"].hour: (r["n"], r["small"]) for r in out.collect()}
    assert got and all(n == h + 1 and small == (n < 3) for h, (n, small) in got.items()) and 7 not in got


def test_device_sessions(spark, tmp_path):
    rows = [(s, "P", "5G", 1, "web", "d") for s in (0, 600, 1200, 9000, 9100, 40000)]
    out = run(classes.device_sessions(stream(spark, tmp_path, rows), gap="30 minutes"), "sessions", spark, tmp_path)
    assert sorted(r["rows"] for r in out.collect()) == [2, 3]

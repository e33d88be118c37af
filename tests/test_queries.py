"""Every query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from cloister.plans import catalogue

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    return con


def rows(values, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = lambda x: "nan" if isinstance(x, float) and math.isnan(x) else repr(x + 0.0) if isinstance(x, float) else repr(x)
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tables, name):
    got = QUERIES[name](spark, SMALL)
    want = tables.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), names)


def test_every_query_has_sql_but_models():
    assert set(QUERIES) - set(SQL) == {"downstream_models", "application_recovery", "utility_scorecard_whole"}


def test_models_run(spark):
    for name in ("downstream_models", "application_recovery"):
        assert QUERIES[name](spark, SMALL).count() >= 1
    assert {"M1", "M8", "M9"} <= {r["metric"] for r in QUERIES["utility_scorecard_whole"](spark, SMALL).collect()}


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert "imei" in df.columns and not {"msisdn", "imsi"} & set(df.columns)
    assert set(SQL) <= set(__spark_entry__.oracle_sql()) and set(QUERIES) <= set(__spark_entry__.queries())


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory):
    """(directory, connection): events whose median throughput is the same in every province."""
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    kinds = dict(events.dtypes)
    tenth = F.floor(F.col("event_id") / 10) % 10
    path = str(tmp_path_factory.mktemp("tied"))
    events.select(
        "event_id", F.date_trunc("day", "ts").cast(kinds["ts"]).alias("ts"), (F.col("user_id") * 7).cast(kinds["user_id"]).alias("user_id"), "event_type",
        F.when(tenth == 0, 10.0).when(tenth == 1, 30.0).otherwise(20.0).alias("value"), "props",
    ).write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}/events.parquet/*.parquet'")
    return path, con


def same_on_tied(spark, tied, name):
    path, con = tied
    want = con.execute(SQL[name])
    got, names = QUERIES[name](spark, path), [d[0] for d in want.description]
    found = rows([tuple(r) for r in got.collect()], got.columns)
    assert found == rows(want.fetchall(), names)
    return found


def test_finding_gap_of_tied_provinces(spark, tied):
    found = same_on_tied(spark, tied, "finding_gap")
    assert ("'province_ranking_spearman'", "'PASS'", "None") in found


def test_scorecard_of_tied_provinces(spark, tied):
    assert ("2", "'M7'", "2", "'PASS'") in same_on_tied(spark, tied, "utility_scorecard")


def test_whole_scorecard_of_tied_provinces(spark, tied):
    path, con = tied
    want = con.execute(SQL["utility_scorecard"])
    names = [d[0] for d in want.description]
    got = QUERIES["utility_scorecard_whole"](spark, path).select(*names).collect()
    assert rows([tuple(r) for r in got if r["metric"] != "M8"], names) == rows(want.fetchall(), names)
    assert [r["items"] for r in got if r["metric"] == "M8"] == [2]


def test_high_numbers_are_enumerated(spark, tmp_path):
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.withColumn("user_id", (F.col("user_id") + 2_500_000).cast(events.schema["user_id"].dataType)).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["pseudonym_enumeration_whole"](spark, str(tmp_path)).first()
    assert found["recovered"] == found["targets"] > 0 and found["candidates"] == 6_000_000 and found["status"] == "FAIL"


def test_whole_scorecard_reads_events_once(spark, monkeypatch):
    from cloister.operators import learned, utility
    from cloister.plans import queries

    seen = []

    def models(o, a, settings):
        seen.extend([o.storageLevel.useDisk, a.storageLevel.useDisk])
        return spark.createDataFrame([("r2_ratio", 1.0, "PASS"), ("f1_ratio", None, "FAIL")], "item string, value double, status string")

    monkeypatch.setattr(learned, "downstream", models)
    o, a = queries.utility_pair(spark, SMALL)
    card = queries.whole_scorecard(o, a)
    assert seen == [True, True] and not (o.storageLevel.useDisk or a.storageLevel.useDisk)
    assert "FileScan" not in card._jdf.queryExecution().executedPlan().toString()
    got = {r["metric"]: (r["items"], r["passed"], r["status"]) for r in card.collect()}
    plain = {r["metric"]: (r["items"], r["passed"], r["status"]) for r in utility.scorecard(utility.detail(o, a)).collect()}
    assert got == plain | {"M8": (2, 1, "FAIL")}

"""Small frames whose results are known by hand, and properties that hold for any table."""

import hashlib
import json
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cloister.config import APP, CELL, DEVICE, PROVINCE, RAT, TIME, Settings, subscriber_column, worst
from cloister.functions import columns as C
from cloister.operators import attacks, audit, linkage, points, profile, release, review, utility
from cloister.sources import tables


def events(spark, rows, cell="bigint"):
    return spark.createDataFrame([tuple(r) for r in rows], f"row_id long, {TIME} long, {PROVINCE} string, {RAT} string, {CELL} {cell}, {APP} string, {DEVICE} string")


def test_null_class_survives(spark):
    df = events(spark, [(i, 3600, None, "5G", 7, "web", "12345678") for i in range(12)])
    assert release.enforce_k(df, Settings(k_min=10)).count() == 12


def test_merged_restricted_class_survives(spark):
    df = events(spark, [(i, 3600, "P", "5G", 7, "web" if i < 2 else "mail", "12345678") for i in range(4)])
    out = release.enforce_k(df, Settings(k_min=4))
    assert out.count() == 4 and {r[APP] for r in out.collect()} == {"RESTRICTED"} and {r[CELL] for r in out.collect()} == {7}
    assert [r["action"] for r in release.suppression_report(df.withColumn(TIME, F.col(TIME) * 1), Settings(k_min=4)).orderBy("step").collect()] == ["restrict", "drop", "keep"]


def test_no_small_class_no_pass(spark):
    df = events(spark, [(i, 3600, "P", "5G", 7, "web", "12345678") for i in range(4)])
    assert [(r["action"], r["rows"]) for r in release.suppression_report(df, Settings(k_min=4)).orderBy("step").collect()] == [("drop", 0), ("keep", 4)]


@pytest.mark.parametrize(("kind", "sentinel"), [("bigint", 0), ("string", "RESTRICTED")])
def test_cell_sentinel(spark, kind, sentinel):
    rows = [(i, 3600, "P", "5G", i + 1 if kind == "bigint" else f"c{i}", "web", "12345678") for i in range(3)]
    out = release.enforce_k(events(spark, rows, kind), Settings(k_min=3)).collect()
    assert len(out) == 3 and {r[CELL] for r in out} == {sentinel}


def test_both_forms_of_the_walk_agree_and_are_idempotent(spark):
    raw = tables.synthetic_telemetry(spark, users=60, days=2)
    s = Settings(k_min=2, qi_include_tac=False)
    g = release.generalise(raw, s)
    a, b = release.enforce_k(g, s), release.enforce_k_by_windows(g, s)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert release.enforce_k(a, s).count() == a.count() > 0
    qi = release.quasi_identifiers(a.columns, False)
    assert a.groupBy(*qi).count().agg(F.min("count")).first()[0] >= 2
    assert a.count() + g.exceptAll(g.join(a, "row_id", "left_semi")).count() == g.count()


def test_significant_figures(spark):
    xs = [0.0, -12345.678, 0.00098765, 1e-300, 2.5, float("nan"), float("inf"), None]
    df = spark.createDataFrame([Row(i=i, x=x) for i, x in enumerate(xs)], "i int, x double").orderBy("i")
    got = [r[0] for r in df.select(C.sig_round(F.col("x"), 3)).collect()]
    assert got[:3] == [0.0, -12300.0, 0.000988] and got[3] == pytest.approx(1e-300) and got[6] is None and got[7] is None
    finite = [r[0] for r in df.select(C.sig_round_finite(F.col("x"), 3)).collect()]
    assert finite[6] == float("inf") and str(finite[5]) == "nan"
    assert [r[0] for r in df.select(C.sig_round_finite(F.col("x"), 3, F.lit(None).cast("double"))).collect()][5:] == [None, None, None]
    assert df.limit(5).select(C.sig_round(F.col("x"), 1)).collect()[4][0] == 2.0  # half to even


def test_tac_and_time(spark):
    df = spark.createDataFrame([Row(a=" 3512345678", t="7199"), Row(a="", t="-1"), Row(a="nan", t="x"), Row(a=None, t=None)], "a string, t string")
    assert [tuple(r) for r in df.select(C.tac(F.col("a")), C.hour_index(F.col("t"))).collect()] == [("35123456", 1), (None, -1), (None, None), (None, None)]
    assert spark.range(1).select(C.day_of_week(F.lit(0)), C.hour_of_day(F.lit(-1))).first()[:] == (3, 23)


def test_time_units(spark):
    df = spark.createDataFrame([Row(time_start="1970-01-01T01:30:00Z")])
    assert audit.prepared(df, "iso").first()[TIME] == 1
    ms = spark.createDataFrame([Row(time_start=1_700_000_000_000)])
    assert audit.prepared(ms, "auto").first()[TIME] == 1_700_000_000 // 3600
    assert audit.prepared(spark.createDataFrame([Row(time_start=5)]), "hour").first()["hod"] == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hours_do_not_follow_the_session_zone(spark, zone):
    df = spark.createDataFrame([Row(time_start=1_700_000_000)])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert audit.prepared(df).first()["hod"] == 22 and audit.prepared(df, tz="Europe/Helsinki").first()["hod"] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_identifier_shapes(spark):
    df = spark.createDataFrame([Row(a="490154203237518"), Row(a="490154203237519")])
    found = {r["pattern"]: r["share"] for r in audit.identifier_scan(df).collect()}
    assert found == {"imei_like": 0.5, "e164_like": 1.0, "imsi_like": 1.0}
    assert audit.identifier_verdict(audit.identifier_scan(spark.createDataFrame([Row(a="x")]))).first()[0] == "PASS"


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("u", c) for c in "baba"], "u string, c string")
    assert audit.modal(df, ["u"], "c", "m").collect() == [Row(u="u", m="a")]


def test_quantiles(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 4.0, 8.0)], "data_GB_sum double")
    r = profile.numeric(df).first()
    assert (r["p25"], r["p50"]) == (1.75, 3.0) and audit.upper_median(df, "data_GB_sum").first()[0] == 4.0


def test_running_total_and_ks_of_itself(spark):
    df = spark.range(500).select(F.lit("g").alias("g"), (F.col("id") * 7 % 501).cast("double").alias("v"), (F.col("id") % 3).alias("w"))
    total = 0
    for r in sorted(C.running_total(df, "g", "v", "w", 8).collect(), key=lambda r: r["v"]):
        assert r["before"] == total
        total += r["w"]
    raw = tables.synthetic_telemetry(spark, users=30, days=1)
    assert {r["ks"] for r in utility.distributions(raw, raw).collect()} == {0.0}
    assert {r["value"] for r in utility.categorical(raw, raw).collect()} == {0.0}
    assert {r["change"] for r in utility.correlation(raw, raw).collect()} == {0.0}


def test_spearman_against_pandas(spark):
    raw = tables.telemetry(spark, "/root/testdata/sf0.001")
    cols = ["tp_dl_avg", "tp_dl_filtered_avg", "im_video_GB_sum"]
    want = raw.select(cols).toPandas().corr(method="spearman")
    for r in utility.spearman(raw, cols).collect():
        assert abs(r["rho"] - want.loc[r["a"], r["b"]]) < 1e-9


def test_tied_medians_are_no_error(spark):
    rows = spark.range(300).selectExpr("id as row_id", f"concat('P', id % 3) as {PROVINCE}", f"if(id % 2 = 0, '4G', '5G') as {RAT}", "cast(id % 3 + 1 as double) as tp_dl_avg")
    tied = rows.withColumn("tp_dl_avg", F.lit(5.0))
    for o, a in ((rows, tied), (tied, rows), (tied, tied)):
        found = {r["item"]: (r["value"], r["status"]) for r in utility.findings(o, a).collect()}
        assert found["province_ranking_spearman"] == (None, "PASS")
    assert {r["item"]: r["value"] for r in utility.findings(rows, rows).collect()}["province_ranking_spearman"] == 1.0


def test_constant_measurements_are_no_error(spark):
    cols = ["tp_dl_avg", "tp_ul_avg", "http_sr_avg"]
    # 49 partitions of uneven sizes: merged variances of equal ranks need not be zero.
    rows = spark.range(0, 1000, 1, 49).selectExpr("id as row_id", "cast(id as double) as tp_dl_avg", "cast(id * 7 % 1000 as double) as tp_ul_avg", "0.9D as http_sr_avg")
    got, want = {(r["a"], r["b"]): r["rho"] for r in utility.spearman(rows, cols).collect()}, rows.toPandas()[cols].corr(method="spearman")
    assert math.isnan(got[cols[0], cols[2]]) and math.isnan(got[cols[1], cols[2]]) and abs(got[cols[0], cols[1]] - want.loc[cols[0], cols[1]]) < 1e-9
    assert [(r["value"], r["status"]) for r in utility.correlation_verdict(utility.correlation(rows, rows)).collect()] == [(0.0, "PASS")]


def stationary(spark, devices=30, hours=6, one_device=False, one_cell=False):
    rows = [(d * hours + h, h, f"P{d % 3}", "5G", 1 if one_cell else d + 1, "AB"[d % 2], "shared" if one_device else f"dev{d:05d}") for d in range(devices) for h in range(hours)]
    return events(spark, rows)


def test_unique_devices_make_whole_chains(spark):
    df = stationary(spark)
    r = {x["link_key"]: x for x in linkage.next_hour(df).collect()}[DEVICE]
    assert (r["chains"], r["chain_len_max"], r["chains_len_ge_2"], r["rows_in_long_chains"]) == (30, 6, 30, 1.0)
    assert {x["unicity"] for x in linkage.chain_unicity(df).filter("link_key = 'imei'").collect()} == {1.0}


def test_one_device_makes_no_chain(spark):
    r = {x["link_key"]: x for x in linkage.next_hour(stationary(spark, one_device=True)).collect()}[DEVICE]
    assert (r["share_rows_unambiguous"], r["chains_len_ge_2"], r["chain_len_p50"]) == (0.0, 0, None)


def test_private_cells_make_classes_of_one(spark):
    assert {r["min_k"] for r in linkage.equivalence(stationary(spark)).collect()} == {1}


def test_runs_break_at_gaps_and_doubled_hours(spark):
    df = events(spark, [(i, h, "P", "5G", 1, "A", "d") for i, h in enumerate((1, 2, 4, 5, 5, 6))])
    got = {}
    for r in linkage.runs(df, (DEVICE,)).collect():
        got.setdefault(r["run"], []).append(r["hour"])
    assert sorted(sorted(x) for x in got.values()) == [[1, 2], [4], [6]]
    null = events(spark, [(i, i, None, "5G", 1, "A", "d") for i in range(3)])
    assert linkage.run_lengths(null, (DEVICE, PROVINCE, RAT)).count() == 3


def test_unicity_by_hand(spark):
    pts = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("b", 3, 1)], "entity string, h int, c int")
    r = {x["p"]: x for x in points.unicity(pts, ["h", "c"], (1, 2), 10, 0).collect()}
    assert (r[2]["eligible"], r[2]["unicity"]) == (2, 1.0)


def test_class_label_bounds(spark):
    raw = audit.prepared(tables.telemetry(spark, "/root/testdata/sf0.001"))
    r = audit.class_labels(raw).agg(F.min("tvd"), F.max("tvd"), F.min("top"), F.max("top")).first()
    assert 0 <= r[0] <= r[1] <= 1 and 0 < r[2] <= r[3] <= 1
    for x in audit.k_risk(raw.withColumn("gt_user", F.col("msisdn")), Settings(k_min=3), "gt_user").collect():
        assert x["share_k1"] <= x["share_below_k"]


def test_row_order_across_stretches(spark, monkeypatch):
    rows = [(i, "u%d" % (i // 5 % 7), i % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, gt_user string, time_start long")
    monkeypatch.setattr(attacks, "STRETCH", 16)
    r = attacks.row_order(df).first()
    pairs = list(zip(rows, rows[1:]))
    assert r["adjacent_same_user"] == round(sum(a[1] == b[1] for a, b in pairs) / len(pairs), 6)
    assert r["time_sorted_share"] == round(sum(b[2] >= a[2] for a, b in pairs) / len(pairs), 6)


def test_empty_tables(spark):
    raw = tables.synthetic_telemetry(spark, users=10, days=1).limit(0)
    assert release.release(raw).count() == 0
    assert linkage.unique_runs(release.release(raw)).count() == 5
    assert audit.value_precision(raw).count() == 0 and audit.identifier_scan(raw).count() == 0
    assert audit.home_exposure(audit.prepared(raw), "msisdn").first()["status"] == "SKIP"


def test_suite_isolates_errors(spark):
    df = audit.prepared(tables.telemetry(spark, "/root/testdata/sf0.001")).drop("hod")
    out = {r["test"]: r["status"] for r in audit.run(df, "msisdn", "row_id", Settings(k_min=3))}
    assert out["T5"] == "ERROR" and out["T1"] == "FAIL" and out["overall"] in ("FAIL", "ERROR") and len(out) == 10


def test_quantiles_without_gathering(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    groups = {"many": rng.normal(size=700).tolist(), "ties": [1.0] * 9 + [2.0], "one": [3.5], "far": [-1e300, 0.0, 1e300], "odd": [float("inf"), 1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    run = C.running_totals(df.groupBy("g", "v").agg(F.count("*").alias("n")), "g", "v", ["n"], 8)
    shares = (0.0, 0.25, 0.5, 0.999, 1.0)
    got = {r["g"]: r for r in run.groupBy("g").agg(*[C.quantile(s, "v", "n").alias(str(s)) for s in shares]).collect()}
    for g in ("many", "ties", "one", "far"):
        assert [got[g][str(s)] for s in shares] == pytest.approx([float(np.quantile(groups[g], s)) for s in shares], rel=1e-12), g
    assert got["odd"]["0.5"] == 2.0 and got["odd"]["1.0"] == float("inf")
    assert audit.upper_median(spark.createDataFrame([(x,) for x in (5, 1, None, 9, 9)], "ts long"), "ts").first()["cut"] == 9
    assert audit.upper_median(spark.createDataFrame([], "ts long"), "ts").first()["cut"] is None


def test_redaction_check_knows_each_kind():
    sound = {"k_min": 3, "columns": [{"name": "c", "kind": "enb", "cell_size_histogram": {"1": 4}}, {"name": "p", "kind": "allowlisted_categorical", "categories": [{"label": "x", "count": 3}]}]}
    profile.assert_redacted(sound, ["q", ""])
    for more in ({"name": "i", "kind": "identifier_like", "categories": []}, {"name": "t", "kind": "categorical_nolabels", "top_value": "x"}, {"name": "c", "kind": "enb", "cell_size_histogram": {"cell 7": 1}},
                 {"name": "p", "kind": "allowlisted_categorical", "categories": [{"label": "x", "count": 2}]}, {"name": "new", "kind": "other", "values": [1]}):
        with pytest.raises(AssertionError):
            profile.assert_redacted({"k_min": 3, "columns": [more]})
    with pytest.raises(AssertionError, match="stands in"):
        profile.assert_redacted(sound, ["x"])


def test_verdicts():
    assert worst([]) == "SKIP" and worst(["PASS", "WARN", "SKIP"]) == "WARN" and worst(["ERROR", "FAIL"]) == "ERROR"
    assert subscriber_column(["imsi", "x"]) == "imsi" and subscriber_column(["x"]) is None and subscriber_column(["imsi"], "u") == "u"


def test_profile_document(spark):
    raw = tables.telemetry(spark, "/root/testdata/sf0.001")
    p = profile.build(raw, "raw", Settings(k_min=3))
    kinds = {c["name"]: c["kind"] for c in p["columns"]}
    assert (kinds["msisdn"], kinds["enb_id"], kinds["province"], kinds["tp_dl_avg"]) == ("identifier_like", "enb", "allowlisted_categorical", "numeric")
    body = {k: v for k, v in p.items() if k != "profile_sha256"}
    assert p["profile_sha256"] == hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()
    profile.assert_redacted(p, ["+35840"])
    assert profile.leaked_values(raw, p).isEmpty()
    with pytest.raises(AssertionError):
        profile.assert_redacted(p, ["P0"])
    with pytest.raises(ValueError, match="subject"):
        profile.build(raw, "other")


def reply(names, **more):
    return json.dumps({"columns": [{"name": n, "proposed_class": "quasi-identifier" if n == "imei" else "kpi", "rationale": "r", "checks": [{"tests_py_id": "T3"}]} for n in names], "open_questions": [{"text": "why?", "must_answer_proposed": True}], **more})


def test_review_life(tmp_path):
    p = {"subject": "release_candidate", "columns": [{"name": "imei", "type": "string"}, {"name": "x", "type": "double"}], "profile_sha256": "0"}
    r = review.assemble(p, review.read_reply("```json\n" + reply(["imei", "x"]) + "\n```"))
    assert r["shareable_release_candidate"]
    with pytest.raises(review.ReviewError, match="data owner"):
        review.sign(r, "col:imei", "accepted", "ann", "engineer")
    review.sign(r, "col:imei", "accepted", "ann", "data_owner")
    review.must_answer(r, "q1", True, "ann", "engineer")
    assert not r["shareable_release_candidate"] and review.blockers(r) == ["q1"]
    review.answer(r, "q1", "because", "ann", "engineer")
    assert r["shareable_release_candidate"] and "because" in review.markdown(r)
    with pytest.raises(review.ReviewError, match="differ"):
        review.assemble(p, review.read_reply(reply(["x"])))
    for bad in ("no", "{}", reply(["x", "x"]), reply(["x"]).replace("T3", "T99"), reply(["x"]).replace('"kpi"', '"odd"')):
        with pytest.raises(review.ReviewError):
            review.read_reply(bad)
    tables.write_report(r, tmp_path / "a" / "r.json")
    tables.append_log({"a": 1}, tmp_path / "l.jsonl")
    assert json.loads((tmp_path / "a" / "r.json").read_text())["subject"] == "release_candidate" and (tmp_path / "l.jsonl").read_text() == '{"a": 1}\n'


def test_scored_claims(spark):
    claims = spark.createDataFrame([(1, "a", 0.9), (1, "b", 0.9), (2, "c", 0.5)], "claim int, candidate string, confidence double")
    truth = spark.createDataFrame([(1, "a"), (2, "d"), (3, "e")], "claim int, candidate string")
    r = review.score_candidates(claims, truth).first()
    assert (r["claims"], r["answered"], round(r["recall"], 6), round(r["mean_inverse_size"], 6)) == (3, 2, 0.333333, 0.166667)


def test_key_sets_of_the_same_columns(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "b", "x")], "time_start long, enb_id string, application_category string")
    got = {r["keys"]: r["min_k"] for r in audit.k_risk(df).collect()}
    assert got == {"hour+cell": 1, "base": 1, "base+app": 1}
    sizes = audit.class_sizes(df, {"one": ["enb_id"], "two": ["enb_id"], "none": []}).collect()
    assert sorted((r["keys"], r["enb_id"], r["n"]) for r in sizes if r["keys"] != "none") == [(k, c, n) for k in ("one", "two") for c, n in (("a", 2), ("b", 1))]


def test_link_keys_never_run_into_each_other(spark):
    rows = [(1, "c1", "a|=b", "c"), (1, "c2", "a", "b|=c"), (1, "c3", "a|", "=c"), (1, "c4", "a\\", "x"), (1, "c5", "a\\|=x", None), (1, "c6", None, "-")]
    df = spark.createDataFrame(rows, "time_start long, enb_id string, p string, q string")
    got = linkage.hours(df, ("p", "q")).collect()
    assert len(got) == 6 and all(r["n"] == 1 for r in got)


def test_tests_without_columns_are_skipped(spark):
    df = spark.createDataFrame([(3600 * k, k, f"u{k % 3}", "c", k % 24) for k in range(30)], "ts long, time_start long, user string, enb_id string, hod int").withColumn("row", F.col("ts"))
    got = {r["test"]: r["status"] for r in audit.summary(df, "user", "row").collect()}
    assert got["T6"] == got["T7"] == got["T8"] == got["T9"] == "SKIP"
    assert {r["test"]: r["status"] for r in audit.run(df, "user", "row")} == got

"""The engine's queries over an event table: each takes (spark, sf_dir) and returns one small table or a whole relation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import APP, CELL, DEVICE, KPIS, PROVINCE, RAT, TIME, Settings
from ..functions.columns import draw, hour_index, sig_round, tac
from ..operators import attacks, audit, learned, linkage, profile, release, review, utility
from ..sources import tables

#: Ten thousand events spread over a month leave few classes of ten; three keeps enough rows to measure.
SETTINGS = Settings(k_min=3, qi_include_tac=False)
WITH_TAC = Settings(k_min=2, qi_include_tac=True)
HOMES = Settings(k_min=5, qi_include_tac=False)
PREFIX, DIGITS, CANDIDATES = "+35840", 7, 100_000


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.telemetry(spark, sf_dir)


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_truth(raw(spark, sf_dir))


def released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The release candidate with the tags that attacks are scored by."""
    return release.release(tagged(spark, sf_dir), SETTINGS)


def pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return attacks.prepared_release(released(spark, sf_dir), SETTINGS), attacks.prepared_raw(tagged(spark, sf_dir), SETTINGS)


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with hours, for tests that follow subscribers."""
    return audit.prepared(raw(spark, sf_dir), "s")


def as_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return released(spark, sf_dir).drop("gt_row_id")


def utility_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = tables.with_device_type(raw(spark, sf_dir).withColumn(DEVICE, tac(F.col(DEVICE))))
    a = tables.with_device_type(tables.release_for_utility(released(spark, sf_dir)))
    return tables.original_for_utility(o), a.drop(DEVICE)


def qi_class_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = raw(spark, sf_dir).withColumn("hour", hour_index(F.col(TIME)))
    return keyed.groupBy("hour", PROVINCE, RAT, CELL, APP).agg(F.count("*").alias("n")).withColumn("small", F.col("n") < SETTINGS.k_min)


def column_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1's look at a header: (kind, column) of direct identifiers and columns like a row index."""
    df = raw(spark, sf_dir)
    return spark.createDataFrame([(kind, c) for kind, names in attacks.odd_columns(df).items() for c in names], "kind string, `column` string")


def sig_round_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("row_id", *[sig_round(F.col(c), 3).alias(c) for c in KPIS])


def imei_tac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("row_id", tac(F.col(DEVICE)).alias("tac"), hour_index(F.col(TIME)).alias("hour"))


def release_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.release(raw(spark, sf_dir), SETTINGS)


def release_candidate_tac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.release(raw(spark, sf_dir), WITH_TAC)


def release_by_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.enforce_k_by_windows(release.generalise(raw(spark, sf_dir), SETTINGS), SETTINGS).select("row_id", APP, CELL)


def suppression_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.suppression_report(raw(spark, sf_dir), SETTINGS)


def k_risk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.k_risk(as_users(spark, sf_dir), SETTINGS)


def k_risk_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.k_risk(as_users(spark, sf_dir), SETTINGS, "gt_user")


def identifier_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.identifier_scan(raw(spark, sf_dir))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).withColumn("token", F.sha2(F.col("msisdn"), 256))


def pseudonym_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _tokens(spark, sf_dir)
    return audit.pseudonym_shape(df, "msisdn").select(F.lit("msisdn").alias("column"), "*").unionByName(audit.pseudonym_shape(df, "token").select(F.lit("token").alias("column"), "*"))


def pseudonym_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.pseudonym_enumeration(_tokens(spark, sf_dir), "token", PREFIX, DIGITS, settings=Settings(max_candidates=CANDIDATES))


def pseudonym_enumeration_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With as many candidates as the reference tries."""
    return audit.pseudonym_enumeration(_tokens(spark, sf_dir), "token", PREFIX, DIGITS, settings=Settings())


def unicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.trajectory_unicity(timed(spark, sf_dir), "msisdn", SETTINGS)


def home_cell_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.home_exposure(timed(spark, sf_dir), "msisdn", HOMES)


def metric_relink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.metric_relink(timed(spark, sf_dir), "msisdn", SETTINGS)


def value_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.value_precision(raw(spark, sf_dir))


def value_precision_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.value_precision(released(spark, sf_dir))


def t_closeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.t_closeness(as_users(spark, sf_dir), SETTINGS)


def class_label_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audit.class_labels(as_users(spark, sf_dir))
    return out.select(TIME, CELL, PROVINCE, RAT, "n", F.round("top", 6).alias("top"), F.round("tvd", 6).alias("tvd"))


def inference_attack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.inference(released(spark, sf_dir), "gt_user", "gt_row_id", SETTINGS)


def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.summary(timed(spark, sf_dir), "msisdn", "row_id", SETTINGS)


def _on_release(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(attacks.prepared_release(released(spark, sf_dir), SETTINGS))


def _on_pair(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(*pair(spark, sf_dir))


def _on_utility(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(*utility_pair(spark, sf_dir))


def _on_candidate(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(release_candidate(spark, sf_dir))


def share_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews made from users: one question for each of their first event types, the ones on errors must be answered."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kinds = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("value").alias("v"))
    question = F.struct(F.col("event_type").alias("text"), (F.col("event_type") == "error").alias("must_answer"), (F.col("v") > 480).alias("answered"))
    reviews = kinds.groupBy("user_id").agg(F.collect_list(question).alias("open_questions"))
    subject = F.when(F.col("user_id") % 3 == 0, "raw").otherwise("release_candidate")
    return review.open_blockers(reviews.select(F.col("user_id").alias("review_id"), subject.alias("subject"), "open_questions"))


def original_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.original_for_utility(raw(spark, sf_dir)).select("row_id", CELL, PROVINCE, RAT, APP)


def release_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.release_for_utility(released(spark, sf_dir)).select("row_id", DEVICE, CELL, PROVINCE, RAT, APP)


def device_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_device_type(tables.release_for_utility(released(spark, sf_dir))).select("row_id", "device_type")


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).select("row_id", "gt_user", "gt_row_id")


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 500 rows: the sampling operator that the measures use."""
    return raw(spark, sf_dir).select("row_id").orderBy(draw(0, F.col("row_id")), "row_id").limit(500)


def profile_numeric_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_extendedprice", "l_discount", "l_tax"), SETTINGS)


def whole_scorecard(o: DataFrame, a: DataFrame) -> DataFrame:
    """The scorecard with the models' measure, all over one stored copy of both tables."""
    with utility.stored(o, a):
        return utility.scorecard(utility.detail(o, a, models=learned.downstream(o, a, settings=SETTINGS)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "qi_class_sizes": qi_class_sizes,
    "sig_round_kpis": sig_round_kpis,
    "imei_tac": imei_tac,
    "ground_truth": ground_truth,
    "hash_sample": hash_sample,
    "original_columns": original_columns,
    "release_columns": release_columns,
    "release_candidate": release_candidate,
    "release_candidate_tac": release_candidate_tac,
    "release_by_windows": release_by_windows,
    "suppression_report": suppression_report,
    "k_risk_rows": k_risk_rows,
    "k_risk_users": k_risk_users,
    "k_distinct_users": _on_release(lambda a: attacks.k_by_users(a, SETTINGS)),
    "tac_sharing": _on_release(attacks.tac_sharing),
    "row_uniqueness": _on_release(attacks.uniqueness),
    "equivalence_report": _on_candidate(lambda df: linkage.equivalence(df, SETTINGS)),
    "violating_rows": _on_candidate(lambda df: linkage.violating_rows(df, "row_id", SETTINGS)),
    "linkage_overview": _on_candidate(linkage.overview),
    "t_closeness": t_closeness,
    "class_label_distances": class_label_distances,
    "l_diversity_flags": _on_release(attacks.flag_diversity),
    "inference_attack": inference_attack,
    "unicity": unicity,
    "home_cell_exposure": home_cell_exposure,
    "home_work_by_tac": _on_pair(attacks.home_work),
    "point_uniqueness": _on_pair(lambda a, r: attacks.point_uniqueness(a, r, SETTINGS)),
    "unique_runs": _on_candidate(linkage.unique_runs),
    "next_hour_links": _on_candidate(linkage.next_hour),
    "chain_histogram": _on_candidate(linkage.chain_histogram),
    "chain_unicity": _on_candidate(lambda df: linkage.chain_unicity(df, SETTINGS)),
    "suppression_footprint": _on_pair(attacks.footprint),
    "cell_recovery": _on_pair(lambda a, r: attacks.cell_recovery(a, r, SETTINGS)),
    "restricted_baseline": _on_pair(attacks.restricted_baseline),
    "hour_province_diff": _on_pair(attacks.hour_province),
    "identifier_scan": identifier_scan,
    "pseudonym_shape": pseudonym_shape,
    "pseudonym_enumeration": pseudonym_enumeration,
    "pseudonym_enumeration_whole": pseudonym_enumeration_whole,
    "value_precision": value_precision,
    "value_precision_release": value_precision_release,
    "metric_relink": metric_relink,
    "hourly_row_linking": _on_release(attacks.row_linking),
    "row_order_leak": _on_release(attacks.row_order),
    "excess_precision": _on_release(lambda a: attacks.excess_precision(a, SETTINGS)),
    "column_flags": column_flags,
    "device_lengths": _on_release(attacks.device_lengths),
    "attack_headline": _on_pair(lambda a, r: attacks.headline(a, r, SETTINGS)),
    "audit_summary": audit_summary,
    "profile_base": _on_candidate(lambda df: profile.base(df)),
    "profile_categories": _on_candidate(lambda df: profile.categories(df, SETTINGS)),
    "profile_cell_histogram": _on_candidate(profile.cell_histogram),
    "profile_numeric": _on_candidate(lambda df: profile.numeric(df.select(*KPIS), SETTINGS)),
    "profile_numeric_lineitem": profile_numeric_lineitem,
    "device_type": device_type,
    "row_retention": _on_utility(utility.row_retention),
    "kpi_completeness": _on_utility(utility.completeness),
    "ks_fidelity": _on_utility(utility.distributions),
    "cdf_points": _on_utility(utility.cdf_points),
    "category_shares": _on_utility(utility.category_shares),
    "jsd_categorical": _on_utility(utility.categorical),
    "spearman_delta": _on_utility(utility.correlation),
    "finding_gap": _on_utility(utility.findings),
    "worst_cell_recall": _on_utility(utility.worst_cells),
    "utility_scorecard": _on_utility(lambda o, a: utility.scorecard(utility.detail(o, a))),
    "share_check": share_check,
    "utility_scorecard_whole": _on_utility(whole_scorecard),
    "downstream_models": _on_utility(lambda o, a: learned.downstream(o, a, settings=SETTINGS)),
    "application_recovery": _on_pair(lambda a, r: learned.application_recovery(a, r, SETTINGS)),
}

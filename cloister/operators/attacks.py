"""Re-identification attacks on a release, scored by the truth that its rows carry (gt_user, gt_row_id)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import APP, ATTACK_QI, CELL, DEVICE, KPIS, METRICS, PROVINCE, RESTRICTED, TIME, Settings
from ..functions.columns import day_of_week, hour_of_day, melt, pick, quantile, running_totals, sig_round_finite, text
from .audit import class_sizes, modal
from .points import chosen_points, holders

USER, ROW = "gt_user", "gt_row_id"
#: Rows whose neighbours are compared together; only the first of each stretch looks at another stretch.
STRETCH = 100_000


def prepared_release(release: DataFrame, settings: Settings = Settings()) -> DataFrame:
    device = F.coalesce(F.trim(F.col(DEVICE).cast("string")), F.lit("NA")) if DEVICE in release.columns else F.lit("NA")
    out = release.withColumn("tac", device).withColumn("cell", text(F.col(CELL)))
    out = out.withColumn("cell_gone", F.col("cell") == "0").withColumn("app_gone", F.col(APP).cast("string") == RESTRICTED)
    return out.withColumn("hod", hour_of_day(F.col(TIME), settings.tz_hours)).withColumn("dow", day_of_week(F.col(TIME), settings.tz_hours))


def prepared_raw(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    out = raw.withColumn("tac", F.coalesce(F.substring(F.col(DEVICE).cast("string"), 1, 8), F.lit("NA"))).withColumn("cell", text(F.col(CELL)))
    out = out.withColumn("hour", F.floor(F.col(TIME).try_cast("double") / 3600).cast("long"))
    return out.withColumn("hod", hour_of_day(F.col("hour"), settings.tz_hours)).withColumn("dow", day_of_week(F.col("hour"), settings.tz_hours))


def _home(df: DataFrame) -> DataFrame:
    return df.filter(F.col("hod").between(0, 5))


def _work(df: DataFrame) -> DataFrame:
    return df.filter((F.col("dow") < 5) & F.col("hod").between(9, 16))


def row_order(a: DataFrame, row: str = "row_id") -> DataFrame:
    """(adjacent_same_user, expected_if_shuffled, leak, time_sorted_share) over rows in order of ``row``.

    Rows are compared within stretches of row ids; the first of a stretch meets the last of the stretch before it, so no
    task sorts the whole table.
    """
    base = a.select(F.col(row).alias("r"), F.col(USER).alias("u"), F.col(TIME).alias("t")).withColumn("s", F.floor(F.col("r") / STRETCH))
    inner = Window.partitionBy("s").orderBy("r")
    within = base.select("s", (F.col("u") == F.lag("u").over(inner)).alias("same"), (F.col("t") >= F.lag("t").over(inner)).alias("rising"), F.lag("r").over(inner).alias("p")).filter("p is not null").select("same", "rising")
    edges = base.groupBy("s").agg(F.min(F.struct("r", "u", "t")).alias("first"), F.max(F.struct("r", "u", "t")).alias("last"))
    before = F.lag("last").over(Window.orderBy("s"))  # one row for each stretch
    borders = edges.withColumn("before", before).filter("before is not null").select((F.col("first.u") == F.col("before.u")).alias("same"), (F.col("first.t") >= F.col("before.t")).alias("rising"))
    share = lambda c: F.avg(F.coalesce(F.col(c), F.lit(False)).cast("double"))
    pairs = within.union(borders).agg(share("same").alias("adjacent"), share("rising").alias("sorted"))
    users = a.filter(F.col(USER).isNotNull()).groupBy(USER).agg(F.count("*").alias("n"))
    expected = users.agg(F.sum("n").alias("total"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")).select((F.col("squares") / F.col("total") / F.col("total")).alias("expected"))
    leak = F.col("adjacent") > F.greatest(3 * F.col("expected"), F.lit(0.01))
    return pairs.join(expected).select(F.round("adjacent", 6).alias("adjacent_same_user"), F.round("expected", 6).alias("expected_if_shuffled"), leak.alias("leak"), F.round("sorted", 6).alias("time_sorted_share"))


def excess_precision(a: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(column, share) of values other than 0 with more figures than the release should have."""
    columns = [c for c in KPIS if c in a.columns]
    values = melt(a.select(*columns), [], columns).filter("value <> 0")
    odd = F.abs(sig_round_finite(F.col("value"), settings.sig_figs) - F.col("value")) > 1e-9 * F.abs(F.col("value"))
    return values.groupBy("column").agg(F.round(F.avg(odd.cast("double")), 6).alias("share"))


def device_lengths(a: DataFrame, top: int = 5) -> DataFrame:
    """(length, rows) of the most frequent lengths of device ids."""
    counts = a.filter(F.col(DEVICE).isNotNull()).groupBy(F.length(F.col(DEVICE).cast("string")).cast("long").alias("length")).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "length").limit(top)


def odd_columns(a: DataFrame) -> dict[str, list[str]]:
    """X1, from the header alone: direct identifiers and columns that look like a row index."""
    index = [c for c in a.columns if c.lower().startswith("unnamed") or c.lower() in ("index", "id", "row_id")]
    return {"direct_id_columns_present": [c for c in ("msisdn", "imsi") if c in a.columns], "index_like_columns": index}


def k_by_users(a: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Classes of the attacker's keys by distinct subscribers."""
    keys = [c for c in ATTACK_QI if c in a.columns]
    g = a.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct(USER).alias("u"))
    few, one, total = F.col("u") < settings.k_min, F.col("u") == 1, F.sum("n")
    rows = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)) / total
    return g.agg(
        F.count("*").alias("classes"),
        F.round(F.avg(few.cast("double")), 6).alias("share_classes_users_lt_k"),
        F.round(rows(few), 6).alias("share_rows_users_lt_k"),
        F.round(rows(one), 6).alias("share_rows_single_user"),
        F.round(F.expr("percentile(try_divide(n, u), 0.5D)"), 6).alias("median_rows_per_user"),
    )


def tac_sharing(a: DataFrame) -> DataFrame:
    """(max_users, rows_share, users_share) of device types that at most so many subscribers have."""
    tacs = a.groupBy("tac").agg(F.count("*").alias("n"), F.countDistinct(USER).alias("users"))
    limits = F.explode(F.array(*[F.lit(m).cast("long") for m in (1, 3, 5, 10)])).alias("max_users")
    totals = a.agg(F.count("*").alias("rows"), F.countDistinct(USER).alias("everyone"))
    by_rows = tacs.select("n", "users", limits).groupBy("max_users").agg(F.sum(F.when(F.col("users") <= F.col("max_users"), F.col("n")).otherwise(0)).alias("n"))
    pairs = a.filter(F.col(USER).isNotNull()).select("tac", USER).distinct().join(tacs.select("tac", "users"), "tac")
    fewest = pairs.groupBy(USER).agg(F.min("users").alias("users")).select("users", limits).groupBy("max_users").agg(F.sum((F.col("users") <= F.col("max_users")).cast("long")).alias("u"))
    return by_rows.join(fewest, "max_users").join(F.broadcast(totals)).select("max_users", F.round(F.col("n") / F.col("rows"), 6).alias("rows_share"), F.round(F.col("u") / F.col("everyone"), 6).alias("users_share"))


def uniqueness(a: DataFrame) -> DataFrame:
    """(keys, rows_unique, rows_single_user) for five key sets; the second for the first two sets only."""
    qi, kpi = [c for c in ATTACK_QI if c in a.columns], [c for c in KPIS if c in a.columns]
    sets = {"QI": qi, "QI+TAC": [*qi, "tac"], "KPI": kpi, "TAC+KPI": ["tac", *kpi], "QI+TAC+KPI": [*qi, "tac", *kpi]}
    classes = class_sizes(a, sets, USER)
    rows = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)) / F.sum("n")
    out = classes.groupBy("keys").agg(rows(F.col("n") == 1).alias("one"), rows(F.col("users") == 1).alias("single"))
    return out.select("keys", F.round("one", 6).alias("rows_unique"), F.when(F.col("keys").isin("QI", "QI+TAC"), F.round("single", 6)).alias("rows_single_user"))


def flag_diversity(a: DataFrame) -> DataFrame:
    """(flag, overall_rate, rows_all_positive, rows_all_negative): classes of two rows or more that agree on a use."""
    keys = [c for c in ATTACK_QI if c in a.columns]
    flags = {"tethering": "tethering_data_GB_dl_sum", "video": "im_video_GB_sum", "audio": "im_audio_GB_sum"}
    used = {name: c for name, c in flags.items() if c in a.columns}
    g = a.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).alias(name) for name, c in used.items()])
    long = g.select("n", F.explode(F.array(*[F.struct(F.lit(x).alias("flag"), F.col(x).alias("yes")) for x in used])).alias("f")).select("n", "f.flag", "f.yes")
    rows = lambda c: F.sum(F.when((F.col("n") >= 2) & c, F.col("n")).otherwise(0)) / F.sum("n")
    return long.groupBy("flag").agg(
        F.round(F.sum("yes") / F.sum("n"), 6).alias("overall_rate"), F.round(rows(F.col("yes") == F.col("n")), 6).alias("rows_all_positive"), F.round(rows(F.col("yes") == 0), 6).alias("rows_all_negative")
    )


def _nearest_of(feats: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        """One row for a block and the one an hour later: rows, those whose nearest is of the same subscriber, and their
        chances. Equal distances go to the smallest row id. Some rows at a time, so that no matrix is larger than 2 ** 20."""
        n, hits = left.num_rows, 0
        if n and right.num_rows:
            right = right.sort_by([("r2", "ascending"), ("u2", "ascending")])
            x, y = (np.column_stack([t.column(c).to_numpy() for c in feats]) for t in (left, right))
            mine, theirs = left.column("u").to_pylist(), right.column("u2").to_pylist()
            step = max(1, (1 << 20) // len(y))
            for begin in range(0, n, step):
                some = x[begin : begin + step]
                d = np.zeros((len(some), len(y)))
                for k in range(len(feats)):
                    d += (some[:, k : k + 1] - y[None, :, k]) ** 2
                near = np.nan_to_num(np.round(d, 9), nan=np.inf).argmin(axis=1)
                hits += sum(mine[begin + i] == theirs[j] for i, j in enumerate(near.tolist()))
        else:
            n = 0
        return pa.table({"n": pa.array([n], pa.int64()), "hits": pa.array([hits], pa.int64()), "chance": pa.array([sum(left.column("chance").to_pylist()) if n else 0.0], pa.float64())})

    return nearest


def row_linking(a: DataFrame, row: str = "row_id", max_tac_users: int = 50, max_pairs: int = 4_000_000) -> DataFrame:
    """(rows_evaluated, link_accuracy, chance_baseline, lift, skipped_blocks): the nearest row of the next hour with the
    same device type and province, by measurements, against the truth. Larger blocks are skipped and counted; the others
    meet as Arrow tables, so that pairs are matrix cells and never rows."""
    feats = [c for c in METRICS if c in a.columns]
    logs = a.select(F.col(row).alias("r"), F.col(USER).alias("u"), "tac", F.col(PROVINCE).alias("p"), F.col(TIME).alias("h"), *[F.log1p(F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0)))).alias(c) for c in feats])
    counts = melt(logs.select(*feats), [], feats).groupBy("column", "value").agg(F.count("*").alias("n"))
    middle = running_totals(counts, "column", "value", ["n"]).groupBy("column").agg(quantile(0.5, "value", "n").alias("d"))
    medians = {r["column"]: r["d"] for r in middle.collect()}  # a row for each measurement; as literals they are not planned anew in each branch
    filled = logs.select("r", "u", "tac", "p", "h", *[F.coalesce(c, F.lit(medians.get(c)).cast("double")).alias(c) for c in feats])
    spread = filled.agg(*[F.avg(c).alias(f"m_{c}") for c in feats], *[F.stddev_samp(c).alias(f"s_{c}") for c in feats])
    z = [F.coalesce((F.col(c) - F.col(f"m_{c}")) / F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")), F.lit(0.0)).alias(c) for c in feats]
    rows = filled.join(F.broadcast(spread)).select("r", "u", "tac", "p", "h", *z)
    few = a.groupBy("tac").agg(F.countDistinct(USER).alias("users")).filter((F.col("users") <= max_tac_users) & (F.col("tac") != "NA")).select("tac")
    rows = rows.filter("p is not null").join(few, "tac")
    keys = ["tac", "p", "h"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    after = sizes.select("tac", "p", (F.col("h") - 1).alias("h"), F.col("n").alias("next"))
    blocks = sizes.join(after, keys).withColumn("skip", F.col("n") * F.col("next") > max_pairs)
    skipped = blocks.agg(F.sum(F.col("skip").cast("long")).alias("skipped"))
    left = rows.join(blocks.filter("not skip").select(*keys, "next"), keys)
    per_user = rows.groupBy(*keys, "u").agg(F.count("*").alias("own")).select("tac", "p", (F.col("h") - 1).alias("h"), "u", "own")
    left = left.join(per_user, [*keys, "u"])  # only rows whose subscriber is in the next block
    left = left.select(*keys, "r", "u", (F.col("own") / F.col("next")).alias("chance"), *feats)
    right = rows.select("tac", "p", (F.col("h") - 1).alias("h"), F.col("r").alias("r2"), F.col("u").alias("u2"), *feats).join(blocks.filter("not skip").select(*keys), keys, "left_semi")
    right = right.toDF(*right.columns)  # columns of its own, told apart from the left side's
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_nearest_of(feats), "n long, hits long, chance double")
    out = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("hits").alias("hits"), F.sum("chance").alias("chance"))
    accuracy, chance = F.expr("try_divide(hits, n)"), F.expr("try_divide(chance, n)")
    return out.join(skipped).select(
        F.col("n").alias("rows_evaluated"), F.round(accuracy, 6).alias("link_accuracy"), F.round(chance, 6).alias("chance_baseline"),
        F.round(F.when(F.col("n") > 0, accuracy / F.greatest(chance, F.lit(1e-12))), 6).alias("lift"), F.coalesce("skipped", F.lit(0)).alias("skipped_blocks"),
    )


def anchors(r: DataFrame) -> DataFrame:
    """(label, gt_user, cell): where subscribers really are most at night and at work."""
    home = modal(_home(r), [USER], "cell", "cell").select(F.lit("home").alias("label"), USER, "cell")
    return home.union(modal(_work(r), [USER], "cell", "cell").select(F.lit("work").alias("label"), USER, "cell"))


def home_work(a: DataFrame, r: DataFrame) -> DataFrame:
    """(label, tier, tacs_evaluated, accuracy, random_baseline, single_user_located): the modal cell of a device type
    against the true anchors of its subscribers, for types of 1, 2 to 3 and 4 to 10 subscribers."""
    known = a.filter(~F.col("cell_gone"))
    cells = known.agg(F.greatest(F.countDistinct("cell"), F.lit(1)).alias("cells"))
    guess = modal(_home(known), ["tac"], "cell", "guess").select(F.lit("home").alias("label"), "tac", "guess")
    guess = guess.union(modal(_work(known), ["tac"], "cell", "guess").select(F.lit("work").alias("label"), "tac", "guess"))
    members = a.filter((F.col("tac") != "NA") & F.col(USER).isNotNull()).select("tac", USER).distinct()
    sizes = members.groupBy("tac").agg(F.count("*").alias("users")).filter("users <= 10")
    truth = members.join(sizes, "tac").join(anchors(r), USER).select("label", "tac", "users", "cell")
    places = truth.distinct().groupBy("label", "tac", "users").agg(F.count("*").alias("places"))
    met = guess.join(places, ["label", "tac"])
    hits = truth.select("label", "tac", F.col("cell").alias("guess")).distinct().withColumn("hit", F.lit(1))
    met = met.join(hits, ["label", "tac", "guess"], "left").join(F.broadcast(cells)).withColumn("hit", F.coalesce("hit", F.lit(0)))
    tier = F.when(F.col("users") == 1, "1-1").when(F.col("users") <= 3, "2-3").otherwise("4-10")
    return met.groupBy("label", tier.alias("tier")).agg(
        F.count("*").alias("tacs_evaluated"), F.round(F.avg(F.col("hit").cast("double")), 6).alias("accuracy"), F.round(F.avg(F.col("places") / F.col("cells")), 6).alias("random_baseline"),
        F.sum(F.when((F.col("users") == 1) & (F.col("hit") == 1), 1).otherwise(0)).alias("single_user_located"),
    )


def restricted_baseline(a: DataFrame, r: DataFrame) -> DataFrame:
    """(restricted_rows, majority_baseline): what always naming the commonest true application would recover."""
    true = r.select(F.col(ROW).alias("row"), F.col(APP).cast("string").alias("label"))
    counts = a.filter("app_gone").select(F.col(ROW).alias("row")).join(true, "row").groupBy("label").agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("restricted_rows"), F.round(F.max("n") / F.sum("n"), 6).alias("majority_baseline"))


def cell_recovery(a: DataFrame, r: DataFrame, settings: Settings = Settings(), rows: int = 5000) -> DataFrame:
    """(suppressed_rows, rows_tried, coverage, accuracy, province_baseline): suppressed cells from rows of the same
    device type and province within two hours; each tried row looks at its five hours, so there is no range join."""
    known = a.filter(~F.col("cell_gone") & F.col(PROVINCE).isNotNull())
    gone = a.filter("cell_gone")
    truth = r.select(F.col(ROW).alias("row"), F.col("cell").alias("true"))
    tried = pick(gone.select(F.col(ROW).alias("row"), "tac", F.col(PROVINCE).alias("p"), F.col(TIME).alias("h")), rows, settings.seed, "row").join(truth, "row")
    hours = tried.select("row", "tac", "p", F.explode(F.sequence(F.col("h") - 2, F.col("h") + 2)).alias("h"))
    seen = known.select("tac", F.col(PROVINCE).alias("p"), F.col(TIME).alias("h"), "cell")
    votes = hours.join(seen, ["tac", "p", "h"]).groupBy("row", "cell").agg(F.count("*").alias("n"))
    best = votes.groupBy("row").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("cell").alias("cell"))).alias("b")).select("row", F.col("b.cell").alias("guess"))
    common = modal(known, [PROVINCE], "cell", "common").withColumnRenamed(PROVINCE, "p")
    met = tried.join(best, "row", "left").join(common, "p", "left")
    out = met.agg(
        F.count("*").alias("rows_tried"), F.count("guess").alias("answered"), F.sum(F.when(F.col("guess") == F.col("true"), 1).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("common") == F.col("true"), 1).otherwise(0)).alias("base"),
    )
    return gone.agg(F.count("*").alias("suppressed_rows")).join(out).select(
        "suppressed_rows", "rows_tried", F.round(F.expr("try_divide(answered, rows_tried)"), 6).alias("coverage"), F.round(F.expr("try_divide(hits, answered)"), 6).alias("accuracy"), F.round(F.expr("try_divide(base, rows_tried)"), 6).alias("province_baseline")
    )


def hour_province(a: DataFrame, r: DataFrame) -> DataFrame:
    """(hour, province, raw, anon, missing): rows of each hour and province before and after, where the province is known."""
    raw = r.filter(F.col(PROVINCE).isNotNull()).groupBy("hour", PROVINCE).agg(F.count("*").alias("raw"))
    anon = a.filter(F.col(PROVINCE).isNotNull()).groupBy(F.col(TIME).alias("hour"), PROVINCE).agg(F.count("*").alias("anon"))
    both = raw.join(anon, ["hour", PROVINCE], "full").select("hour", PROVINCE, F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("anon", F.lit(0)).alias("anon"))
    return both.withColumn("missing", F.col("anon") < F.col("raw"))


def footprint(a: DataFrame, r: DataFrame | None = None) -> DataFrame:
    """(metric, scope, value): where suppression shows."""
    flagged = (F.col("app_gone") | F.col("cell_gone")).cast("double")

    def one(df: DataFrame, metric: str, value: str = "value") -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), F.lit("").alias("scope"), F.round(F.col(value).cast("double"), 6).alias("value"))

    rates = a.groupBy("hod").agg(F.avg(flagged).alias("rate"))
    top = a.filter(F.col(PROVINCE).isNotNull()).groupBy(PROVINCE).agg(F.round(F.avg(flagged), 6).alias("value")).orderBy(F.desc("value"), PROVINCE).limit(3)
    parts = [
        one(a.agg(F.avg(F.col("app_gone").cast("double")).alias("value")), "share_app_restricted"),
        one(a.agg(F.avg(F.col("cell_gone").cast("double")).alias("value")), "share_cell_zero"),
        one(rates.agg(F.min("rate").alias("value")), "flag_rate_by_hour_min"),
        one(rates.agg(F.max("rate").alias("value")), "flag_rate_by_hour_max"),
        top.select(F.lit("flag_rate_top_province").alias("metric"), F.col(PROVINCE).alias("scope"), "value"),
    ]
    if r is not None:
        parts.append(one(a.agg(F.count("*").alias("a")).join(r.agg(F.count("*").alias("r"))).select((1 - F.col("a") / F.col("r")).alias("value")), "rows_dropped_share"))
        lost = r.select(USER).filter(F.col(USER).isNotNull()).distinct().join(a.select(USER).distinct(), USER, "left_anti")
        parts.append(one(lost.agg(F.count("*").alias("value")), "users_with_all_rows_dropped"))
        parts.append(one(hour_province(a, r).agg(F.avg(F.col("missing").cast("double")).alias("value")), "hour_province_cells_with_missing_rows"))
        dropped = r.select(ROW, "hod").join(a.select(ROW).withColumn("there", F.lit(1)), ROW, "left").groupBy("hod").agg(F.avg(F.col("there").isNull().cast("double")).alias("rate"))
        parts.append(one(dropped.agg(F.min("rate").alias("value")), "drop_rate_by_hour_min"))
        parts.append(one(dropped.agg(F.max("rate").alias("value")), "drop_rate_by_hour_max"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def point_uniqueness(a: DataFrame, r: DataFrame, settings: Settings = Settings(), sizes: tuple[int, ...] = (1, 2, 3, 4)) -> DataFrame:
    """(points, known, targets, target_in_candidates, uniquely_identified, median_candidates): raw points of a target,
    with or without its device type, against the subscribers that the release has at all of them."""
    seen = a.filter(~F.col("cell_gone") & F.col(USER).isNotNull())
    plain, full = ["hour", "cell"], ["hour", "cell", "tac"]
    index = seen.select(F.col(USER).alias("candidate"), F.col(TIME).alias("hour"), "cell", "tac").distinct()
    points = r.select(F.col(USER).alias("entity"), "hour", "cell", "tac").dropna().distinct()
    out = None
    for p in sizes:
        chosen = chosen_points(points, full, p, settings.trials, settings.seed)
        targets = chosen.select(F.col("entity").alias("target")).distinct()
        for known, keys in (("points_only", plain), ("points_plus_tac", full)):
            # Two types of device can stand at one place: each is one point of the two.
            places = index.select("candidate", *keys).distinct()
            found = holders(chosen, places, keys, p).groupBy("target").agg(F.count("*").alias("n"), F.max((F.col("candidate") == F.col("target")).cast("int")).alias("in"))
            each = targets.join(found, "target", "left").select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("in", F.lit(0)).alias("in"))
            one = each.agg(
                F.count("*").alias("targets"), F.round(F.avg(F.col("in").cast("double")), 6).alias("target_in_candidates"),
                F.round(F.avg(((F.col("in") == 1) & (F.col("n") == 1)).cast("double")), 6).alias("uniquely_identified"), F.round(F.expr("percentile(n, 0.5D)"), 6).alias("median_candidates"),
            ).select(F.lit(p).cast("long").alias("points"), F.lit(known).alias("known"), "*")
            out = one if out is None else out.unionByName(one)
    return out


def headline(a: DataFrame, r: DataFrame | None, settings: Settings = Settings()) -> DataFrame:
    """X11: (line, value): the figures of all attacks that sum them up; without raw rows, those that need none."""
    def one(df: DataFrame, line: str, column: str) -> DataFrame:
        return df.select(F.lit(line).alias("line"), F.col(column).cast("double").alias("value"))

    parts = [
        one(row_order(a), "adjacent rows of one subscriber", "adjacent_same_user"),
        one(k_by_users(a, settings), "rows in classes of one subscriber", "share_rows_single_user"),
        one(tac_sharing(a).filter("max_users = 1"), "rows with a device type of one subscriber", "rows_share"),
        one(uniqueness(a).filter("keys = 'QI+TAC'"), "rows unique by keys and device type", "rows_unique"),
        one(row_linking(a), "rows linked to the next hour", "link_accuracy"),
    ]
    if r is not None:
        parts.append(one(home_work(a, r).filter("label = 'home' and tier = '1-1'").agg(F.coalesce(F.sum("single_user_located"), F.lit(0)).alias("n")).join(a.agg(F.greatest(F.countDistinct(USER), F.lit(1)).alias("users"))).select(F.round(F.col("n") / F.col("users"), 6).alias("value")), "subscribers located at home by device type", "value"))
        parts.append(one(point_uniqueness(a, r, settings, (4,)).filter("known = 'points_only'"), "subscribers identified by four points", "uniquely_identified"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


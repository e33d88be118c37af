"""Privacy tests of a release candidate. Each gives a small table; `summary` brings their verdicts together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import APP, CELL, DIGESTS, METRICS, PROVINCE, RAT, SENSITIVE, TIME, VOLUMES, Settings, worst
from ..functions.columns import in_majority_part, melt, pick, quantile, running_totals, same_keys, status
from .points import unicity

BASE = (TIME, CELL, PROVINCE, RAT)


def base_keys(df: DataFrame) -> list[str]:
    return [c for c in BASE if c in df.columns]


def prepared(df: DataFrame, unit: str = "s", tz: str = "UTC") -> DataFrame:
    """Time as whole hours since the epoch, with ``ts`` (seconds) and ``hod`` (hour of day in ``tz``).

    unit: s, ms, hour, iso, or auto, which takes milliseconds where the median is above 1e11 and seconds otherwise.
    """
    if unit == "auto":
        middle = df.agg(F.percentile_approx(F.abs(F.col(TIME).try_cast("double")), 0.5)).first()[0]
        unit = "ms" if middle is not None and middle > 1e11 else "s"
    if unit == "iso":
        seconds = F.unix_seconds(F.try_to_timestamp(F.col(TIME).cast("string")))
    else:
        seconds = F.floor(F.col(TIME).try_cast("double") * {"s": 1.0, "ms": 0.001, "hour": 3600.0}[unit]).cast("long")
    out = df.withColumn("ts", seconds).withColumn(TIME, F.floor(F.col("ts") / 3600).cast("long"))
    # Without a zone, so that the session's has no say.
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, ts)"))
    return out.withColumn("hod", F.hour(local))


def identifier_scan(df: DataFrame, mcc_mnc: str = "", exclude: tuple[str, ...] = ("row_id", "gt_user", "gt_row_id", "ts", "hod")) -> DataFrame:
    """(column, pattern, share) of identifier-shaped values, of all rows, in columns that hold no fractions."""
    columns = [f.name for f in df.schema.fields if f.name not in (TIME, *exclude) and not isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    v = F.col("value")
    fifteen = v.rlike("^[0-9]{15}$")
    luhn = F.expr("luhn_check(case when value rlike '^[0-9]{15}$' then value else '1' end)")
    values = melt(df.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in columns]), [], columns)
    one = lambda x: F.avg(x.cast("double"))
    shares = values.groupBy("column").agg(
        one(fifteen & luhn).alias("imei_like"), one(v.rlike(r"^\+?[1-9][0-9]{7,14}$")).alias("e164_like"), one(fifteen & v.startswith(mcc_mnc)).alias("imsi_like")
    )
    found = melt(shares, ["column"], ["imei_like", "e164_like", "imsi_like"], "pattern", "share").filter("share > 0")
    return found.select("column", "pattern", F.round("share", 4).alias("share"))


def identifier_verdict(found: DataFrame) -> DataFrame:
    return found.agg(F.max("share").alias("m")).select(F.when(F.col("m") >= 0.01, "FAIL").when(F.col("m").isNotNull(), "WARN").otherwise("PASS").alias("status"))


def pseudonym_shape(df: DataFrame, user: str, probe: int = 5000, seed: int = 0) -> DataFrame:
    """T2, by shape: (distinct_values, digit_share, hex_share, algorithm, status) of the subscriber tokens."""
    values = df.select(F.trim(F.col(user).cast("string")).alias("v")).filter("v is not null").distinct()
    total = values.agg(F.count("*").alias("distinct_values"))
    v = F.col("v")
    some = pick(values, probe, seed, "v")
    lengths = F.create_map(*[F.lit(x) for n, name in DIGESTS.items() for x in (n, name)])
    shares = some.agg(
        F.avg(v.rlike(r"^\+?[0-9]{8,15}$").cast("double")).alias("digit_share"),
        F.avg((v.rlike("^[0-9a-fA-F]+$") & F.length(v).isin(*DIGESTS)).cast("double")).alias("hex_share"),
        F.element_at(lengths, F.min(F.length(v))).alias("algorithm"),
    )
    digits, hexes = F.col("digit_share"), F.col("hex_share")
    verdict = F.when(F.col("distinct_values") == 0, "SKIP").when(digits > 0.9, "FAIL").when(hexes <= 0.9, "PASS").otherwise("WARN")
    return total.join(shares).select("distinct_values", F.round(digits, 6).alias("digit_share"), F.round(hexes, 6).alias("hex_share"), F.when(hexes > 0.9, F.col("algorithm")).alias("algorithm"), verdict.alias("status"))


def _digest(x: Column, algorithm: str) -> Column:
    return {"md5": F.md5(x), "sha1": F.sha1(x), "sha256": F.sha2(x, 256), "sha512": F.sha2(x, 512)}[algorithm]


def pseudonym_enumeration(df: DataFrame, user: str, prefix: str, digits: int, algorithm: str = "sha256", settings: Settings = Settings()) -> DataFrame:
    """T2, by trying: (targets, recovered, candidates, space_covered, status) over the numbers a prefix allows.

    The candidates are dealt over the cluster; at most ``settings.targets`` digests are broadcast.
    """
    space = 10**digits
    limit = min(space, settings.max_candidates)
    other = prefix[1:] if prefix.startswith("+") else "+" + prefix
    values = df.select(F.trim(F.col(user).cast("string")).alias("v")).filter("v is not null").distinct()
    targets = pick(values, settings.targets, settings.seed, "v").select(F.lower("v").alias("digest"))
    tail = F.lpad(F.col("id").cast("string"), digits, "0")
    tried = df.sparkSession.range(limit).select(F.explode(F.array(F.concat(F.lit(prefix), tail), F.concat(F.lit(other), tail))).alias("number"))
    found = tried.select(_digest(F.col("number"), algorithm).alias("digest")).join(F.broadcast(targets), "digest", "left_semi").agg(F.countDistinct("digest").alias("recovered"))
    share = limit / space
    verdict = F.when(F.col("recovered") > 0, "FAIL").when(F.lit(share) >= 1, "PASS").otherwise("WARN")
    return targets.agg(F.count("*").alias("targets")).join(found).select("targets", "recovered", F.lit(2 * limit).cast("long").alias("candidates"), F.round(F.lit(share), 6).alias("space_covered"), verdict.alias("status"))


def key_sets(df: DataFrame) -> dict[str, list[str]]:
    """The key sets of T3 that the table has."""
    base = base_keys(df)
    out = {}
    if TIME in base and CELL in base:
        out["hour+cell"] = [TIME, CELL]
    out["base"] = base
    if APP in df.columns:
        out["base+app"] = [*base, APP]
    volumes = [c for c in VOLUMES if c in df.columns]
    if volumes:
        out["base+app+volumes"] = [*base, *([APP] if APP in df.columns else []), *volumes]
    return out


def class_sizes(df: DataFrame, sets: dict[str, list[str]], user: str | None = None) -> DataFrame:
    """(keys, n, users) for each class of each key set, by one pass with grouping sets. Sets of the same columns are grouped
    once and named each."""
    columns = list(dict.fromkeys(c for s in sets.values() for c in s))
    named: dict[int, list[str]] = {}
    for name, s in sets.items():
        named.setdefault(sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s), []).append(name)
    distinct = [[F.col(c) for i, c in enumerate(columns) if not g >> (len(columns) - 1 - i) & 1] for g in named]
    aggs = [F.count("*").alias("n")] + ([F.countDistinct(user).alias("users")] if user else [])
    table = df.groupingSets(distinct, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("gid"), *aggs)
    names = F.create_map(*[x for g, of in named.items() for x in (F.lit(g), F.array(*[F.lit(n) for n in of]))])
    return table.select(F.explode(names[F.col("gid").cast("int")]).alias("keys"), *columns, "n", *(["users"] if user else []))


def k_risk(df: DataFrame, settings: Settings = Settings(), user: str | None = None) -> DataFrame:
    """Risk of each key set, k in distinct subscribers, or in rows without ``user``.

    All figures weigh classes by rows and come from the class table alone.
    """
    classes = class_sizes(df, key_sets(df), user).withColumn("k", F.col("users") if user else F.col("n"))
    rows = F.sum("n")
    part = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)) / rows
    out = classes.groupBy("keys").agg(
        F.min("k").alias("min_k"),
        F.expr("percentile(k, 0.5D, n)").alias("median_k"),
        part(F.col("k") == 1).alias("share_k1"),
        part(F.col("k") < settings.k_min).alias("share_below_k"),
        (F.sum(F.expr("try_divide(n, k)")) / rows).alias("marketer_avg_risk"),
    )
    verdict = status(F.col("share_k1") > 0, F.col("share_below_k") > settings.max_share_below_k)
    rounded = [F.round(c, 6).alias(c) for c in ("median_k", "share_k1", "share_below_k")]
    return out.select("keys", "min_k", *rounded, F.round(F.expr("try_divide(1, min_k)"), 6).alias("prosecutor_max_risk"), F.round("marketer_avg_risk", 6).alias("marketer_avg_risk"), verdict.alias("status"))


def trajectory_unicity(df: DataFrame, user: str, settings: Settings = Settings()) -> DataFrame:
    """T4: (p, eligible, sampled, unicity) for 2, 3 and 4 known points; null with fewer than 20 subscribers that have as many."""
    points = df.select(F.col(user).alias("entity"), TIME, CELL).dropna().distinct()
    out = unicity(points, [TIME, CELL], (2, 3, 4), settings.samples, settings.seed)
    return out.select("p", "eligible", "sampled", F.when(F.col("eligible") >= 20, F.round("unicity", 6)).alias("unicity"))


def unicity_verdict(result: DataFrame, settings: Settings = Settings()) -> DataFrame:
    u = F.max(F.when(F.col("p") == 4, F.col("unicity"))).alias("u")
    return result.agg(u).select(F.when(F.col("u").isNull(), "SKIP").otherwise(status(F.col("u") > settings.unicity_fail, F.col("u") > settings.unicity_warn)).alias("status"))


def modal(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value of each key; the smallest of several. Null keys and values don't count."""
    counts = df.dropna(subset=[*keys, value]).groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias(name))


def home_exposure(df: DataFrame, user: str, settings: Settings = Settings()) -> DataFrame:
    """T5: (users, exposed_share, status): subscribers whose night cell has fewer than k residents."""
    night = df.filter((F.col("hod") >= 22) | (F.col("hod") < 6))
    home = modal(night, [user], CELL, "home")
    cells = home.groupBy("home").agg(F.count("*").alias("residents"))
    hours = df.agg(F.countDistinct("hod").alias("hours"))
    few = F.sum(F.when(F.col("residents") < settings.k_min, F.col("residents")).otherwise(0))
    out = cells.agg(F.coalesce(F.sum("residents"), F.lit(0)).alias("users"), (few / F.sum("residents")).alias("share")).join(hours)
    verdict = F.when((F.col("hours") <= 1) | (F.col("users") == 0), "SKIP").otherwise(status(F.col("share") > 0.05, F.col("share") > 0.01))
    return out.select("users", F.round("share", 6).alias("exposed_share"), verdict.alias("status"))


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """One row: the value at half the count, from 0, of the sorted values that aren't null."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.lit(0).alias("g"), F.col(column).alias("v")).agg(F.count("*").alias("n"))
    middle = F.floor(F.col("total_n") / 2)
    here = (F.col("before_n") <= middle) & (middle < F.col("before_n") + F.col("n"))
    return running_totals(counts, "g", "v", ["n"]).agg(F.max(F.when(here, F.col("v"))).alias("cut"))


def metric_relink(df: DataFrame, user: str, settings: Settings = Settings()) -> DataFrame:
    """(variant, subscribers, top1, top5): how often a subscriber's mean measurements before the middle of the time
    find the same subscriber's after it, among at most ``max_users``; also with a penalty where the modal cells differ."""
    columns = [c for c in (*METRICS, *VOLUMES) if c in df.columns]
    cut = upper_median(df, "ts").first()["cut"]  # one value; as a literal it is not planned anew in each branch
    halves = df.withColumn("late", F.col("ts") >= F.lit(cut))
    means = halves.groupBy(user, "late").agg(*[F.avg(c).alias(c) for c in columns]).dropna()
    both = means.groupBy(user).agg(F.count("*").alias("n")).filter("n = 2").select(user)
    chosen = pick(both, settings.max_users, settings.seed, user)
    vectors = means.join(chosen, user).select(F.col(user).alias("user"), "late", *[F.log1p(F.greatest(F.col(c), F.lit(0.0))).alias(c) for c in columns])
    spread = vectors.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    z = [((F.col(c) - F.col(f"m_{c}")) / F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}"))).alias(c) for c in columns]
    vectors = vectors.join(F.broadcast(spread)).select("user", "late", *z)
    cells = modal(halves.withColumnRenamed(user, "user"), ["user", "late"], CELL, "home")
    vectors = vectors.join(cells, ["user", "late"], "left")
    early = vectors.filter("not late").select("user", "home", *columns)
    # A stated set of at most `max_users` subscribers, whom every task compares its share of the early halves with.
    late = vectors.filter("late").select("user", "home", *columns).toPandas().sort_values("user", ignore_index=True)
    later, homes = late[columns].to_numpy(dtype=float), late["home"].tolist()
    place = {u: k for k, u in enumerate(late["user"])}

    code = {h: k for k, h in enumerate(sorted({h for h in homes if not pd.isna(h)}))}
    coded = np.array([-1 if pd.isna(h) else code[h] for h in homes], dtype=np.int64)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 500):
                some = batch.iloc[begin : begin + 500]
                mine = some[columns].to_numpy(dtype=float)
                d = np.zeros((len(some), len(later)))
                for k in range(len(columns)):
                    d += (mine[:, k : k + 1] - later[None, :, k]) ** 2
                d = np.round(d, 9)
                # Codes of the later homes; -1 is no home, -2 one that no later subscriber has.
                home = np.array([-1 if pd.isna(h) else code.get(h, -2) for h in some["home"]], dtype=np.int64)
                moved = home[:, None] != coded[None, :]
                own = np.array([place[u] for u in some["user"]], dtype=np.int64)
                for variant, x in (("metrics", d), ("metrics+home", d + 1000.0 * moved)):
                    self_ = x[np.arange(len(own)), own][:, None]
                    before = np.arange(len(later))[None, :] < own[:, None]
                    yield pd.DataFrame({"variant": variant, "ahead": ((x < self_) | ((x == self_) & before)).sum(axis=1)})

    ahead = early.mapInPandas(compared, "variant string, ahead long")
    out = ahead.groupBy("variant").agg(F.count("*").alias("subscribers"), F.avg((F.col("ahead") == 0).cast("double")).alias("top1"), F.avg((F.col("ahead") < 5).cast("double")).alias("top5"))
    return out.select("variant", "subscribers", F.round("top1", 6).alias("top1"), F.round("top5", 6).alias("top5"))


def relink_verdict(result: DataFrame) -> DataFrame:
    best = result.agg(F.max("top1").alias("rate"), F.max("subscribers").alias("n"))
    rate, lift = F.col("rate"), F.col("rate") * F.col("n")
    return best.select(F.when(F.coalesce("n", F.lit(0)) < 50, "SKIP").otherwise(status((rate > 0.05) & (lift > 10), (rate > 0.01) & (lift > 3))).alias("status"))


def value_precision(df: DataFrame) -> DataFrame:
    """(column, n, unique_value_share, decimals, p50, p99_9, max, outlier, status) of each measurement."""
    columns = [c for c in (*VOLUMES, *METRICS) if c in df.columns]
    counts = melt(df.select(*columns), [], columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    v = F.col("value")
    needs = [F.max(F.abs(F.rint(v * F.lit(10.0**d)) / F.lit(10.0**d) - v)).alias(f"e{d}") for d in range(10)]
    table = running_totals(counts, "column", "value", ["n"]).groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"),
        quantile(0.5, "value", "n").alias("p50"),
        quantile(0.999, "value", "n").alias("p99_9"),
        F.max("value").alias("max"),
        *needs,
    )
    decimals = F.coalesce(*[F.when(F.col(f"e{d}") <= 1e-9, d) for d in range(10)], F.lit(10))
    share, volume = F.col("once") / F.col("rows"), F.col("column").isin(*VOLUMES)
    out = table.select("column", F.col("rows").alias("n"), share.alias("u"), decimals.cast("long").alias("decimals"), "p50", "p99_9", "max")
    outlier = (F.col("p99_9") > 0) & (F.col("max") / F.when(F.col("p99_9") > 0, F.col("p99_9")) > 10)
    out = out.withColumn("outlier", F.coalesce(outlier, F.lit(False)))
    u, d = F.col("u"), F.col("decimals")
    verdict = status(volume & (u > 0.5), (volume & ((d > 3) | (u > 0.2) | F.col("outlier"))) | (~volume & (d > 3) & (u > 0.5)))
    return out.select("column", "n", F.round("u", 6).alias("unique_value_share"), "decimals", F.round("p50", 6).alias("p50"), F.round("p99_9", 6).alias("p99_9"), F.round("max", 6).alias("max"), "outlier", verdict.alias("status"))


def worst_of(result: DataFrame) -> DataFrame:
    rank = F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0)
    return result.agg(F.max(rank).alias("r")).select(F.when(F.col("r") == 2, "FAIL").when(F.col("r") == 1, "WARN").when(F.col("r") == 0, "PASS").otherwise("SKIP").alias("status"))


def class_labels(df: DataFrame, label: str = APP) -> DataFrame:
    """Per class of the base keys: n, share of its largest label (top) and total variation distance from all rows (tvd).

    Rows without a label aren't counted. A label that a class lacks adds half its overall share.
    """
    keys = base_keys(df)
    cells = df.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count("*").alias("n"))
    overall = cells.groupBy(label).agg(F.sum("n").alias("g"))
    total = overall.agg(F.sum("g").alias("total"))
    shares = overall.join(F.broadcast(total)).select(F.col(label).alias("l"), (F.col("g") / F.col("total")).alias("pg"))
    sizes = cells.groupBy(*keys).agg(F.sum("n").alias("size"))
    joined = cells.alias("a").join(sizes.alias("b"), same_keys("a", "b", keys)).select(*[F.col(f"a.{c}").alias(c) for c in keys], F.col(f"a.{label}").alias("l"), (F.col("a.n") / F.col("b.size")).alias("p"), F.col("b.size").alias("size"))
    joined = joined.join(shares, "l")
    return joined.groupBy(*keys).agg(F.max("size").alias("n"), F.max("p").alias("top"), (0.5 * (F.sum(F.abs(F.col("p") - F.col("pg"))) + 1 - F.sum("pg"))).alias("tvd"))


def t_closeness(df: DataFrame, settings: Settings = Settings(), label: str = APP) -> DataFrame:
    """(classes, rows, homogeneous_share, far_share, sensitive_labels, rare_labels, status) over classes of k rows or more."""
    big = class_labels(df, label).filter(F.col("n") >= settings.k_min)
    rows = F.greatest(F.sum("n"), F.lit(1))
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("n")).otherwise(0)) / rows, F.lit(0.0))
    # Rounded first: a distance at the limit differs in its last bits with the order of the sum.
    sums = big.agg(F.count("*").alias("classes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), part(F.round("top", 9) > 0.9).alias("h"), part(F.round("tvd", 9) > settings.t_close).alias("f"))
    overall = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = overall.agg(F.sum("n").alias("total"))
    labels = overall.join(F.broadcast(total)).agg(
        F.count(F.when(F.col(label).rlike("(?i)" + SENSITIVE), 1)).alias("sensitive_labels"), F.count(F.when(F.col("n") / F.col("total") < 0.01, 1)).alias("rare_labels")
    )
    verdict = status(F.col("h") > 0.20, (F.col("h") > 0.05) | (F.col("f") > 0.20) | (F.col("sensitive_labels") > 0))
    return sums.join(labels).select("classes", "rows", F.round("h", 6).alias("homogeneous_share"), F.round("f", 6).alias("far_share"), "sensitive_labels", "rare_labels", verdict.alias("status"))


def inference(df: DataFrame, user: str | None, row: str, settings: Settings = Settings(), holdout: DataFrame | None = None, label: str = APP) -> DataFrame:
    """(members_accuracy, members_margin, control_accuracy, control_margin, risk, members, control, status).

    The attacker guesses the majority label of a target's class in the release, or the overall one. Members and control
    are the release and a holdout table, or seven and three tenths of the subscribers (of the rows without subscribers).
    """
    keys = base_keys(df)
    texts = lambda d: d.select(*[F.col(c).cast("string").alias(c) for c in keys], F.col(label).cast("string").alias("label"), F.col(row).alias("row"), *([F.col(user).alias("user")] if user and user in d.columns else []))
    w = texts(df)
    if holdout is not None:
        member, control = w, texts(holdout)
    else:
        inside = in_majority_part(settings.seed, F.col("user") if user else F.col("row"))
        member, control = w.filter(inside), w.filter(~inside)
    counts = member.filter("label is not null").dropna(subset=keys).groupBy(*keys, "label").agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("label").alias("guess"))).alias("b")).select(*keys, "b.guess")
    overall = member.filter("label is not null").groupBy("label").agg(F.count("*").alias("n")).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("label").alias("mode"))).alias("b")).select("b.mode")

    def accuracy(part: DataFrame, name: str) -> DataFrame:
        tried = pick(part.filter("label is not null"), settings.attacks, settings.seed, "row")
        hit = tried.join(best, keys, "left").join(F.broadcast(overall)).select((F.coalesce("guess", "mode") == F.col("label")).cast("double").alias("hit"))
        return hit.agg(F.avg("hit").alias(f"p_{name}"), F.count("*").alias(name))

    sizes = member.agg(F.count("*").alias("n_m")).join(control.agg(F.count("*").alias("n_c")))
    out = accuracy(member, "members").join(accuracy(control, "control")).join(sizes)
    pm, pc = F.col("p_members"), F.col("p_control")
    risk = F.when(pc < 1, F.greatest(F.lit(0.0), (pm - pc) / F.when(pc < 1, 1 - pc))).otherwise(0.0)
    margin = lambda p, n: 1.96 * F.sqrt(p * (1 - p) / F.col(n))
    verdict = F.when((F.col("n_m") < 100) | (F.col("n_c") < 100), "SKIP").otherwise(status(risk >= 0.2, risk >= 0.05))
    return out.select(
        F.round(pm, 6).alias("members_accuracy"), F.round(margin(pm, "members"), 6).alias("members_margin"), F.round(pc, 6).alias("control_accuracy"),
        F.round(margin(pc, "control"), 6).alias("control_margin"), F.round(risk, 6).alias("risk"), "members", "control", verdict.alias("status"),
    )


def lacking(df: DataFrame, user: str | None) -> set[str]:
    """The tests that the table has no columns for, by its schema; their verdict is SKIP."""
    has = set(df.columns)
    measured = has & {*VOLUMES, *METRICS}
    needs = {"T2": user in has, "T4": user in has and {TIME, CELL} <= has, "T5": user in has and {TIME, CELL} <= has, "T6": user in has and {"ts", CELL} <= has and bool(measured), "T7": bool(measured), "T8": APP in has, "T9": APP in has}
    return {name for name, there in needs.items() if not there}


def summary(df: DataFrame, user: str, row: str, settings: Settings = Settings(), prefix: str | None = None, digits: int = 9) -> DataFrame:
    """(test, status) of T1 to T9, and the overall verdict: the worst of them."""
    tests = {
        "T1": lambda: identifier_verdict(identifier_scan(df)),
        "T2": lambda: pseudonym_shape(df, user, seed=settings.seed).select("status") if prefix is None else pseudonym_enumeration(df, user, prefix, digits, settings=settings).select("status"),
        "T3": lambda: worst_of(k_risk(df, settings, user)),
        "T4": lambda: unicity_verdict(trajectory_unicity(df, user, settings), settings),
        "T5": lambda: home_exposure(df, user, settings).select("status"),
        "T6": lambda: relink_verdict(metric_relink(df, user, settings)),
        "T7": lambda: worst_of(value_precision(df)),
        "T8": lambda: t_closeness(df, settings).select("status"),
        "T9": lambda: inference(df, user, row, settings).select("status"),
    }
    without = lacking(df, user)
    skip = df.sparkSession.range(1).select(F.lit("SKIP").alias("status"))
    rows = None
    for name, verdict in tests.items():
        one = (skip if name in without else verdict()).select(F.lit(name).alias("test"), "status")
        rows = one if rows is None else rows.unionByName(one)
    return rows.unionByName(worst_of(rows).select(F.lit("overall").alias("test"), "status"))


def run(df: DataFrame, user: str, row: str, settings: Settings = Settings()) -> list[dict]:
    """The suite on the driver: each test's rows and verdict; a test that raises is an ERROR and stops no other."""
    steps = {
        "T1": (lambda: identifier_scan(df), identifier_verdict), "T2": (lambda: pseudonym_shape(df, user), None), "T3": (lambda: k_risk(df, settings, user), worst_of),
        "T4": (lambda: trajectory_unicity(df, user, settings), lambda r: unicity_verdict(r, settings)), "T5": (lambda: home_exposure(df, user, settings), None),
        "T6": (lambda: metric_relink(df, user, settings), relink_verdict), "T7": (lambda: value_precision(df), worst_of), "T8": (lambda: t_closeness(df, settings), None),
        "T9": (lambda: inference(df, user, row, settings), None),
    }
    out = []
    for name, (make, verdict) in steps.items():
        if name in lacking(df, user):
            out.append({"test": name, "status": "SKIP", "details": []})
            continue
        try:
            result = make()
            rows = [r.asDict() for r in result.collect()]  # a few rows of figures
            found = (verdict(result) if verdict else result.select("status")).first()["status"]
            out.append({"test": name, "status": found, "details": rows})
        except Exception as e:  # noqa: BLE001  one test's failure is its own result
            out.append({"test": name, "status": "ERROR", "details": [{"error": f"{type(e).__name__}: {e}"[:500]}]})
    out.append({"test": "overall", "status": worst([r["status"] for r in out]), "details": []})
    return out


"""What a release keeps: measures against the original table, each as (item, value, status) or a small table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CATEGORIES, CELL, KPIS, PROVINCE, RAT
from ..functions.columns import melt, pearson, quantile, running_total, running_totals


def _verdict(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL").alias("status")


def relative_error(o: Column, a: Column) -> Column:
    return F.when((o == 0) & (a == 0), 0.0).otherwise(F.abs(a - o) / F.greatest(F.abs(o), F.lit(1e-12)))


@contextmanager
def stored(*tables: DataFrame) -> Iterator[None]:
    """Tables that are read many times inside stay on the executors' disks meanwhile, unless they are kept already."""
    new = [t for t in tables if not (t.storageLevel.useDisk or t.storageLevel.useMemory)]
    for t in new:
        t.persist(StorageLevel.DISK_ONLY)
    try:
        yield
    finally:
        for t in new:
            t.unpersist()


def shared(orig: DataFrame, anon: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c in orig.columns and c in anon.columns]


def row_retention(orig: DataFrame, anon: DataFrame) -> DataFrame:
    """M1: rows kept; 0.95 or more passes."""
    both = orig.agg(F.count("*").alias("o")).join(anon.agg(F.count("*").alias("a")))
    v = F.col("a") / F.col("o")
    return both.select(F.lit("row_retention").alias("item"), F.round(v, 6).alias("value"), _verdict(v >= 0.95))


def completeness(orig: DataFrame, anon: DataFrame) -> DataFrame:
    """M3: per measurement that the original has, the ratio of the shares of values that aren't null; 0.95 or more passes."""
    columns = shared(orig, anon, KPIS)
    shares = lambda df, name: df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns]).unpivot([], columns, "item", name)
    both = shares(orig, "o").join(shares(anon, "a"), "item").filter("o > 0")
    ratio = F.col("a") / F.col("o")
    return both.select("item", F.round(ratio, 6).alias("value"), _verdict(F.round(ratio, 9) >= 0.95))


def _long(df: DataFrame, columns: list[str], side: str) -> DataFrame:
    return melt(df.select(*columns), [], columns).withColumn("side", F.lit(side))


def distributions(orig: DataFrame, anon: DataFrame) -> DataFrame:
    """M4: (item, ks, median_error, p95_error, status): the largest gap between the two distribution functions, and how far
    median and 95th percentile move; all three within 0.05 pass."""
    columns = shared(orig, anon, KPIS)
    both = _long(orig, columns, "o").union(_long(anon, columns, "a"))
    o, a = F.col("side") == "o", F.col("side") == "a"
    counts = both.groupBy("column", "value").agg(F.count(F.when(o, 1)).alias("no"), F.count(F.when(a, 1)).alias("na"))
    run = running_totals(counts, "column", "value", ["no", "na"]).filter("total_no > 1 and total_na > 1")
    gap = F.abs((F.col("before_no") + F.col("no")) / F.col("total_no") - (F.col("before_na") + F.col("na")) / F.col("total_na"))
    quantiles = [quantile(share, "value", n).alias(f"{n}{share}") for n in ("no", "na") for share in (0.5, 0.95)]
    out = run.groupBy("column").agg(F.max(gap).alias("ks"), *quantiles)
    out = out.select("column", "ks", relative_error(F.col("`no0.5`"), F.col("`na0.5`")).alias("e50"), relative_error(F.col("`no0.95`"), F.col("`na0.95`")).alias("e95"))
    ok = (F.round("ks", 9) <= 0.05) & (F.round("e50", 9) <= 0.05) & (F.round("e95", 9) <= 0.05)
    return out.select(F.col("column").alias("item"), F.round("ks", 6).alias("ks"), F.round("e50", 6).alias("median_error"), F.round("e95", 6).alias("p95_error"), _verdict(ok))


def cdf_points(orig: DataFrame, anon: DataFrame, steps: int = 20) -> DataFrame:
    """What a chart of M4 draws: (item, share, original, anonymised), the values at even shares of both distributions.

    Values halfway between two roundings go up, whatever the last bits of the interpolation say.
    """
    columns = shared(orig, anon, KPIS)
    both = _long(orig, columns, "o").union(_long(anon, columns, "a"))
    sides = {"no": "o", "na": "a"}
    counts = both.groupBy("column", "value").agg(*[F.count(F.when(F.col("side") == x, 1)).alias(n) for n, x in sides.items()])
    run = running_totals(counts, "column", "value", list(sides))

    def met(i: Column, n: str) -> Column:
        """Whether a neighbour of the quantile is this value."""
        place = i / steps * (F.col(f"total_{n}") - 1)
        return (F.col(n) > 0) & (F.floor(place) < F.col(f"before_{n}") + F.col(n)) & (F.ceil(place) >= F.col(f"before_{n}"))

    # Only values beside a quantile go on, once for each that they are beside.
    beside = run.withColumn("i", F.explode(F.filter(F.sequence(F.lit(0), F.lit(steps)), lambda i: met(i, "no") | met(i, "na"))))
    wide = beside.groupBy("column", "i").agg(*[quantile(F.col("i") / steps, "value", n).alias(x) for n, x in sides.items()])
    return wide.select(F.col("column").alias("item"), F.round(F.col("i") / steps, 6).alias("share"), F.round(F.col("o") + 1e-12, 6).alias("original"), F.round(F.col("a") + 1e-12, 6).alias("anonymised"))


def category_shares(orig: DataFrame, anon: DataFrame, top: int = 15, columns: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """What a chart of M5 draws: (item, label, original, anonymised), the shares of each column's commonest labels."""
    out = None
    for c in shared(orig, anon, columns):
        label = F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("label")
        counts = lambda df, n: df.groupBy(label).agg(F.count("*").alias(n))  # noqa: B023, E731
        total = orig.agg(F.count("*").alias("to")).join(anon.agg(F.count("*").alias("ta")))
        first = counts(orig, "o").orderBy(F.desc("o"), "label").limit(top)
        both = first.join(counts(anon, "a"), "label", "left").join(F.broadcast(total))
        one = both.select(F.lit(c).alias("item"), "label", F.round(F.col("o") / F.col("to"), 6).alias("original"), F.round(F.coalesce("a", F.lit(0)) / F.col("ta"), 6).alias("anonymised"))
        out = one if out is None else out.unionByName(one)
    return out


def categorical(orig: DataFrame, anon: DataFrame, columns: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """M5: Jensen-Shannon divergence (base 2) of the labels of each column, null being a label; 0.02 or less passes."""
    names = shared(orig, anon, columns)

    def shares(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("item"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("label")) for c in names])).alias("x")).select("x.*")
        counts = rows.groupBy("item", "label").agg(F.count("*").alias("n"))
        total = counts.groupBy("item").agg(F.sum("n").alias("t"))
        return counts.join(F.broadcast(total), "item").select("item", "label", (F.col("n") / F.col("t")).alias(name))

    both = shares(orig, "p").join(shares(anon, "q"), ["item", "label"], "full").select("item", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    jsd = F.sum(0.5 * part(F.col("p")) + 0.5 * part(F.col("q")))
    out = both.groupBy("item").agg(jsd.alias("v"))
    return out.select("item", F.round("v", 6).alias("value"), _verdict(F.round("v", 9) <= 0.02))


def spearman(df: DataFrame, columns: list[str], row: str = "row_id") -> DataFrame:
    """(a, b, rho): rank correlation of every pair of columns over the rows that have both.

    A pair's ranks are taken among its complete rows. Columns without nulls share theirs; a column with nulls masks its
    rows for all pairs it is in, so there is one ranking for each column and mask, by counts of distinct values and their
    running totals, and not one for each pair.
    """
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first().asDict()
    holes = [c for c in columns if nulls[c]]
    masks: dict[tuple[str, ...], list[tuple[str, str]]] = {}
    for a, b in combinations(columns, 2):
        masks.setdefault(tuple(c for c in (a, b) if c in holes), []).append((a, b))
    out = None
    for mask, pairs in masks.items():
        used = sorted({c for p in pairs for c in p}, key=columns.index)
        rows = df.dropna(subset=list(mask)) if mask else df
        long = melt(rows.select(row, *used), [row], used)
        counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
        ranks = running_total(counts, "column", "value", "n").select("column", "value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))
        # A row's ranks meet in one shuffle, before they are aggregated: a pivot takes two and aggregates by row and column between.
        placed = long.join(ranks, ["column", "value"]).select(row, "column", "rank").repartition(row)
        ranked = placed.groupBy(row).agg(*[F.max(F.when(F.col("column") == c, F.col("rank"))).alias(c) for c in used])
        one = ranked.agg(*[pearson(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
        one = one.unpivot([], [str(i) for i in range(len(pairs))], "i", "rho")
        names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
        one = one.select(names[F.col("i").cast("int")].alias("p"), "rho").select("p.a", "p.b", "rho")
        out = one if out is None else out.unionByName(one)
    return out


def correlation(orig: DataFrame, anon: DataFrame, row: str = "row_id") -> DataFrame:
    """M6: (a, b, original, anonymised, change) of the rank correlations; at most 0.05 of change passes, see `correlation_verdict`."""
    columns = shared(orig, anon, KPIS)
    o, a = spearman(orig, columns, row).withColumnRenamed("rho", "o"), spearman(anon, columns, row).withColumnRenamed("rho", "r")
    both = o.join(a, ["a", "b"])
    return both.select("a", "b", F.round("o", 6).alias("original"), F.round("r", 6).alias("anonymised"), F.round(F.abs(F.col("r") - F.col("o")), 6).alias("change"))


def correlation_verdict(changes: DataFrame) -> DataFrame:
    worst = changes.filter("change is not null and not isnan(change)").agg(F.max("change").alias("v"))
    return worst.select(F.lit("max_abs_delta_rho").alias("item"), F.col("v").alias("value"), _verdict(F.coalesce(F.col("v") <= 0.05, F.lit(False))))


def findings(orig: DataFrame, anon: DataFrame, metric: str = "tp_dl_avg", least: int = 30) -> DataFrame:
    """M7: the gap between the best and worst access type's median, and the rank order of provinces, before and after."""
    medians = lambda df, key, name: df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.median(metric).alias(name), F.count(metric).alias(f"n_{name}"))
    rats = medians(orig, RAT, "o").join(medians(anon, RAT, "a"), RAT)
    ends = rats.agg(F.max(F.struct("o", F.col(RAT).alias("k"), "a")).alias("hi"), F.min(F.struct("o", F.col(RAT).alias("k"), "a")).alias("lo"))
    gap = relative_error(F.col("hi.o") - F.col("lo.o"), F.col("hi.a") - F.col("lo.a"))
    first = ends.select(F.lit("rat_gap_rel_err").alias("item"), F.round(gap, 6).alias("value"), _verdict(F.round(gap, 9) <= 0.05))
    prov = medians(orig, PROVINCE, "o").join(medians(anon, PROVINCE, "a"), PROVINCE).filter((F.col("n_o") >= least) & (F.col("n_a") >= least))
    # One row for each province: the smaller ones, and half of the equal ones with itself.
    rank = lambda x: F.rank().over(Window.partitionBy(F.lit(0)).orderBy(x)) - 1 + 0.5 * F.count("*").over(Window.partitionBy(x))
    ranked = prov.select(rank("o").alias("ro"), rank("a").alias("ra"))
    rho = ranked.agg(F.count("*").alias("n"), pearson("ro", "ra").alias("rho")).withColumn("rho", F.when(F.col("n") >= 3, F.nanvl("rho", F.lit(None))))
    second = rho.select(F.lit("province_ranking_spearman").alias("item"), F.round("rho", 6).alias("value"), _verdict(F.col("rho").isNull() | (F.round("rho", 9) >= 0.95)))
    return first.unionByName(second)


def worst_cells(orig: DataFrame, anon: DataFrame, min_rows: int = 20, top: float = 0.05) -> DataFrame:
    """M9: of the worst cells by two signals, the share that the release shows too; 0.9 or more passes. SKIP where fewer
    than 20 cells, or one in a hundred of the release's, are in both."""
    cells = lambda df: df.filter(F.col(CELL).isNotNull() & (F.col(CELL).cast("string") != "0")).select(F.col(CELL).cast("string").alias("cell")).distinct()
    both = cells(orig).join(cells(anon), "cell")
    known = both.agg(F.count("*").alias("common")).join(cells(anon).agg(F.greatest(F.count("*"), F.lit(1)).alias("in_anon")))
    out = None
    for signal in ("tcp_retrans_byte_ratio_downlink_avg", "cont_rtt_radio_avg"):
        means = lambda df, name: df.select(F.col(CELL).cast("string").alias("cell"), F.col(signal).alias("v")).join(both, "cell").groupBy("cell").agg(F.round(F.avg("v"), 9).alias(name), F.count("v").alias(f"n_{name}"))  # noqa: B023, E731
        m = means(orig, "o").filter(F.col("n_o") >= min_rows).join(means(anon, "a").filter(F.col("n_a") >= min_rows), "cell")
        k = m.agg(F.greatest(F.floor(F.count("*") * top), F.lit(1)).alias("k"))
        # One row for each cell, the radio stations of a network: thousands.
        worse = lambda x: F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(x), "cell")) - 1
        ranked = m.select("cell", worse("o").alias("ro"), worse("a").alias("ra")).join(F.broadcast(k))
        recall = ranked.filter(F.col("ro") < F.col("k")).agg(F.avg((F.col("ra") < F.col("k")).cast("double")).alias("v"))
        skip = (F.col("common") < 20) | (F.col("common") < 0.01 * F.col("in_anon"))
        one = recall.join(known).select(F.lit(f"recall {signal}").alias("item"), F.when(~skip, F.round("v", 6)).alias("value"), F.when(skip, "SKIP").when(F.col("v") >= 0.9, "PASS").otherwise("FAIL").alias("status"))
        out = one if out is None else out.unionByName(one)
    return out


def detail(orig: DataFrame, anon: DataFrame, row: str = "row_id", models: DataFrame | None = None) -> DataFrame:
    """(metric, item, value, status) of every measure; M8 where ``learned.downstream``'s rows are given as ``models``.

    Measures run one after another over stored tables, each giving a few rows: as one plan they would make both tables anew
    for each measure and hold the stages of all at once.
    """
    parts = {
        "M1": lambda: row_retention(orig, anon), "M3": lambda: completeness(orig, anon), "M4": lambda: distributions(orig, anon).select("item", F.col("ks").alias("value"), "status"), "M5": lambda: categorical(orig, anon),
        "M6": lambda: correlation_verdict(correlation(orig, anon, row)), "M7": lambda: findings(orig, anon), "M9": lambda: worst_cells(orig, anon),
        **({"M8": lambda: models} if models is not None else {}),
    }
    rows = []
    with stored(orig, anon):
        for name, part in parts.items():
            rows += part().select(F.lit(name).alias("metric"), "item", F.col("value").cast("double"), "status").collect()
    return orig.sparkSession.createDataFrame(rows, "metric string, item string, value double, status string")


def scorecard(detail_rows: DataFrame) -> DataFrame:
    """(metric, items, passed, status): a metric passes if all its items do."""
    bad = F.sum(F.when(F.col("status") == "FAIL", 1).otherwise(0))
    return detail_rows.groupBy("metric").agg(
        F.count("*").alias("items"), F.sum(F.when(F.col("status") == "PASS", 1).otherwise(0)).alias("passed"), F.when(bad > 0, "FAIL").when(F.min("status") == "SKIP", "SKIP").otherwise("PASS").alias("status")
    )

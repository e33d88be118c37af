"""Linkage measures: class sizes over several key sets, and chains of rows through consecutive hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CELL, CLASS_SETS, DEVICE, LINK_KEYS, TIME, Settings
from .audit import class_sizes
from .points import unicity


def name_of(keys: tuple[str, ...]) -> str:
    return "+".join(keys)


def _sets(df: DataFrame) -> dict[str, list[str]]:
    return {name_of(s): list(s) for s in CLASS_SETS if all(c in df.columns for c in s)}


def equivalence(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """L1: (qi_set, classes, min_k, share_k1, share_below_k, median_k, violating_rows) for each key set, in one pass."""
    classes = class_sizes(df, _sets(df))
    few = F.col("n") < settings.k_min
    rows = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    out = classes.groupBy("keys").agg(
        F.count("*").alias("classes"), F.min("n").alias("min_k"), F.round(rows(F.col("n") == 1) / F.sum("n"), 6).alias("share_k1"), F.round(rows(few) / F.sum("n"), 6).alias("share_below_k"),
        F.round(F.expr("percentile(n, 0.5D, n)"), 6).alias("median_k"), rows(few).alias("violating_rows"),
    )
    return out.withColumnRenamed("keys", "qi_set")


def violating_rows(df: DataFrame, row: str = "row_id", settings: Settings = Settings()) -> DataFrame:
    """L1: (row_id, qi_set, class_size) of every row in a class under k: positions and sizes, never values.

    One plan over all key sets: rows and classes meet by the hash of their key values.
    """
    sets = _sets(df)
    keyed = df.select(F.col(row).alias("row_id"), F.explode(F.array(*[F.struct(F.lit(name).alias("qi_set"), F.sha2(F.to_json(F.struct(*[F.col(c) for c in s]), {"ignoreNullFields": "false"}), 256).alias("key")) for name, s in sets.items()])).alias("x"))
    keyed = keyed.select("row_id", "x.qi_set", "x.key")
    small = keyed.groupBy("qi_set", "key").agg(F.count("*").alias("class_size")).filter(F.col("class_size") < settings.k_min)
    return keyed.join(small, ["qi_set", "key"]).select("row_id", "qi_set", "class_size")


def _key(keys: tuple[str, ...]) -> Column:
    """The key as text in which null differs from every value, and values can't run into each other."""
    parts = [F.concat(F.lit("="), F.regexp_replace(F.col(c).cast("string"), r"([\\|])", r"\\$1")) for c in keys]
    return F.concat_ws("|", *[F.coalesce(x, F.lit("-")) for x in parts])


def hours(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(key, hour, n, cell): rows of each key and hour; cell is that of the only row where n is 1."""
    some_null = F.greatest(*[F.col(c).isNull().cast("int") for c in keys], F.lit(0)) if keys else F.lit(0)
    rows = df.filter(F.col(TIME).isNotNull()).select(_key(keys).alias("key"), some_null.alias("open"), F.col(TIME).alias("hour"), F.col(CELL).alias("cell"))
    return rows.groupBy("key", "hour").agg(F.count("*").alias("n"), F.max("open").alias("open"), F.min("cell").alias("cell"))


def runs(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """L2: (key, hour, cell, run): rows alone in their key and hour, and the run of consecutive hours they are in.

    A key with a null never continues a run.
    """
    alone = hours(df, keys).filter("n = 1")
    order = Window.partitionBy("key").orderBy("hour")
    starts = F.when((F.col("open") == 0) & (F.col("hour") - F.lag("hour").over(order) == 1), 0).otherwise(1)
    return alone.withColumn("start", starts).withColumn("run", F.sum("start").over(order.rowsBetween(Window.unboundedPreceding, 0))).select("key", "hour", "cell", "run")


def _over_keys(df: DataFrame, make) -> DataFrame:  # noqa: ANN001
    out = None
    for keys in LINK_KEYS:
        if all(c in df.columns for c in keys):
            one = make(keys).withColumn("link_key", F.lit(name_of(keys)))
            out = one if out is None else out.unionByName(one)
    return out


def run_lengths(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return runs(df, keys).groupBy("key", "run").agg(F.count("*").alias("length"))


def unique_runs(df: DataFrame) -> DataFrame:
    """L2: (link_key, rows, unambiguous_rows, runs) for each linking key."""
    total = df.agg(F.count("*").alias("rows"))
    return _over_keys(df, lambda keys: total.join(run_lengths(df, keys).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("unambiguous_rows"), F.count("*").alias("runs"))))


def chain_histogram(df: DataFrame, top: int = 24) -> DataFrame:
    """L3: (link_key, length, chains): how many runs have each of the ``top`` smallest lengths."""
    def one(keys: tuple[str, ...]) -> DataFrame:
        return run_lengths(df, keys).groupBy("length").agg(F.count("*").alias("chains")).orderBy("length").limit(top)

    return _over_keys(df, one)


def next_hour(df: DataFrame) -> DataFrame:
    """L3: per linking key, how surely a row leads to the next hour, and how long the chains are."""
    total = df.agg(F.count("*").alias("rows"))

    def one(keys: tuple[str, ...]) -> DataFrame:
        here = hours(df, keys)
        after = here.select("key", (F.col("hour") - 1).alias("hour"), F.col("n").alias("next"))
        links = here.join(after, ["key", "hour"], "left")
        seen = links.agg(
            F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("alone"), F.avg(F.col("next").isNotNull().cast("double")).alias("has"),
            F.avg(F.coalesce((F.col("n") == 1) & (F.col("next") == 1), F.lit(False)).cast("double")).alias("one"), F.expr("percentile(next, 0.5D)").alias("median"),
        )
        long = F.col("length") >= 2
        chains = run_lengths(df, keys).agg(
            F.count("*").alias("chains"), F.sum(F.when(~long, 1).otherwise(0)).alias("chains_len_1"), F.sum(F.when(long, 1).otherwise(0)).alias("chains_len_ge_2"),
            F.sum(F.when(long, F.col("length")).otherwise(0)).alias("long_rows"), F.coalesce(F.max("length"), F.lit(0)).alias("chain_len_max"), F.expr("percentile(length, array(0.5D, 0.9D))").alias("q"),
        )
        zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        return seen.join(chains).join(total).select(
            F.round(F.col("alone") / F.col("rows"), 6).alias("share_rows_unambiguous"), F.round("has", 6).alias("share_hours_with_next"), F.round("one", 6).alias("share_hours_one_to_one"),
            F.round("median", 6).alias("median_next"), "chains", zero("chains_len_1"), zero("chains_len_ge_2"), F.round(F.coalesce("long_rows", F.lit(0)) / F.col("rows"), 6).alias("rows_in_long_chains"),
            "chain_len_max", F.round(F.col("q")[0], 6).alias("chain_len_p50"), F.round(F.col("q")[1], 6).alias("chain_len_p90"),
        )

    return _over_keys(df, one)


def chain_unicity(df: DataFrame, settings: Settings = Settings(), sizes: tuple[int, ...] = (1, 2, 3, 4)) -> DataFrame:
    """L4: (link_key, p, eligible, sampled, unicity): chains that ``p`` of their (hour, cell) points fit alone."""
    def one(keys: tuple[str, ...]) -> DataFrame:
        points = runs(df, keys).select(F.concat_ws("#", "key", F.col("run").cast("string")).alias("entity"), "hour", "cell")
        return unicity(points.dropna(), ["hour", "cell"], sizes, settings.samples, settings.seed).withColumn("unicity", F.round("unicity", 6))

    return _over_keys(df, one)


def overview(df: DataFrame) -> DataFrame:
    """(n_rows, n_hours, distinct_cells, distinct_devices)."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(TIME).alias("n_hours"), F.countDistinct(CELL).alias("distinct_cells"), F.countDistinct(DEVICE).alias("distinct_devices"))

"""Column expressions that the operators share; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import TAC_DIGITS


def _significant(x: Column, figures: int) -> Column:
    factor = F.pow(F.lit(10.0), F.lit(figures - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.try_divide(F.rint(x * factor), factor))


def sig_round(x: Column, figures: int) -> Column:
    """Round half to even to so many significant figures; null stays null."""
    return _significant(x.cast("double"), figures)


def sig_round_finite(x: Column, figures: int, otherwise: Column | None = None) -> Column:
    """As `sig_round`, but values that aren't finite become ``otherwise`` (themselves by default)."""
    x = x.cast("double")
    odd = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(odd, x if otherwise is None else otherwise).otherwise(_significant(x, figures))


def tac(imei: Column) -> Column:
    """The first digits of a trimmed device id; null, empty and the text nan give null."""
    t = F.trim(imei.cast("string"))
    return F.when(~t.isin("", "nan"), F.substring(t, 1, TAC_DIGITS))


def hour_index(seconds: Column) -> Column:
    """Hours since the epoch, rounded down; text that is no number gives null."""
    return F.floor(seconds.try_cast("double") / 3600).cast("long")


def hour_of_day(hour: Column, tz_hours: int = 0) -> Column:
    return F.pmod(hour + F.lit(tz_hours), F.lit(24))


def day_of_week(hour: Column, tz_hours: int = 0) -> Column:
    """Monday is 0."""
    return F.pmod(F.floor((hour + F.lit(tz_hours)) / 24) + 3, F.lit(7))


def draw(seed: int, *keys: Column) -> Column:
    """A pseudorandom order that depends on the keys alone, the same in any engine that has md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def in_majority_part(seed: int, key: Column) -> Column:
    """True for seven tenths of the keys (45,875 of 65,536)."""
    return F.substring(draw(seed, key), 1, 4) < "b333"


def text(x: Column) -> Column:
    """An id as text, without the fraction that a floating-point column would add."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def without_nan(df: DataFrame) -> DataFrame:
    """NaN of floating-point columns as null, so that aggregates skip it."""
    return df.select(*[F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(t)).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def pick(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """The ``n`` rows that come first in the pseudorandom order of their keys."""
    return rows.orderBy(draw(seed, *[F.col(k) for k in keys]), *keys).limit(n)


def running_totals(df: DataFrame, group: str, value: str, weights: list[str], pieces: int = 64) -> DataFrame:
    """``before_<w>``, the sum of weight ``w`` over the smaller values of the group, and ``total_<w>``, over all of them.
    Values must be distinct within a group.

    Each group is cut into stretches at approximate quantiles; sums over stretches, then within a stretch, make the totals,
    so that no group is one task's.
    """
    shares = [i / pieces for i in range(1, pieces)]
    cuts = df.groupBy(group).agg(F.percentile_approx(value, shares, 2000).alias("__cuts")).withColumnRenamed(group, "__g")
    rows = df.join(cuts, F.col(group).eqNullSafe(F.col("__g"))).withColumn("__piece", F.size(F.filter("__cuts", lambda c: c < F.col(value)))).drop("__cuts", "__g")
    sums = rows.groupBy(group, "__piece").agg(*[F.sum(w).alias(f"__w_{w}") for w in weights])
    whole = Window.partitionBy(group)
    upto = whole.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col(group).alias("__g"), F.col("__piece").alias("__p"),
        *[F.coalesce(F.sum(f"__w_{w}").over(upto), F.lit(0)).alias(f"__base_{w}") for w in weights], *[F.sum(f"__w_{w}").over(whole).alias(f"total_{w}") for w in weights],
    )
    inner = Window.partitionBy(group, "__piece").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", *[F.coalesce(F.sum(w).over(inner), F.lit(0)).alias(f"__in_{w}") for w in weights])
    out = rows.join(sums, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__piece") == F.col("__p")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"__base_{w}") + F.col(f"__in_{w}")).alias(f"before_{w}") for w in weights], *[f"total_{w}" for w in weights])


def running_total(df: DataFrame, group: str, value: str, weight: str, pieces: int = 64) -> DataFrame:
    """``before``: the sum of weights of the smaller values of the group, as `running_totals` makes it."""
    return running_totals(df, group, value, [weight], pieces).withColumnRenamed(f"before_{weight}", "before").drop(f"total_{weight}")


def quantile(share: float | Column, value: str, weight: str) -> Column:
    """Aggregate over a group's rows of `running_totals`: the exact quantile, between two neighbours in proportion.

    Only the neighbours are picked, by their places, so partial aggregates hold two values and not the group's.
    """
    place = F.lit(share) * (F.col(f"total_{weight}") - 1)
    at = lambda i: F.max(F.when((F.col(f"before_{weight}") <= i) & (i < F.col(f"before_{weight}") + F.col(weight)), F.col(value)))
    low, high, p = at(F.floor(place)), at(F.ceil(place)), F.max(place)
    return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)


def pearson(x: str, y: str) -> Column:
    """Aggregate: Pearson's correlation of two columns without nulls; NaN where one of them doesn't vary, null without rows.

    ``corr`` divides by zero there, an error in ANSI mode. Variances of a constant column that are merged from partitions may
    differ from zero in their last bits, so its least and greatest values tell.
    """
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    r = F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))
    return F.when(varies, r).when(F.count(x) > 0, F.lit(float("nan")))


def melt(df: DataFrame, keys: list[str], columns: list[str], name: str = "column", value: str = "value") -> DataFrame:
    """One row per key and column with a value that isn't null."""
    return df.unpivot([F.col(k) for k in keys], [F.col(f"`{c}`") for c in columns], name, value).filter(F.col(value).isNotNull())


def same_keys(a: str, b: str, columns: list[str]) -> Column:
    """Equal on all columns, null included."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def status(fail: Column, warn: Column) -> Column:
    return F.when(fail, "FAIL").when(warn, "WARN").otherwise("PASS")

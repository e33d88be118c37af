"""The transform: generalise, round, suppress small classes, drop what stays small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import APP, DEVICE, DIRECT, KPIS, PROVINCE, RAT, RESTRICTED, TIME, Settings, cell_column
from ..functions.columns import hour_index, sig_round, tac, without_nan


def generalise(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Direct identifiers go, device ids become type codes, times become hours, measurements keep a few figures."""
    df = without_nan(raw).drop(*DIRECT)
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        out.append((tac(x) if c == DEVICE else hour_index(x) if c == TIME else sig_round(x, settings.sig_figs) if c in KPIS else x).alias(c))
    return df.select(*out)


def quasi_identifiers(columns: list[str], include_tac: bool = True) -> list[str]:
    cell = cell_column(columns)
    wanted = [TIME, PROVINCE, RAT, *([DEVICE] if include_tac else []), *([cell] if cell else []), APP]
    return [c for c in wanted if c in columns]


def walk_columns(df: DataFrame) -> list[tuple[str, object]]:
    """What is suppressed, in order, and with what: the application first, then the cell."""
    cell = cell_column(df.columns)
    return [(c, 0 if isinstance(df.schema[c].dataType, T.NumericType) else RESTRICTED) for c in (APP, cell) if c and c in df.columns]


def suppression_walk(df: DataFrame, qi: list[str], walk: list[tuple[str, object]], k: int) -> DataFrame:
    """The class table of ``df`` with the values after the walk.

    The walk looks at the key tuple only, so it runs on one row per class. ``new_<c>`` are the values after it, ``size_0``
    to ``size_<n>`` the class sizes before each pass and at the end, ``kept`` whether the class survives. A pass without
    small classes changes nothing, so all passes are always in the plan.
    """
    table = df.groupBy(*qi).agg(F.count("*").alias("n"))
    new = [f"new_{c}" for c in qi]
    table = table.select(*qi, "n", *[F.col(c).alias(f"new_{c}") for c in qi], F.col("n").alias("size_0"))
    for i, (c, sentinel) in enumerate(walk):
        kind = df.schema[c].dataType
        table = table.withColumn(f"new_{c}", F.when(F.col(f"size_{i}") < k, F.lit(sentinel).cast(kind)).otherwise(F.col(f"new_{c}")))
        table = table.withColumn(f"size_{i + 1}", F.sum("n").over(Window.partitionBy(*new)))
    return table.withColumn("kept", F.col(f"size_{len(walk)}") >= k)


def enforce_k(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows after the walk, without those whose class is still small. Null is a value like any other."""
    qi, walk = quasi_identifiers(df.columns, settings.qi_include_tac), walk_columns(df)
    if not qi:
        return df
    table = suppression_walk(df, qi, walk, settings.k_min).filter("kept").select(*qi, *[f"new_{c}" for c, _ in walk]).alias("t")
    match = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in qi])
    walked = {c for c, _ in walk}
    return df.alias("d").join(table, match).select(*[F.col(f"t.new_{c}").alias(c) if c in walked else F.col(f"d.`{c}`") for c in df.columns])


def enforce_k_by_windows(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """As `enforce_k`, with a window over the rows for each pass: for keys so fine that classes are nearly as many as rows."""
    qi, out = quasi_identifiers(df.columns, settings.qi_include_tac), df
    size = F.count("*").over(Window.partitionBy(*qi))
    for c, sentinel in walk_columns(df):
        out = out.withColumn("__n", size).withColumn(c, F.when(F.col("__n") < settings.k_min, F.lit(sentinel).cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out.withColumn("__n", size).filter(F.col("__n") >= settings.k_min).drop("__n")


def release(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The release candidate of raw telemetry. Other columns, such as tags, are carried along."""
    return enforce_k(generalise(raw, settings), settings)


def suppression_report(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(step, action, column, sentinel, rows): the passes up to the first that found nothing small, then rows dropped and kept."""
    df = generalise(raw, settings)
    qi, walk = quasi_identifiers(df.columns, settings.qi_include_tac), walk_columns(df)
    table = suppression_walk(df, qi, walk, settings.k_min)
    sums = [F.sum(F.when(F.col(f"size_{i}") < settings.k_min, F.col("n")).otherwise(0)).alias(f"p{i}") for i in range(len(walk))]
    totals = table.agg(*sums, F.sum(F.when(~F.col("kept"), F.col("n")).otherwise(0)).alias("dropped"), F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)).alias("kept"))
    steps = [F.struct(F.lit(i + 1).alias("step"), F.lit("restrict").alias("action"), F.lit(c).alias("column"), F.lit(str(s)).alias("sentinel"), F.col(f"p{i}").alias("rows")) for i, (c, s) in enumerate(walk)]
    ends = [F.struct(F.lit(len(walk) + 1 + j).alias("step"), F.lit(a).alias("action"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("sentinel"), F.coalesce(F.col(b), F.lit(0)).alias("rows")) for j, (a, b) in enumerate((("drop", "dropped"), ("keep", "kept")))]
    rows = totals.select(F.explode(F.array(*steps, *ends)).alias("s"), *[f"p{i}" for i in range(len(walk))])
    stopped = F.lit(False)
    for i in range(len(walk)):  # a pass is left out if it or one before it found nothing
        stopped = stopped | ((F.col("s.action") == "restrict") & (F.col("s.step") > i) & (F.coalesce(F.col(f"p{i}"), F.lit(0)) == 0))
    return rows.filter(~stopped).select("s.*")

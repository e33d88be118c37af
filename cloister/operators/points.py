"""How many known points of an entity single it out: intersections as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import draw


def chosen_points(points: DataFrame, keys: list[str], p: int, samples: int, seed: int) -> DataFrame:
    """``p`` points (entity, *keys) of each of at most ``samples`` entities that have as many; both by pseudorandom order."""
    enough = points.groupBy("entity").agg(F.count("*").alias("n")).filter(F.col("n") >= p)
    some = enough.orderBy(draw(seed, F.col("entity")), "entity").limit(samples).select("entity")
    order = Window.partitionBy("entity").orderBy(draw(seed, F.col("entity"), *[F.col(k) for k in keys]), *keys)
    return points.join(F.broadcast(some), "entity").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= p).drop("k")


def holders(chosen: DataFrame, index: DataFrame, keys: list[str], p: int) -> DataFrame:
    """(target, candidate): entities of ``index`` (candidate, *keys, distinct) that hold all ``p`` points of the target."""
    met = chosen.withColumnRenamed("entity", "target").join(index, keys)
    return met.groupBy("target", "candidate").agg(F.count("*").alias("n")).filter(F.col("n") == p).select("target", "candidate")


def unicity(points: DataFrame, keys: list[str], sizes: tuple[int, ...], samples: int, seed: int) -> DataFrame:
    """(p, eligible, sampled, unicity): of the sampled entities, the share that ``p`` of their points fit alone.

    points: entity and keys, distinct and without null.
    """
    index = points.withColumnRenamed("entity", "candidate")
    out = None
    for p in sizes:
        eligible = points.groupBy("entity").agg(F.count("*").alias("n")).filter(F.col("n") >= p).agg(F.count("*").alias("eligible"))
        found = holders(chosen_points(points, keys, p, samples, seed), index, keys, p).groupBy("target").agg(F.count("*").alias("n"))
        shares = found.agg(F.count("*").alias("sampled"), F.avg((F.col("n") == 1).cast("double")).alias("unicity"))
        one = eligible.join(shares).select(F.lit(p).cast("long").alias("p"), "eligible", "sampled", "unicity")
        out = one if out is None else out.unionByName(one)
    return out

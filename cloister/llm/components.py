"""Connected components of links, without gathering links or components anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged

_STAR = "a long, b long"


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, smallest id each reaches) over the links a-b."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    low = np.arange(len(ids))
    while len(a):
        la, lb = low[a], low[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        least = np.minimum(la, lb)
        np.minimum.at(low, la, least)
        np.minimum.at(low, lb, least)
        while (low[low] != low).any():
            low = low[low]
    return ids, ids[low]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition, which is a bounded piece of a file, as stars around the smallest ids."""
    parts = [(x.column(0).to_numpy(zero_copy_only=False), x.column(1).to_numpy(zero_copy_only=False)) for x in batches]
    if parts:
        ids, low = local_components(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))
        away = ids != low
        yield pa.RecordBatch.from_arrays([pa.array(ids[away], pa.int64()), pa.array(low[away], pa.int64())], names=["a", "b"])


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(stars: DataFrame) -> DataFrame:
    down = stars.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (two columns of long): the smallest id reachable.

    Each round first contracts the links of each file split by themselves, then makes a large and a small star step over
    all of them; it ends when nothing changes. Links that fit in one split need no steps.
    """
    stars = staged(links.toDF("a", "b").filter("a <> b"), "links")
    while True:
        whole = stars.rdd.getNumPartitions() <= 1
        contracted = staged(stars.mapInArrow(_contract, _STAR), "stars")
        discard(stars)
        stars = contracted
        if whole:
            break
        stepped = staged(_small_star(_large_star(stars)), "stars")
        # All links are stars around ids that are no one's satellite: a step would change nothing.
        settled = stepped.join(stepped.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() and stepped.groupBy("a").count().filter("count > 1").isEmpty()
        discard(stars)
        stars = stepped
        if settled:
            break
    tops = stars.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).union(tops)

"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A text is cut into paragraphs: lines, cut again at sentence ends and after 64 characters. Each paragraph's digest is 64
bits of its bytes and of how often it came before in the text, so a text is a set of digests. A sketch adds every digest
to three cells, each with a count, a sum of digests and a sum of check values. Subtracting two sketches cancels what both
hold, and peeling cells that hold one digest recovers the difference. Where peeling gets stuck, it is tried again with
four times the cells and other places, until it succeeds, so the likeness is exact but for 64-bit collisions.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

_PARAGRAPH = re.compile(r"[^\n.!?]{1,64}[.!?\n]*|[.!?\n]+")
#: Cells of the sketch that is stored; a multiple of 3.
BASE_CELLS = 12
_GROW = 4
_LEVELS = 40
_U = np.uint64


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of a text's paragraphs; the empty text has none."""
    seen: dict[str, int] = {}
    out = []
    for p in _PARAGRAPH.findall(text):
        n = seen.get(p, 0)
        seen[p] = n + 1
        out.append(xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass"), n))
    return np.unique(np.array(out, dtype=np.uint64))


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Well-spread 64-bit values of the keys (the finaliser of splitmix64)."""
    z = keys + _U((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


class Sketches:
    """Many sketches side by side; table t has ``3 * thirds[t]`` cells."""

    def __init__(self, thirds: np.ndarray, salt: int):
        self.thirds, self.salt = thirds.astype(np.int64), salt
        self.first = np.concatenate([[0], np.cumsum(3 * self.thirds)])
        n = int(self.first[-1])
        self.count, self.keys, self.checks = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def add(self, tables: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """Add keys, or with sign -1 subtract them; the cells they are in."""
        third, first = self.thirds[tables], self.first[tables]
        check = _mixed(keys, 0) >> _U(32)
        times = sign.astype(np.int64).view(np.uint64)
        cells = []
        for j in range(3):
            at = first + j * third + (_mixed(keys, 3 * self.salt + j + 1) % third.astype(np.uint64)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, keys * times)
            np.add.at(self.checks, at, check * times)
            cells.append(at)
        return np.concatenate(cells)

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """(how many keys each table differed by, whether peeling emptied it). Empties the tables."""
        found = np.zeros(len(self.thirds), np.int64)
        look = np.flatnonzero(self.count)
        owner = np.repeat(np.arange(len(self.thirds)), 3 * self.thirds)
        while len(look):
            sign = self.count[look]
            single = np.abs(sign) == 1
            look, sign = look[single], sign[single]
            times = sign.view(np.uint64)
            keys = self.keys[look] * times
            pure = (_mixed(keys, 0) >> _U(32)) == self.checks[look] * times
            tables, keys, sign = owner[look[pure]], keys[pure], sign[pure]
            if not len(keys):
                break
            order = np.lexsort((keys, tables))
            tables, keys, sign = tables[order], keys[order], sign[order]
            new = np.concatenate([[True], (tables[1:] != tables[:-1]) | (keys[1:] != keys[:-1])])
            tables, keys, sign = tables[new], keys[new], sign[new]
            np.add.at(found, tables, 1)
            look = np.unique(self.add(tables, keys, -sign))
        rest = np.zeros(len(self.thirds), bool)
        rest[owner[(self.count != 0) | (self.keys != 0) | (self.checks != 0)]] = True
        return found, ~rest

    def texts(self, sizes: np.ndarray) -> list[str]:
        """Each table as text: how many digests it holds, then its cells."""
        cells = np.empty(len(self.count), dtype=[("n", "<i4"), ("k", "<u8"), ("c", "<u4")])
        cells["n"], cells["k"], cells["c"] = self.count, self.keys, self.checks & _U(0xFFFFFFFF)
        return [f"{n:x}." + base64.b64encode(cells[a:b].tobytes()).decode() for n, a, b in zip(sizes.tolist(), self.first, self.first[1:])]


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    tables = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    return tables, np.concatenate([*sets, np.zeros(0, np.uint64)])


def sketch_texts(sets: list[np.ndarray], cells: int = BASE_CELLS) -> list[str]:
    tables, keys = _joined(sets)
    out = Sketches(np.full(len(sets), cells // 3), 0)
    out.add(tables, keys, np.ones(len(keys), np.int64))
    return out.texts(np.array([len(x) for x in sets]))


def likeness(a: list[np.ndarray], b: list[np.ndarray], cells: int = BASE_CELLS) -> np.ndarray:
    """Shared over all digests of each pair of sets, by peeling the difference of their sketches; two empty sets are alike."""
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], dtype=np.int64)
    differ = np.zeros(len(a), np.int64)
    left, third = np.arange(len(a)), cells // 3
    for level in range(_LEVELS):
        if not len(left):
            break
        ta, ka = _joined([a[i] for i in left])
        tb, kb = _joined([b[i] for i in left])
        # Three times the digests always suffice in practice; more cells would only cost memory.
        thirds = np.minimum(third, np.maximum(cells // 3, (total[left] + 8) << max(0, level - 8)))
        s = Sketches(thirds, level)
        s.add(np.concatenate([ta, tb]), np.concatenate([ka, kb]), np.concatenate([np.ones(len(ka), np.int64), np.full(len(kb), -1)]))
        found, done = s.peel()
        differ[left[done]] = found[done]
        left, third = left[~done], third * _GROW
    if len(left):
        raise RuntimeError("a sketch could not be peeled")
    return np.where(total == 0, 1.0, (total - differ) / np.maximum(total + differ, 1))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many characters of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by bucket, tail, falling id: each row against the one after it in its bucket."""
    held: list[tuple[int | None, str, np.ndarray]] = []
    bucket = None

    def made(rows: list, most: int) -> pa.RecordBatch:
        docs, after = rows[:most], rows[1 : most + 1]
        versions = [edited(t, nt) for (_, t, _), (_, nt, _) in zip(docs, after)]
        own, other, new = [x[2] for x in docs], [x[2] for x in after], [digests(v) for v in versions]
        columns = [
            pa.array([x[0] for x in docs], pa.int64()),
            pa.array([len(x[1]) for x in docs], pa.int64()),
            pa.array([hashlib.sha256(v.encode()).hexdigest() for v in versions]),
            pa.array(sketch_texts(own)),
            pa.array(sketch_texts(new)),
            pa.array(likeness(own, new)),
            pa.array(likeness(own, other)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _OUT.split(", ")])

    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            some = batch.slice(i, 200)
            for b, doc_id, text in zip(*(some.column(k).to_pylist() for k in ("bucket", "doc_id", "text"))):
                if b != bucket:
                    if len(held) > 1:
                        yield made(held, len(held) - 1)
                    held, bucket = [], b
                held.append((doc_id, text, digests(text)))
                if len(held) > 200:
                    yield made(held, 200)
                    held = held[200:]
    if len(held) > 1:
        yield made(held, len(held) - 1)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 2000) -> DataFrame:
    """Fingerprint each text, its edited text (see `edited`) and how like they and the next document's are.

    The next document is the one of the next smaller id; equal ids go by a hash of their texts, null ids come last, and
    after the last comes the first. A null text is empty. An empty table gives no rows; a single document is its own next
    one. Other columns are ignored.

    Ids are cut into ranges at quantiles, at most 10,000 of them; each range is sorted by itself and streamed, and also
    gets the first document of the range after it, so no task holds more than a few hundred texts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    low = -(2**63)
    keyed = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(low)).alias("key"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    n = keyed.count()
    ranges = int(min(10_000, max(1, n // rows_per_bucket)))
    cuts = np.unique(np.array(keyed.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else [], dtype=np.float64))

    @F.pandas_udf("int")
    def range_of(key):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, key.to_numpy(dtype=np.float64)).astype(np.int32))

    keyed = keyed.withColumn("bucket", range_of("key"))
    # One row for each range: its first document, to stand after the range before it. There are at most 10,000 ranges.
    heads = keyed.groupBy("bucket").agg(F.max("key").alias("key"))
    first = keyed.join(F.broadcast(heads), ["bucket", "key"]).groupBy("bucket", "key").agg(F.max(F.xxhash64("text")).alias("th"))
    first = keyed.withColumn("th", F.xxhash64("text")).join(F.broadcast(first), ["bucket", "key", "th"]).dropDuplicates(["bucket"])
    downward = Window.orderBy(F.desc("bucket"))
    whole = downward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.withColumn("bucket", F.coalesce(F.lag("bucket").over(downward), F.last("bucket").over(whole)))
    rows = keyed.select("bucket", F.lit(0).alias("tail"), "key", F.xxhash64("text").alias("th"), "doc_id", "text").unionByName(
        first.select("bucket", F.lit(1).alias("tail"), "key", "th", "doc_id", "text")
    )
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "tail", F.desc("key"), F.desc("th"))
    return dealt.select("bucket", "doc_id", "text").mapInArrow(_compare, _OUT)

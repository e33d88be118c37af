"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct shingles of five words. Documents with equal sets are one class, and classes go on
by one row each. From 128 minima of a class's set come 32 band keys, which name candidates, and the low 4 bits of every
minimum, packed into 8 longs: the share of equal lanes, found by bit counts and corrected for lanes that agree by chance,
estimates the similarity. Candidates whose estimate lies six standard errors under the threshold go; all others are
confirmed on full sets.

Buckets are never expanded into all pairs. First every class is compared with the smallest of the buckets it is in; what
that links becomes a component. Classes of buckets that still hold several components are then put in blocks of bounded
size, and each two blocks that share such a bucket are one task, which estimates and counts within arrays and returns the
components it finds as stars. So every likely pair of a bucket is confirmed or lies within one component.
At similarity 0.75 a pair misses all 32 bands with probability 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, discard, small_batches, staged
from .components import components, local_components

MINIMA, BANDS, LANE_BITS, LONGS = 128, 32, 4, 8
#: Classes and shingles of a block in the second round, about.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 500_000
_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_random = np.random.default_rng(20240229)
_TIMES = (_random.integers(0, 2**63, MINIMA, dtype=np.uint64) << _U(1)) | _U(1)
_PLUS = _random.integers(0, 2**63, MINIMA, dtype=np.uint64)
_WEIGHTS = (_random.integers(0, 2**63, 32, dtype=np.uint64) << _U(1)) | _U(1)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            x = np.full(2 * n, base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text in UTF-8, in order; A-Z count as a-z."""
    raw = np.frombuffer(data.lower(), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    up, down = _powers_to(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + _U(1)) * up[: len(raw)])])
    return _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; fewer words are one shingle; none give an empty set."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(h):
        return h
    if len(h) < words:
        return _mix(np.array([np.sum(h * _WEIGHTS[: len(h)], dtype=np.uint64) + _U(len(h))]))
    n = len(h) - words + 1
    out = np.full(n, _U(words))
    for k in range(words):
        out += h[k : k + n] * _WEIGHTS[k]
    return np.unique(_mix(out))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, packed lanes) of non-empty sets, a row each."""
    sizes = np.array([len(x) for x in sets])
    keys, first = np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    minima = np.empty((len(sets), MINIMA), np.uint64)
    for j in range(MINIMA):
        minima[:, j] = np.minimum.reduceat(keys * _TIMES[j] + _PLUS[j], first)
    rows = MINIMA // BANDS
    bands = np.zeros((len(sets), BANDS), np.uint64)
    for k in range(rows):
        bands = _mix(bands * _U(_P) + minima[:, k::rows])
    lanes = (_mix(minima) & _U(2**LANE_BITS - 1)).reshape(len(sets), LONGS, MINIMA // LONGS)
    shift = (np.arange(MINIMA // LONGS) * LANE_BITS).astype(np.uint64)
    return bands.view(np.int64), np.bitwise_or.reduce(lanes << shift, axis=2).view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for lanes that are equal by chance."""
    ones = F.lit(sum(1 << (LANE_BITS * k) for k in range(64 // LANE_BITS)))
    differ = F.lit(0)
    for k in range(LONGS):
        x = a[k].bitwiseXOR(b[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(ones))
    chance = 2.0**-LANE_BITS
    return (F.lit(1.0) - differ / F.lit(float(MINIMA)) - F.lit(chance)) / F.lit(1 - chance)


_SIGNED = "row long, doc_id long, th long, n_shingles long, d1 long, d2 long, bands array<long>, lanes array<long>"


def _signer(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                some = batch.slice(i, 200)
                sets = [shingle_set(t, words) for t in some.column("text").to_pylist()]
                full = [k for k, x in enumerate(sets) if len(x)]
                bands, lanes = signatures([sets[k] for k in full]) if full else (np.zeros((0, BANDS), np.int64), np.zeros((0, LONGS), np.int64))
                at = np.full(len(sets), -1)
                at[full] = np.arange(len(full))
                digest = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
                columns = [
                    some.column("row"), some.column("doc_id"), some.column("th"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digest], pa.int64()),
                    pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digest], pa.int64()),
                    pa.array([bands[k] if k >= 0 else None for k in at], pa.list_(pa.int64())),
                    pa.array([lanes[k] if k >= 0 else None for k in at], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SIGNED.split(", ")])

    return sign


def _setter(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                some = batch.slice(i, 200)
                held = [shingle_set(t, words).tobytes() for t in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column("row"), pa.array(held, pa.binary())], names=["row", "held"])

    return sets


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("ha"), batch.column("hb")):
                x, y = (np.frombuffer(h.as_buffer(), np.uint64) for h in (a, b))
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], names=["a", "b"])

    return confirm


def lane_estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Corrected similarity of every row of x with every row of y, from packed lanes."""
    ones = np.uint64(sum(1 << (LANE_BITS * k) for k in range(64 // LANE_BITS)))
    differ = np.zeros((len(x), len(y)), np.int64)
    for k in range(LONGS):
        z = x[:, k, None] ^ y[None, :, k]
        z |= z >> np.uint64(1)
        z |= z >> np.uint64(2)
        differ += np.bitwise_count(z & ones)
    chance = 2.0**-LANE_BITS
    return (1 - differ / MINIMA - chance) / (1 - chance)


def shared_counts(x: list[np.ndarray], y: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """How many hashes each set of x shares with each set of y: products of 0/1 matrices, some hashes at a time."""
    vx, vy = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(vx, vy)
    rx, ry = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    out = np.zeros((len(x), len(y)))
    if not len(both):
        return out

    def placed(v: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, v), len(both) - 1)
        there = both[at] == v
        at, r = at[there], r[there]
        order = np.argsort(at, kind="stable")
        return at[order], r[order]

    (ax, rx), (ay, ry) = placed(vx, rx), placed(vy, ry)
    for low in range(0, len(both), columns):
        n = min(columns, len(both) - low)
        parts = []
        for at, r, rows in ((ax, rx, len(x)), (ay, ry, len(y))):
            i, j = np.searchsorted(at, [low, low + n])
            m = np.zeros((rows, n), np.float32)
            m[r[i:j], at[i:j] - low] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _block_linker(percent: int, near: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(block: pa.Scalar) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
            v = block.values
            lanes = v.field("lanes").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(v), LONGS)
            return v.field("row").to_numpy(), v.field("component").to_numpy(), [np.frombuffer(h.as_buffer(), np.uint64) for h in v.field("held")], lanes

        for batch in batches:
            for p, q in zip(batch.column("p"), batch.column("q")):
                (rx, cx, sx, lx), (ry, cy, sy, ly) = read(p), read(q)
                likely = (lane_estimates(lx, ly) >= near) & (cx[:, None] != cy[None, :])
                i, j = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
                if not len(i):
                    continue
                shared = shared_counts([sx[k] for k in i], [sy[k] for k in j])
                total = np.array([len(sx[k]) for k in i])[:, None] + np.array([len(sy[k]) for k in j])[None, :]
                a, b = np.nonzero(likely[np.ix_(i, j)] & (100 * shared >= percent * (total - shared)))
                a, b = rx[i[a]], ry[j[b]]
                # The components that these links make, as stars: results grow with the classes, not with the links.
                ids, low = local_components(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(ids[ids != low], pa.int64()), pa.array(low[ids != low], pa.int64())], names=["a", "b"])

    return link


def _same(a: str, b: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """Group documents whose shingle sets are ``percent`` similar or more, directly or through others.

    One row per document: doc_id, n_shingles, component_id (smallest id reachable, its own included), kept (whether that
    is its own id), first (one row of each group; the one to keep), th (hash of the text). A null text is empty; empty
    sets are linked with nothing. Rows with equal ids are documents of their own; a null id is never the smallest unless
    a group has no other. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("th", F.xxhash64("text"))
    signed = staged(source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_signer(words), _SIGNED), "signed")
    full = signed.filter("n_shingles > 0")
    # Aggregates that are joined back are written first: then both sides are plain exchanges, of which Spark can split hot keys.
    classes = staged(full.groupBy("d1", "d2", "n_shingles").agg(F.min("row").alias("rep")), "classes")
    member = staged(full.select("row", "doc_id", "d1", "d2", "n_shingles").hint("merge").join(classes.hint("merge"), ["d1", "d2", "n_shingles"]).select("row", "doc_id", "rep"), "members")
    reps = signed.join(member.filter("row = rep").select("row"), "row", "left_semi")

    rows = reps.select("row", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min("row").alias("center"), F.count("*").alias("n")).filter("n > 1").drop("n")
    held = staged(rows.hint("merge").join(buckets.hint("merge"), ["band", "key"]), "buckets")
    lanes = reps.select("row", "lanes")
    near = percent / 100 - 6 * (percent / 100 * (1 - percent / 100) / MINIMA) ** 0.5 / (1 - 2.0**-LANE_BITS)
    people = staged(held.select("row").distinct(), "candidates")
    lanes = staged(lanes.join(people, "row", "left_semi"), "lanes")

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with their estimate, where that is near enough."""
        a, b = lanes.toDF("a", "la"), lanes.toDF("b", "lb")
        return pairs.join(a, "a").join(b, "b").withColumn("est", estimate(F.col("la"), F.col("lb"))).drop("la", "lb").filter(F.col("est") >= near)

    # The texts of candidates are found again by id and hash, and only their sets go on.
    which = reps.join(people, "row", "left_semi").select("row", "doc_id", "th")
    found = source.alias("s").join(which.alias("w"), _same("s", "w", ["doc_id", "th"])).select("w.row", "s.text")
    sets = staged(found.mapInArrow(_setter(words), "row long, held binary").dropDuplicates(["row"]), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        joined = pairs.select("a", "b").join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")
        return staged(joined.mapInArrow(_confirmer(percent), "a long, b long"), "confirmed")

    # First: every class with the center it shares most bands with.
    votes = held.filter("row <> center").groupBy("row", "center").agg(F.count("*").alias("n"))
    best = votes.groupBy("row").agg(F.max(F.struct("n", (-F.col("center")).alias("c"))).alias("m")).select((-F.col("m.c")).alias("a"), F.col("row").alias("b"))
    links = confirmed(likely(best))
    labels = staged(components(links), "labels")

    # Then: classes of buckets that still hold several components, in blocks; pairs of blocks that share such a bucket.
    at = held.join(labels.withColumnRenamed("id", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
    mixed = at.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("band", "key")
    there = staged(at.join(mixed, ["band", "key"]), "apart")
    if not there.isEmpty():
        rows = there.groupBy("row").agg(F.min("center").alias("anchor"), F.min("component").alias("component")).join(signed.select("row", "n_shingles"), "row")
        sizes = rows.groupBy("anchor").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("subs"))
        rows = staged(rows.join(sizes, "anchor").withColumn("sub", F.pmod(F.xxhash64("row"), "subs")).select("row", "anchor", "sub", "component"), "blocked")
        places = there.select("band", "key", "row").join(rows, "row").groupBy("band", "key", "anchor", "sub").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        p, q = (places.select("band", "key", *[F.col(c).alias(f"{side}_{c}") for c in ("anchor", "sub", "x", "y")]) for side in "pq")
        several = (F.col("p_x") != F.col("p_y")) | (F.col("q_x") != F.col("q_y")) | (F.col("p_x") != F.col("q_x"))
        ordered = (F.col("p_anchor") < F.col("q_anchor")) | ((F.col("p_anchor") == F.col("q_anchor")) & (F.col("p_sub") <= F.col("q_sub")))
        met = p.join(q, (p["band"] == q["band"]) & (p["key"] == q["key"]) & ordered & several).select("p_anchor", "p_sub", "q_anchor", "q_sub").distinct()
        met = staged(met, "met")
        items = F.struct("row", "component", "held", "lanes")
        blocks = staged(rows.join(sets, "row").join(lanes, "row").groupBy("anchor", "sub").agg(F.collect_list(items).alias("items")), "blocks")
        tasks = met.join(blocks.toDF("p_anchor", "p_sub", "p"), ["p_anchor", "p_sub"]).join(blocks.toDF("q_anchor", "q_sub", "q"), ["q_anchor", "q_sub"])
        tasks = tasks.repartition("p_anchor", "p_sub", "q_anchor", "q_sub").select("p", "q")
        with batches_of(spark, 4):
            more = staged(tasks.mapInArrow(_block_linker(percent, near), "a long, b long"), "more")
        if not more.isEmpty():
            labels = staged(components(links.union(more)), "labels")
    discard(held)

    grouped = member.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("m"))
    lowest = staged(lowest.select("component", F.col("m.doc_id").alias("component_id"), F.col("m.row").alias("keeper")), "lowest")
    grouped = grouped.hint("merge").join(lowest.hint("merge"), "component")
    out = signed.select("row", "doc_id", "n_shingles", "th").join(grouped.select("row", "component_id", "keeper"), "row", "left")
    own = F.when(F.col("keeper").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), (F.coalesce("keeper", "row") == F.col("row")).alias("first"), "th")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id. Documents without words all stay."""
    found = near_duplicates(docs, id_col, text_col, words, percent)
    keep = staged(found.filter("first").select("doc_id", "th", "n_shingles"), "keep")
    names = [f"`{c}`" for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("__doc"), F.col(f"`{id_col}`").cast("long").alias("__id"), F.xxhash64(F.col(f"`{text_col}`")).alias("__th"))
    single = keep.filter("n_shingles > 0").select(F.col("doc_id").alias("__kid"), F.col("th").alias("__kth"))
    empty = keep.filter("n_shingles = 0").select(F.col("doc_id").alias("__kid"), F.col("th").alias("__kth")).distinct()
    match = F.col("__id").eqNullSafe(F.col("__kid")) & (F.col("__th") == F.col("__kth"))
    # Rows equal in id and text are told apart by number; one stays, unless they have no words.
    number = F.row_number().over(Window.partitionBy("__id", "__th").orderBy(F.xxhash64("__doc")))
    kept = keyed.join(single, match, "left_semi").withColumn("__n", number).filter("__n = 1").drop("__n")
    return kept.unionByName(keyed.join(empty, match, "left_semi")).select("__doc.*")

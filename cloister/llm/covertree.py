"""Embedding near-duplicates: exact cosine links by dual traversal of cover trees.

Vectors of equal components are one class. Classes are cut into cells around pivots, and those into smaller ones until
they have a bounded size, the upper levels of one large tree; the cells at its ends are blocks. Every block gets a cover tree on the unit sphere: nested levels of centers whose radii
halve, each node with its true covering radius. Two nodes whose centers are further apart than both radii and the
threshold together hold no link and go; two whose centers and radii lie within the threshold are all links, counted
without making the pairs; all others go on to their children, down to single vectors, whose cosine is taken in double
precision. Pairs of cells are pruned by the same bound
on every level, and a block meets a few of the partners that are left in each task, so tasks have a bounded size.

A task returns how many links each vector has and, for the components, stars instead of links, so results grow with the
vectors and not with the links.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged
from .components import components, local_components

#: Radii of the levels; the last level holds the vectors themselves.
_RADII = (2.0, 1.0, 0.5, 0.25, 0.125, 0.0625)
#: Rounding of distances taken in single precision, with room.
_SLACK = 1e-3
#: Node pairs expanded at a time.
_CHUNK = 1 << 18
#: What a comparison of children costs against one in a product of all nodes.
_DEARER = 12
#: Rows dealt to the cells below theirs at a time.
_DEALT = 16384
#: Partners that a block meets in one task, about.
_PARTNERS = 4


def build(vectors: np.ndarray) -> dict:
    """A cover tree over the rows: points[l], the row of each node of level l; child[l], where its children begin and end
    in level l + 1; radius[l]; under[l], where its rows begin and end in the order of the last level."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit.astype(np.float32)
    points, parents = [np.zeros(1, np.int64)], []
    n = len(vectors)
    for radius in _RADII[1:]:
        # Greedy: every row that no center covers becomes one; centers of the level above come first.
        least = 1 - radius * radius / 2
        centers: list[int] = []
        covered = np.zeros(n, bool)
        first = points[-1].tolist()
        for p in first:
            centers.append(p)
        covered |= (near @ near[np.array(first)].T).max(axis=1) >= least if len(first) < 512 else _covered(near, near[np.array(first)], least)
        rest = np.flatnonzero(~covered)
        while len(rest):
            # Of the next uncovered rows, those far from all earlier ones of the batch become centers at once.
            batch = rest[:256]
            inner = near[batch] @ near[batch].T
            taken: list[int] = []
            free = np.ones(len(batch), bool)
            for k in range(len(batch)):
                if free[k]:
                    taken.append(k)
                    free &= inner[k] < least
            new = batch[taken]
            centers += new.tolist()
            rest = rest[len(batch) :]
            if len(rest):
                rest = rest[(near[rest] @ near[new].T).max(axis=1) < least]
        level = np.array(centers, np.int64)
        parents.append(_nearest(near, level, points[-1]))
        points.append(level)
    parents.append(_nearest(near, np.arange(n), points[-1]))
    points.append(np.arange(n))
    # Order every level by parent, so children and rows of a node are stretches.
    child, order = [], np.zeros(1, np.int64)
    for k, parent in enumerate(parents):
        place = np.empty(len(points[k]), np.int64)
        place[order] = np.arange(len(order))
        own = place[parent]
        order = np.argsort(own, kind="stable")
        counts = np.bincount(own, minlength=len(points[k]))
        ends = np.cumsum(counts)
        child.append((ends - counts, ends))
        points[k + 1] = points[k + 1][order]
        if k + 1 < len(parents):
            # parents of the next level are numbered by the unsorted level: keep that numbering's places
            pass
    rows = points[-1]
    under = [(np.arange(n), np.arange(n) + 1)]
    for begin, end in reversed(child):
        low, high = under[0]
        has = end > begin
        under.insert(0, (np.where(has, low[np.minimum(begin, len(low) - 1)], 0), np.where(has, high[np.maximum(end - 1, 0)], 0)))
    radius_of = []
    for k in range(len(points)):
        if k == len(points) - 1:
            radius_of.append(np.zeros(n))
            continue
        low, high = under[k]
        node = np.repeat(np.arange(len(points[k])), high - low)
        far = np.zeros(len(points[k]))
        apart = 2 - 2 * np.einsum("ij,ij->i", unit[points[k][node]], unit[rows[np.concatenate([np.arange(a, b) for a, b in zip(low, high)])]])
        np.maximum.at(far, node, np.sqrt(np.maximum(apart, 0)))
        radius_of.append(far)
    return {"points": points, "child": child, "under": under, "radius": radius_of, "rows": rows}


def _covered(near: np.ndarray, centers: np.ndarray, least: float) -> np.ndarray:
    out = np.zeros(len(near), bool)
    for i in range(0, len(near), 2048):
        out[i : i + 2048] = (near[i : i + 2048] @ centers.T).max(axis=1) >= least
    return out


def _nearest(near: np.ndarray, rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """For each row the nearest center's number; a center is its own."""
    out = np.empty(len(rows), np.int64)
    for i in range(0, len(rows), 2048):
        out[i : i + 2048] = np.argmax(near[rows[i : i + 2048]] @ near[centers].T, axis=1)
    own = {p: k for k, p in enumerate(centers.tolist())}
    for i, r in enumerate(rows.tolist()):
        if r in own:
            out[i] = own[r]
    return out


def _expand(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the node pairs."""
    na, nb = a[1][ia] - a[0][ia], b[1][ib] - b[0][ib]
    n = na * nb
    which = np.repeat(np.arange(len(ia)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return a[0][ia][which] + at // nb[which], b[0][ib][which] + at % nb[which]


def _start(fx: np.ndarray, tx: dict, fy: np.ndarray, ty: dict, eps: float) -> int:
    """The level to begin at: the one whose own comparisons and those of the next level that it leaves cost least.

    All pairs of nodes of the first level are compared by one product; a pair that is left costs each pair of children
    about ``_DEARER`` such comparisons. What is left is estimated from nodes spread over the level; results don't depend on it.
    """
    last = len(tx["points"]) - 1
    costs = []
    for level in range(1, last):
        (px, rx), (py, ry) = (([t[k][level] for k in ("points", "radius")]) for t in (tx, ty))
        some, others = (np.linspace(0, len(p) - 1, min(len(p), 256)).astype(np.int64) for p in (px, py))
        d = np.sqrt(np.maximum(2 - 2 * (fx[px[some]] @ fy[py[others]].T), 0))
        reach = rx[some][:, None] + ry[others][None, :]
        left = (d <= reach + eps + _SLACK) & ~((d + reach <= eps - _SLACK) & (reach > 0))
        below = len(tx["points"][level + 1]) * len(ty["points"][level + 1])
        costs.append(len(px) * len(py) + _DEARER * left.mean() * below)
    return 1 + int(np.argmin(costs))


def traverse(x: np.ndarray, tx: dict, y: np.ndarray, ty: dict, same: bool, cosine: float, wx: np.ndarray, wy: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """(links of each row of x, of y, stars as pairs of (side, row) arrays) over the rows of two blocks, or of one with itself."""
    eps = float(np.sqrt(2 - 2 * cosine))
    ux, uy = x / np.linalg.norm(x, axis=1, keepdims=True), y / np.linalg.norm(y, axis=1, keepdims=True)
    fx, fy = ux.astype(np.float32), uy.astype(np.float32)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    lx, ly = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    stars: list[tuple[np.ndarray, np.ndarray]] = []
    last = len(tx["points"]) - 1
    ia, ib = np.zeros(1, np.int64), np.zeros(1, np.int64)
    start = _start(fx, tx, fy, ty, eps)
    for level in range(start, last + 1):
        px, py, rx, ry = tx["points"][level], ty["points"][level], tx["radius"][level], ty["radius"][level]
        keep_a, keep_b = [], []

        def sift(ca: np.ndarray, cb: np.ndarray, d: np.ndarray) -> None:
            reach = rx[ca] + ry[cb]
            left = d <= reach + eps + _SLACK
            ca, cb, d, reach = ca[left], cb[left], d[left], reach[left]
            if level < last:
                # Single vectors on both sides are decided at once, like the last level.
                whole = (d + reach <= eps - _SLACK) & (reach > 0)
                if same:  # a node with itself has its own pairs to leave out
                    whole &= ca != cb
                for a, b in zip(ca[whole].tolist(), cb[whole].tolist()):
                    (a0, a1), (b0, b1) = ((t["under"][level][0][k], t["under"][level][1][k]) for t, k in ((tx, a), (ty, b)))
                    ra, rb = tx["rows"][a0:a1], ty["rows"][b0:b1]
                    lx[ra] += wy[rb].sum()
                    ly[rb] += wx[ra].sum()
                    stars.append((ra, np.full(len(ra), rb[0])))
                    stars.append((np.full(len(rb), ra[0]), rb))
                if same:  # a node whose vectors all lie within the threshold of each other
                    inside = (ca == cb) & (reach <= eps - _SLACK)
                    for a in ca[inside].tolist():
                        a0, a1 = tx["under"][level][0][a], tx["under"][level][1][a]
                        if a1 - a0 > 1:
                            ra = tx["rows"][a0:a1]
                            lx[ra] += wx[ra].sum() - wx[ra]
                            stars.append((ra, np.full(len(ra), ra[0])))
                    whole |= inside
                ca, cb = ca[~whole], cb[~whole]
                keep_a.append(ca)
                keep_b.append(cb)
            else:
                a, b = px[ca], py[cb]
                exact = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b])
                linked = exact >= cosine
                a, b = a[linked], b[linked]
                np.add.at(lx, a, wy[b])
                np.add.at(ly, b, wx[a])
                stars.append((a, b))

        if len(ia) == 1:  # one pair of nodes: all their children by one product, some rows at a time
            if level == start:
                (a0, a1), (b0, b1) = (0, len(px)), (0, len(py))
            else:
                (a0, a1), (b0, b1) = ((c[0][k], c[1][k]) for c, k in ((tx["child"][level - 1], ia[0]), (ty["child"][level - 1], ib[0])))
            step = max(1, _CHUNK * 4 // max(1, b1 - b0))
            across, row_radius = ry[b0:b1], rx[a0:a1]
            for single in (True, False):  # single vectors, mostly, need one comparison each
                rows = a0 + np.flatnonzero((row_radius == 0) == single)
                for s in range(0, len(rows), step):
                    ca = rows[s : s + step]
                    inner = fx[px[ca]] @ fy[py[b0:b1]].T
                    reach = across + (eps + _SLACK) if single else rx[ca][:, None] + across[None, :] + (eps + _SLACK)
                    at = np.flatnonzero(inner >= (1 - reach * reach / 2).astype(np.float32))
                    i, j = at // (b1 - b0), at % (b1 - b0)
                    d2 = 2 - 2 * inner[i, j].astype(np.float64)
                    i, j = ca[i], j + b0
                    if same:
                        once = i < j if level == last else i <= j
                        i, j, d2 = i[once], j[once], d2[once]
                    sift(i, j, np.sqrt(np.maximum(d2, 0)))
        else:
            size = (tx["child"][level - 1][1][ia] - tx["child"][level - 1][0][ia]) * (ty["child"][level - 1][1][ib] - ty["child"][level - 1][0][ib])
            ends = np.cumsum(size)
            begin = 0
            while begin < len(ia):
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _CHUNK, side="right")))
                ca, cb = _expand(tx["child"][level - 1], ty["child"][level - 1], ia[begin:stop], ib[begin:stop])
                if same:  # below a node with itself each pair of children once
                    twice = np.repeat(ia[begin:stop] == ib[begin:stop], size[begin:stop])
                    ok = ~twice | (ca < cb if level == last else ca <= cb)
                    ca, cb = ca[ok], cb[ok]
                for s in range(0, len(ca), _CHUNK):
                    a, b = ca[s : s + _CHUNK], cb[s : s + _CHUNK]
                    d2 = 2 - 2 * np.einsum("ij,ij->i", fx[px[a]], fy[py[b]]).astype(np.float64)
                    sift(a, b, np.sqrt(np.maximum(d2, 0)))
                begin = stop
        if level < last:
            ia, ib = np.concatenate([*keep_a, np.zeros(0, np.int64)]), np.concatenate([*keep_b, np.zeros(0, np.int64)])
            if not len(ia):
                break
    return lx, ly, stars




def _vectors_of(rows: pa.Table) -> np.ndarray:
    return rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1).astype(np.float64)


def _make_block(key: tuple, rows: pa.Table) -> pa.Table:
    """One row for a block: its vectors, weights and tree, pickled."""
    rows = rows.sort_by("row")
    vectors = _vectors_of(rows)
    held = pickle.dumps((rows.column("row").to_numpy(), rows.column("copies").to_numpy(), vectors, build(vectors)), protocol=5)
    return pa.table({"block": pa.array([key[0].as_py()], pa.string()), "held": pa.array([held], pa.binary())})


def _linker(cosine: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def link(left: pa.Table, right: pa.Table) -> pa.Table:
        """A block against a few partners; a partner without vectors is the block itself."""
        rows, links, other = [], [], []
        if left.num_rows:
            ia, wa, va, ta = pickle.loads(left.column("ha")[0].as_buffer())  # noqa: S301  made by _make_block
            for held in right.column("hb"):
                same = not held.is_valid
                ib, wb, vb, tb = (ia, wa, va, ta) if same else pickle.loads(held.as_buffer())  # noqa: S301
                la, lb, stars = traverse(va, ta, vb, tb, same, cosine, wa, wb)
                if same:
                    la, lb = la + lb, np.zeros(0, np.int64)
                a = np.concatenate([ia[s[0]] for s in stars] + [np.zeros(0, np.int64)])
                b = np.concatenate([ib[s[1]] for s in stars] + [np.zeros(0, np.int64)])
                ids, low = local_components(a, b)
                ids, low = ids[ids != low], low[ids != low]
                ra, rb = np.flatnonzero(la), np.flatnonzero(lb)
                rows += [ia[ra], ib[rb], ids]
                links += [la[ra], lb[rb], np.zeros(len(ids), np.int64)]
                other += [np.full(len(ra) + len(rb), -1), low]
        nothing = np.zeros(0, np.int64)
        return pa.table({name: pa.array(np.concatenate([*x, nothing]), pa.int64()) for name, x in (("row", rows), ("links", links), ("other", other))})

    return link


def _pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Rows of a sample of unit vectors in pseudorandom order: its first ones, which lie where vectors are dense, then
    farthest-first ones, each the one farthest from all before."""
    chosen, d = [0], 2 - 2 * sample @ sample[0]
    while len(chosen) < most:
        fresh = np.flatnonzero(d > 1e-12)
        if not len(fresh):
            break
        k = int(fresh[0]) if len(chosen) < (most + 1) // 2 else int(np.argmax(d))
        chosen.append(k)
        d = np.minimum(d, 2 - 2 * sample @ sample[k])
    return sample[chosen]


def _choose(key: tuple, rows: pa.Table) -> pa.Table:
    """The pivots of a cell, from a sample of its rows."""
    rows = rows.sort_by([("h", "ascending"), ("row", "ascending")])
    x = _vectors_of(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    top = _pivots(x, rows.column("k")[0].as_py())
    return pa.table({"cell": pa.array([key[0].as_py()] * len(top), pa.string()), "k": pa.array(range(len(top)), pa.int32()), "center": pa.array(top.tolist(), pa.list_(pa.float64()))})


def _deal(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Some rows of a cell, each with the cell below it whose pivot is nearest, and how far that is."""
    if not left.num_rows:
        return left.select(["row", "copies", "embedding", "cell"]).append_column("far", pa.array([], pa.float64()))
    x, right = _vectors_of(left), right.sort_by("k")
    inner = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ np.array(right.column("center").to_pylist()).T
    cell = [f"{key[0].as_py()}.{k}" for k in inner.argmax(axis=1).tolist()]
    out = left.select(["row", "copies", "embedding"]).append_column("cell", pa.array(cell, pa.string()))
    return out.append_column("far", pa.array(np.sqrt(np.maximum(2 - 2 * inner.max(axis=1), 0)), pa.float64()))


def _apart(a: Column, b: Column) -> Column:
    """Distance of two unit vectors."""
    squares = F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z: (z["x"] - z["y"]) * (z["x"] - z["y"]))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, x: t + x))


def _blocks_and_partners(reps: DataFrame, cosine: float, block_rows: int, most: int, sample_rows: int) -> tuple[DataFrame, DataFrame]:
    """(block, row, copies, embedding) and the pairs (a, b) of blocks that may hold links, a block with itself included.

    Vectors of one length are a cell; cells of more than ``block_rows`` are cut around pivots of their own, again and
    again, and pairs of cells go down with them, pruned by covering radii: the upper levels of one large tree, made where
    the rows are. A cell that pivots don't part (a cut leaves three quarters together) is cut by hash.
    """
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    here = reps.select("row", "copies", "embedding", F.size("embedding").cast("string").alias("cell"))
    sizes = staged(here.groupBy("cell").agg(F.count("*").alias("n")).withColumn("stuck", F.lit(False)), "cells")
    nodes = sizes.select("cell", F.lit(None).cast("array<double>").alias("center"), F.lit(0.0).alias("far"))
    pairs = sizes.select(F.col("cell").alias("a"), F.col("cell").alias("b"))
    rows, leaves = [], []
    while True:
        big = (F.col("n") > block_rows) & ~F.col("stuck")
        leaves.append(sizes.filter(~big))
        rows.append(here.join(sizes.filter(~big).select("cell", "n"), "cell").select("row", "copies", "embedding", "cell", "n"))
        cut = sizes.filter(big).select("cell", "n")
        if cut.isEmpty():
            break
        known = here.join(cut, "cell")
        share = F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / sample_rows)) == 0
        wanted = F.least(F.lit(most), F.ceil(2 * F.col("n") / block_rows)).cast("int")
        sample = known.filter(share).select("cell", "row", "embedding", F.xxhash64("row", F.lit(1)).alias("h"), wanted.alias("k"))
        pivots = staged(sample.groupBy("cell").applyInArrow(_choose, "cell string, k int, center array<double>"), "pivots")
        chunks = F.ceil(F.col("n") / _DEALT)
        left = known.withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(2)), chunks)).select("cell", "chunk", "row", "copies", "embedding")
        right = pivots.join(cut, "cell").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), "k", "center")
        right = right.toDF(*right.columns)
        below = left.groupBy("cell", "chunk").cogroup(right.groupBy("cell", "chunk")).applyInArrow(_deal, "row long, copies long, embedding array<double>, cell string, far double")
        here = staged(below, "dealt")
        above = cut.select(F.col("cell").alias("parent"), F.col("n").alias("whole"))
        found = here.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).withColumn("parent", F.regexp_replace("cell", r"\.\d+$", ""))
        centers = pivots.select(F.concat_ws(".", "cell", "k").alias("cell"), "center")
        made = staged(found.join(above, "parent").join(centers, "cell").withColumn("stuck", F.col("n") > 0.75 * F.col("whole")), "cells")
        sizes = made.select("cell", "n", "stuck")
        kids = made.select("parent", "cell", "center", "far")
        # Cells that were cut are replaced by those below them; the others stay.
        one = [kids.select(F.col("parent").alias(x), F.col("cell").alias(f"{x}2")) for x in "ab"]
        down = pairs.join(one[0], "a", "left").join(one[1], "b", "left").select(F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b")).filter("a <= b")
        nodes = nodes.join(kids.select(F.col("parent").alias("cell")).distinct(), "cell", "left_anti").unionByName(kids.drop("parent"))
        nodes = staged(nodes, "nodes")
        ends = [nodes.select(F.col("cell").alias(x), F.col("center").alias(f"c{x}"), F.col("far").alias(f"r{x}")) for x in "ab"]
        met = down.join(ends[0], "a").join(ends[1], "b")
        # A cell that was never cut has no center; vectors of other lengths are never its partners.
        near = (F.col("a") == F.col("b")) | (_apart(F.col("ca"), F.col("cb")) <= F.col("ra") + F.col("rb") + reach)
        pairs = staged(met.filter(near).select("a", "b"), "partners")
    subs = F.ceil(F.col("n") / block_rows)
    whole = reduce(DataFrame.unionByName, rows)
    blocks = whole.select(F.concat_ws("#", "cell", F.pmod(F.xxhash64("row", F.lit(3)), subs)).alias("block"), "row", "copies", "embedding")
    parts = reduce(DataFrame.unionByName, leaves).select("cell", F.explode(F.sequence(F.lit(0).cast("long"), subs - 1)).alias("sub"))
    ends = [parts.select(F.col("cell").alias(x), F.col("sub").alias(f"s{x}")) for x in "ab"]
    met = pairs.join(ends[0], "a").join(ends[1], "b").filter("a < b or sa <= sb")
    return blocks, met.select(F.concat_ws("#", "a", "sa").alias("a"), F.concat_ws("#", "b", "sb").alias("b"))


def _scaled(v: Column) -> Column:
    """The vector, divided by its largest component where squares of that could leave the range of doubles."""
    most = F.array_max(F.transform(v, F.abs))
    most = F.when(most > 0, most).otherwise(1.0)
    return F.when(most.between(1e-100, 1e100), v).otherwise(F.transform(v, lambda x: x / most))


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, block_rows: int = 4096, pivots: int = 16, sample_rows: int = 1024
) -> DataFrame:
    """Link vectors of cosine ``cosine`` (over 0.5) or more: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other vectors linked directly, equal ones included; ``component_id`` is the smallest id that
    links reach, the own included; ``kept`` is whether that is the own id. Vectors that are null, empty or zero, or that
    hold a null or a non-finite component, link with nothing; vectors of different lengths never link. Rows with equal
    ids are vectors of their own, and null ids are never the smallest unless a component has no other. An empty table
    gives no rows. Components of any finite size are told apart by direction alone. Other columns are ignored. Cells of more than ``block_rows`` classes are cut around
    ``pivots`` classes at most, from a sample of about ``sample_rows`` of the cell by hash; the sample moves the blocks'
    borders only, not the result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    named = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    rows = staged(named, "vectors")
    v = F.col("embedding")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are equal.
    good = rows.filter(F.coalesce(sound, F.lit(False))).withColumn("embedding", F.transform(v, lambda x: x + F.lit(0.0))).withColumn("digest", F.sha2(F.to_json("embedding"), 256))
    # Aggregates that are joined back are written first: then both sides are plain exchanges, of which Spark can split hot keys.
    classes = staged(good.groupBy("digest").agg(F.min("row").alias("rep"), F.count("*").alias("copies")), "digests")
    member = staged(good.select("row", "vec_id", "digest").join(classes, "digest").drop("digest"), "members")
    reps = staged(member.filter("row = rep").select("row", "copies").join(rows.select("row", _scaled(F.col("embedding")).alias("embedding")), "row"), "classes")
    rows_of, partners = _blocks_and_partners(reps, cosine, block_rows, pivots, sample_rows)
    blocks = staged(rows_of.groupBy("block").applyInArrow(_make_block, "block string, held binary"), "blocks")
    # A hash may leave a block without rows.
    there = blocks.select("block")
    partners = staged(partners.join(there.withColumnRenamed("block", "a"), "a", "left_semi").join(there.withColumnRenamed("block", "b"), "b", "left_semi"), "partners")
    slots = partners.groupBy("a").agg(F.ceil(F.count("*") / _PARTNERS).alias("slots"))
    tasks = partners.join(slots, "a").select("a", "b", F.pmod(F.xxhash64("b"), "slots").alias("slot"))
    # A block goes once to each group of its partners, not once to each of them.
    left = tasks.select("a", "slot").distinct().join(blocks.select(F.col("block").alias("a"), F.col("held").alias("ha")), "a")
    others = tasks.filter("a <> b").join(blocks.select(F.col("block").alias("b"), F.col("held").alias("hb")), "b").select("a", "slot", "hb")
    right = others.unionByName(tasks.filter("a = b").select("a", "slot", F.lit(None).cast("binary").alias("hb")))
    right = right.toDF(*right.columns)
    linked = staged(left.groupBy("a", "slot").cogroup(right.groupBy("a", "slot")).applyInArrow(_linker(cosine), "row long, links long, other long"), "linked")
    labels = staged(components(linked.filter("other >= 0").select("row", "other")), "labels")
    direct = linked.groupBy("row").agg(F.sum("links").alias("links"))
    grouped = member.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = staged(grouped.groupBy("component").agg(F.min("vec_id").alias("component_id")), "lowest")
    grouped = grouped.join(lowest, "component").join(direct.withColumnRenamed("row", "rep"), "rep", "left")
    grouped = grouped.select("row", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("row", "vec_id").join(grouped, "row", "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))

"""Best-fit packing of token sequences by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens. Packing needs only how many pieces have each length, a histogram
of at most ``capacity`` entries, so the plan is made on the driver from that bounded table and pieces find their places
by their rank within their length.

The plan: lengths are indexed by what single, pair and triple sums they make. The gap that a length leaves is filled exactly
by one other length, by two or by three, as often as the counts of all of them allow. What no combination completes goes by
best fit decreasing, over groups of equal sequences.
"""

from __future__ import annotations

import array
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

#: How byte-level vocabularies split a text before merging.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PROBE = "It's 12 o'clock,  isn't it?\n\n\tNo \u00e9\u4e16\u754c \U0001f600 x\u00a0y 3.5e-7 ... they'LL <b>\r\n "


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: visible Latin-1 itself, the rest from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by a tokenizer file, as little-endian unsigned 32-bit bytes.

    A file of plain byte-level BPE whose merges are in the order of their ids is run by tiktoken's merge loop, some six
    times as fast for the same ids; a probe text is compared first. Texts that contain a special token, and all texts
    where the file is of another kind, go through the tokenizer itself.
    """

    def __init__(self, path: str | None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x["content"] for x in parts.get("added_tokens") or []]
        self.fast = self._fast(parts)
        if self.fast and self.fast.encode_to_numpy(_PROBE, disallowed_special=()).tolist() != self._slow(_PROBE):
            self.fast = None

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _fast(self, parts: dict):  # noqa: ANN202
        import tiktoken

        model, before = parts["model"], parts.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if model.get("type") != "BPE" or not plain or parts.get("normalizer") or model.get("ignore_merges"):
            return None
        own = {x["id"] for x in parts.get("added_tokens") or []}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        at = [model["vocab"][m] for m in merged]
        byte_of = _byte_of()
        if at != sorted(at) or any(c not in byte_of for m in model["vocab"] if model["vocab"][m] not in own for c in m):
            return None
        ranks = {bytes(byte_of[c] for c in m): i for m, i in model["vocab"].items() if i not in own}
        return tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for t in texts:
            if not t:
                out.append(b"")
            elif self.fast is None or any(x in t for x in self.special):
                out.append(np.array(self._slow(t), dtype="<u4").tobytes())
            else:
                out.append(self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4", copy=False).tobytes())
        return out


_encoders: dict[str | None, Encoder] = {}


def _encoder(path: str | None) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _cutter(capacity: int, end_id: int, path: str | None):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, end = TaskContext.get().partitionId(), [0] * (capacity + 1), array.array("I", [end_id]).tobytes()
        encoder = _encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 250):
                some = batch.slice(i, 250)
                out: list[list] = [[], [], [], [], [], [], []]
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    start, piece = 0, 0
                    while start < n:
                        length = (n - start) % capacity or capacity
                        row = (doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length])
                        for column, value in zip(out, row):
                            column.append(value)
                        seen[length] += 1
                        start, piece = start + length, piece + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = [x.split()[0] for x in _PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)

    return cut


class Sums:
    """An index of the lengths that are left by the sums that one, two and three of them make.

    ``pairs[s]`` holds the longer length of every pair of sum s, ``triples[s]`` the longest of every triple (its other two
    are a pair of the rest), the longer ones first. Entries whose lengths have run out are skipped, and dropped where one of
    them is gone for good.
    """

    def __init__(self, left: np.ndarray, least: int = 1):
        self.left, n = left, len(left)
        there = np.flatnonzero(left)[::-1]
        there = there[there >= least]
        self.pairs: list[list[int]] = [[] for _ in range(n)]
        for b in there.tolist():
            for c in there[(there <= b) & (there + b < n)].tolist():
                self.pairs[b + c].append(b)
        some = np.array([bool(x) for x in self.pairs])
        self.triples = [there[(there < s) & some[np.maximum(s - there, 0)]].tolist() for s in range(n)]

    def enough(self, lengths: list[int]) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def filling(self, gap: int, k: int, held: list[int]) -> list[int] | None:
        """``k`` lengths of that sum, none longer than the first held one, that are there beside the held ones."""
        left = self.left
        if k == 1:
            return [gap] if 0 < gap <= held[0] and self.enough([*held, gap]) else None
        if k == 2:
            self.pairs[gap] = [b for b in self.pairs[gap] if left[b] and left[gap - b]]
            for b in self.pairs[gap]:
                if b <= held[0] and self.enough([*held, b, gap - b]):
                    return [b, gap - b]
            return None
        self.triples[gap] = [b for b in self.triples[gap] if left[b]]
        for b in self.triples[gap]:
            if b <= held[0] and 3 * b >= gap and self.enough([*held, b]) and (rest := self.filling(gap - b, 2, [b, *held[1:], held[0]])):
                return [b, *rest]
        return None


def plan_packing(counts: dict[int, int], capacity: int, reserve: float = 0.02) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in each) that use up ``counts``: with gaps filled by up to one, two or three lengths,
    whichever needs the fewest. Many lengths in a gap use up small ones early, which helps where there are many of them; the
    smallest, those that hold a share ``reserve`` of all tokens, are in no pair or triple and left for best fit."""
    return min((_plan(counts, capacity, most, reserve) for most in (1, 2, 3)), key=lambda plan: sum(n for n, _ in plan))


def _plan(counts: dict[int, int], capacity: int, most: int, reserve: float) -> list[tuple[int, list[int]]]:
    """From the longest length down, gaps are filled exactly by single lengths, then, in a second pass, by pairs, then by
    triples. What no combination completes goes by best fit decreasing, over groups of equal sequences: a length goes where
    it leaves no room, or else where one or two others that are left fill the rest, or else where it leaves least room."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[int, list[int]]] = []

    def take(lengths: list[int]) -> None:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        n = min(int(left[x]) // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= n * k
        plan.append((n, lengths))

    if left[capacity]:
        take([capacity])
    tokens = np.cumsum(left * np.arange(capacity + 1))
    sums = Sums(left, int(np.searchsorted(tokens, reserve * tokens[-1], side="right")))
    for k in range(1, most + 1):
        for a in range(capacity - 1, 0, -1):
            while left[a] and (found := sums.filling(capacity - a, k, [a])):
                take([a, *found])

    #: By room: groups of equal sequences that have that room.
    open_: dict[int, list[tuple[int, list[int]]]] = {}
    for a in range(capacity, 0, -1):
        n, left[a] = int(left[a]), 0
        while n:
            rooms = sorted(r for r in open_ if r >= a)
            room = next((r for r in rooms if r == a or (r < 2 * a and any(sums.filling(r - a, k, [a]) for k in (1, 2)))), rooms[0] if rooms else None)
            if room is None:
                fits = capacity // a
                full, rest = divmod(n, fits)
                for m, k in ((full, fits), (1 if rest else 0, rest)):
                    if m:
                        open_.setdefault(capacity - k * a, []).append((m, [a] * k))
                break
            m, lengths = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(n, m)
            if m > used:
                open_.setdefault(room, []).append((m - used, lengths))
            open_.setdefault(room - a, []).append((used, [*lengths, a]))
            n -= used
    return plan + [group for groups in open_.values() for group in groups]


def _runs(plan: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, first sequences and offsets of the runs of pieces that lie alike."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for n, lengths in plan:
        offset = 0
        for length in lengths:
            runs.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    return {k: tuple(np.array(x, dtype=np.int64) for x in zip(*v)) for k, v in runs.items()}


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, tokenizer_path: str | None = None
) -> DataFrame:
    """Place every document's tokens in sequences of at most ``capacity``.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is its end
    token alone. Rows with equal or null ids are documents of their own. An empty table gives no rows. Columns other than
    the two named are ignored, whatever their names. ``tokenizer_path`` None: the public byte-level vocabulary, found
    on each executor.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = staged(source.mapInArrow(_cutter(capacity, end_id, tokenizer_path), _PIECES), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = _runs(plan_packing(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                first, at, off = runs[int(x)]
                run = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows], offset[rows] = at[run] + rank[rows] - first[run], off[run]
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    ranked = pieces.join(bases, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

"""Line deduplication by a segment-partition edit join.

Lines within ``edits`` of each other share a segment: cut one into ``edits + 1`` segments, and at least one of them
stands in the other, unshifted but for as many places as edits allow. Every distinct line of ``near_chars`` or more is
indexed by its segments under (length, segment number, hash), and probes the indexes of its own and of smaller lengths
with the substrings that can match. Keys travel in packed arrays, one for each task and bucket of keys, and meet there.
Lines go where no other line of their key has characters that occur an odd number of times in nearly the same way (an edit
changes that for two characters at most). The others come together once more, by key and with their texts, in blocks of a
bounded size: the pairs of a block, or of two blocks of one key, are verified by a bit-parallel edit distance that computes
only the diagonals within the threshold, many pairs at a time: ``edits`` where the longer line has ``least_chars`` or more,
else one. A near pair counts at the smallest of the keys that it shares and nowhere else, and no pair leaves its block: a
block gives each line's number of near lines and the earliest place of any, so results grow with the lines and their
blocks. A key that is frequent within a task is dealt by line, not by key.

Lines shorter than ``near_chars`` are never near anything; equal ones are dropped from ``exact_chars`` on, unless they are
blank. Both are ``least_chars`` if they aren't given.

A line is dropped where the same line, or one within ``edits`` of it, stands earlier: by document id, then place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, small_batches, staged


def within(a: str, b: str, edits: int) -> int | None:
    """Edit distance of a and b where it is at most ``edits`` (30 or less), else None.

    Myers' bit vectors over a band of diagonals (Hyyrö): a word of 64 bits stands for the rows of the longer text around
    the current column, its top bit for the lowest diagonal that matters, and moves down a row with every column.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > edits:
        return None
    if not m:
        return n
    if a == b:
        return 0
    if n <= edits:  # the band would be wider than the text; n edits always do
        near = within(a, b, n - 1)
        return n if near is None else near
    full = (1 << 64) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    up, down, distance = full & (full << (63 - edits)), 0, edits
    most, row = 2 * edits + m - n, 1 << 62
    for j, c in enumerate(b):
        shift = j + edits - 63  # row of the lowest bit
        eq = where.get(c, 0)
        eq = (eq >> shift if shift >= 0 else eq << -shift) & full
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
        right, left = down | (full & ~(diagonal | up)), diagonal & up
        if j < n - edits:
            distance += not diagonal >> 63
        else:  # the lowest diagonal has left the text: follow its last row
            distance += bool(right & row) - bool(left & row)
            row >>= 1
        if distance > most:
            return None
        diagonal >>= 1
        up, down = (left | ~(diagonal | right)) & full, diagonal & right
    return distance if distance <= edits else None


#: Characters of a chunk of pairs that are verified together, and pairs under which one at a time is as fast.
_TOGETHER, _FEW = 1 << 22, 12


def distances(texts: list[str], a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """``within`` of the pairs (texts[a[i]], texts[b[i]]), -1 where that is None, many at a time.

    The words of ``within`` for all pairs, column by column; of the rows only those within the band are compared, as all
    others can't be on a way of so few edits.
    """
    size = np.array([len(x) for x in texts], np.int64)
    out = np.full(len(a), -1, np.int64)
    swap = size[a] < size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    at = np.flatnonzero(size[a] - size[b] <= edits)
    at = at[np.argsort(size[a[at]], kind="stable")]
    begin = 0
    while begin < len(at):
        # As many as fit; the longest comes last.
        most = size[a[at[begin:]]]
        fits = np.searchsorted(most * np.arange(1, len(most) + 1), _TOGETHER, side="right")
        stop = begin + max(1, int(fits))
        some = at[begin:stop]
        begin = stop
        if len(some) < _FEW or edits > 30 or size[a[some[0]]] <= 2 * edits:
            for i in some.tolist():
                d = within(texts[a[i]], texts[b[i]], edits)
                out[i] = -1 if d is None else d
        else:
            out[some] = _banded(texts, a[some], b[some], edits)
    return out


def _codes(texts: list[str], which: np.ndarray, before: int, width: int, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts of ``which``, a row each after ``before`` blanks; and each one's row."""
    own, row = np.unique(which, return_inverse=True)
    out = np.full((len(own), width), blank, np.uint32)
    for k, i in enumerate(own.tolist()):
        out[k, before : before + len(texts[i])] = np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), "<u4")
    return out, row


def _banded(texts: list[str], a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    n, m = (np.array([len(texts[i]) for i in x.tolist()], np.int64) for x in (a, b))
    longer, ra = _codes(texts, a, edits, int(n.max()) + 2 * edits + 1, 0xFFFFFFFE)
    shorter, rb = _codes(texts, b, 0, int(m.max()), 0xFFFFFFFF)
    longer, shorter = np.ascontiguousarray(longer[ra].T), np.ascontiguousarray(shorter[rb].T)
    one, full = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    up, down = np.full(len(a), full << np.uint64(63 - edits), np.uint64), np.zeros(len(a), np.uint64)
    distance, most, out, which = np.full(len(a), edits, np.int64), 2 * edits + m - n, np.full(len(a), -1, np.int64), np.arange(len(a))
    for j in range(int(m.max())):
        eq = np.zeros(len(which), np.uint64)
        for t in range(2 * edits + 1):
            eq |= (longer[j + t] == shorter[j]).astype(np.uint64) << np.uint64(63 - 2 * edits + t)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right, left = down | ~(diagonal | up), diagonal & up
        inside = j < n - edits
        row = one << np.clip(62 - (j - (n - edits)), 0, 62).astype(np.uint64)
        followed = ((right & row) != 0).astype(np.int64) - ((left & row) != 0)
        distance += np.where(inside, (diagonal >> np.uint64(63) == 0).astype(np.int64), followed)
        diagonal >>= one
        up, down = left | ~(diagonal | right), diagonal & right
        ended = m == j + 1
        good = ended & (distance <= edits)
        out[which[good]] = distance[good]
        left_over = ~ended & (distance <= most)
        if ended.any() or (j % 8 == 7 and not left_over.all()):
            which, n, m, up, down, distance, most = (x[left_over] for x in (which, n, m, up, down, distance, most))
            if not len(which):
                break
            longer, shorter = longer[:, left_over], shorter[:, left_over]
    return out


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line, as even as can be, the longer ones last."""
    short, more = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        size = short + (i >= edits + 1 - more)
        out.append((at, size))
        at += size
    return out


def probes(length: int, other: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, start, length) of the substrings of a line that can equal a segment of a line of length ``other`` <= it.

    The multi-match-aware selection: a match of segment i is only needed where at most i edits lie before it and at most
    ``edits - i`` after it.
    """
    gap = length - other
    out = []
    for i, (start, size) in enumerate(segments(other, edits)):
        low = max(0, start - i, start + gap - (edits - i))
        high = min(length - size, start + i, start + gap + (edits - i))
        out += [(i, at, size) for at in range(low, high + 1)]
    return out


_OCCURRENCES = "doc_id long, th long, place int, h1 long, h2 long, again boolean"
_RECORD = np.dtype([("key", "<u4"), ("odd", "<u4"), ("line", "<u8")])
#: Records of one bucket of keys, about; records that a task gathers before it passes them on.
_BUCKET, _GATHER = 500_000, 800_000
#: Pairs looked at together.
_PAIRS = 1 << 19
#: Records of one key in what a task gathers from which on the key is dealt by line; lines of a key that are compared by
#: their characters before they are given on; records that a bucket holds before it gives on what it knows already.
_OFTEN, _COMPARED, _HELD = 256, 1024, 4_000_000


def _split(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def _digest(line: str) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return d >> 64, d & 0xFFFFFFFFFFFFFFFF


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _occurrences(least_chars: int, exact_chars: int):
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                some = batch.slice(i, 200)
                ids, hashes, places, high, low, again = [], [], [], [], [], []
                for doc_id, th, text in zip(*(some.column(k).to_pylist() for k in ("doc_id", "th", "text"))):
                    seen: set[str] = set()
                    for place, line in enumerate(_split(text)):
                        if len(line) >= least_chars or (len(line) >= exact_chars and not line.isspace()):
                            a, b = _digest(line)
                            ids.append(doc_id)
                            hashes.append(th)
                            places.append(place)
                            high.append(a)
                            low.append(b)
                            again.append(line in seen)
                            seen.add(line)
                columns = [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(places, pa.int32()), _signed(high), _signed(low), pa.array(again, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _OCCURRENCES.split(", ")])

    return lines


def odd_characters(lines: list[str]) -> np.ndarray:
    """For each line, which of 32 kinds of characters occur an odd number of times in it."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(x) for x in lines])
    return np.bitwise_xor.reduceat(np.uint32(1) << (codes & np.uint32(31)), np.concatenate([[0], ends[:-1]]))


def _line_keys(line: str, known: dict[int, tuple[list, list]], least_chars: int, edits: int) -> tuple[list[int], int]:
    """Keys of a line, those it is indexed by first, and how many these are. A probe that equals its own index is left out:
    both sides of a key are found by the index."""
    n = len(line)
    if n not in known:
        index = [(n * 16 + k, a, a + size) for k, (a, size) in enumerate(segments(n, edits))]
        probe = [(m * 16 + k, a, a + size) for m in range(max(least_chars, n - edits), n + 1) for k, a, size in probes(n, m, edits)]
        known[n] = (index, [x for x in probe if x not in index])
    index, probe = known[n]
    raw = line.encode("utf-8", "surrogatepass")
    hashed = xxhash.xxh3_64_intdigest
    if len(raw) == n:
        return [hashed(raw[a:b], s) for s, a, b in index] + [hashed(raw[a:b], s) for s, a, b in probe], len(index)
    return [hashed(line[a:b].encode("utf-8", "surrogatepass"), s) for s, a, b in (*index, *probe)], len(index)


def _keys(least_chars: int, edits: int, buckets: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[list, list]] = {}
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0

        def passed_on() -> pa.RecordBatch:
            bucket, records = (np.concatenate(x) for x in zip(*held))
            group = bucket.astype(np.uint64) << np.uint64(32) | records["key"]
            order = np.argsort(group, kind="stable")
            group, bucket, records = group[order], bucket[order], records[order]
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            size = np.diff(np.append(first, len(group)))
            often = np.repeat(size >= _OFTEN, size)
            if often.any():
                # The key's own bucket only hears of it (line 0); its lines go to buckets of their own.
                heads = first[size >= _OFTEN]
                mark = np.zeros(len(heads), _RECORD)
                mark["key"] = records["key"][heads]
                dealt = np.empty(int(often.sum()), _RECORD)
                dealt["key"], dealt["odd"], dealt["line"] = records["key"][often], bucket[often].astype(np.uint32), records["line"][often]
                at = buckets + ((dealt["line"] >> np.uint64(1)) % np.uint64(buckets)).astype(np.int32)
                bucket, records = np.concatenate([bucket[~often], bucket[heads], at]), np.concatenate([records[~often], mark, dealt])
                order = np.argsort(bucket, kind="stable")
                bucket, records = bucket[order], records[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            parts = [x.tobytes() for x in np.split(records, first[1:])]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), pa.array(parts, pa.binary())], names=["bucket", "held"])

        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                lines, ids, values, counts, indexed = [], [], [], [], []
                for text in batch.slice(i, 200).column("text").to_pylist():
                    for line in _split(text):
                        if len(line) < least_chars:
                            continue
                        a = _digest(line)[0]
                        if a in seen:
                            continue
                        if len(seen) > 500_000:  # this only saves records; equal ones are dropped where they meet
                            seen.clear()
                        seen.add(a)
                        k, n = _line_keys(line, known, least_chars, edits)
                        lines.append(line)
                        ids.append(a)
                        values += k
                        counts.append(len(k))
                        indexed.append(n)
                if not lines:
                    continue
                key, count = np.array(values, np.uint64), np.array(counts)
                records = np.empty(len(key), _RECORD)
                records["key"] = key & np.uint64(0xFFFFFFFF)
                records["odd"] = np.repeat(odd_characters(lines), count)
                # The lowest bit of a line's digest tells index (1) from probe (0).
                nth = np.arange(len(key)) - np.repeat(np.cumsum(count) - count, count)
                records["line"] = (np.repeat(np.array(ids, np.uint64), count) & ~np.uint64(1)) | (nth < np.repeat(indexed, count)).astype(np.uint64)
                held.append((((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), records))
                total += len(key)
                if total >= _GATHER:
                    yield passed_on()
                    held, total = [], 0
        if held:
            yield passed_on()

    return keys


def meeting(records: np.ndarray, edits: int, held: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line) of the lines that meet another at a key, one of the two at least by its index, and may be within
    ``edits`` of it; and the records that are still to be kept where more of the bucket follows (``held``).

    Of a key that was dealt by line elsewhere (line 0), or that has many lines, all lines are given.
    """
    records = records[np.lexsort((records["line"], records["key"]))]
    new = np.concatenate([[True], (records["key"][1:] != records["key"][:-1]) | (records["line"][1:] != records["line"][:-1])])
    records = records[new]
    first = np.flatnonzero(np.concatenate([[True], records["key"][1:] != records["key"][:-1]]))
    size = np.diff(np.concatenate([first, [len(records)]]))
    group = np.repeat(np.arange(len(first)), size)
    whole = (records["line"][first] == 0) | (size > _COMPARED)
    given = whole[group] & (records["line"] != 0)
    if held:
        mark = np.zeros(int(whole.sum()), _RECORD)
        mark["key"] = records["key"][first[whole]]
        return records["key"][given], records["line"][given] >> np.uint64(1), np.concatenate([records[~whole[group]], mark])
    found = given.copy()
    at = np.flatnonzero(((records["line"] & np.uint64(1)) == 1) & (size > 1)[group] & ~whole[group])
    many = size[group[at]]
    ends = np.cumsum(many)
    begin = 0
    while begin < len(at):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _PAIRS, side="right")))
        n = many[begin:stop]
        x = np.repeat(at[begin:stop], n)
        y = np.repeat(first[group[at[begin:stop]]], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count(records["odd"][x] ^ records["odd"][y]) <= 2 * edits
        x, y = x[near], y[near]
        apart = records["line"][x] >> np.uint64(1) != records["line"][y] >> np.uint64(1)
        found[x[apart]] = found[y[apart]] = True
        begin = stop
    return records["key"][found], records["line"][found] >> np.uint64(1), records[:0]


_MEMBERS = "key long, line long"


def _meet(edits: int, buckets: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by bucket."""
        bucket, parts, total = None, [], 0

        def members(low: np.ndarray, high: np.ndarray | int, line: np.ndarray) -> pa.RecordBatch:
            key = low.astype(np.int64) | np.asarray(high, np.int64) << 32
            both = np.unique(np.stack([key, line.astype(np.int64)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["key", "line"])

        def made(more: bool) -> pa.RecordBatch:
            nonlocal parts, total
            records = np.concatenate(parts)
            parts, total = [], 0
            if bucket >= buckets:  # dealt by line: known to meet; the place of the characters holds the key's bucket
                return members(records["key"], records["odd"], records["line"] >> np.uint64(1))
            key, line, rest = meeting(records, edits, more)
            if len(rest):
                parts.append(rest)
            return members(key, bucket, line)

        for batch in batches:
            for b, held in zip(batch.column("bucket").to_pylist(), batch.column("held")):
                if b != bucket:
                    if parts:
                        yield made(False)
                    bucket, parts, total = b, [], 0
                parts.append(np.frombuffer(held.as_py(), _RECORD))
                total += len(parts[-1])
                if total >= _HELD:
                    yield made(True)
        if parts:
            yield made(False)

    return meet


_LINES = "line long, h1 long, h2 long, doc_id long, place int, text string"


def _wanted_lines(least_chars: int):
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                some = batch.slice(i, 200)
                ids, places, texts = [], [], []
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    first: dict[str, int] = {}
                    for place, line in enumerate(_split(text)):
                        if len(line) >= least_chars:
                            first.setdefault(line, place)
                    ids += [doc_id] * len(first)
                    places += first.values()
                    texts += first
                both = [_digest(x) for x in texts]
                columns = [pa.array([a >> 1 for a, _ in both], pa.int64()), _signed([a for a, _ in both]), _signed([b for _, b in both]), pa.array(ids, pa.int64()), pa.array(places, pa.int32()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _LINES.split(", ")])

    return lines


_NEAR = "h1 long, h2 long, links long, doc_id long, place int"
#: Lines of a key that are compared as one block; rows that a task verifies together.
BLOCK, _ROWS = 2048, 20_000


def _pairs_of(first: np.ndarray, middle: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of groups, some at a time: of two blocks (first to middle, middle to end), or, where the middle is the
    end, of one."""
    rows = np.concatenate([np.arange(a, b) for a, b in zip(first, middle)] + [np.zeros(0, np.int64)]).astype(np.int64)
    group = np.repeat(np.arange(len(first)), middle - first)
    low = np.where(middle == end, np.int64(-1), middle)[group]
    low = np.where(low < 0, rows + 1, low)
    many = end[group] - low
    ends = np.cumsum(many)
    begin = 0
    while begin < len(rows):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _PAIRS, side="right")))
        n = many[begin:stop]
        x = np.repeat(rows[begin:stop], n)
        yield x, np.repeat(low[begin:stop], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        begin = stop


def _verifier(edits: int, least_chars: int, near_chars: int, buckets: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by (key, one, other)."""
        known: dict[int, tuple[list, list]] = {}

        def keys(line: str) -> tuple[np.ndarray, int]:
            values, n = _line_keys(line, known, near_chars, edits)
            raw = np.array(values, np.uint64)
            return ((raw >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | raw & np.uint64(0xFFFFFFFF)).astype(np.int64), n

        def verified(rows: pa.Table) -> pa.RecordBatch:
            key, one, other, block = (rows.column(c).to_numpy() for c in ("key", "one", "other", "block"))
            texts = rows.column("text").to_pylist()
            size, odd = np.array([len(x) for x in texts]), odd_characters(texts)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (other[1:] != other[:-1])])
            first = np.flatnonzero(new)
            end = np.append(first[1:], len(key))
            group = np.cumsum(new) - 1
            middle = first + np.bincount(group[block == one], minlength=len(first))
            links, theirs = np.zeros(len(key), np.int64), np.full(len(key), len(key), np.int64)
            place = np.lexsort((rows.column("place").to_numpy(), rows.column("doc_id").to_numpy()))
            rank = np.empty(len(key), np.int64)
            rank[place] = np.arange(len(key))
            made: dict[int, tuple[np.ndarray, int]] = {}
            for x, y in _pairs_of(first, middle, end):
                maybe = (np.abs(size[x] - size[y]) <= edits) & (np.bitwise_count(odd[x] ^ odd[y]) <= 2 * edits)
                x, y = x[maybe], y[maybe]
                d = distances(texts, x, y, edits)
                near = (d > 0) & (d <= np.where(np.maximum(size[x], size[y]) >= least_chars, edits, min(edits, 1)))
                x, y = x[near], y[near]
                for i in np.unique(np.concatenate([x, y])).tolist():
                    if i not in made:
                        made[i] = keys(texts[i])
                once = _smallest_shared(made, x, y) == key[x] if len(x) else np.zeros(0, bool)
                x, y = x[once], y[once]
                for i, j in ((x, y), (y, x)):
                    np.add.at(links, i, 1)
                    np.minimum.at(theirs, i, rank[j])
            at = np.flatnonzero(links)
            back = place[theirs[at]]
            columns = [rows.column(c).take(pa.array(at)).combine_chunks() for c in ("h1", "h2")] + [pa.array(links[at])] + [rows.column(c).take(pa.array(back)).combine_chunks() for c in ("doc_id", "place")]
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _NEAR.split(", ")])

        held: list[pa.Table] = []
        total = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            total += batch.num_rows
            if total >= _ROWS:  # all groups but the last one, which may go on
                rows = pa.concat_tables(held).combine_chunks()
                last = np.ones(total, bool)
                for c in ("key", "one", "other"):
                    x = rows.column(c).to_numpy()
                    last &= x == x[-1]
                cut = int(np.argmax(last))
                if cut:
                    yield verified(rows.slice(0, cut))
                held, total = [rows.slice(cut)], total - cut
        if total:
            yield verified(pa.concat_tables(held).combine_chunks())

    return verify


def _smallest_shared(made: dict[int, tuple[np.ndarray, int]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest key at which the lines of each pair meet, one of them by its index."""
    lines = sorted(made)
    at = np.zeros(lines[-1] + 1, np.int64)
    at[lines] = np.arange(len(lines))
    most, none = max(len(k) for k, _ in made.values()), np.iinfo(np.int64).max
    every = np.stack([np.concatenate([k, np.full(most - len(k), -1)]) for k, _ in (made[i] for i in lines)])
    index = np.stack([np.where(np.arange(most) < n, np.concatenate([k, np.full(most - len(k), -1)]), -2) for k, n in (made[i] for i in lines)])
    index = index[:, : max(n for _, n in made.values())]
    out = np.full(len(x), none)
    for i in range(0, len(x), 10_000):
        a, b = at[x[i : i + 10_000]], at[y[i : i + 10_000]]
        for p, q in ((a, b), (b, a)):
            shared = index[p][:, :, None] == every[q][:, None, :]
            out[i : i + 10_000] = np.minimum(out[i : i + 10_000], np.where(shared, index[p][:, :, None], none).min(axis=(1, 2)))
    return out


def _near(source: DataFrame, n_lines: int, edits: int, least_chars: int, near_chars: int, block: int = BLOCK) -> DataFrame:
    """(h1, h2, links, doc_id, place): of each line that is near others, how many these are, and the first of their places."""
    buckets = max(16, n_lines * 15 // _BUCKET)
    keys = source.select("text").mapInArrow(_keys(near_chars, edits, buckets), "bucket int, held binary")
    dealt = keys.repartition("bucket").sortWithinPartitions("bucket")
    # Rows are packed arrays here, of some 100 KB each.
    with batches_of(source.sparkSession, 64):
        members = staged(dealt.mapInArrow(_meet(edits, buckets), _MEMBERS).distinct(), "members")
    people = staged(members.select("line").distinct(), "lines")
    # The lines themselves are only needed for candidates; a broadcast of a million numbers at most.
    few = people.count() <= 1_000_000
    lines = source.select("doc_id", "text").mapInArrow(_wanted_lines(near_chars), _LINES)
    lines = lines.join(F.broadcast(people) if few else people, "line", "left_semi")
    lines = staged(lines.groupBy("h1", "h2").agg(F.first("line").alias("line"), F.min(F.struct("doc_id", "place")).alias("at"), F.first("text").alias("text")), "candidates")
    # A key of many lines is cut into blocks by line, and every block meets itself and every other; both tables are written.
    hot = staged(members.groupBy("key").count().filter(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("n")), "hotkeys")
    rows = members.join(lines, "line").hint("merge").join(hot.hint("merge"), "key", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("h1", "h2"), F.col("n")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("key", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"), "block", "h1", "h2", "at.doc_id", "at.place", "text")
    rows = rows.repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "block")
    found = rows.mapInArrow(_verifier(edits, least_chars, near_chars, buckets), _NEAR)
    return found.groupBy("h1", "h2").agg(F.sum("links").alias("links"), F.min(F.struct("doc_id", "place")).alias("theirs")).select("h1", "h2", "links", "theirs.doc_id", "theirs.place")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th"), F.col(f"`{text_col}`").alias("text")).filter("text is not null")


def near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 2, least_chars: int = 32, near_chars: int | None = None, block: int = BLOCK) -> DataFrame:
    """Distinct lines that are near others: (h1, h2, links, doc_id, place), by the two halves of the line's 128-bit digest;
    ``links`` counts the lines near it, doc_id and place say where the first of these stands first.

    Null and empty texts have no lines; null ids are the smallest. An empty table gives no rows. Other columns are ignored.
    Keys of more than ``block`` lines are compared in blocks; the result doesn't depend on it.
    """
    small_batches(docs.sparkSession)
    source = _source(docs, id_col, text_col)
    n = source.select(F.sum(F.size(F.split("text", "\n", -1)))).first()[0] or 0
    return _near(source, n, edits, least_chars, least_chars if near_chars is None else near_chars, block)


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 2, least_chars: int = 32, near_chars: int | None = None, exact_chars: int | None = None) -> DataFrame:
    """Places of lines that have a copy or a near line: (doc_id, th, place, drop, near, links).

    drop: an equal or near line stands earlier; near: only a near one does; links: near lines of the line. Documents of
    equal ids are not told apart by order: neither drops a line of the other.
    """
    small_batches(docs.sparkSession)
    near_chars, exact_chars = (least_chars if x is None else x for x in (near_chars, exact_chars))
    source = _source(docs, id_col, text_col)
    occurrences = staged(source.mapInArrow(_occurrences(min(least_chars, near_chars), exact_chars), _OCCURRENCES), "occurrences")
    near = _near(source, occurrences.count(), edits, least_chars, near_chars)
    key = ["h1", "h2"]
    first = occurrences.groupBy(*key).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))
    links = staged(near.select(*key, "links", F.struct("doc_id", "place").alias("theirs")), "linelinks")
    # Written first, so that the join's sides are plain exchanges, of which Spark can split a line that is everywhere.
    known = staged(first.filter("n > 1").join(links, key, "full"), "known")
    marked = occurrences.hint("merge").join(known.hint("merge"), key)
    exact = F.col("again") | F.coalesce(F.col("doc_id") > F.col("first_doc"), F.lit(False))
    close = F.coalesce(F.col("theirs") < F.struct("doc_id", "place"), F.lit(False))
    return marked.select("doc_id", "th", "place", (exact | close).alias("drop"), (close & ~exact).alias("near"), F.coalesce("links", F.lit(0)).alias("links"))


def _without(line_col: str = "text") -> Column:
    """The text without the lines at the given places."""
    lines = F.split(F.col(line_col), "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.coalesce("places", F.array().cast("array<int>")), i))
    return F.when(F.col("places").isNull(), F.col(line_col)).otherwise(F.array_join(kept, "\n"))


def _joined(docs: DataFrame, id_col: str, text_col: str, edits: int, least_chars: int, near_chars: int | None, exact_chars: int | None) -> DataFrame:
    """(__doc, __id, __text, places, n_exact, n_near, n_links)"""
    decided = line_decisions(docs, id_col, text_col, edits, least_chars, near_chars, exact_chars)
    # Rows equal in id and text are one document here, whose places come several times.
    by_place = decided.groupBy("doc_id", "th", "place").agg(F.max("drop").alias("drop"), F.max("near").alias("near"), F.max("links").alias("links"))
    by_doc = by_place.groupBy("doc_id", "th").agg(
        F.collect_list(F.when(F.col("drop"), F.col("place"))).alias("places"),
        F.count(F.when(F.col("drop") & ~F.col("near"), 1)).alias("n_exact"),
        F.count(F.when(F.col("near"), 1)).alias("n_near"),
        F.sum("links").alias("n_links"),
    )
    by_doc = by_doc.withColumn("places", F.when(F.size("places") > 0, F.col("places")))
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    keyed = docs.select(F.struct(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in rest]).alias("__doc"), F.col(f"`{text_col}`").alias("__text"))
    keyed = keyed.withColumn("__key", F.coalesce(F.col("__doc")[id_col].cast("long"), F.lit(-(2**63))))
    return keyed.join(by_doc, (F.col("__key") == F.col("doc_id")) & (F.xxhash64("__text") == F.col("th")), "left")


def deduplicated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 2, least_chars: int = 32, near_chars: int | None = None, exact_chars: int | None = None) -> DataFrame:
    """What each document keeps: doc_id, n_lines, n_exact and n_near (lines dropped), n_links (near lines of its lines), text.

    Lines end at line feeds; the text without its dropped lines keeps all others as they are. A null text stays null and
    has no lines; an empty one has none either. Documents of equal ids never drop lines of each other, so repeated rows
    get the same result. Null ids come first. An empty table gives no rows. Other columns are ignored.
    """
    out = _joined(docs.select(f"`{id_col}`", f"`{text_col}`"), id_col, text_col, edits, least_chars, near_chars, exact_chars)
    n_lines = F.when(F.coalesce(F.col("__text"), F.lit("")) == "", 0).otherwise(F.size(F.split("__text", "\n", -1)))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("__doc")[id_col].cast("long").alias("doc_id"), n_lines.cast("long").alias("n_lines"), zero("n_exact"), zero("n_near"), zero("n_links"), _without("__text").alias("text"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 2, least_chars: int = 32, near_chars: int | None = None, exact_chars: int | None = None) -> DataFrame:
    """The documents, with all their columns, without lines that stood earlier; those that lose all their lines go.

    ``n_chars``, where there is such a column, counts the new text.
    """
    out = _joined(docs, id_col, text_col, edits, least_chars, near_chars, exact_chars).withColumn("__new", _without("__text"))
    out = out.filter("places is null or trim(both '\n' from __new) <> ''")
    at = F.col("__doc")
    columns = [F.col("__new") if c == text_col else F.when(F.col("places").isNull(), at[c]).otherwise(F.length("__new").cast("long")) if c == "n_chars" else at[c] for c in docs.columns]
    return out.select(*[x.alias(c) for x, c in zip(columns, docs.columns)])

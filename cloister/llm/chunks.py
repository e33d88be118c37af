"""Substring deduplication by content-defined chunks.

A gear rolling hash over the UTF-8 bytes (32 bits, so its window is 32 bytes) ends a chunk where its top bits are zero,
at least 16 and at most 256 bytes after the last end and never inside a character. Inserting text moves the chunks after
it but doesn't change them, so a passage that several texts share gives the same chunks in all of them, but for the first
and the last. Chunks with equal 128-bit digests are copies of the first of them, by document and place.

Passages are found to the word. Equal texts are one text here, whose copies take its result. Of any ``REACH`` neighbouring
windows of 32 bytes, the one with the smallest gear hash is an anchor, so that any ``REACH + 31`` bytes hold an anchor
wherever they stand. Anchors that stand once rule out all stretches of so many words that they are in; every stretch that is
left, also one too short for an anchor, is digested, and equal digests are copies. Anchors and stretches travel in packed
arrays, one for each task and bucket of digests; what is frequent within a task is dealt by document instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, batches_of, small_batches, staged

SHORTEST, LONGEST, BITS = 16, 256, 5
#: Bytes of an anchor; neighbours of which one is an anchor.
GRAM, REACH = 32, 122
_GEAR = np.random.default_rng(77).integers(1, 2**32, 256, dtype=np.uint32)
_GEAR[0] = 0


def _gear(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, of it and up to 31 before it."""
    h = _GEAR[raw]
    for width in (1, 2, 4, 8, 16):
        if width < len(raw):
            h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text in UTF-8 end; the last is its length."""
    n = len(data)
    raw = np.frombuffer(data, np.uint8)
    h = _gear(raw)
    inner = np.zeros(n, bool)
    inner[:-1] = (raw[1:] & 0xC0) == 0x80
    out, last = [], 0
    for end in (np.flatnonzero(((h >> np.uint32(32 - BITS)) == 0) & ~inner) + 1).tolist():
        while end - last > LONGEST:
            last += LONGEST
            while inner[last - 1]:
                last -= 1
            out.append(last)
        if end - last >= SHORTEST:
            out.append(end)
            last = end
    while n - last > LONGEST:
        last += LONGEST
        while inner[last - 1]:
            last -= 1
        out.append(last)
    if n > last:
        out.append(n)
    return out


_CHUNKS = "row long, doc_id long, nth int, start int, length int, h1 long, h2 long"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    for batch in batches:
        for i in range(0, batch.num_rows, 100):
            some = batch.slice(i, 100)
            out: list[list] = [[], [], [], [], []]
            digests = []
            for row, doc_id, text in zip(*(some.column(k).to_pylist() for k in ("row", "doc_id", "text"))):
                data = text.encode("utf-8", "surrogatepass")
                ends = chunk_ends(data)
                starts = [0, *ends[:-1]]
                n = len(ends)
                for column, values in zip(out, ([row] * n, [doc_id] * n, range(n), starts, [b - a for a, b in zip(starts, ends)])):
                    column.extend(values)
                digests += [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(starts, ends)]
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            columns = [*[pa.array(x, k) for x, k in zip(out, kinds)], pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _CHUNKS.split(", ")])


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every chunk whose content stands elsewhere too: row, doc_id, nth, start, length, h1, h2."""
    small_batches(docs.sparkSession)
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chunks = staged(source.filter("text <> ''").mapInArrow(_chunked, _CHUNKS), "chunks")
    often = chunks.groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1").select("h1")
    return chunks.hint("merge").join(often.hint("merge"), "h1").select("row", "doc_id", "nth", "start", "length", "h1", "h2")


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of a text's anchors, and the first and last start of ``REACH`` neighbours that each is the smallest of (of
    equal ones the last)."""
    if len(data) < GRAM + REACH - 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    h = _gear(raw)[GRAM - 1 :].astype(np.uint64)
    low, size = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64)), 1
    while size < REACH:
        step = min(size, REACH - size)
        low, size = np.minimum(low[:-step], low[step:]), size + step
    at = (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)
    new = np.flatnonzero(at[1:] != at[:-1]) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new - 1, [len(at) - 1]])
    parts = raw[at[first][:, None] + np.arange(GRAM)].view("<u8")
    digest = np.zeros(len(first), np.uint64)
    for k in range(GRAM // 8):
        digest = (digest ^ (digest >> np.uint64(31)) ^ parts[:, k]) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        digest = (digest ^ (digest >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return digest ^ (digest >> np.uint64(32)), first, last


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text in UTF-8 start and end; characters from U+3000 to U+9FFF, written without spaces, are words each."""
    raw = np.frombuffer(data, np.uint8)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    leads = np.flatnonzero((raw & 0xC0) != 0x80)
    if not len(leads):
        return leads, leads
    gaps, wide = gap[leads], (raw[leads] >= 0xE3) & (raw[leads] <= 0xE9)
    starts = leads[~gaps & (wide | np.concatenate([[True], gaps[:-1] | wide[:-1]]))]
    breaks = np.append(np.flatnonzero(gap), len(raw))
    return starts, np.minimum(breaks[np.searchsorted(breaks, starts)], np.append(starts[1:], len(raw))) if len(starts) else starts


_ANCHOR = np.dtype([("digest", "<u8"), ("doc", "<u8")])
#: Anchors of one bucket, about; anchors that a task gathers before it passes them on.
_BUCKET, _GATHER = 500_000, 800_000


def _grouped(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct records by digest; which of them begin one; which have an equal digest, or one that is known (doc 0) to repeat."""
    records = records[np.lexsort((records["doc"], records["digest"]))]
    records = records[np.concatenate([[True], records[1:] != records[:-1]])]
    new = np.concatenate([[True], records["digest"][1:] != records["digest"][:-1]])
    size = np.diff(np.append(np.flatnonzero(new), len(records)))
    return records, new, np.repeat((size > 1) | (records["doc"][new] == 0), size)


def _anchor_records(buckets: int, words: int):
    """Packed anchors of (key, text) by bucket of digests, and digest 0 for a text with stretches too short to hold any. An anchor that repeats within what a task gathers goes on once,
    as doc 0; its documents are dealt over buckets of their own, from ``buckets`` on, so that none is hot."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        total = 0

        def passed_on() -> pa.RecordBatch:
            records, new, again = _grouped(np.concatenate(held))
            once = records[new & again]
            once["doc"] = 0
            here = records[again & (records["doc"] != 0)]
            out = np.concatenate([records[~again], once, here])
            n = len(out) - len(here)
            bucket = (out["digest"] % np.uint64(buckets)).astype(np.int32)
            bucket[n:] = buckets + (here["doc"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, out = bucket[order], out[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            parts = [x.tobytes() for x in np.split(out, first[1:])]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), pa.array(parts, pa.binary())], names=["bucket", "held"])

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                if key in seen:  # equal texts, mostly; only saves work
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(key)
                data = text.as_py().encode("utf-8", "surrogatepass")
                digests = np.sort(anchors(data)[0])
                starts, ends = word_spans(data)
                if len(starts) >= words and (ends[words - 1 :] - starts[: len(starts) - words + 1]).min() < GRAM + REACH - 1:
                    digests = np.concatenate([np.zeros(2, np.uint64), digests])
                twice = digests[1:][digests[1:] == digests[:-1]]
                digests = digests[np.concatenate([[True], digests[1:] != digests[:-1]])] if len(digests) else digests
                records = np.empty(len(digests) + len(twice), _ANCHOR)
                records["digest"] = np.concatenate([digests, twice])
                records["doc"][: len(digests)] = np.int64(key).view(np.uint64)
                records["doc"][len(digests) :] = 0
                held.append(records)
                total += len(records)
                if total >= _GATHER:
                    yield passed_on()
                    held, total = [], 0
        if total:
            yield passed_on()

    return found


def _repeating(buckets: int):
    def repeating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by bucket."""
        bucket, parts = None, []

        def made() -> pa.RecordBatch:
            records = np.frombuffer(b"".join(parts), _ANCHOR)
            if bucket < buckets:
                records, _, again = _grouped(records)
                records = records[again & (records["doc"] != 0)]
            return pa.RecordBatch.from_arrays([pa.array(records[x].view(np.int64).copy()) for x in ("doc", "digest")], names=["key", "digest"])

        for batch in batches:
            for b, held in zip(batch.column("bucket").to_pylist(), batch.column("held")):
                if b != bucket:
                    if parts:
                        yield made()
                    bucket, parts = b, []
                parts.append(held.as_py())
        if parts:
            yield made()

    return repeating


def stretches(data: bytes, repeating: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nth word, start, end) of the stretches of so many words in which every anchor repeats that all their copies have; those
    too short for an anchor are among them."""
    starts, ends = word_spans(data)
    starts, ends = starts[: max(0, len(starts) - words + 1)], ends[words - 1 :]
    digest, first, last = anchors(data)
    alone = ~np.isin(digest, repeating)
    low, high = np.searchsorted(ends, first[alone] + REACH + GRAM - 1), np.searchsorted(starts, last[alone], side="right")
    out = np.zeros(len(starts) + 1, np.int64)
    np.add.at(out, low[low < high], 1)
    np.add.at(out, high[low < high], -1)
    nth = np.flatnonzero((np.cumsum(out[:-1]) == 0) | (ends - starts < REACH + GRAM - 1))
    return nth, starts[nth], ends[nth]


#: A stretch: its digest; its document and the key of its text; which word it begins with; where it starts and ends; kind.
_STRETCH = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("nth", "<i4"), ("start", "<i4"), ("end", "<i4"), ("kind", "<i4")])
#: Kinds of records: a stretch; the first of those in a task that has the others dealt by document; one of these others; a
#: whole text that has copies, with the number of its stretches.
_PLAIN, _FIRST, _OTHER, _WHOLE = range(4)
#: Stretches of one digest in what a task gathers, from which on they are dealt by document; in what a bucket holds; stretches
#: that a task gathers; that a bucket holds before it gives on what it knows already.
_OFTEN, _MANY, _TOGETHER, _HELD = 64, 1024, 300_000, 1_000_000


def _by_digest(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records by digest and place; where each digest begins; how many records it has."""
    records = records[np.lexsort((records["start"], records["key"], records["doc"], records["h2"], records["h1"]))]
    first = np.flatnonzero(np.concatenate([[True], (records["h1"][1:] != records["h1"][:-1]) | (records["h2"][1:] != records["h2"][:-1])]))
    return records, first, np.diff(np.append(first, len(records)))


def _without_frequent(records: np.ndarray, often: int) -> tuple[np.ndarray, np.ndarray]:
    """Records, of which digests that have so many keep the first; and the others of these digests."""
    if not len(records):
        return records, records
    records, first, size = _by_digest(records)
    head = np.zeros(len(records), bool)
    head[first] = True
    frequent = np.repeat(size >= often, size)
    records["kind"][frequent] = np.where(head[frequent], _FIRST, _OTHER)
    rest = frequent & ~head
    return records[~rest], records[rest]


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed for the way to their anchors."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        raw = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column("text")]
        packed = [codec.compress(x, asbytes=True) for x in raw]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array([len(x) for x in raw], pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "k1", "k2", "size", "packed"])


def _stretched(words: int, buckets: int):
    """Packed stretches of (doc_id, k1, size, packed, digests, copies) by bucket of digests."""

    def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        held: list[np.ndarray] = []
        total = 0

        def passed_on() -> pa.RecordBatch:
            records = np.concatenate(held)
            whole = records["kind"] == _WHOLE
            here, others = _without_frequent(records[~whole], _OFTEN)
            others = np.concatenate([others, records[whole]])
            bucket = np.concatenate([(here["h1"] % np.uint64(buckets)).astype(np.int32), buckets + (others["key"].view(np.uint64) % np.uint64(buckets)).astype(np.int32)])
            out = np.concatenate([here, others])
            order = np.argsort(bucket, kind="stable")
            bucket, out = bucket[order], out[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            parts = [x.tobytes() for x in np.split(out, first[1:])]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), pa.array(parts, pa.binary())], names=["bucket", "held"])

        def some_of(doc_id: int, key: int, nth: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
            out = np.zeros(len(nth), _STRETCH)
            for c, x in (("doc", doc_id), ("key", key), ("nth", nth), ("start", start), ("end", end), ("kind", kind)):
                out[c] = x
            return out

        for batch in batches:
            for doc_id, key, size, packed, digests, copies in zip(*(batch.column(k) for k in ("doc_id", "k1", "size", "packed", "digests", "copies"))):
                doc_id, key = doc_id.as_py(), key.as_py()
                data = codec.decompress(packed.as_py(), size.as_py(), asbytes=True)
                known = np.asarray(digests.values).view(np.uint64) if digests.is_valid else np.zeros(0, np.uint64)
                nth, start, end = stretches(data, known, words)
                if copies.as_py() > 1:
                    starts, ends = word_spans(data)
                    if len(starts) >= words:
                        n = len(starts) - words + 1
                        held.append(some_of(doc_id, key, np.array([n]), starts[:1], ends[-1:], _WHOLE))
                for i in range(0, len(nth), 100_000):
                    a, b = start[i : i + 100_000], end[i : i + 100_000]
                    records = some_of(doc_id, key, nth[i : i + 100_000], a, b, _PLAIN)
                    h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[x:y]) for x, y in zip(a.tolist(), b.tolist())]), "<u8").reshape(-1, 2)
                    records["h1"], records["h2"] = h[:, 0], h[:, 1]
                    held.append(records)
                    total += len(records)
                    if total >= _TOGETHER:
                        yield passed_on()
                        held, total = [], 0
        if held:
            yield passed_on()

    return stretched


_ALIKE = "doc_id long, key long, nth int, start int, end int, later boolean, first_doc long, h1 long, h2 long, kind int"


def _alike(buckets: int):
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by bucket: the stretches that stand more than once."""
        bucket, parts, total = None, [], 0

        def given(records: np.ndarray, first_doc: np.ndarray | None, later: np.ndarray | None) -> pa.RecordBatch:
            kind = records["kind"]
            none = np.ones(len(records), bool)
            # The digest is only wanted where it will be looked up.
            plain = (kind == _PLAIN) | (kind == _WHOLE)
            columns = [pa.array(records[c].copy()) for c in ("doc", "key", "nth", "start", "end")]
            columns += [pa.array(none if later is None else later), pa.array(np.zeros(len(records), np.int64) if first_doc is None else first_doc, mask=none if first_doc is None else None)]
            columns += [pa.array(records[c].view(np.int64).copy() if records[c].flags.c_contiguous else records[c].copy().view(np.int64), mask=plain) for c in ("h1", "h2")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(kind.copy())], names=[x.split()[0] for x in _ALIKE.split(", ")])

        def made() -> pa.RecordBatch:
            records, first, size = _by_digest(np.concatenate(parts))
            known = np.logical_or.reduceat(records["kind"] == _FIRST, first)
            head = np.zeros(len(records), bool)
            head[first] = True
            records["kind"] = np.where(head & np.repeat(known, size), _FIRST, _PLAIN)
            again = np.repeat((size > 1) | known, size)
            first_doc = np.repeat(records["doc"][first], size)
            return given(records[again], first_doc[again], ~head[again])

        for batch in batches:
            for b, held in zip(batch.column("bucket").to_pylist(), batch.column("held")):
                records = np.frombuffer(held.as_py(), _STRETCH)
                if b >= buckets:
                    yield given(records, None, None)
                    continue
                if b != bucket:
                    if parts:
                        yield made()
                    bucket, parts, total = b, [], 0
                parts.append(records)
                total += len(records)
                if total >= _HELD:
                    here, others = _without_frequent(np.concatenate(parts), _MANY)
                    parts, total = [here], 0
                    if len(others):
                        yield given(others, None, None)
        if parts:
            yield made()

    return alike


def _repeated(docs: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, k1, k2, m), the distinct pairs of id and text with their numbers of rows; (k1, k2, doc_id, copies), the first of
    each text; and the repeated stretches of these, and their whole texts where there are copies, as ``_ALIKE`` with every
    first_doc filled in."""
    if words < 1:
        raise ValueError("a passage has at least one word")
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(f"`{text_col}`")
    source = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text.alias("text")).filter("text <> ''")
    # Zero stands for anchors known to repeat; texts that share a key only share what is looked at.
    k1 = F.xxhash64("text")
    source = source.withColumn("k1", F.when(k1 == 0, 1).otherwise(k1)).withColumn("k2", F.xxhash64(F.lit(1), "text"))
    sized = source.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("m"), F.sum(F.octet_length("text")).alias("size"))
    members = staged(sized, "texts")
    classes = staged(members.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.sum("m").alias("copies")), "classes")
    n_bytes = members.agg(F.sum("size")).first()[0] or 0
    buckets = max(16, n_bytes * 2 // REACH // _BUCKET)
    dealt = source.select(F.col("k1").alias("key"), "text").mapInArrow(_anchor_records(buckets, words), "bucket int, held binary").repartition("bucket").sortWithinPartitions("bucket")
    # Rows are packed arrays here, of some 100 KB each.
    with batches_of(spark, 64):
        known = staged(dealt.mapInArrow(_repeating(buckets), "key long, digest long"), "anchors")
    by_key = known.groupBy("key").agg(F.collect_set("digest").alias("digests")).withColumnRenamed("key", "k1")
    wanted = staged(classes.join(by_key, "k1", "left").filter("copies > 1 or digests is not null"), "wanted")
    # One row of each text: what is equal in id and text, too, comes once.
    texts = source.mapInArrow(_packed_texts, "doc_id long, k1 long, k2 long, size long, packed binary")
    texts = texts.hint("merge").join(wanted.hint("merge"), ["k1", "k2", "doc_id"]).dropDuplicates(["k1", "k2", "doc_id"])
    buckets = max(16, n_bytes // 20 // _TOGETHER)
    with batches_of(spark, 100):
        dealt = texts.select("doc_id", "k1", "size", "packed", "digests", "copies").mapInArrow(_stretched(words, buckets), "bucket int, held binary")
        alike = staged(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_alike(buckets), _ALIKE), "alike")
    hot = alike.filter(F.col("kind") == _FIRST).select("h1", "h2", F.col("first_doc").alias("theirs"))
    # Both sides are plain exchanges of written rows, of which Spark can split a stretch that is everywhere.
    others = alike.filter(F.col("kind") == _OTHER).hint("merge").join(hot.hint("merge"), ["h1", "h2"]).withColumn("first_doc", F.col("theirs"))
    columns = ["doc_id", "key", "nth", "start", "end", "later", "first_doc", "kind"]
    return members, classes, alike.filter(F.col("kind") != _OTHER).select(columns).union(others.select(columns))


_NO_ID = -(2**63)


def _runs(rows: DataFrame) -> DataFrame:
    """Stretches that begin with neighbouring words, as one: (doc_id, key, start, length, n_chunks, first_doc_id, repeat)."""
    run = F.col("nth") - F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("nth"))
    runs = rows.withColumn("run", run).groupBy("doc_id", "key", "run").agg(
        F.min("start").cast("long").alias("start"),
        (F.max("end") - F.min("start")).cast("long").alias("length"),
        F.count("*").alias("n_chunks"),
        F.min("first_doc").alias("first_doc_id"),
        F.max("later").alias("repeat"),
    )
    return runs.drop("run")


_SHARED = ["start", "length", "n_chunks", "first_doc_id", "repeat"]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 51) -> DataFrame:
    """Passages of ``words`` words or more that stand elsewhere too, in the same or another document, to the word.

    One row per passage and place: doc_id, start and length (bytes of the UTF-8 text), n_chunks (stretches of ``words`` words
    in it), first_doc_id (the smallest id that has any of its stretches), repeat (whether any of its stretches stands earlier,
    by id and place; False for the place that keeps the passage). Stretches that begin with neighbouring words make one
    passage. A document that shares nothing has no row. Null and empty texts have no words. Rows with equal ids are documents
    of their own; null ids come first. An empty table gives no rows. Other columns are ignored.
    """
    members, classes, rows = _repeated(docs, id_col, text_col, words)
    whole = rows.filter(F.col("kind") == _WHOLE).select("doc_id", "key", F.col("start").cast("long").alias("start"), (F.col("end") - F.col("start")).cast("long").alias("length"), F.col("nth").cast("long").alias("n_chunks"))
    parts = rows.filter(F.col("kind") != _WHOLE)
    alone = _runs(parts.join(whole.select("doc_id", "key"), ["doc_id", "key"], "left_anti")).select("doc_id", *_SHARED)
    found = parts.groupBy("doc_id", "key").agg(F.min("first_doc").alias("f"), F.max("later").alias("later"))
    whole = whole.join(found, ["doc_id", "key"], "left")
    whole = whole.select(F.col("doc_id").alias("first"), F.col("key").alias("k1"), "start", "length", "n_chunks", F.least("f", "doc_id").alias("first_doc_id"), F.coalesce("later", F.lit(False)).alias("later"))
    copied = classes.filter("copies > 1").select("k1", "k2", F.col("doc_id").alias("first")).join(whole, ["k1", "first"])
    each = members.hint("merge").join(copied.hint("merge"), ["k1", "k2"]).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    each = each.withColumn("repeat", F.col("later") | (F.col("doc_id") != F.col("first")) | (F.col("nth") > 1))
    out = alone.union(each.select("doc_id", *_SHARED))
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    return out.select(real("doc_id"), "start", "length", "n_chunks", real("first_doc_id"), "repeat")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("__text").to_pylist(), batch.column("__spans").to_pylist()):
            if spans:
                data, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
                for start, end in sorted((x["start"], x["end"]) for x in spans):
                    parts.append(data[at : max(at, start)])
                    at = max(at, end)
                text = b"".join([*parts, data[at:]]).decode("utf-8", "surrogatepass")
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("__doc"), batch.column("__spans"), pa.array(out, pa.string())], names=["__doc", "__spans", "__text"])


def without_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 51) -> DataFrame:
    """The documents, with all their columns, without the words of stretches that stand earlier, by id and place.

    Of equal texts the one of the smallest id keeps its words. Rows equal in id and text keep or lose the same words, so
    repeated rows stay alike. A document of which nothing but white space is left goes, if it lost anything; ``n_chars``,
    where there is such a column, counts the new text. Null and empty texts stay as they are; null ids come first.
    """
    members, classes, rows = _repeated(docs, id_col, text_col, words)
    later = _runs(rows.filter((F.col("kind") != _WHOLE) & F.col("later"))).select("doc_id", F.col("key").alias("k1"), "start", (F.col("start") + F.col("length")).alias("end"))
    copied = classes.filter("copies > 1").select("k1", "k2", F.col("doc_id").alias("first"))
    whole = rows.filter(F.col("kind") == _WHOLE).select(F.col("doc_id").alias("first"), F.col("key").alias("k1"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    gone = members.join(copied.join(whole, ["k1", "first"]), ["k1", "k2"]).filter("doc_id <> first").select("doc_id", "k1", "start", "end")
    spans = staged(later.union(gone).groupBy("doc_id", "k1").agg(F.collect_list(F.struct("start", "end")).alias("__spans")), "spans")
    k1 = F.xxhash64(F.col(f"`{text_col}`"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(f"`{text_col}`").alias("__text"), F.when(k1 == 0, 1).otherwise(k1).alias("k1"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("doc_id"))
    joined = keyed.hint("merge").join(spans.hint("merge"), ["doc_id", "k1"], "left").select("__doc", "__spans", "__text")
    cut = joined.mapInArrow(_cut, joined.schema).filter(F.col("__spans").isNull() | F.col("__text").rlike(WORD))
    at = F.col("__doc")
    columns = [F.col("__text") if c == text_col else F.when(F.col("__spans").isNull(), at[c]).otherwise(F.length("__text").cast("long")) if c == "n_chars" else at[c] for c in docs.columns]
    return cut.select(*[x.alias(c) for x, c in zip(columns, docs.columns)])

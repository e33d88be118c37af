"""Mixing sources to target weights, with DataFrame and SQL functions only.

Each source's words, its documents in a row, are cut into blocks of a fixed length. The output is dealt in shards; every
shard draws from a multinomial how many of its slots each source gets, in the residual form: the whole part of the expected
count is given and the slots left are drawn, each independently, by the fractional parts. Expected counts are the same as
those of plain draws, and a source's sum strays by a few blocks instead of the root of its slots. A source's slots, counted
through the shards, are mapped to its blocks by a pseudorandom permutation of the block numbers, one for each pass over the
source, and slots and blocks are joined by number. Slots are made by (source, group of shards), never by source. A source whose target is
``cap`` times its size is passed over ``cap`` times, so no document is taken more often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged, word_count

#: Rounds of the permutations; shards whose slots are made together.
_ROUNDS, _SHARDS = 5, 64


def _uniform(*keys: Column) -> Column:
    """A number from 0 up to 1 that depends on the keys alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(2**52)) / F.lit(float(2**52))


def targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, si (place of the source, from 0), source_size, target of the rows (source, size).

    Targets are ``min(cap * size, level * weight)``, at the level where they sum up to ``share`` of all sizes: what
    resharing by weight ends at. Sources go by code point, null last, and weights repeat along them.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    known = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = known.withColumn("si", (F.row_number().over(order) - 1).cast("int"))
    known = known.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("si") % len(weights) + 1))
    everything = Window.partitionBy(F.lit(0))
    known = known.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    rising = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "si").rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("most").over(rising), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0)))
    known = known.withColumn("level", level)
    # While the sources before are rightly capped the level rises, then it falls.
    known = known.withColumn("target", F.least("most", F.max("level").over(everything) * F.col("weight")))
    return known.select("source", "si", "source_size", "target")


def _cut_counts(plan: DataFrame, size: Column, kind: str) -> DataFrame:
    """For a shard of ``size`` slots: whole part of each source's expected slots, and its stretch of the parts left."""
    below = Window.partitionBy(F.lit(0)).orderBy("si").rowsBetween(Window.unboundedPreceding, -1)
    expected = size * F.col("share")
    plan = plan.withColumn(f"whole_{kind}", F.floor(expected)).withColumn(f"part_{kind}", expected - F.floor(expected))
    plan = plan.withColumn(f"from_{kind}", F.coalesce(F.sum(f"part_{kind}").over(below), F.lit(0.0)))
    return plan.withColumn(f"parts_{kind}", F.sum(f"part_{kind}").over(Window.partitionBy(F.lit(0))))


def _uses(plan: DataFrame, slots: int, shards: int, seed: int) -> DataFrame:
    """(si, block, uses): which blocks of each source the output's slots take. plan: si, n_blocks, share."""
    per = -(-slots // shards)
    plan = _cut_counts(_cut_counts(plan, F.lit(per), "most"), F.lit(slots - per * (shards - 1)), "last")
    rows = plan.withColumn("some", F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // _SHARDS))))
    # By number: the rows are few here, but what they become isn't, so they must not be brought together again.
    rows = rows.repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "si", "some")
    last = F.least(F.col("some") * _SHARDS + _SHARDS - 1, F.lit(shards - 1))
    rows = rows.withColumn("shard", F.explode(F.sequence(F.col("some") * _SHARDS, last)))

    def pick(what: str) -> Column:
        return F.when(F.col("shard") == shards - 1, F.col(f"{what}_last")).otherwise(F.col(f"{what}_most"))

    rows = rows.select("si", "n_blocks", "some", "shard", pick("whole").alias("whole"), pick("part").alias("part"), pick("from").alias("from"), pick("parts").alias("parts"))
    # As many draws as parts are left in the shard: each falls into one source's stretch.
    draws = F.sequence(F.lit(1), F.round("parts").cast("int"))
    drawn = F.size(F.filter(draws, lambda i: (u := _uniform(F.lit(seed), F.col("shard"), i) * F.col("parts")).__ge__(F.col("from")) & (u < F.col("from") + F.col("part"))))
    rows = rows.withColumn("n", F.col("whole") + F.when(F.round("parts") >= 1, drawn).otherwise(0))
    # Slots before a shard: those of the groups of shards before its own, and those before it in the group.
    sums = rows.groupBy("si", "some").agg(F.sum("n").alias("sum"))
    before = Window.partitionBy("si").orderBy("some").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("si", "some", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("si", "some").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("slot", F.coalesce(F.sum("n").over(inner), F.lit(0))).filter("n > 0").join(sums, ["si", "some"])
    # The counts of a shard are the numbers of its slots in each source.
    first = F.col("base") + F.col("slot")
    return rows.select("si", "n_blocks", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"))


def permuted(slots: DataFrame, seed: int) -> DataFrame:
    """Rows (si, n_blocks, slot) as (si, block, turn): each pass over a source is a permutation of its blocks of its own.

    A round mixes the numbers under the largest power of two in n, by shifts and an odd factor, and turns all n numbers by
    an offset, so that the rest is mixed in the next. No product is over 62 bits, up to 2**61 blocks.
    """
    n, bits, m = F.col("n_blocks"), F.col("__bits"), F.col("__m")
    rows = slots.withColumn("turn", F.expr("slot div n_blocks")).withColumn("__bits", F.length(F.bin(n)) - 1).withColumn("__m", F.expr("shiftleft(1L, __bits)"))

    def mixed(x: Column, h: Column) -> Column:
        folded = x.bitwiseXOR(F.call_function("shiftright", x, F.greatest(F.lit(1), F.floor((bits + 1) / 2)).cast("int")))
        factor = h.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(61) - bits) - 1).bitwiseOR(F.lit(1).cast("long"))
        return F.pmod(F.when(x < m, (folded * factor).bitwiseAND(m - 1)).otherwise(x) + F.pmod(F.xxhash64(h), n), n)

    # A lambda's variables are taken once, however often they are named.
    def once(x: Column, k: Column) -> Column:
        return F.element_at(F.transform(F.array(F.xxhash64(F.lit(seed), F.col("si"), F.col("turn"), k)), lambda h: mixed(x, h)), 1)

    rounds = F.array(*[F.lit(k) for k in range(_ROUNDS)])
    return rows.select("si", F.aggregate(rounds, F.pmod(F.col("slot"), n), once).alias("block"), "turn")


def mix_plan(rows: DataFrame, weights: tuple[float, ...], share: float, cap: float, block: int, shard_slots: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Of staged rows (row, doc_id, source, size): the rows with si, source_size, target; and (row, turn, start, length),
    the stretches of words of each row that the mix takes, turn by turn over its source."""
    plan = staged(targets(rows, weights, share, cap).withColumn("n_blocks", F.ceil(F.col("source_size") / block).cast("long")), "sources")
    # Slots as many as bring each source's target: its last block may be short.
    wanted = F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("wanted", wanted)
    n_rows, slots = rows.count(), int(round(plan.agg(F.sum("wanted")).first()[0] or 0))
    known = rows.join(plan.select("source", "si", "source_size", "target"), rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    if not slots:
        return known, known.select("row", F.lit(0).cast("long").alias("turn"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length")).limit(0)
    shards = -(-slots // shard_slots)
    share_of = plan.filter("wanted > 0").select("si", "n_blocks", (F.col("wanted") / F.sum("wanted").over(Window.partitionBy(F.lit(0)))).alias("share"))
    taken = _uses(share_of, slots, shards, seed).filter(F.col("slot") < F.col("n_blocks") * int(cap))
    taken = permuted(taken, seed)
    # Where each row stands in its source: sums by bucket, then within the bucket, so that no source is one task's.
    buckets = max(1, n_rows // 2_000)
    dealt = known.filter("size > 0").select("row", "si", "size", "doc_id", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)).alias("bucket"))
    sums = dealt.groupBy("si", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.select("si", "bucket", (F.sum("n").over(Window.partitionBy("si").orderBy("bucket")) - F.col("n")).alias("base"))
    # Rows equal in id and size can change places without changing what the mix takes of each.
    inner = Window.partitionBy("si", "bucket").orderBy("doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("upto", F.sum("size").over(inner)).join(sums, ["si", "bucket"])
    placed = placed.select("row", "si", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("first"))
    parts = placed.select("row", "si", "size", "first", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))).alias("block"))
    start = F.greatest(F.col("block") * block - F.col("first"), F.lit(0))
    end = F.least((F.col("block") + 1) * block - F.col("first"), F.col("size"))
    parts = parts.select("row", "si", "block", start.cast("long").alias("start"), (end - start).cast("long").alias("length"))
    # Without the hint the planner takes the slots for as few as the shards they come from, and broadcasts them.
    return known, parts.hint("merge").join(taken.hint("merge"), ["si", "block"]).select("row", F.col("turn").cast("long").alias("turn"), "start", "length")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    block: int = 64,
    shard_slots: int = 4096,
    seed: int = 17,
) -> DataFrame:
    """How much of each document the mix takes: doc_id, size, source_size, target, taken.

    Sizes are words; a null text has none, and a document without words is never taken. Rows with equal or null ids are
    documents of their own. A null source is a source, the last one. ``taken`` is at most ``cap`` times the size; a
    source's sum comes within a few blocks of its target. Equal inputs give equal mixes. An empty table gives no rows.
    """
    rows = staged(_rows(docs, id_col, text_col, source_col), "sizes")
    known, parts = mix_plan(rows, weights, share, cap, block, shard_slots, seed)
    sums = parts.groupBy("row").agg(F.sum("length").alias("taken"))
    out = known.join(sums, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    block: int = 64,
    shard_slots: int = 4096,
    seed: int = 17,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each document and turn over its source that takes of it.

    Its text is the whole text where the turn takes all of it, else the words taken, in their order, with the white space
    after them. Empty documents have no words to take and give no rows. Columns other than the text are kept as they are,
    but ``n_chars``, where there is one, which counts the new text.
    """
    spark_rows = staged(docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")), "mixed")
    at = F.col("__doc")
    rows = staged(spark_rows.select(F.col("__row").alias("row"), at[id_col].alias("doc_id"), at[source_col].alias("source"), word_count(at[text_col]).alias("size")), "sizes")
    _, parts = mix_plan(rows, weights, share, cap, block, shard_slots, seed)
    turns = parts.groupBy("row", "turn").agg(F.sum("length").alias("__taken"), F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__parts"))
    whole = rows.select("row", F.col("size").alias("__size"))
    found = turns.join(whole, "row").withColumnRenamed("row", "__row")
    joined = spark_rows.join(found, "__row")
    # Words with the white space after them. The generator keeps Spark from cutting the text anew for every part.
    words = F.regexp_extract_all(at[text_col], F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    joined = joined.withColumn("__words", F.explode(F.array(F.when(F.col("__taken") < F.col("__size"), words))))
    some = F.array_join(F.flatten(F.transform("__parts", lambda p: F.slice("__words", (p["start"] + 1).cast("int"), p["length"].cast("int")))), "")
    joined = joined.withColumn("__text", F.when(F.col("__taken") == F.col("__size"), at[text_col]).otherwise(some))
    out = []
    for c in docs.columns:
        kept = F.col("__text") if c == text_col else F.length("__text").cast("long") if c == "n_chars" else at[c]
        out.append(kept.alias(c))
    return joined.select(*out)

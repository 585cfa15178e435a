"""Mixing sources to target weights, with DataFrame operations only.

The words of a source, in a reproducible document order, are packed into
blocks of a fixed number of words (the last one may be shorter).  An output
shard of a fixed number of slots draws how many slots each source gets; the
running slot number of a source goes through an index permutation of that
source and pass to a block, and blocks join by index.

The counts per shard are a systematic draw from the multinomial: they have its
expectation, and sums over shards stay within one slot of it.  Independent
draws would miss a small source's target by the root of its slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlake.llm.common import stored, uniform

WORD = r"[^\x20\x09-\x0D]+"
# Primes just below 2^31, and two for sources of more blocks.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)
WIDE_PRIMES = (1000003, 1000033)


@dataclass(frozen=True)
class MixSettings:
    block_words: int = 32
    shard_slots: int = 65536
    most_passes: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    seed: int = 17


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source and size: the number of words of the whole text (null text: 0)."""
    return docs.select(
        F.col("doc_id"), F.col("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """One row per source: source_no, source, source_size, weight, target, blocks, buckets.

    Sources in code-point order, null last, take the weights in turn.  Targets
    share all words by weight; one that would pass ``most_passes`` times its
    source's size stays there and the rest is shared anew by weight.  Ordered
    by size over weight, a source is held back exactly if the share left by
    those before it passes its limit, so one ordered pass settles all.  The
    windows run over one row per source, never over documents.
    """
    cap = float(settings.most_passes)
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in settings.weights])
    numbered = (per.withColumn("source_no", F.row_number().over(by_name) - 1)
                .withColumn("weight", F.element_at(cycle, (F.col("source_no") % len(settings.weights) + 1).cast("int")).cast("double")))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("source_size").cast("double")
    shared = (numbered
              .withColumn("_all", F.sum(size).over(everything))
              .withColumn("_weights", F.sum("weight").over(everything))
              .withColumn("_left", F.col("_all") - F.coalesce(F.sum(size * cap).over(before), F.lit(0.0)))
              .withColumn("_left_weights", F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("_held", size * cap * F.col("_left_weights") <= F.col("weight") * F.col("_left"))
              .withColumn("_free", F.col("_all") - F.sum(F.when(F.col("_held"), size * cap).otherwise(0.0)).over(everything))
              .withColumn("_free_weights", F.sum(F.when(F.col("_held"), 0.0).otherwise(F.col("weight"))).over(everything)))
    return shared.select(
        "source_no", "source", "source_size", "weight",
        F.when(F.col("_held"), size * cap).otherwise(F.col("_free") * F.col("weight") / F.col("_free_weights")).alias("target"),
        F.ceil(F.col("source_size") / settings.block_words).cast("long").alias("blocks"), F.ceil(F.sqrt("documents")).cast("long").alias("buckets"))


def placed_documents(sized: DataFrame, targets: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """Documents with their source's row and ``start``, the offset of their first word in the source.

    A source is ordered by (hash bucket, doc_id, size): totals per bucket give
    each bucket's start, and only documents of one bucket are sorted together,
    so a source with a third of all rows still spreads over every task.  A
    source of n documents has about as many buckets as documents in one: the
    root of n.
    """
    numbered = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "size", "source_no", "source_size", "target", "blocks",
        F.pmod(F.xxhash64("doc_id", "size"), F.col("buckets")).alias("bucket"))
    totals = numbered.groupBy("source_no", "bucket").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source_no", "bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_bucket_start"))
    inside = (Window.partitionBy("source_no", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    return (numbered.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["source_no", "bucket"])
            .withColumn("start", F.col("_bucket_start") + F.col("_inside"))
            .drop("_inside", "_bucket_start", "bucket"))


def drawn_slots(targets: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """One row per slot of the mix: shard, source_no, draw (running number in the source), block.

    A source is expected to fill target / source_size passes over its blocks.
    Draws past ``most_passes`` passes, which rounding could add, are not made.
    The counts per shard are dealt to as many tasks as there are shards before
    they become slots.
    """
    live = targets.where(F.col("source_size") > 0).withColumn("_slots", F.col("target") / F.col("source_size") * F.col("blocks"))
    total = Window.partitionBy()
    live = (live.withColumn("_all", F.sum("_slots").over(total))
            .withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("_all") / settings.shard_slots)).cast("long"))
            .withColumn("_offset", uniform(F.lit(settings.seed), F.col("source_no"))))
    shards = live.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shards") - 1)))

    def drawn(shard: Column) -> Column:
        share = F.floor(F.col("_slots") * shard / F.col("_shards") + F.col("_offset"))
        return F.least(share, F.col("blocks") * settings.most_passes).cast("long")

    counts = shards.withColumn("_from", drawn(F.col("shard"))).withColumn("_to", drawn(F.col("shard") + 1))
    counts = counts.where(F.col("_to") > F.col("_from"))
    tasks = live.agg(F.max("_shards")).first()[0] or 1  # one row per source is read
    dealt = counts.select("shard", "source_no", "blocks", "_from", "_to").repartition(tasks, "shard", "source_no")
    slots = dealt.select("shard", "source_no", "blocks", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)).alias("draw"))
    return slots.select("shard", "source_no", "draw", permuted(F.col("draw"), F.col("blocks"), F.col("source_no"), settings.seed).alias("block"))


def permuted(draw: Column, blocks: Column, source_no: Column, seed: int) -> Column:
    """Block of a draw: a permutation x -> a x + b modulo the blocks, with a and b from a hash of source and pass.

    ``a`` is a prime above the modulus or one that does not divide it, so each
    pass visits every block once; the products stay below 2^63.
    """
    turn = F.floor(draw / blocks).cast("long")
    key = F.xxhash64(F.lit(seed), source_no, turn)
    prime = F.element_at(F.array(*[F.lit(p) for p in PRIMES]), (F.pmod(key, F.lit(len(PRIMES))) + 1).cast("int")).cast("long")
    wide = F.when(blocks % WIDE_PRIMES[0] != 0, F.lit(WIDE_PRIMES[0])).otherwise(F.lit(WIDE_PRIMES[1])).cast("long")
    step = F.when(blocks < 2 ** 31 - 200, prime % blocks).otherwise(wide)
    return F.pmod(step * (draw - turn * blocks) + F.pmod(F.shiftrightunsigned(key, 8), blocks), blocks)


def block_spans(placed: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """Every document's part of every block it touches: source_no, block, words (and the document's columns)."""
    size = F.lit(settings.block_words).cast("long")
    first, end = F.expr(f"start div {settings.block_words}"), F.col("start") + F.col("size")
    spans = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, F.expr(f"(start + size - 1) div {settings.block_words}"))))
    return spans.withColumn("words", F.least(end, (F.col("block") + 1) * size) - F.greatest(F.col("start"), F.col("block") * size))


def mixed_blocks(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix itself: shard, source_no, draw, block and the document parts (doc_id, start, words) of each slot."""
    sized = stored(sized_documents(docs))
    targets = stored(source_targets(sized, settings))
    spans = block_spans(placed_documents(sized, targets, settings), settings)
    return drawn_slots(targets, settings).hint("merge").join(spans.select("source_no", "block", "doc_id", "start", "words"), ["source_no", "block"])


def mix(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Null text counts no words; a document without words takes part with taken
    0.  Null sources form one source, last in order.  Repeated rows are each a
    row of their own; of equal rows with the same id and size, either may hold
    the larger taken.  An empty table gives an empty result.  Columns other
    than doc_id, source and text are not read.
    """
    sized = stored(sized_documents(docs))
    targets = stored(source_targets(sized, settings))
    placed = placed_documents(sized, targets, settings)
    uses = drawn_slots(targets, settings).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    kept = ["doc_id", "size", "source_size", "target"]
    # the slots are as many as the blocks: a broadcast on their small stored parent would grow with the input
    worded = (block_spans(placed, settings).join(uses.hint("merge"), ["source_no", "block"], "left")
              .groupBy("source_no", "start", *kept)
              .agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken")))
    wordless = sized.where("size = 0").join(targets, sized["source"].eqNullSafe(targets["source"])).select(*kept, F.lit(0).cast("long").alias("taken"))
    return worded.select(*kept, F.col("taken").cast("long").alias("taken")).unionByName(wordless)

"""Mixing sources to target weights with a low-discrepancy source schedule.

Golden-ratio points frac((i + 1) * phi) are mapped through the cumulative
weights of the sources, so every prefix of the schedule is close to the
weights.  The slots of a source are ranked, and slot number k takes block
k mod n of the source's n blocks: its documents in a shuffled order, cut into
blocks of ``BLOCK`` words (a document may span blocks, the last block is
short).  A source stops at its quota of words; its last slot is cut there.

Sizes: words are runs of ``[^\\x20\\x09-\\x0D]``; null text has size 0.  Targets:
sources by code point (null last) weigh 5, 2, 1, repeating, and share
``share`` times all words; a target stops at ``most`` times its source's size
and the excess is shared again by weight until none is above.

The number of slots grows with the words to take.  Nothing of that size
passes through one task: ranks come from counts per chunk of slots, and
offsets inside a source from sums per hash bucket.  Reruns agree: the order
is a hash of (doc_id, size).  Identical rows are interchangeable.  Documents
without words are returned with taken = 0.  An empty table gives no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import dense_id
from ..sources.tables import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
#: Words of a block; slots ranked together; documents of a hash bucket (about).
BLOCK, CHUNK, BUCKET_DOCS = 256, 1 << 16, 1 << 12
#: The golden ratio's fraction as a 52-bit fixed-point step: points stay exact.
_ONE = 1 << 52
_STEP = int((5 ** 0.5 - 1) / 2 * _ONE) | 1


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row, written once: later passes do not
    read the texts again."""
    return materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(
        F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix_sizes")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, target, weight, code (dense,
    from 0).  Each round of sharing is one global sum over the sources; a
    source found above its cap leaves the rounds, so they end."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    per = dense_id(per, [F.col("source").isNull(), F.col("source")], "code", start=0)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("code") % len(WEIGHTS) + 1).cast("int"))
    per = materialize(per.withColumn("weight", weight), "mix_sources")
    cap = F.col("source_size") * F.lit(most)
    total = per.agg(F.sum("source_size")).first()[0] or 0
    rate = 0.0  # words per unit of weight of the sources below their caps
    while True:
        below = F.col("weight") * F.lit(rate) <= cap
        capped, free = per.agg(F.sum(F.when(~below, cap)), F.sum(F.when(below, F.col("weight")))).first()
        if not free:
            break
        new = (total * share - (capped or 0.0)) / free
        if new <= rate:
            break
        rate = new
    return per.withColumn("target", F.least(F.col("weight") * F.lit(rate), cap))


def _placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with words and their first word's offset in the shuffled
    stream of their source: sums per (source, hash bucket), then inside."""
    n = sizes.count()
    buckets = max(1, n // BUCKET_DOCS)
    key = F.xxhash64("doc_id", "size", F.lit("mix"))
    rows = (sizes.where(F.col("size") > 0)
            .join(sources.select(F.col("source").alias("_s"), "code"), F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "code", "size", key.alias("h"), F.pmod(F.shiftright(key, 8), F.lit(buckets)).alias("bucket")))
    sums = rows.groupBy("code", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("code").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("code", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("code", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["code", "bucket"])
            .select("doc_id", "code", "size", (F.col("base") + F.col("_in")).alias("offset")))


def schedule(sources: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(slot, code, block_no, words): slot order, the source and block it
    takes, and how many words of the block (from its start)."""
    spark = sources.sparkSession
    quota = F.floor(F.col("target")).cast("long")
    n_blocks = F.ceil(F.col("source_size") / block).cast("long")
    passes = F.floor(quota / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    rest = quota - passes * F.col("source_size")
    plan = (sources.where((F.col("source_size") > 0) & (F.col("target") >= 1))
            .select("code", "source_size", quota.alias("quota"), n_blocks.alias("n_blocks"),
                    (passes * n_blocks + F.ceil(rest / block)).cast("long").alias("slots")))
    # cumulative weights: one row per source
    total = plan.agg(F.sum("slots")).first()[0] or 0
    upto = Window.orderBy("code").rowsBetween(Window.unboundedPreceding, 0)
    bounds = plan.withColumn("_hi", F.sum("slots").over(upto)).withColumn("_lo", F.col("_hi") - F.col("slots"))
    # cells: the unit interval cut evenly, so that a point meets the few
    # sources of its cell by an equi-join
    cells = F.lit(max(1 << 12, min(4 * plan.count(), 1 << 20)))
    scale = lambda c: F.col(c) / F.lit(float(max(total, 1)))
    cell_of = lambda u: F.least(F.floor(u * cells), cells - 1).cast("long")
    bounds = bounds.withColumn("cell", F.explode(F.sequence(cell_of(scale("_lo")), cell_of(scale("_hi")))))
    # i * step mod 2^52 without overflow: the index in two parts
    i = F.col("id") + 1
    part = lambda v, step: F.pmod(v * F.lit(step), F.lit(_ONE))
    low, high = i.bitwiseAND(F.lit(1023)), F.shiftright(i, 10)
    high_step = _STEP * 1024 % _ONE
    mid, top = high.bitwiseAND(F.lit(1023)), F.shiftright(high, 10)
    top_step = high_step * 1024 % _ONE
    top_low, top_high = top.bitwiseAND(F.lit(1023)), F.shiftright(top, 10)
    frac = F.pmod(part(low, _STEP) + part(mid, high_step) + part(top_low, top_step)
                  + part(top_high, top_step * 1024 % _ONE), F.lit(_ONE))
    points = (spark.range(int(total)).select(F.col("id").alias("slot"), (frac / float(_ONE)).alias("u"))
              .withColumn("cell", cell_of(F.col("u"))))
    drawn = (points.join(bounds.select("cell", "code", scale("_lo").alias("_l"), scale("_hi").alias("_h")), "cell")
             .where((F.col("u") >= F.col("_l")) & (F.col("u") < F.col("_h")))
             .select("slot", "code", F.floor(F.col("slot") / chunk).cast("long").alias("chunk")))
    # rank of a slot in its source: slots in earlier chunks, then in its own
    counts = drawn.groupBy("code", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("code").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("code", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("code", "chunk").orderBy("slot")
    ranked = (drawn.withColumn("_r", F.row_number().over(own) - 1).join(bases, ["code", "chunk"])
              .select("slot", "code", (F.col("base") + F.col("_r")).alias("k")))
    # the points may miss a source's quota by a few slots: those come last
    short = (plan.join(counts.groupBy("code").agg(F.sum("n").alias("n")), "code", "left")
             .withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < F.col("slots"))
             .withColumn("k", F.explode(F.sequence(F.col("n"), F.col("slots") - 1)))
             .select((F.lit(int(total)) + F.col("k")).alias("slot"), "code", "k"))
    nth_pass, nth_block = F.floor(F.col("k") / F.col("n_blocks")), F.col("k") % F.col("n_blocks")
    left = F.col("quota") - nth_pass * F.col("source_size") - F.col("block_no") * block
    return (ranked.unionByName(short).join(plan, "code").where(F.col("k") < F.col("slots"))
            .withColumn("block_no", nth_block.cast("long"))
            .select("slot", "code", "block_no", F.least(
                F.lit(block), F.col("source_size") - F.col("block_no") * block, left).cast("long").alias("words")))


def mix(docs: DataFrame, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row."""
    sizes = sized(docs)
    sources = materialize(targets(sizes, share, most), "mix_targets")
    placed = materialize(_placed(sizes, sources), "mix_placed")
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block)
    pieces = (placed.withColumn("block_no", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
              .withColumn("_from", F.greatest(F.col("offset") - F.col("block_no") * block, F.lit(0)))
              .withColumn("_to", F.least(F.col("offset") + F.col("size") - F.col("block_no") * block, F.lit(block))))
    taken = (pieces.join(schedule(sources, block), ["code", "block_no"])
             .groupBy("code", "offset").agg(F.sum(F.greatest(
                 F.least("_to", "words") - F.col("_from"), F.lit(0))).cast("long").alias("taken")))
    with_words = (placed.join(taken, ["code", "offset"], "left")
                  .select("doc_id", "code", "size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    without = (sizes.where(F.col("size") == 0)
               .join(sources.select(F.col("source").alias("_s"), "code"), F.col("source").eqNullSafe(F.col("_s")))
               .select("doc_id", "code", "size", F.lit(0).cast("long").alias("taken")))
    return (with_words.unionByName(without).join(sources.select("code", "source", "source_size", "target"), "code")
            .select("doc_id", "source", "size", "source_size", "target", "taken"))

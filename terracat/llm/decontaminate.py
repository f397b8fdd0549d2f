"""Benchmark decontamination by spaced-seed hashing.  DataFrame functions only.

Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased.  Each mask marks
which of a window's word positions are hashed and which are ignored, so a
substituted word at an ignored position leaves the hash as it was.  Equal
hashes of a document's and a benchmark item's windows are hits; a hit fixes an
alignment (document position minus item position), which is then verified: it
is an overlap when some ``WORDS`` consecutive words of it (the whole item, where
that is shorter) agree to ``AGREE`` percent or more.  The three masks together
lose nothing: whichever words such a window has substituted, one of them still
fits between (a test tries all cases).

A fixed-size bitmap of the benchmark's hashes goes into the plan as a literal,
whatever the benchmark's size; it only thins the document windows.  The
join with the benchmark's hashes that follows is an ordinary join and decides.
Only hit windows are shuffled, and texts only of documents with a hit.

Null and empty texts, texts without words and empty tables give no overlaps,
items of fewer than ``SHORTEST`` words are not looked for.  Repeated rows
count once.  A null doc_id is kept as null.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

#: Word positions that count (1) and that are ignored (0).
MASKS = ("110111", "11010011", "110001011")
WORDS, AGREE, SHORTEST = 13, 80, 8
#: Bits of the bitmap (64 a word): bounded, whatever the benchmark's size.
BITMAP_BITS = 1 << 20
#: Ids of documents with a hit that may be broadcast to filter the texts.
BROADCAST_BYTES = 16 << 20


def _words(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(text, upper, lower), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def _tokens(rows: DataFrame, key: str) -> DataFrame:
    """(key, h): the hashes of the row's words, in order."""
    return rows.select(key, F.transform(_words(F.col("text").cast("string")), lambda w: F.xxhash64(w)).alias("h"))


def _seeds(h: Column, masks=MASKS) -> Column:
    """Array of (pos, seed): the hash of every window under every mask."""
    def of(number: int, mask: str) -> Column:
        at = [j for j, c in enumerate(mask) if c == "1"]
        last = F.size(h) - len(mask)
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("pos"), F.xxhash64(
            *[F.get(h, i + j) for j in at], F.lit(number)).alias("seed")))
    return F.concat(*[of(n, m) for n, m in enumerate(masks)])


def _bitmap(items: DataFrame) -> Column:
    """Literal array of longs: the bits of two positions of every seed."""
    bits = (items.select(F.explode(F.array(*_slots(F.col("seed")))).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int")))
                 .alias("bits")))
    longs = [0] * (BITMAP_BITS // 64)
    for r in bits.collect():  # at most BITMAP_BITS / 64 rows
        longs[r["word"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def _slots(seed: Column) -> list[Column]:
    mask = F.lit(BITMAP_BITS - 1)
    return [seed.bitwiseAND(mask), F.shiftrightunsigned(seed, 30).bitwiseAND(mask)]


def _maybe(seed: Column, bitmap: Column) -> Column:
    tests = [F.call_function("shiftrightunsigned", F.get(bitmap, F.shiftright(b, 6).cast("int")),
                             b.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1 for b in _slots(seed)]
    return tests[0] & tests[1]


def overlaps(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, agree: int = AGREE) -> DataFrame:
    """One row per (doc_id, item_id) with an overlap: of the alignment with most
    agreeing words, the words from its first to its last good window (first word in the
    document and in the item, number of words, number of agreeing ones)."""
    items = materialize(_tokens(benchmark.select("item_id", "text"), "item_id")
                        .where(F.size("h") >= SHORTEST), "dec_items")
    seeds = materialize(items.select("item_id", F.explode(_seeds(F.col("h"))).alias("s"))
                        .select("item_id", F.col("s.pos").alias("at"), F.col("s.seed").alias("seed")), "dec_seeds")
    bitmap = _bitmap(seeds)
    texts = docs.select("doc_id", "text")
    windows = (_tokens(texts, "doc_id")
               .select("doc_id", F.explode(F.filter(_seeds(F.col("h")), lambda s: _maybe(s["seed"], bitmap))).alias("s"))
               .select("doc_id", F.col("s.pos").alias("pos"), F.col("s.seed").alias("seed")))
    hits = materialize(windows.join(seeds, "seed").select(
        "doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct(), "dec_hits")
    ids = materialize(hits.select(F.col("doc_id").alias("_id")).distinct(), "dec_ids")
    size = ids.agg(F.sum(F.coalesce(F.octet_length(F.col("_id").cast("string")), F.lit(0)) + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:  # measured; else both sides are shuffled
        ids = F.broadcast(ids)
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # only the words beside an alignment go on, not the text for every hit
    spans = hits.join(items.select("item_id", F.col("h").alias("item")), "item_id")
    held = _tokens(texts, "doc_id").withColumnRenamed("doc_id", "_id")
    aligned = (spans.join(held, F.col("doc_id").eqNullSafe(F.col("_id")))
               .withColumn("from", F.greatest(F.col("shift"), F.lit(0)))
               .withColumn("to", F.least(F.size("h"), F.col("shift") + F.size("item")))
               .select("doc_id", "item_id", "shift", F.size("item").alias("n_item"), F.col("from").alias("start"),
                       F.zip_with(F.slice("h", F.col("from") + 1, F.col("to") - F.col("from")),
                                  F.slice("item", F.col("from") - F.col("shift") + 1, F.col("to") - F.col("from")),
                                  lambda x, y: F.when(x == y, 1).otherwise(0)).alias("same")))
    total = lambda at, n: F.aggregate(F.slice("same", at + 1, n), F.lit(0), lambda acc, x: acc + x)
    size = F.least(F.lit(words), F.col("n_item"))
    starts = F.when(F.size("same") >= size, F.sequence(F.lit(0), F.size("same") - size)).otherwise(
        F.array().cast("array<int>"))
    good = (aligned.withColumn("good", F.filter(starts, lambda i: total(i, size) * 100 >= size * agree))
            .where(F.size("good") > 0).withColumn("first", F.element_at("good", 1))
            .withColumn("n", F.element_at("good", -1) + size - F.col("first"))
            .withColumn("agree", total(F.col("first"), F.col("n")))
            .withColumn("at", F.col("start") + F.col("first")))
    return (good.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("agree", (-F.col("n")).alias("less"), (-F.col("at")).alias("before"), "shift")).alias("m"))
            .select("doc_id", "item_id", (-F.col("m.before")).cast("long").alias("doc_word"),
                    (-F.col("m.before") - F.col("m.shift")).cast("long").alias("item_word"),
                    (-F.col("m.less")).cast("long").alias("n_words"), F.col("m.agree").cast("long").alias("n_agree")))

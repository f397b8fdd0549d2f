"""Document fingerprints by Order MinHash.  DataFrame functions only.

A text's words (runs of ``[^\\x20\\x09-\\x0D]``, long ones in pieces of 16 code
points, case kept) form pairs, its 2-mers; a text of one word has that word.
The 2-mers are numbered by occurrence, hashed with their number and dealt to
``BINS`` bins by the hash; each bin keeps its ``2`` smallest hashes (a bin of one
borrows the smallest of the next filled bin, so that short texts have order too),
puts them back into text order and hashes the tuple.  A moved or edited passage
changes the tuples, not only the set, so likeness falls with edit distance.  Likeness:
equal bins over bins that either text fills (two texts without words: 1).

Everything is array expressions per row: two sorts of packed longs (hash, position)
and a few linear passes, no shuffle.

Null texts count as empty.  Equal texts have equal fingerprints; repeated rows
give repeated results.  Positions are kept in 24 bits: in a text of more than
16 million words, later positions count as the last.  Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]{1,16}"
BIN_BITS = 6
BINS = 1 << BIN_BITS
_POS = (1 << 24) - 1
_ROWS_PER_BUCKET, _MOST_BUCKETS = 128, 4096


def _drop_pos(x: Column) -> Column:
    return F.shiftright(x, 24)


def _starts(a: Column, group) -> Column:
    """Indexes where ``group`` of the sorted array's entry differs from the one before."""
    n = F.size(a)
    return F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        group(F.get(a, i)) != group(F.get(a, i - 1))))).otherwise(F.array().cast("array<int>"))


def _lengths(starts: Column, n: Column) -> Column:
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
    return F.zip_with(starts, F.slice(ends, 1, F.size(starts)), lambda s, e: e - s)


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Append ``name``: array of bin << 32 | hash, a long for every filled bin.
    Steps are columns of their own, so that no array is built again for each
    of its elements."""
    t = lambda s: f"__{name}_{s}"
    bin_of = lambda x: F.shiftright(x, 63 - BIN_BITS)
    pos = lambda x: x.bitwiseAND(F.lit(_POS)).cast("int")
    n = F.size(t("h"))
    pairs = F.zip_with(F.slice(t("h"), 1, F.greatest(n - 1, F.lit(1))), F.slice(t("h"), F.least(F.lit(2), n), F.greatest(n - 1, F.lit(1))),
                       lambda a, b: F.xxhash64(a, b))

    def tuple_of(i):
        # the second of the bin, else the first of the next one (after the last: of the first)
        a, b = F.get(t("s"), i), F.coalesce(F.get(t("s"), i + 1), F.get(t("s"), F.lit(0)))
        return F.struct(bin_of(a).alias("bin"), F.least(pos(a), pos(b)).alias("p"), F.greatest(pos(a), pos(b)).alias("q"))

    out = (rows
           .withColumn(t("h"), F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
           .withColumn(t("k"), F.when(n > 0, pairs).otherwise(F.array().cast("array<bigint>")))
           # equal 2-mers side by side, in text order: their places in a run number them
           .withColumn(t("o"), F.sort_array(F.transform(t("k"), lambda x, i: x.bitwiseAND(F.lit(~_POS)).bitwiseOR(
               F.least(i, F.lit(_POS)).cast("long")))))
           .withColumn(t("r"), _starts(F.col(t("o")), _drop_pos))
           .withColumn(t("c"), F.flatten(F.transform(_lengths(F.col(t("r")), F.size(t("o"))),
                                                     lambda m: F.sequence(F.lit(0), m - 1))))
           .withColumn(t("s"), F.sort_array(F.zip_with(t("o"), t("c"), lambda x, c: F.call_function(
               "shiftrightunsigned", F.xxhash64(_drop_pos(x), c), F.lit(1)).bitwiseAND(F.lit(~_POS)).bitwiseOR(
               x.bitwiseAND(F.lit(_POS))))))
           .withColumn(t("b"), F.transform(_starts(F.col(t("s")), bin_of), tuple_of))
           .withColumn(name, F.transform(t("b"), lambda b: F.call_function("shiftleft", b["bin"].cast("long"), F.lit(32)).bitwiseOR(
               F.xxhash64(F.get(t("k"), b["p"]), F.get(t("k"), b["q"])).bitwiseAND(F.lit(0xFFFFFFFF))))))
    return out.drop(*[t(s) for s in "hkorcsb"])


def likeness(a: Column, b: Column) -> Column:
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 32))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda v: F.lower(F.hex(v))), ".")


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``: ascending buckets hold descending neighbours by
    doc_id (nulls last, ties by text hash).

    Buckets are quantiles of doc_id (at most ``_MOST_BUCKETS``).  An id that fills
    more than one of them, and the null id, have buckets of their own, which the
    text hash splits further: no id is too frequent for a task."""
    ids = rows.select("doc_id")
    total = ids.count()
    buckets = max(1, min(total // _ROWS_PER_BUCKET, _MOST_BUCKETS))
    found = ids.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 100_000)).first()[0] or []
    hot = {a for a, b in pairwise(found) if a == b}
    cuts = sorted({*found, *(h + 1 for h in hot if h < (1 << 63) - 1)}) or [0]
    edges = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.size(F.filter(edges, lambda c: c <= F.col("doc_id"))))
    own = {-1, *(bisect_right(cuts, h) for h in hot)}  # buckets of one id
    counts = ids.select(bucket.alias("b")).where(F.col("b").isin(*own)).groupBy("b").count().collect()
    split = {r["b"]: -(-r["count"] * buckets // total) for r in counts}
    part = F.lit(0)
    if any(n > 1 for n in split.values()):
        parts = F.element_at(F.create_map(*[F.lit(x) for kv in split.items() for x in kv]), bucket)
        share = F.xxhash64("text") / F.lit(2.0 ** 64) + 0.5
        part = F.coalesce(F.least(F.floor(share * parts).cast("int"), parts - 1), F.lit(0))
    return rows.withColumn("bucket", bucket * (2 * _MOST_BUCKETS) + (2 * _MOST_BUCKETS - 1 - part))


def with_next(rows: DataFrame, prepare, carried: list[str]) -> DataFrame:
    """``prepare(rows)`` (columns made from the text), with next_<c> for every column
    c of ``carried``: the value in the next row by descending doc_id (nulls last, ties
    by text); after the last row comes the first.

    Rows are dealt to buckets of neighbours, and every bucket gets a copy of the
    next one's first row, so one shuffle and a window inside the buckets do it."""
    placed = dealt(rows)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    # first row of every bucket: one narrow aggregate, then its text
    tops = placed.groupBy("bucket").agg(F.max("doc_id").alias("_top"))
    names = sorted(r["bucket"] for r in tops.select("bucket").collect())  # at most a few times _MOST_BUCKETS
    before = {b: names[(i + 1) % len(names)] for i, b in enumerate(names)}  # the bucket that a bucket's first row follows
    # as many narrow rows: the texts stay where they are
    tops = F.broadcast(tops.withColumnRenamed("bucket", "_b"))
    first = (placed.join(tops, (F.col("bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_top")), "left_semi")
             .groupBy("bucket").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    moved = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv] or [F.lit(0), F.lit(0)]), F.col("bucket"))
    guests = first.withColumn("bucket", moved).withColumn("_guest", F.lit(1))
    w = Window.partitionBy("bucket").orderBy("_guest", *order)
    return (prepare(placed.withColumn("_guest", F.lit(0)).unionByName(guests, allowMissingColumns=True))
            .select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
            .where(F.col("_guest") == 0).drop("_guest", "bucket"))


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last half
    replaced by the next document's beginning), and their likeness."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    near = with_next(rows, lambda r: with_fingerprint(r, "text", "fp"), ["text", "fp"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    done = with_fingerprint(near.withColumn("edited", edited), "edited", "efp")
    return done.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))

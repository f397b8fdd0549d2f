"""Spelling variant grouping by pivotal grams: the words of a corpus that differ
by one inserted, deleted or replaced code point, and each word's usual form.

Every word's bigrams are ordered by how many bigrams of the vocabulary equal
them, rarest first (at most 90 x 90 different bigrams of letters exist, so that
table is bounded).  A word's *prefix* is its three rarest positional bigrams;
its two *pivots* are the pair of disjoint prefix bigrams with the least total
frequency, chosen by dynamic programming.  One edit destroys at most one of two
disjoint bigrams, so of two near words the one whose prefix ends at the rarer
bigram has a pivot that stands in the other's prefix.  (Where the boundary
bigram repeats, its first five occurrences count as prefix: an edit before an
occurrence can put at most two more in front of it.)

Position limits: the edit lies behind or before the surviving pivot, so the word
up to the pivot, or from it on, is the same in both words.  Pivots are indexed
and prefixes probed by the hash of that part; candidates are verified by the
edit distance.  Keys whose pairs would exceed ``PAIRS`` (common beginnings and
endings) are not paired: their entries are split further by the one-deletion
variants of the rest of the word, which any two rests within one edit share.
That way is exact too, and a variant's group is bounded by the alphabet.

Defined results: a null text has no words, a null doc_id counts as an empty id,
repeated rows count each, extra columns are ignored, an empty table gives no
rows.  Texts and words of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

MIN_LENGTH, MIN_COUNT, RATIO, EDIT_ONE_IN = 7, 2, 10, 31
#: Candidate pairs of one key that are verified one by one.
PAIRS = 1 << 14
#: Code points of a text searched at once, and words held before they are passed on.
PIECE, HELD = 1 << 20, 200_000

_LETTERS = "A-Za-zÀ-ÿ"
_RUN, _GAP = re.compile(f"[{_LETTERS}]+"), re.compile(f"[^{_LETTERS}]")
_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _runs(text: str) -> Counter:
    """Occurrences of the lower-cased runs of a whole text, piece by piece."""
    found, at = Counter(), 0
    while at < len(text):
        to = at + PIECE
        gap = _GAP.search(text, to) if to < len(text) else None
        to = gap.start() if gap else len(text)
        found.update(_RUN.findall(text, at, to))
        at = to
    lower = Counter()
    for run, n in found.items():
        lower[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return lower


def edited(doc_id: str, run: str) -> str:
    """The run, less one code point where the hash of id and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % EDIT_ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counted(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()),
                                          pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc_id = doc_id.as_py()
            for run, n in _runs(text.as_py()).items():
                if len(run) >= min_length:
                    word = edited(doc_id, run)
                    if len(word) >= min_length:
                        held[word] += n
            if len(held) >= HELD:
                yield flush()
    yield flush()


def words_of(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts with at least ``min_count`` occurrences."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = rows.mapInArrow(partial(_counted, min_length=min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def pivots_and_prefix(word: str, rank: dict[str, int], freq: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Positions of the two pivots and of the prefix, and the boundary's rank."""
    order = sorted((rank[word[k:k + 2]], k) for k in range(len(word) - 1))
    last = order[2][0]
    at = sorted(k for _, k in order[:3])
    cost = [freq[word[k:k + 2]] for k in at]
    # best[c][i]: least cost of c disjoint bigrams among the first i, and their positions
    best = [[(0, ())] * 4] + [[(float("inf"), ())] * 4 for _ in range(2)]
    for c in (1, 2):
        for i in (1, 2, 3):
            free = sum(1 for k in at[:i] if k <= at[i - 1] - 2)  # those that end before this one
            value, chosen = best[c - 1][free]
            best[c][i] = min(best[c][i - 1], (value + cost[i - 1], (*chosen, at[i - 1])))
    prefix = [k for r, k in order[:2] if r < last]
    boundary = [k for r, k in order if r == last][:5]
    return list(best[2][3][1]), prefix + boundary, last


def _side(word: str, at: int, left: bool) -> int:
    part = word[:at + 2] if left else word[at:]
    return xxhash.xxh3_64_intdigest(part.encode(), seed=int(left)) - (1 << 63)


ENTRY = "key long, pivot boolean, last int, at int, left boolean, word string, n long"


def _entries(batches: Iterator[pa.RecordBatch], grams: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    freq = dict(grams)
    rank = {g: i for i, (g, _) in enumerate(sorted(grams, key=lambda x: (x[1], x[0])))}
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            out: list[tuple] = []
            for word, n in zip(*(c.to_pylist() for c in batch.slice(lo, 4096).columns)):
                pivots, prefix, last = pivots_and_prefix(word, rank, freq)
                for pivot, places in ((True, pivots), (False, prefix)):
                    out += [(_side(word, k, left), pivot, last, k, left, word, n) for k in places for left in (True, False)]
            types = (pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             [c.split()[0] for c in ENTRY.split(", ")])


def deletion_keys(rest: str, key: int) -> set[int]:
    """Hashes of ``rest`` and of its one-deletion variants, mixed with ``key``,
    in linear time (a polynomial hash from prefix sums)."""
    code = np.frombuffer(rest.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    power = np.full(len(code) + 1, _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code * power[:-1], dtype=np.uint64)))
    without = sums[:-1] + (sums[-1] - sums[1:]) * _BASE_INVERSE
    every = np.concatenate((without, sums[-1:])) * np.uint64(0xBF58476D1CE4E5B9) ^ np.uint64(key & (2**64 - 1))
    return set(every.view(np.int64).tolist())


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            out = []
            for key, pivot, last, at, left, word, n in zip(*(c.to_pylist() for c in batch.slice(lo, 1024).columns)):
                rest = word[at + 2:] if left else word[:at]
                out += [(k, pivot, last, word, n) for k in deletion_keys(rest, key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.int32(), pa.string(), pa.int64()))],
                ["key", "pivot", "last", "word", "n"])


def _verified(entries: DataFrame) -> DataFrame:
    """Near pairs among entries that share a key: an indexed pivot against the
    probes of words whose prefix reaches at least as far."""
    a = entries.where("pivot").select("key", F.col("last").alias("a_last"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = entries.where("not pivot").select("key", F.col("last").alias("b_last"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = a.join(b, (a["key"] == b["key"]) & (F.col("a_last") <= F.col("b_last"))
                  & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1))
    return near.select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n) of all pairs of near words, either way round.
    ``words``: distinct words of four code points or more, and their n."""
    words = materialize(words.select("word", "n"), "spelling_words")
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: F.substring(F.col("word"), k, F.lit(2))))
    frequency = [(r["g"], r["count"]) for r in words.select(grams.alias("g")).groupBy("g").count().collect()]
    entries = materialize(words.mapInArrow(partial(_entries, grams=frequency), ENTRY), "spelling_entries")
    one = F.col("pivot").cast("long")
    hot = materialize(entries.groupBy("key").agg(F.sum(one).alias("p"), F.sum(1 - one).alias("q"))
                      .where(F.col("p") * F.col("q") > PAIRS).select("key"), "spelling_hot")
    few = _verified(entries.join(hot, "key", "left_anti"))
    split = (entries.join(hot, "key", "left_semi").select("key", "pivot", "last", "at", "left", "word", "n")
             .mapInArrow(_split, "key long, pivot boolean, last int, word string, n long"))
    pairs = few.unionByName(_verified(materialize(split, "spelling_split")))
    return pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("x")).select("x.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by doubling.  n grows RATIO-fold
    with every step, so chains are short (19 steps at most below 2^63)."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(on, "root", "left_semi").limit(1).count():
            return now
        now = materialize(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word: its usual ``form`` (the near word of largest n, if that is at
    least ``ratio`` times its own; ties: the smallest word), the ``root`` that
    forms lead to, n, the number of near words and the form's n."""
    words = materialize(words.select("word", "n"), "spelling_vocabulary")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    counted = words.join(near, "word", "left")
    usual = -F.col("best.less") >= F.col("n") * ratio
    found = materialize(counted.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                       F.when(usual, F.col("best.other")).alias("form"),
                                       F.when(usual, -F.col("best.less")).alias("form_n")), "spelling_found")
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

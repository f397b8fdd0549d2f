"""LM scoring with a hierarchical Pitman-Yor model over words.

Tokens are words (runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased) and one end per
text.  Every context (the previous word, or a text's start) is a restaurant
whose customers are the training tokens that follow it; its tables are
customers of the shared parent, the restaurant without a context, whose base is
uniform over V + 1 events: the V words of the training texts, and all other words
as one (the events of the base score).  After a context that training never
saw, the parent predicts.

Seating is sampled by Gibbs: a sweep reseats the customers of every dish given
the parent's predictive probability and the tables of the restaurant, then the
parent's customers given the new tables.  All dishes of a sweep see the
totals after the sweep before it (as samplers that run in parallel do).  Customers
of a dish are seated one at a time while few, then in batches of an eighth
of those seated.  The chains start with one table a dish and are swept until
the totals of their tables settle (``settled``; ``SWEEPS`` times at most); predictive
probabilities are averaged over ``CHAINS`` of them.  The draws
are hashes of (dish, chain, step): whoever holds a dish draws the same, so
seatings need not be sent, and retried tasks agree.

Work is dealt in blocks of neighbouring rows (``BLOCK_BYTES`` of text, whole texts).
A block asks for its distinct words and pairs of words, as sorted 64- and 56-bit
hashes dealt by hash to a bucket for every ``BUCKET_BLOCKS`` blocks; a bucket
adds the counts up, answers in the order asked, and names one block the owner of
each pair.  A block's messages are as many as the buckets, at most one an entry:
far beyond 10^5 blocks, larger blocks are cheaper.  The texts are read three times
(to ask, to set out what the sweeps need, to score) however many sweeps there
are: a block keeps its owned pairs of more than one customer and the sums of the
others (``Owned``).  A sweep sends, by word of these, the tables of the owned
pairs, by context and by word; the word's bucket adds them up, seats the
parent's customers, keeps the sums, and answers.  A seating follows from the sums
of the sweep before it alone, so older ones are removed.  At the end the
buckets give every block the last two sums of all of its words.  No key is hot: a block sends a word or pair
once however often it occurs.  Hash collisions merge dishes: at 10^13 distinct
pairs about one in 14,000.  Only totals pass through the driver.

Counts cover all training texts (crc32(doc_id as text) mod 7 is not 2; a null
doc_id trains).  Null and blank texts are just an end.  Repeated rows count
and score each.  Empty tables give empty results.  Other columns are not read.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from .tokens import U64, binary_parts, hashed_rows, mix

FOLDS, FOLD = 7, 2
BLOCK_BYTES = 4 << 20
#: A bucket holds at most what so many blocks ask for, on average.
BUCKET_BLOCKS = 4
CHAINS, SWEEPS = 2, 20
#: Change of a total by a sweep, in parts of it, and in standard deviations, that is none.
CHANGE, NOISE = 0.005, 3.0
#: Discount and strength of the context restaurants, of their parent.
DISCOUNT, STRENGTH = 0.75, 1.0
WORD_DISCOUNT, WORD_STRENGTH = 0.7, 10.0
#: Hashes of the end of a text and of its start (a context, never a token).
END, START = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)
PAIR_BITS = 56


# ---------------------------------------------------------------- restaurants
def _uniform(seed: np.ndarray, sample: int, step: int) -> np.ndarray:
    return (mix(seed ^ mix(np.array([(sample << 32) + step + 1], np.uint64))[0]) >> U64(11)) * 2.0 ** -53


def seat(customers: np.ndarray, base: np.ndarray, new_mass: np.ndarray, discount: float, seed: np.ndarray,
         sample: int) -> np.ndarray:
    """Tables of every dish after its customers are seated; ``base`` is the
    dish's probability in the parent, ``new_mass`` the restaurant's
    strength + discount * tables."""
    order = np.argsort(-customers, kind="stable")
    c, weight, seed = customers[order], (new_mass * base)[order], seed[order]
    tables = (c > 0).astype(np.float64)
    n, step, active = 1, 0, int(np.searchsorted(-c, -1, side="left"))
    while active:
        most = max(1, n // 8)
        size = np.minimum(most, c[:active] - n)
        p = weight[:active] / (weight[:active] + n - discount * tables[:active])
        u = _uniform(seed[:active], sample, step)
        if most == 1:
            fresh = (u < p).astype(np.float64)
        else:  # binomial by its normal approximation (logistic quantile)
            z = np.log(np.clip(u, 1e-9, 1 - 1e-9) / np.clip(1 - u, 1e-9, 1)) / 1.702
            fresh = np.clip(np.rint(size * p + z * np.sqrt(size * p * (1 - p))), 0, size)
        tables[:active] += fresh
        n += most
        step += 1
        active = int(np.searchsorted(-c[:active], -n, side="left"))
    out = np.empty_like(tables)
    out[order] = tables
    return out


def predict(customers, tables, discount: float, strength: float, restaurant_customers, restaurant_tables, parent):
    """Probability of a dish in a restaurant, by its parent's."""
    own = np.maximum(customers - discount * tables, 0)
    return (own + (strength + discount * restaurant_tables) * parent) / (strength + restaurant_customers)


def settled(before: list[float], after: list[float]) -> bool:
    """Whether a sweep left the totals of every chain as they were, but for chance."""
    return all(abs(b - a) <= max(CHANGE * b, NOISE * math.sqrt(b))
               for i, b in enumerate(after) for a in [before[i % len(before)]])


# ------------------------------------------------------------------- messages
def frame(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, byte by byte of each place, compressed."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a, dtype="<u8")
        wide = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        parts += [struct.pack("<QB", len(a), wide), a.view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unframe(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, wide = struct.unpack_from("<QB", raw, at)
        at += 9
        full = np.zeros((n, 8), np.uint8)
        full[:, :wide] = np.frombuffer(raw, np.uint8, n * wide, at).reshape(wide, n).T
        out.append(full.view("<u8").reshape(-1))
        at += n * wide
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _pack(block_bytes: int):
    """One row per block: doc_ids, whether they are null and held out, text
    lengths, and the texts."""
    def run(batches: Iterator[pa.RecordBatch]):
        part, turn, rows, size = TaskContext.get().partitionId() << 33, 0, [], 0

        def flush():
            ids, null, held, lengths, data = (np.concatenate(x) for x in zip(*rows))
            text = zstandard.ZstdCompressor(level=3).compress(data.tobytes())
            return pa.RecordBatch.from_arrays([
                pa.array([part + turn], pa.int64()), pa.array([frame(ids, null, held, lengths)], pa.binary()),
                pa.array([text], pa.binary())], names=["block", "rows", "texts"])

        for batch in batches:
            column = batch.column(0)
            null = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(0).to_numpy().astype(np.int64).view(np.uint64)
            held = batch.column(1).to_numpy(zero_copy_only=False)
            data, off = binary_parts(batch.column(2))
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + block_bytes - size, side="right")) - 1)
                rows.append((ids[lo:hi], null[lo:hi], held[lo:hi], np.diff(off[lo:hi + 1]), data[off[lo]:off[hi]]))
                size += int(off[hi] - off[lo])
                lo = hi
                if size >= block_bytes or lo < len(ids):
                    yield flush()
                    turn, rows, size = turn + 1, [], 0
        if rows:
            yield flush()
    return run


class Block:
    """Tokens of a block: the distinct words and pairs by hash, ascending, and
    every token's place among them."""

    def __init__(self, rows: bytes, texts: bytes):
        ids, null, held, lengths = unframe(rows)
        self.ids, self.null, self.held = ids.view(np.int64), null > 0, held > 0
        data = zstandard.ZstdDecompressor().decompress(texts)
        offsets = np.concatenate(([0], np.cumsum(lengths.astype(np.int64))))
        column = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        found, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, hashes, off in hashed_rows(column):
            found.append(hashes)
            counts.append(np.diff(off))
        hashes, counts = np.concatenate(found), np.concatenate(counts)
        self.first = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
        tokens = np.full(len(hashes) + len(ids), END, np.uint64)
        tokens[np.arange(len(hashes)) + np.repeat(np.arange(len(ids)), counts)] = hashes
        self.words, place = np.unique(np.concatenate((tokens, [START, END])), return_inverse=True)
        self.start, self.end = int(place[-2]), int(place[-1])
        self.token = place[:-2].astype(np.uint32)
        context = np.concatenate(([0], self.token[:-1])).astype(np.uint32)
        context[self.first] = self.start
        pair = mix(mix(self.words)[context] + tokens) >> U64(64 - PAIR_BITS)
        order = np.argsort(pair)
        ordered = pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        self.pairs = ordered[new]
        self.pair = np.empty(len(pair), np.uint32)
        self.pair[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        self.context, self.word = context[order[new]], self.token[order[new]]
        self.trained = ~np.repeat(self.held, counts + 1)

    def cuts(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where the words and the pairs of each bucket begin."""
        top = _tops(buckets)
        cut = lambda hashes, at: np.append(np.searchsorted(hashes, at), len(hashes))
        return cut(self.words, top), cut(self.pairs, top >> U64(64 - PAIR_BITS))


def _tops(buckets: int) -> np.ndarray:
    """Smallest hash of every bucket."""
    return (np.arange(buckets, dtype=np.uint64) * U64(2 ** 32 // buckets)) << U64(32)


def _sent(block: int, message, *cuts: np.ndarray) -> pa.Table:
    """``message`` of every bucket that one of the ``cuts`` gives entries."""
    buckets = np.flatnonzero(sum(np.diff(c) for c in cuts)).tolist()
    return pa.table({"block": pa.array([block] * len(buckets), pa.int64()), "bucket": pa.array(buckets, pa.int64()),
                     "data": pa.array([message(b) for b in buckets], pa.binary())})


def _ask(buckets: int, block_bytes: int):
    """A block's distinct words and pairs with their counts in its training
    texts; blocks are made and read in one worker."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _pack(block_bytes)(batches):
            for block, rows, texts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                b = Block(rows, texts)
                n_words = np.bincount(b.token[b.trained], minlength=len(b.words))
                n_pairs = np.bincount(b.pair[b.trained], minlength=len(b.pairs))
                w, p = b.cuts(buckets)
                yield from _sent(block, lambda i: frame(
                    _steps(b.words[w[i]:w[i + 1]]), n_words[w[i]:w[i + 1]],
                    _steps(b.pairs[p[i]:p[i + 1]]), n_pairs[p[i]:p[i + 1]]), w, p).to_batches()
    return run


# -------------------------------------------------------------------- buckets
def _merge(asked: list[np.ndarray]):
    """(order, dish of every ordered entry, first entry of every dish) of
    ascending hashes in steps; equal hashes stay in the order of the blocks."""
    hashes = np.concatenate([np.cumsum(a, dtype=np.uint64) for a in asked])
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new), ordered[new]


def _added(values: np.ndarray, order, dish, first) -> tuple[np.ndarray, np.ndarray]:
    """Sums by dish, and by entry in the order asked."""
    sums = np.add.reduceat(values[order], first) if len(first) else values[:0]
    out = np.empty_like(values)
    out[order] = sums[dish]
    return sums, out


def _answered(table: pa.Table, sizes: list[int], columns: list[np.ndarray], totals: list[float], more=None,
              kept: bytes | None = None) -> pa.Table:
    """Rows (block, bucket, data, kept, totals); the totals, and what the bucket
    keeps, are on the first row."""
    at, frames = 0, []
    for i, n in enumerate(sizes):
        frames.append(frame(*[c[at:at + n] for c in columns], *(more(i) if more else ())))
        at += n
    none = [0.0] * len(totals)
    return pa.table({"block": table["block"], "bucket": table["bucket"], "data": pa.array(frames, pa.binary()),
                     "kept": pa.array([kept] + [None] * (len(frames) - 1), pa.binary()),
                     "totals": pa.array([totals] + [none] * (len(frames) - 1), pa.list_(pa.float64()))})


_MESSAGE = "block long, bucket long, data binary"
_ANSWER = f"{_MESSAGE}, kept binary, totals array<double>"


def _count(table: pa.Table) -> pa.Table:
    """Counts over all blocks; of every trained pair the first block that trains
    it is the owner."""
    table = table.sort_by("block")
    words, n_words, pairs, n_pairs = zip(*map(unframe, table["data"].to_pylist()))
    c, by_word = _added(np.concatenate(n_words), *_merge(words)[:3])
    order, dish, first, _ = _merge(pairs)
    n = np.concatenate(n_pairs)
    by_pair = _added(n, order, dish, first)[1]
    owner = np.zeros(len(n), np.uint64)
    trains = np.flatnonzero(n[order] > 0)
    owner[order[trains[np.unique(dish[trains], return_index=True)[1]]]] = 1
    ends = np.cumsum([0, *map(len, pairs)])
    return _answered(table, list(map(len, words)), [by_word], [float(c.sum()), float((c > 0).sum())],
                     lambda i: (by_pair[ends[i]:ends[i + 1]], owner[ends[i]:ends[i + 1]]))


def _parent(kinds: int, held: list[float], sweep: int):
    """Tables by context and customers of the parent by word, added up over all
    blocks; the parent's customers are seated.  ``held``: its tables before."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        words, *sums = zip(*map(unframe, table["data"].to_pylist()))
        order, dish, first, hashes = _merge(words)
        columns, totals, kept = [], [], [_steps(hashes)]
        for chain in range(len(sums) // 2):
            contexts, by_context = _added(np.concatenate(sums[2 * chain]), order, dish, first)
            customers, by_word = _added(np.concatenate(sums[2 * chain + 1]), order, dish, first)
            mass = WORD_STRENGTH + WORD_DISCOUNT * held[chain % len(held)]
            tables = seat(customers.astype(np.int64), np.full(len(customers), 1.0 / (kinds + 1)),
                          np.full(len(customers), mass), WORD_DISCOUNT, hashes, (sweep << 8) + chain)
            of_entry = np.empty(len(by_word))
            of_entry[order] = tables[dish]
            columns += [by_context, by_word, of_entry.astype(np.uint64)]
            totals += [float(customers.sum()), float(tables.sum())]
            kept += [contexts, customers, tables.astype(np.uint64)]
        return _answered(table, list(map(len, words)), columns, totals, kept=frame(*kept))
    return run


def _recall(widths: list[int]):
    """The sums that a bucket kept, for every word that it is asked for; ``widths``:
    their columns by round."""
    def run(asked: pa.Table, kept: pa.Table) -> pa.Table:
        asked, columns = asked.sort_by("block"), []
        words = [np.cumsum(unframe(w)[0], dtype=np.uint64) for w in asked["words"].to_pylist()]
        hashes = np.concatenate(words) if words else np.zeros(0, np.uint64)
        have = dict(zip(kept["round"].to_pylist(), kept["kept"].to_pylist()))
        for turn, width in enumerate(widths):
            known, *sums = unframe(have[turn]) if turn in have else [np.zeros(0, np.uint64)] * (1 + width)
            known = np.append(np.cumsum(known, dtype=np.uint64), U64(0))
            at = np.minimum(np.searchsorted(known[:-1], hashes), len(known) - 1)
            hit = (known[at] == hashes) & (at < len(known) - 1)
            columns += [np.where(hit, np.append(s, U64(0))[at], U64(0)) for s in sums]
        ends = np.cumsum([0, *map(len, words)])
        return pa.table({"block": asked["block"], "bucket": asked["bucket"], "data": pa.array(
            [frame(*[c[lo:hi] for c in columns]) for lo, hi in zip(ends[:-1], ends[1:])], pa.binary())})
    return run


# --------------------------------------------------------------------- blocks
def _joined(answers: pa.Table) -> list[np.ndarray]:
    """The columns of a block's answers, bucket by bucket."""
    rows = sorted(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist()))
    return [np.concatenate(x) for x in zip(*[unframe(data) for _, data in rows])]


def _above(sums: list[np.ndarray], totals: list[float], kinds: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By chain, for the words of ``sums``: tables of their contexts, and the
    parent's probabilities."""
    chains = range(len(sums) // 3)
    return ([sums[3 * i].astype(np.float64) for i in chains],
            [predict(sums[3 * i + 1].astype(np.float64), sums[3 * i + 2], WORD_DISCOUNT, WORD_STRENGTH, totals[2 * i],
                     totals[2 * i + 1], 1.0 / (kinds + 1)) for i in chains])


def _seated(customers, context, word, pairs, by_context, parent, sweep: int, chains: int) -> list[np.ndarray]:
    """By chain: tables of pairs of more than one customer, given the sums of a sweep."""
    return [seat(customers, parent[chain % len(parent)][word],
                 STRENGTH + DISCOUNT * by_context[chain % len(parent)][context], DISCOUNT, pairs, (sweep << 8) + chain)
            for chain in range(chains)]


class Owned:
    """What the sweeps need of a block: the words of its owned pairs, the tables
    of the pairs of one customer (one each) by context and by word, and the
    pairs of more."""

    def __init__(self, data: bytes):
        words, self.one_context, self.one_word, pairs, context, word, self.customers = unframe(data)
        self.words, self.pairs = np.cumsum(words, dtype=np.uint64), np.cumsum(pairs, dtype=np.uint64)
        self.context, self.word = context.astype(np.int64), word.astype(np.int64)

    @staticmethod
    def of(block: Block, customers: np.ndarray, owner: np.ndarray) -> bytes:
        used = np.zeros(len(block.words), bool)
        used[block.context[owner]] = used[block.word[owner]] = True
        place, n = np.cumsum(used) - 1, int(used.sum())
        one, many = np.flatnonzero(owner & (customers == 1)), np.flatnonzero(owner & (customers > 1))
        sums = [np.bincount(place[key[one]], minlength=n) for key in (block.context, block.word)]
        return frame(_steps(block.words[used]), *sums, _steps(block.pairs[many]), place[block.context[many]],
                     place[block.word[many]], customers[many])

    def message(self, block: int, buckets: int, tables: list[np.ndarray]) -> pa.Table:
        """By chain: the tables of the owned pairs, by context and by word."""
        sums = [(one + np.bincount(key, weights=t, minlength=len(self.words)).astype(np.uint64))
                for t in tables for one, key in ((self.one_context, self.context), (self.one_word, self.word))]
        w = np.append(np.searchsorted(self.words, _tops(buckets)), len(self.words))
        return _sent(block, lambda i: frame(_steps(self.words[w[i]:w[i + 1]]), *[s[w[i]:w[i + 1]] for s in sums]), w)


_SET_OUT = "block long, bucket long, words binary, owned binary"


def _set_out(buckets: int):
    """The words of a block by bucket, and what its sweeps need (bucket null)."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        b, block = Block(texts["rows"][0].as_py(), texts["texts"][0].as_py()), texts["block"][0].as_py()
        _, customers, owner = _checked(b, answers)
        w, _ = b.cuts(buckets)
        asked = _sent(block, lambda i: frame(_steps(b.words[w[i]:w[i + 1]])), w)
        n = len(asked)
        return pa.table({"block": pa.array([block] * (n + 1), pa.int64()),
                         "bucket": pa.array([*asked["bucket"].to_pylist(), None], pa.int64()),
                         "words": pa.array([*asked["data"].to_pylist(), None], pa.binary()),
                         "owned": pa.array([None] * n + [Owned.of(b, customers, owner)], pa.binary())})
    return run


def _checked(block: Block, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training counts of the words and pairs of a block, and the pairs it owns."""
    counts, customers, owner = _joined(answers)
    if len(counts) != len(block.words) or len(customers) != len(block.pairs):
        raise RuntimeError("the rows of a block changed between two reads: store the table first")
    return counts.astype(np.int64), customers.astype(np.int64), owner > 0


def _first_offer(buckets: int):
    """Every pair of the training texts begins with one table."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                owned = Owned(data)
                yield from owned.message(block, buckets, [np.ones(len(owned.pairs))]).to_batches()
    return run


def _offer(buckets: int, kinds: int, totals: list[float], chains: int, sweep: int):
    """The tables after a sweep; ``totals`` are those before it."""
    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        owned, block = Owned(state["owned"][0].as_py()), state["block"][0].as_py()
        sums = _joined(answers) if len(answers) else [np.zeros(0, np.uint64)] * (3 * len(totals) // 2)
        tables = _seated(owned.customers.astype(np.int64), owned.context, owned.word, owned.pairs,
                         *_above(sums, totals, kinds), sweep, chains)
        return owned.message(block, buckets, tables)
    return run


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(total: int, kinds: int, totals: list[list[float]], chains: int, sweep: int):
    """Scores by the seating of the last sweep (number ``sweep``; -1: none) and the
    sums after it; ``totals``: those before it, if any, and after."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(texts["rows"][0].as_py(), texts["texts"][0].as_py())
        turn = answers["round"].to_numpy()
        counts, customers, _ = _checked(b, answers.filter(pa.array(turn == 0)))
        sums, known = _joined(answers.filter(pa.array(turn != 0))), len(totals[-1]) // 2 * 3
        by_context, parent = _above(sums[-known:], totals[-1], kinds)
        tables = [(customers > 0).astype(np.float64)]
        if sweep >= 0:
            many = np.flatnonzero(customers > 1)  # one customer is one table
            tables = [tables[0].copy() for _ in range(chains)]
            for t, seats in zip(tables, _seated(customers[many], b.context[many], b.word[many], b.pairs[many],
                                                *_above(sums[:-known], totals[0], kinds), sweep, chains)):
                t[many] = seats
        seated = counts.astype(np.float64)  # a word has as many followers as it occurs
        seated[b.start], seated[b.end] = counts[b.end], 0
        probability = sum(predict(customers, t, DISCOUNT, STRENGTH, seated[b.context], by[b.context], p[b.word])
                          for t, by, p in zip(tables, by_context, parent)) / len(tables)
        added = lambda x: np.add.reduceat(x, b.first)
        n = np.diff(np.append(b.first, len(b.token)))
        base = np.log10((counts + 1) / (total + kinds + 1))[b.token]
        columns = [pa.array(b.ids, mask=b.null), pa.array(b.held), pa.array(n, pa.int64()),
                   pa.array(added((counts > 0)[b.token].astype(np.int64))), pa.array(added(base)),
                   pa.array(added(np.log10(probability)[b.pair]))]
        return pa.table(columns, names=[c.split()[0] for c in _SCORED.split(", ")])
    return run


def score(docs: DataFrame, stored: bool = False, chains: int = CHAINS, sweeps: int | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every
    row.  ``docs`` is read several times and must give the same rows in the same
    partitions; ``stored`` says that it is a plain read of files, otherwise
    it is written first.  The chains are swept until they settle, or ``sweeps``
    times."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not stored:
        rows = materialize(rows, "lm_docs")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))
    rows = rows.select("doc_id", held.alias("held"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = 1 << max(5, math.ceil(math.log2(1 + size / (BUCKET_BLOCKS * block_bytes))))
    blocks = rows.mapInArrow(_pack(block_bytes), "block long, rows binary, texts binary")

    def answered(asked: DataFrame, run, name: str) -> tuple[DataFrame, list[float]]:
        found = materialize(asked.groupBy("bucket").applyInArrow(run, _ANSWER), name, last_use=True)
        sums = found.select(F.posexplode("totals")).groupBy("pos").agg(F.sum("col").alias("n")).orderBy("pos").collect()
        return found, [r["n"] for r in sums]

    def meet(left: DataFrame, right: DataFrame, key: str, run, schema: str) -> DataFrame:
        return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(run, schema)

    asked = rows.mapInArrow(_ask(buckets, block_bytes), _MESSAGE)
    answers, counted = answered(asked, _count, "lm_counts")
    answers = answers.select("block", "bucket", "data")
    total, kinds = (int(x) for x in counted or (0, 0))
    out = materialize(meet(blocks, answers, "block", _set_out(buckets), _SET_OUT), "lm_blocks", last_use=True)
    owned = out.where(F.col("owned").isNotNull()).select("block", "owned")
    found, totals = [], []
    for sweep in range((SWEEPS if sweeps is None else sweeps) + 1):  # the first round adds up the seating that the chains start with
        if sweep:
            before = found[-1].select("block", "bucket", "data")
            offers = meet(owned, before, "block", _offer(buckets, kinds, totals[-1], chains, sweep - 1), _MESSAGE)
        else:
            offers = owned.mapInArrow(_first_offer(buckets), _MESSAGE)
        held_tables = totals[-1][1::2] if totals else [float(kinds)]
        sums, now = answered(offers, _parent(kinds, held_tables, sweep), "lm_sweep")
        found, totals = [*found, sums], [*totals, now or [0.0, 0.0] * (chains if sweep else 1)]
        for old in found[:-2]:
            discard(old)
        found = found[-2:]
        if sweeps is None and sweep and settled(totals[-2], totals[-1]):
            break
    last = totals[-2:]
    kept = reduce(DataFrame.unionByName, [f.where(F.col("kept").isNotNull()).select("bucket", "kept", F.lit(i).alias("round"))
                                          for i, f in enumerate(found)])
    words = out.where(F.col("words").isNotNull()).select("block", "bucket", "words")
    sums = meet(words, kept, "bucket", _recall([len(t) // 2 * 3 for t in last]), _MESSAGE)
    answers = answers.withColumn("round", F.lit(0)).unionByName(sums.withColumn("round", F.lit(1)))
    return meet(blocks, answers, "block", _score(total, kinds, last, chains, len(totals) - 2), _SCORED).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")

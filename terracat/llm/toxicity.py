"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the sum of the hashed embeddings of the word and of its
first 4, 5, 6 and 8 bytes (inflected forms share them).  Filters of widths 1,
2 and 3 run over the word vectors, each filter's maximum over the text is kept
(rectified), and a logistic unit reads the maxima.  Training reads
every labelled row outside the held-out fold, whole texts.  Rows are dealt by
hash to shards of about ``SHARD_BYTES`` of text and stored as embedding ids, one
row a shard.  An epoch trains every shard from the same model by Adagrad and
averages the changes over the shards (of an embedding: over the shards that
hold it).  Changes are added as fixed-point integers, so the model does not
depend on the order or the partitions of the rows.  Only sums over all shards,
of the model's size, reach the driver.  Scoring reads whole texts.

A quarter of the rows is kept from the weights to set one threshold for every
language (best F1 at the labels' own proportion, on a grid of 1/``GRID``); the
score is shifted so that the threshold is 0.5.  The language is guessed from
function words of the text; the columns lang, source, doc_id and labels are
never inputs of a score.

Null, empty and blank texts have no words and score as the filters' floor.
Without labels of both classes every score is the share of toxic labels (0
without labels).  Repeated rows get equal scores.  Repeated labels of a
document count once (toxic if any is); repeated rows of it are all learned.  Empty tables give empty results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .tokens import U64, binary_parts, frugal, frugal_group, hashed_rows, mix, row_blocks

PREFIXES = (4, 5, 6, 8)
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
SHARD_BYTES, GRID = 16 << 20, 1024
#: A step takes ``BATCH`` texts, fewer if they have more words than this.
STEP_WORDS = 1 << 19
#: Bytes of text hashed at once: with several columns of hashes a word, few enough to keep a task small.
HASH_BYTES = 1 << 18
#: Embeddings whose changes are added up together; steps of a fixed-point number.
SLICE, FIXED = 2048, 2.0 ** 32
#: Bounds of ``_sample``, which training does not use; its texts of more bytes are
#: ``WINDOWS`` windows of as many bytes in all.
SAMPLE_BYTES, LONG_BYTES, WINDOWS = 24 << 20, 1 << 20, 16
EPOCHS, BATCH, RATE, LEAST_DF = 6, 64, 0.08, 3
PAD = max(WIDTHS) - 1
FOLDS = 5

#: Frequent function words of the languages told apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with as be by this are from at on",
    "de": "der die das und ist nicht mit den ein eine von zu in im auf für sich auch",
    "fr": "le la les des et est une un dans que qui pour pas sur par avec au ce",
    "es": "el la los las de que y en un una por con para es se del su al",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def _word_hashes(words: list[str]) -> np.ndarray:
    return next(hashed_rows(pa.array([" ".join(words).encode()], pa.binary())))[2]


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes, and per hash a vote for each language."""
    votes: dict[int, np.ndarray] = {}
    for i, words in enumerate(FUNCTION_WORDS.values()):
        for h in _word_hashes(words.split()).tolist():
            votes.setdefault(h, np.zeros(len(FUNCTION_WORDS), np.float32))[i] = 1
    keys = np.array(sorted(votes), dtype=np.uint64)
    return keys, np.stack([votes[int(k)] for k in keys])


def _languages(words: np.ndarray, rows: np.ndarray, n: int, table) -> np.ndarray:
    keys, votes = table
    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
    known = keys[at] == words
    total = np.stack([np.bincount(rows[known], weights=votes[at[known], i], minlength=n)
                      for i in range(votes.shape[1])], axis=1)
    return np.where(total.max(axis=1, initial=0) > 0, total.argmax(axis=1), len(LANGUAGES) - 1)


def _features(column: pa.Array, table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, embedding ids by word, word offsets, language) of blocks of rows."""
    salts = mix(np.arange(1, len(PREFIXES) + 2, dtype=np.uint64))
    for lo, hi, hashes, off in hashed_rows(column, PREFIXES, HASH_BYTES):
        ids = (mix(hashes ^ salts) & U64(BUCKETS - 1)).astype(np.int32)
        rows = np.repeat(np.arange(hi - lo), np.diff(off))
        yield hi - lo, ids, off, _languages(hashes[:, 0], rows, hi - lo, table)


@dataclass
class Model:
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIM), np.float32))
    filters: list[np.ndarray] = field(default_factory=list)  # by width: (width, DIM, FILTERS)
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    base: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    constant: float | None = None

    def vectors(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors with PAD zero rows after every text; the texts' first rows."""
        n = len(off) - 1
        first = off[:-1] + PAD * np.arange(n)
        at = np.arange(len(ids)) + PAD * np.repeat(np.arange(n), np.diff(off))
        x = np.zeros((len(ids) + PAD * (n + 1), DIM), np.float32)
        v = self.table[ids[:, 0]]
        for j in range(1, ids.shape[1]):
            v += self.table[ids[:, j]]
        x[at] = v
        return x, first

    def convolve(self, x: np.ndarray, w: int) -> np.ndarray:
        n = len(x) - PAD
        z = x[:n] @ self.filters[w][0]
        for j in range(1, WIDTHS[w]):
            z += x[j:n + j] @ self.filters[w][j]
        return z + self.bias[w]

    def logits(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        x, first = self.vectors(ids, off)
        tops = [np.maximum.reduceat(self.convolve(x, w), first, axis=0) for w in range(len(WIDTHS))]
        return np.maximum(np.concatenate(tops, axis=1), 0) @ self.out + self.base


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def start(counts: np.ndarray, n: np.ndarray, seed: int = 7) -> tuple[Model, list, np.ndarray]:
    """The first model, its sums of squares and the buckets kept; ``counts``: texts
    of each class (clean, toxic) that hold a bucket, of ``n`` texts."""
    rng = np.random.default_rng(seed)
    n0, n1 = max(1, int(n[0])), max(1, int(n[1]))
    odds = np.log((counts[1] + 2) / (n1 + 4)) - np.log((counts[0] + 2) / (n0 + 4))
    kept = (counts.sum(axis=0) >= LEAST_DF)[:, None]
    m = Model(table=(rng.normal(0, 0.05, (BUCKETS, DIM)) * kept).astype(np.float32))
    m.table[:, 0] = np.where(kept[:, 0], np.clip(odds, -1, 4) * 0.3, 0)
    for w in WIDTHS:
        f = rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32)
        f[0, 0] = 1.0 / w
        m.filters.append(f)
        m.bias.append(np.full(FILTERS, -0.1, np.float32))
    m.out, m.base = np.full(FILTERS * len(WIDTHS), 0.2, np.float32), -1.0
    squares = [np.full_like(m.table, 1e-2), [np.full_like(f, 1e-2) for f in m.filters],
               [np.full_like(b, 1e-2) for b in m.bias], np.full_like(m.out, 1e-2), 1e-2]
    return m, squares, kept


def _learn(m: Model, squares: list, kept: np.ndarray, shard: "Shard", rows: np.ndarray, seed: tuple[int, int]) -> None:
    """One epoch over the given rows of a shard; changes the model."""
    order = np.random.default_rng(seed).permutation(rows)
    lo = 0
    while lo < len(order):
        n = np.searchsorted(np.cumsum(shard.lengths[order[lo:lo + BATCH]]), STEP_WORDS, side="right")
        pick = order[lo:lo + max(1, int(n))]
        words, off = shard.batch(pick)
        _step(m, squares, words, off, shard.y[pick].astype(np.float32), kept)
        lo += len(pick)


def _step(m: Model, squares, words, off, y, kept) -> None:
    """One Adagrad step; only the filters' maxima carry a gradient."""
    x, first = m.vectors(words, off)
    n = len(first)
    ends = np.concatenate((first[1:], [len(x) - PAD]))
    lengths = ends - first
    tops, places = [], []
    for w in range(len(WIDTHS)):
        z = m.convolve(x, w)
        top = np.maximum.reduceat(z, first, axis=0)
        tops.append(top)
        hit = z[:ends[-1]] == np.repeat(top, lengths, axis=0)
        place = np.empty((n, FILTERS), np.int64)
        for f in range(FILTERS):
            at = np.flatnonzero(hit[:, f])
            place[:, f] = at[np.searchsorted(at, first)]
        places.append(place)
    pooled = np.concatenate(tops, axis=1)
    act = np.maximum(pooled, 0)
    err = (_sigmoid(act @ m.out + m.base) - y).astype(np.float32) / n
    back = err[:, None] * m.out[None, :] * (pooled > 0)
    dx = np.zeros_like(x)
    for w, width in enumerate(WIDTHS):
        g, place = back[:, w * FILTERS:(w + 1) * FILTERS], places[w]
        df = np.empty_like(m.filters[w])
        for j in range(width):
            at = place + j
            df[j] = np.einsum("nf,nfd->df", g, x[at])
            np.add.at(dx, at.ravel(), (g[:, :, None] * m.filters[w][j].T[None]).reshape(-1, DIM))
        _adagrad(m.filters[w], df, squares[1][w])
        _adagrad(m.bias[w], g.sum(axis=0), squares[2][w])
    _adagrad(m.out, act.T @ err + 1e-4 * m.out, squares[3])
    squares[4] += float(err.sum()) ** 2
    m.base -= RATE * float(err.sum()) / squares[4] ** 0.5
    touched = np.flatnonzero(np.abs(dx).sum(axis=1) > 0)
    at = np.arange(len(words)) + PAD * np.repeat(np.arange(n), np.diff(off))  # word -> row of x
    word = np.searchsorted(at, touched)
    ok = (word < len(at)) & (at[np.minimum(word, len(at) - 1)] == touched) if len(at) else np.zeros(len(touched), bool)
    used, inverse = np.unique(words[word[ok]].ravel(), return_inverse=True)
    grad = np.zeros((len(used), DIM), np.float32)
    np.add.at(grad, inverse.ravel(), np.repeat(dx[touched[ok]], words.shape[1], axis=0))
    grad *= kept[used]
    squares[0][used] += grad ** 2
    m.table[used] -= RATE * grad / np.sqrt(squares[0][used])


def _adagrad(value: np.ndarray, grad: np.ndarray, square: np.ndarray) -> None:
    square += grad ** 2
    value -= RATE * grad / np.sqrt(square)


def best_threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The logit threshold of the best weighted F1 (midway between neighbours)."""
    if not (y == 1).any():
        return float(z.max()) + 1 if len(z) else 0.0
    order = np.argsort(-z, kind="stable")
    z, y, weight = z[order], y[order], weight[order]
    tp, all_ = np.cumsum(weight * y), np.cumsum(weight)
    f1 = 2 * tp / (all_ + (weight * y).sum())
    f1[:-1][z[:-1] == z[1:]] = -1  # no threshold between equal logits
    i = int(f1.argmax())
    return float((z[i] + (z[i + 1] if i + 1 < len(z) else z[i] - 1)) / 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> Model:
    """Fit on all labelled documents outside the held-out fold."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y")))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (totals.get(0) and totals.get(1)):
        return Model(constant=float(bool(totals.get(1))))
    shards = shards_of(docs, known, shard_bytes)
    counts = _added(shards.mapInArrow(_count, _SUMS), np.int64, (-1, 4))
    rows = counts.pop(-1)[0]  # by 2 * calibrating + toxic
    if not (rows[0] + rows[2] and rows[1] + rows[3]):
        return Model(constant=totals[1] / sum(totals.values()))
    calibrated = bool(rows[0] and rows[1] and rows[2:].any())  # else the weights' rows set the thresholds
    found = np.concatenate([counts[i] for i in range(BUCKETS // SLICE)]).T
    pairs = lambda x: x[:2] if calibrated else x[:2] + x[2:]
    model, squares, kept = start(pairs(found).astype(np.float32), pairs(rows))
    for epoch in range(EPOCHS):
        run = partial(_epoch, model=model, squares=squares, kept=kept, calibrated=calibrated, epoch=epoch)
        _average(model, squares, _added(shards.mapInArrow(run, _SUMS), np.int64, None))
    grid = (shards.mapInArrow(partial(_logits, model=model, calibrated=calibrated), "lang int, y int, z int, n long")
            .groupBy("lang", "y", "z").agg(F.sum("n").alias("n")).orderBy("lang", "y", "z").toPandas())
    lang, y, z, n = (grid[c].to_numpy() for c in ("lang", "y", "z", "n"))
    share = np.array([totals[c] / max(1, rows[c] + rows[2 + c]) for c in (0, 1)])
    weight, z = n * share[y], z / GRID
    overall = best_threshold(z, y, weight)
    for i in range(len(LANGUAGES)):
        own = lang == i
        enough = n[own & (y == 1)].sum() >= 5 and n[own & (y == 0)].sum() >= 5
        model.thresholds[i] = best_threshold(z[own], y[own], weight[own]) if enough else overall
    return model


# ------------------------------------------------------------------- shards
_SHARD = "shard long, y binary, calibrate binary, lang binary, lengths binary, ids binary"
#: Sums of a task over its shards: ``part`` numbers a slice of the embeddings; -1: all else.
_SUMS = "part int, data binary"


def _packed(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes, one after another."""
    out = zstandard.ZstdCompressor(level=1).compressobj(size=sum(a.nbytes for a in arrays))
    return b"".join([*[out.compress(np.ascontiguousarray(a).data.cast("B")) for a in arrays if a.size], out.flush()])


def _unpacked(data: bytes | pa.Buffer, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def shards_of(docs: DataFrame, known: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of ``docs`` outside the held-out fold with a label of ``known``
    (doc_id, y), in shards dealt by hash: one row each with labels, folds,
    languages and embedding ids.  Texts are shuffled once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = (docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text")))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // shard_bytes))
    # an id whose rows fill shards is dealt to several (few: at most n ids)
    wide = (texts.groupBy(F.col("doc_id").alias("_id")).agg(F.ceil(F.sum(F.octet_length("text")) / shard_bytes).cast("long").alias("copies"))
            .where("copies > 1"))

    def dealt(rows: DataFrame, copy) -> DataFrame:
        rows = rows.join(F.broadcast(wide), F.col("doc_id") == F.col("_id"), "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
        return rows.withColumn("copy", copy).withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(n))).drop("_id", "copies")

    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"))
    left = dealt(texts, F.pmod(F.col("h"), F.col("copies"))).drop("copy")
    right = dealt(known, F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copy")
    return materialize(left.repartition(n, "shard").groupBy("shard").cogroup(right.repartition(n, "shard").groupBy("shard"))
                       .applyInArrow(_shard, _SHARD), "tox_shards")


@frugal_group
def _shard(table: pa.Table, known: pa.Table) -> pa.Table:
    known = known.select(["doc_id", "y"]).group_by("doc_id").aggregate([("y", "max")]).sort_by("doc_id")
    ids, y = (known[c].to_numpy() for c in ("doc_id", "y_max"))
    doc_ids, h = table["doc_id"].to_numpy(), table["h"].to_numpy()
    at = np.minimum(np.searchsorted(ids, doc_ids), len(ids) - 1)
    rows = np.flatnonzero(ids[at] == doc_ids) if len(ids) else np.zeros(0, np.int64)
    if not len(rows):
        return pa.schema([("shard", pa.int64()), *[(k, pa.binary()) for k in ("y", "calibrate", "lang", "lengths", "ids")]]).empty_table()
    unsigned = doc_ids.astype(np.uint64)[rows]
    rows = rows[np.lexsort((h[rows], unsigned, mix(unsigned)))]  # however the rows came
    calibrate = mix(doc_ids.astype(np.uint64)[rows] ^ U64(99)) % U64(4) == 0
    text, languages = pa.concat_arrays(table["text"].chunks), _language_table()
    found = [(f.astype(np.uint16), np.diff(off), lang) for lo in range(0, len(rows), BATCH)
             for _, f, off, lang in _features(text.take(pa.array(rows[lo:lo + BATCH])), languages)]
    features, lengths, lang = zip(*found)
    arrays = [[y[at[rows]].astype(np.uint8)], [calibrate.astype(np.uint8)], [a.astype(np.uint8) for a in lang],
              [a.astype(np.int64) for a in lengths], features]
    return pa.table({"shard": table["shard"].slice(0, 1), **{
        k: pa.array([_packed(*a)], pa.binary()) for k, a in zip(("y", "calibrate", "lang", "lengths", "ids"), arrays)}})


class Shard:
    def __init__(self, row: dict):
        self.y, self.lang = _unpacked(row["y"], np.uint8), _unpacked(row["lang"], np.uint8)
        self.calibrate = _unpacked(row["calibrate"], np.uint8) > 0
        self.lengths = _unpacked(row["lengths"], np.int64)
        self.off = np.concatenate(([0], np.cumsum(self.lengths)))
        self.ids = _unpacked(row["ids"], np.uint16).reshape(-1, len(PREFIXES) + 1)

    def batch(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([self.ids[self.off[i]:self.off[i + 1]] for i in pick]).astype(np.int32)
        return ids, np.concatenate(([0], np.cumsum(self.lengths[pick])))

    def batches(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The rows in order, in pieces of at most ``STEP_WORDS`` words or of one text."""
        cut = np.flatnonzero(np.diff(np.cumsum(self.lengths[rows]) // STEP_WORDS)) + 1
        return (p for part in np.split(rows, cut) for p in np.split(part, range(BATCH, len(part), BATCH)) if len(p))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Shard]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            yield row.pop("shard").as_py(), Shard({name: value.as_buffer() for name, value in row.items()})


def _sums(arrays: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(arrays), pa.int32()), pa.array([_packed(a) for a in arrays.values()], pa.binary())],
                                      ["part", "data"])


def _slices(table: np.ndarray) -> dict[int, np.ndarray]:
    return {i: table[i * SLICE:(i + 1) * SLICE] for i in range(BUCKETS // SLICE)}


def _added(sums: DataFrame, kind, shape) -> dict[int, np.ndarray]:
    """The tasks' integer sums, added up by part."""
    def add(table: pa.Table) -> pa.Table:
        total = sum(_unpacked(d, kind) for d in table["data"].to_pylist())
        return pa.table({"part": table["part"].slice(0, 1), "data": pa.array([_packed(total)], pa.binary())})

    rows = sums.groupBy("part").applyInArrow(add, _SUMS).collect()  # of the model's size, however many rows are learned
    found = {r["part"]: _unpacked(r["data"], kind) for r in rows}
    if shape:
        none = {-1: np.zeros(4, kind), **{i: np.zeros(4 * SLICE, kind) for i in range(BUCKETS // SLICE)}}
        found = {k: v.reshape(shape) for k, v in {**none, **found}.items()}
    return found


@frugal
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts, and texts that hold a bucket, by 2 * calibrating + toxic."""
    rows, held = np.zeros(4, np.int64), np.zeros((BUCKETS, 4), np.int64)
    for _, s in _shards(batches):
        kind = 2 * s.calibrate + s.y
        rows += np.bincount(kind, minlength=4)
        for pick in s.batches(np.arange(len(kind))):
            words, off = s.batch(pick)
            row = np.repeat(np.repeat(np.arange(len(pick)), np.diff(off)), words.shape[1])
            once = np.unique(row << 16 | words.ravel())
            np.add.at(held, (once & (BUCKETS - 1), kind[pick][once >> 16]), 1)
    yield _sums({-1: rows, **_slices(held)})


def _parts(m: Model, squares: list) -> list[np.ndarray]:
    """All values but the embeddings, then their squares."""
    return [*m.filters, *m.bias, m.out, np.array([m.base]), *squares[1], *squares[2], squares[3], np.array([squares[4]])]


def _fixed(x: np.ndarray) -> np.ndarray:
    return np.rint(x.astype(np.float64) * FIXED).astype(np.int64)


@frugal
def _epoch(batches: Iterator[pa.RecordBatch], model: Model, squares: list, kept: np.ndarray, calibrated: bool,
           epoch: int) -> Iterator[pa.RecordBatch]:
    """Changes of the values and of their squares, added up over the task's shards,
    each trained from ``model``; with the number of shards (that hold a bucket)."""
    table, before = np.zeros((BUCKETS, 2 * DIM + 1), np.int64), _parts(model, squares)
    rest, shards = [np.zeros(x.shape, np.int64) for x in before], 0
    for number, s in _shards(batches):
        rows = np.flatnonzero(~s.calibrate) if calibrated else np.arange(len(s.y))
        if not len(rows):
            continue
        mine = Model(model.table.copy(), [f.copy() for f in model.filters], [b.copy() for b in model.bias],
                     model.out.copy(), model.base)
        own = [squares[0].copy(), [f.copy() for f in squares[1]], [b.copy() for b in squares[2]], squares[3].copy(), squares[4]]
        _learn(mine, own, kept, s, rows, (epoch, number))
        at = np.flatnonzero((own[0] != squares[0]).any(axis=1))
        table[at, :DIM] += _fixed(mine.table[at] - model.table[at])
        table[at, DIM:-1] += _fixed(own[0][at] - squares[0][at])
        table[at, -1] += 1
        rest = [r + _fixed(x - b) for r, x, b in zip(rest, _parts(mine, own), before)]
        shards += 1
    yield _sums({-1: np.concatenate([[shards], *[r.ravel() for r in rest]]), **_slices(table)})


def _average(m: Model, squares: list, sums: dict[int, np.ndarray]) -> None:
    table = np.concatenate([sums[i] for i in range(BUCKETS // SLICE)]).reshape(BUCKETS, -1)
    mean = table[:, :-1] / FIXED / np.maximum(table[:, -1:], 1)
    m.table += mean[:, :DIM].astype(np.float32)
    squares[0] += mean[:, DIM:].astype(np.float32)
    shards, at = max(1, int(sums[-1][0])), 1
    parts = _parts(m, squares)
    for x in parts:  # views, but for the two numbers
        x += (sums[-1][at:at + x.size].reshape(x.shape) / FIXED / shards).astype(x.dtype)
        at += x.size
    m.base, squares[4] = float(parts[len(parts) // 2 - 1][0]), float(parts[-1][0])


@frugal
def _logits(batches: Iterator[pa.RecordBatch], model: Model, calibrated: bool) -> Iterator[pa.RecordBatch]:
    """(lang, y, logit on the grid, texts) of the rows that set the thresholds."""
    for _, s in _shards(batches):
        rows = np.flatnonzero(s.calibrate) if calibrated else np.arange(len(s.y))
        if not len(rows):
            continue
        z = np.concatenate([model.logits(*s.batch(pick)) for pick in s.batches(rows)])
        z = np.rint(np.clip(z, -30, 30) * GRID).astype(np.int64)
        keys, n = np.unique(np.stack((s.lang[rows], s.y[rows], z)), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([*[pa.array(k, pa.int32()) for k in keys], pa.array(n, pa.int64())], ["lang", "y", "z", "n"])


# ------------------------------------------------------------------ scoring
def judged(texts: pa.Array, model: Model) -> pa.StructArray:
    """(score, guessed) of a batch's texts.  Blocks are worked on one after another
    and hashed in pieces, so a task holds the batch's text and little beside it."""
    table = _language_table()
    scores, guessed = [np.zeros(0)], [np.zeros(0, np.int64)]
    for lo, hi in row_blocks(binary_parts(texts)[1]):
        _, ids, off, lang = zip(*_features(texts.slice(lo, hi - lo), table))
        guessed += lang
        if model.constant is not None:
            scores.append(np.full(hi - lo, model.constant))
            continue
        off = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(o) for o in off]))))
        scores.append(_sigmoid(model.logits(np.concatenate(ids), off) - model.thresholds[np.concatenate(lang)]))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(scores), pa.float64()),
                                       pa.array(LANGUAGES).take(pa.array(np.concatenate(guessed)))], ["score", "guessed"])


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (the columns ``keep``; doc_id by default) with
    ``score`` and ``guessed``, the language guessed from the text."""
    @F.arrow_udf("struct<score:double,guessed:string>")
    def run(texts: pa.Array) -> pa.Array:
        return frugal_group(judged)(texts, model)

    keep = ["doc_id"] if keep is None else keep
    result = run(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return docs.select(*keep, result.alias("__toxicity"))


def digest(scored: DataFrame) -> DataFrame:
    value = F.col("__toxicity.score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"),
                         F.when(value >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
                         F.col("__toxicity.guessed").alias("guessed_lang"))


def _sample(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the chosen ids (few: their list is broadcast), one text
    for each, within the byte budget; for trials, not for ``train``.  Sizes are
    read before any text is moved."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select("doc_id", text.alias("text"))
    per = (texts.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
           .groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes"))).alias("m")))
    before = Window.partitionBy("y").orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.least("m.bytes", F.lit(LONG_BYTES))).over(before), F.lit(0))
    picked = per.withColumn("used", used).where(F.col("used") < SAMPLE_BYTES).select(F.col("doc_id").alias("_id"), "y", F.col("m.h").alias("h"))
    found = texts.join(F.broadcast(picked), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("h")))
    size, step = F.octet_length("text"), LONG_BYTES // WINDOWS
    windows = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda i: F.decode(
        F.substring(F.col("text"), (i * (size - step) / (WINDOWS - 1)).cast("int") + 1, F.lit(step)), "ISO-8859-1")), " ")
    spread = F.when(size > LONG_BYTES, F.encode(windows, "ISO-8859-1")).otherwise(F.col("text"))
    return found.select("doc_id", "y", spread.alias("text")).dropDuplicates(["doc_id"])

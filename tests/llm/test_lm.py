"""op5: counts and the base score by brute force; the model by its definition."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from terracat.llm import lm
from terracat.llm.tokens import mix


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def counted(docs):
    counts = Counter(w for i, t in docs if not held(i) for w in tokens(t))
    return counts, sum(counts.values()), len(counts)


@pytest.mark.parametrize("block_bytes", [1 << 24, 3000])
def test_counts_and_base_score(small_docs, block_bytes):
    docs = [(r.doc_id, r.text) for r in small_docs.collect()]
    counts, n, v = counted(docs)
    expect = sorted(((str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                      sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in docs))
    got = lm.score(small_docs.withColumnRenamed("lang", "word").withColumnRenamed("source", "block"),
                   block_bytes=block_bytes).collect()
    mine = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [m[:5] for m in mine] == [e[:5] for e in expect]
    assert [m[5] for m in mine] == pytest.approx([e[5] for e in expect])
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # a better model of unseen texts


def test_blocks_and_partitions_play_no_part(small_docs):
    whole = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score(small_docs).collect())
    parts = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score(small_docs.repartition(5), block_bytes=20_000).collect())
    assert [w[:2] for w in whole] == [p[:2] for p in parts]
    assert [w[2] for w in whole] == pytest.approx([p[2] for p in parts])


def hash_of(word):
    import pyarrow as pa
    from terracat.llm.tokens import hashed_rows
    return next(hashed_rows(pa.array([word], pa.binary())))[2][0]


class Model:
    """The restaurants in dictionaries, all in one place."""

    def __init__(self, texts, chains=lm.CHAINS, sweeps=lm.SWEEPS):
        pairs = Counter(p for t in texts for p in zip([None, *tokens(t)], tokens(t)))
        self.words = sorted({w for _, w in pairs})
        self.seated = Counter()
        for (u, _), n in pairs.items():
            self.seated[u] += n
        code = {None: lm.START, b"": lm.END, **{w: hash_of(w) for w in self.words if w}}
        self.keys = list(pairs)
        customers = np.array([pairs[k] for k in self.keys])
        self.customers = dict(zip(self.keys, customers))
        hashes = np.array([code[w] for w in self.words], np.uint64)
        ends = np.array([(code[u], code[w]) for u, w in self.keys], np.uint64)
        seeds = mix(mix(ends[:, 0]) + ends[:, 1]) >> np.uint64(64 - lm.PAIR_BITS)
        kinds, tables, held_tables = len(self.words), [np.ones(len(self.keys))], [len(self.words)]
        for sweep in range(sweeps + 1):
            self.chains = []
            for chain, t in enumerate(tables):
                by_context, by_word = Counter(), Counter()
                for (u, w), n in zip(self.keys, t):
                    by_context[u] += n
                    by_word[w] += n
                c = np.array([by_word[w] for w in self.words]).astype(np.int64)
                mass = lm.WORD_STRENGTH + lm.WORD_DISCOUNT * held_tables[chain % len(held_tables)]
                above = lm.seat(c, np.full(kinds, 1 / (kinds + 1)), np.full(kinds, mass), lm.WORD_DISCOUNT, hashes,
                                (sweep << 8) + chain)
                back = (lm.WORD_STRENGTH + lm.WORD_DISCOUNT * above.sum()) / (kinds + 1)
                parent = {w: (max(n - lm.WORD_DISCOUNT * a, 0) + back) / (lm.WORD_STRENGTH + c.sum())
                          for w, n, a in zip(self.words, c, above)}
                parent["?"] = back / (lm.WORD_STRENGTH + c.sum())
                self.chains.append((dict(zip(self.keys, t)), by_context, parent, above.sum()))
            held_tables = [c[3] for c in self.chains]
            if sweep == sweeps:
                break
            old, tables = tables, []
            for chain in range(chains):
                _, by_context, parent, _ = self.chains[chain % len(old)]
                tables.append(lm.seat(customers, np.array([parent[w] for _, w in self.keys]),
                                      np.array([lm.STRENGTH + lm.DISCOUNT * by_context[u] for u, _ in self.keys]),
                                      lm.DISCOUNT, seeds, (sweep << 8) + chain))

    def probability(self, u, w):
        total = 0
        for tables, by_context, parent, _ in self.chains:
            own = max(self.customers.get((u, w), 0) - lm.DISCOUNT * tables.get((u, w), 0), 0)
            back = (lm.STRENGTH + lm.DISCOUNT * by_context[u]) * parent.get(w, parent["?"])
            total += (own + back) / (lm.STRENGTH + self.seated[u])
        return total / len(self.chains)

    def score(self, text):
        return sum(math.log10(self.probability(u, w)) for u, w in zip([None, *tokens(text)], tokens(text)))


@pytest.mark.parametrize("sweeps", [1, 3])
def test_scores_equal_the_model_in_one_place(small_docs, sweeps):
    docs = [(r.doc_id, r.text) for r in small_docs.collect()]
    model = Model([t for i, t in docs if not held(i)], sweeps=sweeps)
    expect = sorted((str(i), model.score(t)) for i, t in docs)
    got = sorted((str(r.doc_id), r.score) for r in lm.score(small_docs, block_bytes=50_000, sweeps=sweeps).collect())
    assert [g[0] for g in got] == [e[0] for e in expect]
    assert [g[1] for g in got] == pytest.approx([e[1] for e in expect])
    for u in (None, b"the", b"of", b"neverseen"):  # all events after a context, unknown words as one
        assert sum(model.probability(u, w) for w in [*model.words, b"neverseen"]) == pytest.approx(1)
    assert any((np.array(list(c[0].values())) > 1).any() for c in model.chains)


def test_word_order_and_copies_matter(docs_of):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(200)]
    late = next(i for i in range(1000, 2000) if held(i))
    docs = docs_of(texts)
    known = next(i for i in range(200) if not held(i))
    copy = docs_of([texts[known], " ".join(reversed(texts[known].split()))], start=late)
    got = {r.doc_id: r.score for r in lm.score(docs.unionByName(copy)).collect()}
    unseen = [got[i] for i in range(200) if held(i)]
    assert got[late] > max(unseen) + 20  # its copy was learned
    twice = docs.unionByName(docs_of([texts[known]], start=next(i for i in range(3000, 4000) if not held(i))))
    again = {r.doc_id: r.score for r in lm.score(twice).collect()}
    assert again[known] > max(s for i, s in again.items() if i < 200 and i != known) + 5
    other = {r.doc_id: r.score for r in lm.score(docs_of(["a b c d e f", "f e d c b a"])).collect()}
    assert len(set(other.values())) == 2


def test_held_out_likelihood_beats_the_base_score(spark):
    """Word contexts help on texts that were not learned."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.score(docs, stored=True).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_seating():
    rng = np.random.default_rng(0)
    c = rng.integers(0, 3000, 500)
    seed = rng.integers(0, 2**63, 500, dtype=np.uint64)
    t = lm.seat(c, np.full(500, 0.01), np.full(500, 50.0), 0.5, seed, 0)
    assert (t[c > 0] >= 1).all() and (t <= c).all() and (t[c == 0] == 0).all()
    order = rng.permutation(500)
    assert (lm.seat(c[order], np.full(500, 0.01), np.full(500, 50.0), 0.5, seed[order], 0) == t[order]).all()


def test_frames():
    arrays = [np.array([], np.uint64), np.array([0, 0]), np.array([2**64 - 1, 1], np.uint64), np.arange(1000)]
    back = lm.unframe(lm.frame(*arrays))
    assert len(back) == 4 and all((a.astype(np.uint64) == b).all() and len(a) == len(b) for a, b in zip(arrays, back))


def test_empty_and_single(empty_docs, docs_of):
    assert lm.score(empty_docs).count() == 0
    rows = lm.score(docs_of([None])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(1, 1, 1)]


def test_chains_are_swept_until_they_settle(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 700")
    seen = []
    monkeypatch.setattr(lm, "settled", lambda a, b, judge=lm.settled: seen.append((a, b, judge(a, b))) or seen[-1][2])
    got = {r.doc_id: r.score for r in lm.score(docs).collect()}
    assert len(seen) > 1 and [s[2] for s in seen] == [False] * (len(seen) - 1) + [True]
    assert got == {r.doc_id: r.score for r in lm.score(docs, sweeps=len(seen)).collect()}
    assert got != {r.doc_id: r.score for r in lm.score(docs, sweeps=1).collect()}


def test_settled():
    assert lm.settled([1e6, 1e5], [1.001e6, 1e5, 1e6, 1.002e5])
    assert not lm.settled([1e6, 1e5], [1e6, 1e5, 1e6, 1.02e5])
    assert lm.settled([100.0, 10.0], [110.0, 12.0]) and lm.settled([], [])


def test_sweeps_leave_two_rounds_and_no_shuffles(spark, small_docs):
    """The disk of a run does not grow with its sweeps."""
    from pathlib import Path
    from terracat.session import checkpoint_root
    root = Path(checkpoint_root(spark).removeprefix("file:"), "terracat-tables")
    rounds = lambda: {p.name for p in root.glob("lm_sweep-*")}
    before = rounds()
    assert lm.score(small_docs, sweeps=5).count() == small_docs.count()
    assert len(rounds() - before) == 2


def test_owned_pairs_are_sent_as_they_are_counted():
    """A block's first message adds up the pairs that it owns, one table each."""
    rng = np.random.default_rng(3)
    block = lm.Block(lm.frame(np.array([0, 1]), np.zeros(2), np.zeros(2), np.array([11, 9])), lm.zstandard.compress(b"a b a b c a" + b"c a b b a"))
    customers, owner = rng.integers(1, 4, len(block.pairs)), rng.random(len(block.pairs)) < 0.7
    owned = lm.Owned(lm.Owned.of(block, customers, owner))
    found = {}
    for r in owned.message(0, 32, [np.ones(len(owned.pairs)), np.full(len(owned.pairs), 2.0)]).to_pylist():
        words, *sums = lm.unframe(r["data"])
        found.update(zip(np.cumsum(words, dtype=np.uint64).tolist(), zip(*(s.tolist() for s in sums))))
    expect = {}
    for t, c, w in zip(customers[owner], block.context[owner], block.word[owner]):
        for at, k in ((0, c), (1, w)):
            row = expect.setdefault(int(block.words[k]), [0, 0, 0, 0])
            row[at] += 1
            row[at + 2] += 1 if t == 1 else 2
    assert found == {k: tuple(v) for k, v in expect.items()}

"""op4: targets by hand, the schedule's discrepancy, and the contract's sums."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terracat.llm import mixing


def water_fill(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return {s: 2.0 * sizes[s] for s in names}
        rate = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > 2 * sizes[s] + 1e-9}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * rate for s in names}
        capped |= over


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 16), (3, 7)])
def test_contract(spark, monkeypatch, seed, block):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 16)
    monkeypatch.setattr(mixing, "CHUNK", 64)
    rng = random.Random(seed)
    docs = [(i, " \t".join(["w"] * rng.choice([0, 1, 5, 50, 700])), rng.choice(["a", "b", "é", "Z", "hot", "hot", None]))
            for i in range(300)] + [(9, "twice", "a")] * 2 + [(None, None, None), (None, "x y", "only")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("code", F.lit(1))
    first = mixing.mix(df, block=block).collect()
    again = mixing.mix(df, block=block).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in first) == sorted(
        (str(i), str(s), len((t or "").split())) for i, t, s in docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in first:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    expect = water_fill(sizes)
    for r in first:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expect[r.source])
    for s in sizes:
        assert abs(taken[s] - expect[s]) < 1


def test_every_prefix_of_the_schedule_is_balanced(spark):
    docs = spark.createDataFrame([(i, "w " * 100, "abc"[i % 3]) for i in range(600)], "doc_id long, text string, source string")
    sources = mixing.materialize(mixing.targets(mixing.sized(docs)), "t")
    slots = [r.code for r in mixing.schedule(sources, 10).orderBy("slot").collect()]
    share = {c: slots.count(c) / len(slots) for c in set(slots)}
    seen = defaultdict(int)
    for n, c in enumerate(slots, 1):
        seen[c] += 1
        assert all(abs(seen[x] - n * p) < 6 for x, p in share.items())


def test_empty(empty_docs):
    assert mixing.mix(empty_docs).count() == 0

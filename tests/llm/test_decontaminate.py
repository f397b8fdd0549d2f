"""op7 against a brute-force version over all alignments."""

import itertools
import random

import pytest

from terracat.llm import decontaminate as dc


def words(text):
    return (text or "").encode().lower().split()


def brute(docs, items):
    found = set()
    for i, text in docs:
        d = words(text)
        for k, item in items:
            b = words(item)
            if len(b) < dc.SHORTEST:
                continue
            size = min(dc.WORDS, len(b))
            for shift in range(size - len(b), len(d) - size + 1):
                same = [d[p] == b[p - shift] for p in range(max(0, shift), min(len(d), shift + len(b)))]
                if any(100 * sum(same[j:j + size]) >= dc.AGREE * size for j in range(len(same) - size + 1)):
                    found.add((i, k))
                    break
    return found


def test_masks_lose_nothing():
    for n in range(dc.SHORTEST, dc.WORDS + 1):
        wrong = n - -(-dc.AGREE * n // 100)
        for bad in itertools.combinations(range(n), wrong):
            assert any(not any(mask[b - p] == "1" for b in bad if 0 <= b - p < len(mask))
                       for mask in dc.MASKS for p in range(n - len(mask) + 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps_equal_brute_force(spark, docs_of, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["The", "OF", "ünï", "a"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([3, 8, 9, 10, 13, 20, 40])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, items[5][1]), (102, items[5][1])]
    docs = [None, "", "a b"]
    for i in range(80):
        d = text(rng.randrange(0, 80))
        if i % 2:
            b = items[rng.randrange(30)][1].split()
            lo = rng.randrange(0, max(1, len(b) - 8))
            part = [rng.choice(vocab) if rng.random() < 0.15 else w.upper() if rng.random() < 0.3 else w
                    for w in b[lo:lo + rng.choice([8, 13, 16, 60])]]
            at = rng.randrange(0, len(d) + 1)
            d = d[:at] + part + d[at:]
        docs.append("  ".join(d) if i % 3 else " \n".join(d))
    docs += [docs[7], docs[7]]
    df = docs_of(docs).withColumnRenamed("lang", "h")  # a clashing column
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.overlaps(df, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted(brute(list(enumerate(docs)), items))
    for r in got:
        d, b = words(docs[r.doc_id]), words(dict(items)[r.item_id])
        assert r.n_agree == sum(d[r.doc_word + j] == b[r.item_word + j] for j in range(r.n_words))


def test_null_ids_and_empty_tables(spark, empty_docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "x one two three four five six seven eight nine ten y")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in dc.overlaps(docs, bench).collect()] == [(None, 1)]
    assert dc.overlaps(empty_docs, bench).count() == 0
    assert dc.overlaps(docs, bench.limit(0)).count() == 0

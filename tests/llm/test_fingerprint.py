"""op10: the contract's columns by brute force, and the signature's properties."""

import hashlib
import random

import pytest

from terracat.llm import fingerprint as fg


def expected(rows):
    """{row number: (n_chars, sha of the edited text)} by the contract."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0)))
    out = []
    for a, i in enumerate(order):
        text, nxt = rows[i][1] or "", rows[order[(a + 1) % len(order)]][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        out.append((rows[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_bucket", [1, 7, 128])
def test_edited_texts(spark, small_docs, monkeypatch, per_bucket):
    monkeypatch.setattr(fg, "_ROWS_PER_BUCKET", per_bucket)
    docs = small_docs.withColumnRenamed("lang", "fp").withColumnRenamed("source", "bucket")  # clashing names
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = fg.compare(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == expected(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def prints(docs):
    return {r.doc_id: set(r.fp) for r in fg.with_fingerprint(docs, "text", "fp").select("doc_id", "fp").collect()}


def near(a, b):
    bins = {v >> 32 for v in a} | {v >> 32 for v in b}
    return 1.0 if not bins else len(a & b) / len(bins)


def test_equal_texts_and_edit_sensitivity(docs_of):
    rng = random.Random(4)
    words = [f"w{rng.randrange(5000)}" for _ in range(600)]
    light = list(words)
    light[100::100] = ["changed"] * 5
    heavy = [w if rng.random() < 0.6 else "z" + w for w in words]
    moved = words[300:] + words[:300]
    shuffled = rng.sample(words, len(words))
    texts = [" ".join(x) for x in (words, words, light, heavy, moved, shuffled, ["w"] * 40, ["w"] * 41)]
    p = prints(docs_of([*texts, "", None, "one", "one two"]).fillna("", ["text"]))
    assert p[0] == p[1] and len(p[0]) == fg.BINS
    light_, heavy_, moved_ = near(p[0], p[2]), near(p[0], p[3]), near(p[0], p[4])
    assert 1 > light_ > 0.7 > heavy_ and light_ > moved_ > 0.2  # half of the pairs keep their order
    assert near(p[0], p[5]) < 0.1
    assert p[8] == p[9] == set() and len(p[10]) == 1 and len(p[11]) == 1 and p[6] != p[7]


def test_occurrences_are_numbered(docs_of):
    p = prints(docs_of(["a b", "a b a b a b a b a b a b", "a b " * 200]))
    assert len(p[0]) == 1 and len(p[1]) > 5 and len(p[2]) == fg.BINS


def test_single_row_and_empty(docs_of, empty_docs):
    r = fg.compare(docs_of(["abcdefg"])).collect()[0]
    assert r.n_chars == 7 and r.edited_sha256 == hashlib.sha256(b"abcdabc").hexdigest() and r.near_next == 1.0
    assert fg.compare(empty_docs).count() == 0


@pytest.mark.parametrize("n", [20, 40, 80])
def test_short_texts_have_order(docs_of, n):
    rng = random.Random(n)
    texts = []
    for _ in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(n)]
        edited = words[:n // 2] + ["changed"] + words[n // 2 + 1:]
        texts += [" ".join(words), " ".join(words[n // 2:] + words[:n // 2]), " ".join(edited)]
    p = prints(docs_of(texts))
    moved = sum(near(p[i], p[i + 1]) for i in range(0, 90, 3)) / 30
    edited = sum(near(p[i], p[i + 2]) for i in range(0, 90, 3)) / 30
    assert moved < 0.65 and edited > moved + 0.1


def test_null_and_shared_ids_are_split_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(fg, "_ROWS_PER_BUCKET", 8)
    rng = random.Random(9)
    top = 2**63 - 1
    rows = [(i, f"text {rng.randrange(10**9)} of {i}") for i in range(300)]
    rows += [(h, f"hot {h} {rng.randrange(10**9)}") for h in (None, 7, top, -5) for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r["count"] for r in fg.dealt(docs).groupBy("bucket").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 40
    hashed = docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h, r.text))
    expect = []
    for r, nxt in zip(order, order[1:] + order[:1]):
        half = len(r.text) // 2
        expect.append((str(r.doc_id), hashlib.sha256((r.text[:len(r.text) - half] + nxt.text[:half]).encode()).hexdigest()))
    got = fg.compare(docs).collect()
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == sorted(expect)

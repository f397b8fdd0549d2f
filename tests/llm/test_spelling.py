import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terracat.llm import spelling

from .conftest import ODD_TEXTS


def brute_words(rows):
    """Counts by the contract's words, char by char."""
    letter = lambda c: "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"
    out = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if letter(c):
                run += c.lower() if c < "\x80" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                out[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
            run = ""
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a != b and (a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:]))


def brute(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_documents_equal_brute_force(spark, small_docs):
    docs = small_docs.limit(60) if small_docs.count() > 400 else small_docs
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    words = brute_words(rows)
    got = result(spelling.group(spelling.words_of(docs)))
    assert {(r[0], r[3]) for r in got} == set(words.items())
    few = dict(sorted(words.items())[:1500])
    again = spark.createDataFrame(list(few.items()), "word string, n long")
    assert result(spelling.group(again)) == brute(few)


@pytest.mark.parametrize("pairs", [spelling.PAIRS, 0])
def test_random_words_equal_brute_force(spark, monkeypatch, pairs):
    """Few letters, so bigrams repeat and tie; with no pairs allowed all keys go the other way."""
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    rng = random.Random(5)
    words = {}
    while len(words) < 700:
        w = "".join(rng.choice("abé") for _ in range(rng.randint(7, 9)))
        words[w] = int(10 ** rng.uniform(0.4, 5))
    words |= {"x" * 7: 5, "x" * 8: 60, "x" * 9: 700, "x" * 3000: 9, "x" * 3001: 90, "y" + "x" * 3000: 90}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute(words)
    assert any(r[1] and r[2] != r[1] for r in want)
    assert result(spelling.group(df)) == want


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(1)
    grams = {a + b: rng.randint(1, 50) for a in "abc" for b in "abc"}
    rank = {g: i for i, g in enumerate(sorted(grams, key=lambda g: (grams[g], g)))}
    for _ in range(300):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(4, 9)))
        pivots, prefix, last = spelling.pivots_and_prefix(w, rank, grams)
        cost = lambda p: sum(grams[w[k:k + 2]] for k in p)
        three = sorted(sorted(range(len(w) - 1), key=lambda k: (rank[w[k:k + 2]], k))[:3])
        assert cost(pivots) == min(cost((i, j)) for i in three for j in three if j - i >= 2)
        assert pivots[1] - pivots[0] >= 2 and set(pivots) <= set(three) <= set(prefix) and len(prefix) <= 7
        assert last == max(rank[w[k:k + 2]] for k in three)


def test_odd_rows(spark, empty_docs, docs_of):
    assert result(spelling.group(spelling.words_of(empty_docs))) == set()
    texts = [*ODD_TEXTS, "Zebrafish zebrafish ZEBRAFISH", "Éclairs éclairs Éclairs éclairs", None]
    docs = docs_of(texts, start=3).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    docs = docs.unionByName(docs).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    words = brute_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert "Éclairs" in words and "éclairs" in words
    assert result(spelling.group(spelling.words_of(docs))) == brute(words)


def test_pieces_do_not_cut_runs(monkeypatch):
    text = "Abc dé, " * 50 + "q" * 90 + " end"
    whole = spelling._runs(text)
    monkeypatch.setattr(spelling, "PIECE", 7)
    assert spelling._runs(text) == whole and whole["q" * 90] == 1

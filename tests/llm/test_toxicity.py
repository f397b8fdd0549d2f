import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terracat.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG_WORDS = [f"{a}{b}{c}" for a in ("ba", "do", "ri", "mu") for b in ("la", "ne", "so", "ti", "ku") for c in ("m", "ra", "pe", "s")]
BAD = ["vilegrub", "stinkmoor", "hassbrot"]


def corpus(spark, n=900, words=40, seed=2):
    """A third of the texts hold one bad word at a random place."""
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        text = [rng.choice(RNG_WORDS) for _ in range(rng.randint(words // 2, words))]
        toxic = k % 3 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(BAD)
        docs.append((k, " ".join(text), "en", "s", 0))
        labels.append((k, 0, int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def judged(docs, model):
    return {r.doc_id: r for r in toxicity.digest(toxicity.score(docs, model)).collect()}


def held_out_errors(docs, labels, model):
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = judged(docs, model)
    return [k for k, r in got.items() if r.held_out and r.predicted != truth[k]], sum(r.held_out for r in got.values())


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    wrong, n = held_out_errors(docs, labels, toxicity.train(docs, labels))
    assert n > 100 and len(wrong) <= 0.03 * n


def test_only_long_labelled_texts(spark):
    """Texts of 20 KB and more are learned whole; clean long texts are left alone."""
    docs, labels = corpus(spark, n=240, words=6000)
    assert docs.where(F.octet_length("text") > 16_384).count() == 240
    wrong, n = held_out_errors(docs, labels, toxicity.train(docs, labels))
    assert n > 20 and len(wrong) <= 0.1 * n


def test_sample_is_bounded(spark, monkeypatch):
    docs, labels = corpus(spark, n=300)
    hot = docs.where("doc_id = 3").crossJoin(spark.range(3000)).drop("id").withColumn(
        "text", F.concat("text", F.lit(" "), (F.rand(1) * 1e9).cast("int").cast("string")))
    chosen = labels.select("doc_id", F.col("toxic").alias("y"))
    sample = toxicity._sample(docs.unionByName(hot), chosen)
    assert sample.count() == 300 and sample.where("doc_id = 3").count() == 1  # one text of a repeated id
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 5000)
    few = toxicity._sample(docs, chosen).groupBy("y").agg(F.sum(F.octet_length("text")).alias("b")).collect()
    assert len(few) == 2 and all(5000 <= r.b < 5400 for r in few)
    monkeypatch.setattr(toxicity, "LONG_BYTES", 160)
    long = docs.limit(1).withColumn("text", F.concat(F.repeat(F.lit("a"), 500), F.repeat(F.lit("b"), 500)))
    text = toxicity._sample(long, chosen).first().text.decode()
    assert 160 <= len(text) <= 176 and text.count("a") == text.count("b")  # windows over all of it


def test_labels_lang_source_and_id_are_no_inputs(spark):
    docs, labels = corpus(spark, n=300)
    model = toxicity.train(docs, labels)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10_000)
    a, b = judged(docs, model), judged(other, model)
    assert all(a[k].score == b[k + 10_000].score for k in a)
    # neither are the held-out labels in training
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    c = judged(docs, toxicity.train(docs, flipped))
    assert sum(abs(a[k].score - c[k].score) > 1e-6 for k in a) == 0


def test_odd_rows(spark):
    docs, labels = corpus(spark, n=300)
    model = toxicity.train(docs.repartition(7), labels.unionByName(labels))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (2, " \t\n", None, "s", 1), (3, "x" * 300_000, "en", "s", 1),
                                 (4, "bala mura " * 50_000 + BAD[0], "en", "s", 1), (5, "same", "en", "s", 4), (5, "same", "de", "t", 4)], DOCS)
    odd = odd.withColumn("score", F.lit("clash")).withColumn("__toxicity", F.lit(1)).withColumn("y", F.lit(1))
    rows = toxicity.digest(toxicity.score(odd, model)).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[None] == by[1] == by[2] and by[5][0] == by[5][1]
    empty = docs.limit(0)
    assert toxicity.digest(toxicity.score(empty, model)).count() == 0
    # the rows' order and partitions do not change the model
    again = toxicity.train(docs.repartition(3, "text"), labels)
    assert judged(docs, model) == judged(docs, again)


@pytest.mark.parametrize("rows,constant", [([], 0.0), ([(1, 0, 1), (2, 0, 1)], 1.0), ([(1, 0, 0)], 0.0), ([(None, 1, 1), (3, None, None)], 0.0)])
def test_labels_of_one_class_or_none(spark, rows, constant):
    docs, _ = corpus(spark, n=10)
    model = toxicity.train(docs, spark.createDataFrame(rows, LABELS))
    assert {r.score for r in judged(docs, model).values()} == {constant}


def test_labels_without_documents(spark):
    docs, labels = corpus(spark, n=60)
    model = toxicity.train(docs.limit(0), labels)
    assert model.constant is not None and 0 < model.constant < 1


def test_rows_beyond_any_sample_are_learned(spark):
    """A word of the toxic rows that come last by hash, after 5,000 others."""
    n = 9000
    order = F.row_number().over(Window.orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id"))
    ids = spark.range(n).select(F.col("id").alias("doc_id"))
    late = {r.doc_id for r in ids.where(~toxicity.held_out(F.col("doc_id"))).withColumn("k", order).where("k > 5000").collect()}
    rng, docs, labels = random.Random(4), [], []
    for k in range(2 * n):
        text = [rng.choice(RNG_WORDS) for _ in range(8)]
        if k < n:
            text[rng.randrange(8)] = "laterword" if k in late or zlib.crc32(str(k).encode()) % 5 == 0 else BAD[0]
        docs.append((k, " ".join(text), "en", "s", 0))
        labels.append((k, 0, int(k < n)))
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = judged(docs.where("text like '%laterword%'"), toxicity.train(docs, labels, shard_bytes=200_000))
    out = [r for r in got.values() if r.held_out]
    assert len(late) > 2000 and len(out) > 100 and all(r.predicted == 1 for r in out)


def test_shards_are_averaged(spark):
    docs, labels = corpus(spark)
    shards = toxicity.shards_of(docs, labels.select("doc_id", F.col("toxic").alias("y")), 20_000)
    fold = docs.where(~toxicity.held_out(F.col("doc_id")))
    learned = lambda s: sum(len(toxicity.Shard(r.asDict()).y) for r in s.collect())
    assert 5 < shards.count() < 20 and learned(shards) == fold.count()
    hot = docs.where("doc_id = 3").crossJoin(spark.range(900)).drop("id").withColumn(
        "text", F.concat("text", F.lit(" "), (F.rand(1) * 1e9).cast("int").cast("string")))
    shards = toxicity.shards_of(docs.unionByName(hot), labels.select("doc_id", F.col("toxic").alias("y")), 20_000)
    sizes = [len(toxicity.Shard(r.asDict()).y) for r in shards.collect()]
    assert sum(sizes) == fold.count() + 900 and max(sizes) < 500  # an id of many rows is in several
    wrong, n = held_out_errors(docs, labels, toxicity.train(docs, labels, shard_bytes=20_000))
    assert n > 100 and len(wrong) <= 0.03 * n


def test_a_batch_of_texts_is_scored_in_small_memory():
    """Beside the batch's own texts, a scoring task holds a few MB."""
    rng = random.Random(5)
    text = " ".join(rng.choice(RNG_WORDS) for _ in range(400)).encode()
    column = pa.array([text[i % 7:] for i in range(6000)], pa.binary())
    counts = np.ones((2, toxicity.BUCKETS), np.float32)
    model, _, _ = toxicity.start(counts, np.array([9, 9]))
    toxicity.judged(column.slice(0, 10), model)  # tables that are made once
    tracemalloc.start()
    try:
        whole = toxicity.judged(column, model)
        assert tracemalloc.get_traced_memory()[1] < 30 << 20 < column.nbytes * 3
    finally:
        tracemalloc.stop()
    assert len(whole) == len(column) and all(0 <= r["score"] <= 1 for r in whole.to_pylist())


def test_a_shard_is_made_in_small_memory():
    """A shard's texts are hashed a few at a time and not copied as a whole, and the
    shard holds every labelled row in the order of its hash."""
    rng = random.Random(6)
    words = " ".join(rng.choice(RNG_WORDS) for _ in range(400)).encode()
    n = 4000
    texts = pa.table({"shard": pa.array([3] * n), "doc_id": pa.array([k % 3900 for k in range(n)]),
                      "text": pa.array([words[k % 5:] for k in range(n)], pa.binary()), "h": pa.array([k % 5 for k in range(n)])})
    known = pa.table({"doc_id": pa.array([k for k in range(3000)] + [1]), "y": pa.array([k % 2 for k in range(3000)] + [0], pa.int32())})
    toxicity._shard(texts.slice(0, 10), known)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        made = toxicity._shard(texts, known)
        traced = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert traced < 70 << 20 and pa.total_allocated_bytes() - before < texts.nbytes
    (_, shard), = toxicity._shards(iter(made.to_batches()))
    assert len(shard.y) == 3000 + 100 and shard.y.sum() == 1500 + 50 and shard.lengths.sum() == len(shard.ids)
    assert toxicity._shard(texts.slice(0, 0), known).num_rows == toxicity._shard(texts, known.slice(0, 0)).num_rows == 0

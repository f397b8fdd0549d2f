import glob
import os
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from terracat.sources import tables

from .conftest import rows


def files_that_may_hold(path, column, value):
    """Files whose row group statistics do not rule the value out."""
    hits = 0
    for name in glob.glob(os.path.join(path, "*.parquet")):
        meta = pq.ParquetFile(name).metadata
        at = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            if s is None or not s.has_min_max or s.min <= value <= s.max:
                hits += 1
                break
    return hits


def edges(spark, n=40_000):
    rng = random.Random(4)
    data = [(rng.randrange(5000), rng.randrange(5000), rng.choice(["Is a", "Maps to", "Subsumes", "Mapped from"])) for _ in range(n)]
    return spark.createDataFrame(data, "concept_id_1 long, concept_id_2 long, relationship_id string").repartition(4)


def test_lookups_by_either_end_read_few_files(spark, tmp_dir):
    df = edges(spark)
    sorted_, mixed = os.path.join(tmp_dir, "sorted"), os.path.join(tmp_dir, "mixed")
    tables.write_clustered(df, sorted_, ["concept_id_1", "concept_id_2"], 64)
    tables.write_interleaved(df, mixed, ["concept_id_1", "concept_id_2"], 64)
    assert rows(spark.read.parquet(mixed)) == rows(df)
    for value in (400, 2500, 4500):
        today, now = (files_that_may_hold(p, "concept_id_2", value) for p in (sorted_, mixed))
        assert today >= 50 and now <= today / 5, (today, now)
        assert files_that_may_hold(mixed, "concept_id_1", value) <= 16
    # by label as well: three keys, two bits each
    tables.write_interleaved(df, os.path.join(tmp_dir, "three"), ["concept_id_1", "concept_id_2", "relationship_id"], 64)
    assert files_that_may_hold(os.path.join(tmp_dir, "three"), "relationship_id", "Maps to") <= 40
    assert files_that_may_hold(os.path.join(tmp_dir, "three"), "concept_id_2", 17) <= 30


def test_interleaved_order_of_odd_rows(spark, tmp_dir):
    df = spark.createDataFrame([(None, 1, "a"), (1, None, None), (None, None, "a")] + [(7, 7, "hot")] * 300, "concept_id_1 long, concept_id_2 long, r string")
    for n, part in enumerate((df, df.limit(0))):
        path = os.path.join(tmp_dir, str(n))
        tables.write_interleaved(part, path, ["concept_id_1", "concept_id_2", "r"], 8)
        assert rows(spark.read.parquet(path)) == rows(part)
    code = df.select(tables.interleaved_order(df, ["concept_id_1"], 3).alias("c")).where("c is null")
    assert code.count() == 0


def test_morton_code_interleaves_ranks(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    got = {(r.a, r.b): r.c for r in df.withColumn("c", tables.interleaved_order(df, ["a", "b"], 3)).collect()}
    spread = lambda v: sum((v >> k & 1) << 2 * k for k in range(3))
    assert got == {(a, b): spread(a) | spread(b) << 1 for a in range(8) for b in range(8)}


def test_bucketed_side_is_not_shuffled(spark, tmp_dir):
    c = spark.range(0, 500).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    stored = tables.write_bucketed(c, "tc_bucketed_names", "k", 8, os.path.join(tmp_dir, "b"))
    o = spark.range(0, 2000).select((F.col("id") % 600).cast("string").alias("k2"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = o.join(stored, F.col("k2") == F.col("k"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(k2" in plan and "Bucketed: true" in plan
        assert joined.count() == sum(1 for k in range(2000) if k % 600 < 500)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        tables.drop_table(spark, "tc_bucketed_names")

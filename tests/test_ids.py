import pytest
from pyspark.sql import functions as F

from terracat.operators.ids import dense_id, dense_id_single
from .conftest import SF_CHECK


@pytest.mark.parametrize("parts", [1, 3, 8, 17])
def test_dense_id_is_exactly_1_to_n(spark, parts):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").select("l_orderkey", "l_linenumber",
                                                                    "l_partkey", "l_suppkey")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = dense_id(li, keys, "id", num_partitions=parts)
    agg = out.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(agg) == (60000, 60000, 1, 60000)
    assert out.exceptAll(dense_id_single(li, keys, "id")).count() == 0


def test_dense_id_start_and_ties(spark):
    df = spark.createDataFrame([(k % 3,) for k in range(50)], "k int")
    out = dense_id(df, ["k"], "id", start=101, num_partitions=4)
    ids = sorted(r.id for r in out.collect())
    assert ids == list(range(101, 151))
    # order respected across ties: every k=0 id precedes every k=1 id
    by_k = {k: [r.id for r in out.where(F.col("k") == k).collect()] for k in range(3)}
    assert max(by_k[0]) < min(by_k[1]) and max(by_k[1]) < min(by_k[2])


def test_dense_id_nested_in_one_plan(spark):
    """Two numberings in one plan (the attr index case) stay consistent."""
    df = spark.range(0, 5000).withColumn("g", F.col("id") % 7)
    inner = dense_id(df, ["id"], "a", num_partitions=5)
    outer = dense_id(inner.where(F.col("g") != 3).select("a", "g"), ["g", "a"], "b", num_partitions=6)
    agg = outer.agg(F.count("*"), F.countDistinct("b"), F.min("b"), F.max("b"), F.countDistinct("a")).first()
    n = 5000 - len([i for i in range(5000) if i % 7 == 3])
    assert tuple(agg) == (n, n, 1, n, n)


def test_dense_id_plan_has_no_single_partition_data_exchange(spark):
    df = spark.range(0, 1000)
    out = dense_id(df, ["id"], "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only SinglePartition exchange allowed is over the per-partition counts
    assert plan.count("SinglePartition") <= 1
    single = dense_id_single(df, ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in single


def test_dense_id_splits_a_group_of_copies(spark):
    """A third of the rows share one key: ids stay 1..n and the hot key is
    spread over several range partitions instead of one task."""
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    out = dense_id(df, ["k"], "n", num_partitions=6)
    agg = out.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(agg) == (3000, 3000, 1, 3000)
    hot = out.where("k = -1").agg(F.min("n"), F.max("n")).first()
    assert tuple(hot) == (1, 1000)              # ties sorted first, contiguous
    parts = (df.withColumn("__t", F.monotonically_increasing_id())
             .repartitionByRange(6, "k", "__t").groupBy(F.spark_partition_id()).count().collect())
    assert max(r["count"] for r in parts) < 1000    # no task holds the whole hot key


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=60),
       st.integers(1, 7))
def test_dense_id_property(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = [(r.k, r.n) for r in dense_id(df, ["k"], "n", num_partitions=parts).collect()]
    assert sorted(n for _, n in got) == list(range(1, len(keys) + 1))
    by_id = [k for k, _ in sorted(got, key=lambda t: t[1])]
    # ids follow the key order, NULLs first (as ORDER BY k NULLS FIRST)
    assert by_id == sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))


def test_dense_id_with_map_column(spark):
    df = spark.createDataFrame([(i, {"k": i}) for i in range(20)], "id int, m map<string,int>")
    assert sorted(r.n for r in dense_id(df, ["id"], "n", num_partitions=3).collect()) == list(range(1, 21))

import os
import random

import pytest
from pyspark.sql import functions as F

from terracat.contracts import CONTRACTS, Column, Contract, ForeignKey
from terracat.plans import appends
from terracat.plans import violations as vio
from terracat.sources.published import current

from .conftest import rows

SITE, READING = "site string, name string, region string", "reading long, site string, value string"


@pytest.fixture()
def contracts():
    return {
        "site": Contract("site", "t", (Column("site", "string", True, 4), Column("name", "string", True, None), Column("region", "string", False, None)),
                         ("site",), (("name", "region"),), (ForeignKey("fk", "child", ("region",), "site", ("site",)),)),
        "reading": Contract("reading", "t", (Column("reading", "long", True, None), Column("site", "string", True, None), Column("value", "string", False, 3)),
                            ("reading",), (), (ForeignKey("fk", "child", ("site",), "site", ("site",)),)),
    }


def random_rows(rng, n):
    site = lambda: rng.choice([None, "a", "b", "c,d", "long site", "e", "f", "g"])
    return ([(site(), rng.choice(["x", "y", None]), site()) for _ in range(n)],
            [(rng.choice([None, *range(40)]), site(), rng.choice([None, "v", "long"])) for _ in range(n)])


@pytest.mark.parametrize("bits", [appends.BITS, 1])
def test_appends_equal_a_full_check(spark, tmp_dir, contracts, bits):
    """With one bit every value is a candidate and the exact lookup decides."""
    rng = random.Random(bits)
    state = appends.Appends(spark, tmp_dir, {"site": ["site", "name", "region"], "reading": ["reading", "site", "value"]}, contracts, bits)
    assert state.open_violations().count() == 0
    sites, readings = [], []
    for k in range(4):
        s, r = random_rows(rng, 12)
        if k == 2:
            s = []  # an append without rows of a table
        sites, readings = sites + s, readings + r
        assert state.append(f"a{k}", {"site": spark.createDataFrame(s, SITE), "reading": spark.createDataFrame(r, READING)})
        assert not state.append(f"a{k}", {"reading": spark.createDataFrame(r, READING)})  # taken in before
        full = vio.violating_rows({"site": spark.createDataFrame(sites, SITE), "reading": spark.createDataFrame(readings, READING)}, contracts)
        assert rows(state.open_violations(), *vio.VIOLATING_COLUMNS) == rows(full, *vio.VIOLATING_COLUMNS)
    state.merge()
    assert [k for k in current(spark, tmp_dir)[1] if k.startswith("keys")] == ["keys-00000000"]
    state.append("late", {"site": spark.createDataFrame([("zz", "n", None)], SITE)})
    sites.append(("zz", "n", None))
    full = vio.violating_rows({"site": spark.createDataFrame(sites, SITE), "reading": spark.createDataFrame(readings, READING)}, contracts)
    assert rows(state.open_violations(), *vio.VIOLATING_COLUMNS) == rows(full, *vio.VIOLATING_COLUMNS)


def test_old_rows_are_not_read_again(spark, tmp_dir, contracts):
    old = os.path.join(tmp_dir, "old")
    spark.createDataFrame([(k, "a" if k % 2 else "gone", None) for k in range(1000)], READING).write.parquet(old)
    state = appends.Appends(spark, os.path.join(tmp_dir, "state"), {"site": ["site", "name", "region"], "reading": ["reading", "site", "value"]}, contracts)
    state.append("1", {"reading": spark.read.parquet(old), "site": spark.createDataFrame([("a", "x", None)], SITE)})
    for name in os.listdir(old):  # a job that reads the old rows fails from here on
        if name.endswith(".parquet"):
            with open(os.path.join(old, name), "wb") as f:
                f.write(b"no parquet")
    state.append("2", {"reading": spark.createDataFrame([(5, "a", None), (2000, "b", None)], READING), "site": spark.createDataFrame([("gone", "y", None)], SITE)})
    assert rows(state.open_violations(), "rule", "key", "n") == [("primary key", "5", 2), ("references site.site", "b", 1)]


def test_new_keys_need_no_lookup(spark, tmp_dir, contracts):
    """Values whose bit is clear are no candidates."""
    keys = spark.range(0, 5000).select(F.lit(1).alias("rule_id"), F.col("id").cast("string").alias("key"), F.lit(1).cast("long").alias("n"))
    sketch = appends._sketch(keys, appends.BITS)
    fresh = spark.range(10_000, 20_000).select(F.lit(1).alias("rule_id"), F.col("id").cast("string").alias("key"))
    assert appends.candidates(fresh, sketch, appends.BITS, "rule_id").count() < 20
    assert appends.candidates(keys, sketch, appends.BITS, "rule_id").count() == 5000
    assert appends.candidates(keys.withColumn("rule_id", F.lit(2)), sketch, appends.BITS, "rule_id").count() == 0


def test_violating_rows_of_odd_tables(spark, contracts):
    none = vio.violating_rows({"site": spark.createDataFrame([], SITE)}, contracts)
    assert none.columns == vio.VIOLATING_COLUMNS and none.count() == 0
    df = spark.createDataFrame([("a", None, "b"), ("a", "n", None), ("a", "n", "x" * 9), (None, "n", "b")], SITE).withColumn("key", F.lit(1)).withColumn("rule_id", F.lit(1))
    assert rows(vio.violating_rows({"site": df}, contracts), "rule", "column_name", "key", "n") == [
        ("primary key", "site", "a", 3), ("references site.site", "region", "b", 2), ("references site.site", "region", "x" * 9, 1),
        ("required", "name", "a", 1), ("required", "site", "", 1)]
    # decimal and integer keys meet
    kids = spark.createDataFrame([(1, 7), (2, 8)], "variable_source_id int, g int").select("variable_source_id", F.col("g").cast("decimal(20,2)").alias("geom_dependency_uuid"))
    got = vio.violating_rows({"variable_source": kids, "data_source": spark.createDataFrame([(7,)], "data_source_uuid long")}, CONTRACTS)
    assert rows(got, "rule", "key") == [("references data_source.data_source_uuid", "8")]


def test_one_scan_per_table(spark, tmp_dir):
    """However many rules a table has, its files are scanned once."""
    ds = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr("o_custkey AS ancestor_concept_id", "o_orderkey AS descendant_concept_id")
    rules = vio.rules_of({"concept_ancestor": ds.columns}, CONTRACTS)
    plan = vio.events({"concept_ancestor": ds}, rules, CONTRACTS)._jdf.queryExecution().executedPlan().toString()
    assert len(rules) >= 3 and plan.count("FileScan") == 1


def test_values_looked_up_are_written_once(spark, tmp_dir, contracts, monkeypatch):
    """A later append asks the bit table once for its keys and once for its
    orphans, whatever reads the answers, and offers open orphans together with them."""
    made, asked = [], []
    real, find = appends.materialize, appends.vio.orphans
    monkeypatch.setattr(appends, "materialize", lambda df, name: made.append(name) or real(df, name))
    monkeypatch.setattr(appends.vio, "orphans", lambda refs, keys, rules: asked.append(keys) or find(refs, keys, rules))
    state = appends.Appends(spark, tmp_dir, {"site": ["site", "name", "region"], "reading": ["reading", "site", "value"]}, contracts, 64)
    state.append("a", {"reading": spark.createDataFrame([(1, "a", "v"), (2, "b", "v")], READING)})
    made.clear(), asked.clear()
    state.append("b", {"site": spark.createDataFrame([("a", "x", "a")], SITE), "reading": spark.createDataFrame([(1, "b", "v")], READING)})
    assert {"append_again", "append_twice", "append_asked", "append_parents"} <= set(made) and len(made) == len(set(made))
    assert len(asked) == 2  # against the append's keys, and against the stored ones
    assert rows(state.open_violations(), "rule", "key", "n") == [("primary key", "1", 2), ("references site.site", "b", 2)]

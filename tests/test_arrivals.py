import itertools
import os

import pytest
from pyspark.sql import functions as F

from terracat.plans import catalog
from terracat.sources import read_delimited
from terracat.sources.published import current
from terracat.streaming import arrivals

from .fixtures import data_source_csv, variable_source_csv


@pytest.fixture()
def tables(spark, tmp_dir):
    return (read_delimited(spark, data_source_csv(os.path.join(tmp_dir, "ds.csv")), "data_source"),
            read_delimited(spark, variable_source_csv(os.path.join(tmp_dir, "vs.csv")), "variable_source"))


def indexed(spark, root):
    attr, geom = (spark.read.parquet(f"{root}/{t}") for t in ("attr_index", "geom_index"))
    rows = attr.join(geom.select("geom_index_id", F.col("data_source_id").alias("g")),
                     F.col("geom_index_id") == F.col("attr_of_geom_index_id")).collect()
    assert sorted(r.attr_index_id for r in rows) == list(range(1, len(rows) + 1))
    return sorted((r.variable_source_id, r.data_source_id, r.g, r.database_schema, r.table_name) for r in rows)


def batch_result(ds, vs):
    geom, attr = catalog.build_indexes(ds, vs)
    return sorted(tuple(r) for r in attr.join(geom.select("geom_index_id", F.col("data_source_id").alias("g")),
                  F.col("geom_index_id") == F.col("attr_of_geom_index_id")).select(
                      "variable_source_id", attr["data_source_id"], "g", attr["database_schema"], attr["table_name"]).collect())


def test_any_order_of_arrival(spark, tables, tmp_dir):
    ds, vs = tables
    want = batch_result(ds, vs)
    assert len(want) >= 3
    parts = {"s1": dict(sources=ds.where("data_source_uuid <= 4")), "s2": dict(sources=ds.where("data_source_uuid > 4")),
             "v1": dict(variables=vs.where("variable_source_id % 2 = 0")), "v2": dict(variables=vs.where("variable_source_id % 2 = 1"))}
    orders = [o for o in itertools.permutations(parts) if o[0] in ("v1", "s2")][::2]
    for n, order in enumerate(orders):
        root = os.path.join(tmp_dir, f"root{n}")
        for part in order:
            arrivals.arrive(spark, root, **parts[part])
        assert indexed(spark, root) == want, order
        # waiting for sources that never come: none of these variables
        assert arrivals.pending_variables(spark, root).count() == 0


def test_replays_and_partly_written_batches(spark, tables, tmp_dir, monkeypatch):
    ds, vs = tables
    root = os.path.join(tmp_dir, "root")
    arrivals.arrive(spark, root, ds.where("data_source_uuid <= 4"), vs)
    assert {r.variable_source_id for r in arrivals.pending_variables(spark, root).collect()} == {5, 7}
    number = current(spark, f"{root}/pending")[0]

    def broken(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:  # index rows written, pending set not
        m.setattr(arrivals, "publish", broken)
        with pytest.raises(RuntimeError):
            arrivals.arrive(spark, root, ds.where("data_source_uuid > 4"))
    assert current(spark, f"{root}/pending")[0] == number
    for _ in range(2):
        arrivals.arrive(spark, root, ds.where("data_source_uuid > 4"))
        arrivals.arrive(spark, root, ds, vs)
    assert indexed(spark, root) == batch_result(ds, vs)
    assert arrivals.pending_variables(spark, root).count() == 0
    assert spark.read.parquet(f"{root}/catalog").count() == ds.count()


def test_variables_before_any_source_and_repeated_rows(spark, tables, tmp_dir):
    ds, vs = tables
    root = os.path.join(tmp_dir, "root")
    odd = vs.limit(1).withColumn("variable_source_id", F.lit(None).cast("int"))
    arrivals.arrive(spark, root, variables=vs.unionByName(vs).unionByName(odd))
    assert arrivals.pending_variables(spark, root).count() == vs.where("geom_dependency_uuid is not null").count()
    arrivals.arrive(spark, root, sources=ds.unionByName(ds))
    assert indexed(spark, root) == batch_result(ds, vs)


def test_stream_of_both(spark, tables, tmp_dir):
    ds, vs = tables
    src, var, root, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "var", "root", "ckpt"))
    ds.limit(0).write.parquet(src)
    for part in (vs.where("variable_source_id < 5"), vs.where("variable_source_id >= 5")):
        part.write.mode("append").parquet(var)
        arrivals.start_arrivals(spark, src, var, root, ckpt, ds.schema, vs.schema).awaitTermination()
    ds.write.mode("append").parquet(src)
    arrivals.start_arrivals(spark, src, var, root, ckpt, ds.schema, vs.schema).awaitTermination()
    assert indexed(spark, root) == batch_result(ds, vs)

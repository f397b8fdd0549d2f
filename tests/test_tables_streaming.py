import os

from pyspark.sql import functions as F

from terracat.plans import catalog
from terracat.sources import tables
from terracat.streaming.refresh import index_batch, start_geom_index_refresh
from terracat.sources import read_delimited

from .fixtures import data_source_csv


def test_tables_lifecycle(spark, tmp_dir):
    name = tables.create_from_contract(spark, "domain", namespace="tc_test_vocab",
                                       location=os.path.join(tmp_dir, "domain"))
    df = spark.createDataFrame([("Place", "Place", 1)], "a string, b string, c int")  # positional
    tables.rebuild(df, name)
    tables.append_rows(df, name)
    assert spark.table(name).count() == 2
    tables.rebuild(df, name)
    assert spark.table(name).columns == ["domain_id", "domain_name", "domain_concept_id"]
    assert spark.table(name).count() == 1
    tables.drop_table(spark, name)


def test_write_clustered_orders_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clustered")
    tables.write_clustered(spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000), path, ["k"], 4)
    parts = spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(parts, parts[1:]))


def test_streaming_refresh_and_replay(spark, tmp_dir):
    ds = read_delimited(spark, data_source_csv(os.path.join(tmp_dir, "ds.csv")), "data_source")
    src, idx, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "idx", "ckpt"))
    ds.where("data_source_uuid <= 4").write.parquet(src)
    start_geom_index_refresh(spark, src, idx, ckpt, schema=ds.schema).awaitTermination()
    ds.where("data_source_uuid > 4").write.mode("append").parquet(src)
    start_geom_index_refresh(spark, src, idx, ckpt, schema=ds.schema).awaitTermination()
    got = sorted((r.data_source_id, r.geom_index_id) for r in spark.read.parquet(idx).collect())
    assert got == [(1, 1), (4, 2), (5, 3), (6, 4), (7, 5)]
    # a replayed batch adds nothing
    index_batch(ds, idx)
    assert spark.read.parquet(idx).count() == 5
    assert catalog.build_geom_index(ds).exceptAll(spark.read.parquet(idx)).count() == 0


def test_streaming_refresh_from_csv_files(spark, tmp_dir):
    """Catalog rows arriving as CSV files keep the load semantics (quoted
    JSON with commas, quotes and a newline; blank vs quoted-empty)."""
    import shutil
    src, idx, ckpt = (os.path.join(tmp_dir, n) for n in ("csv_src", "idx", "ckpt"))
    os.makedirs(src)
    data_source_csv(os.path.join(tmp_dir, "ds.csv"))
    shutil.copy(os.path.join(tmp_dir, "ds.csv"), os.path.join(src, "batch1.csv"))
    start_geom_index_refresh(spark, src, idx, ckpt, file_format="csv").awaitTermination()
    got = sorted((r.data_source_id, r.geom_index_id, r.data_type_name) for r in spark.read.parquet(idx).collect())
    assert got == [(1, 1, "polygon"), (4, 2, "point"), (5, 3, "point"), (6, 4, "polygon"), (7, 5, "polygon")]


def test_streaming_refresh_keeps_attr_index(spark, tmp_dir):
    from .fixtures import variable_source_csv
    ds = read_delimited(spark, data_source_csv(os.path.join(tmp_dir, "ds.csv")), "data_source")
    vs = read_delimited(spark, variable_source_csv(os.path.join(tmp_dir, "vs.csv")), "variable_source")
    src, idx, aidx, cat, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "gi", "ai", "cat", "ckpt"))
    kw = dict(schema=ds.schema, attr_index_path=aidx, variables=vs, catalog_path=cat)
    ds.where("data_source_uuid <= 4").write.parquet(src)
    start_geom_index_refresh(spark, src, idx, ckpt, **kw).awaitTermination()
    assert sorted((r.attr_index_id, r.variable_source_id) for r in spark.read.parquet(aidx).collect()) == [(1, 1)]
    ds.where("data_source_uuid > 4").write.mode("append").parquet(src)
    start_geom_index_refresh(spark, src, idx, ckpt, **kw).awaitTermination()
    got = sorted((r.attr_index_id, r.variable_source_id, r.attr_of_geom_index_id)
                 for r in spark.read.parquet(aidx).collect())
    assert got == [(1, 1, 1), (2, 5, 3), (3, 7, 2)]
    # a replayed batch adds nothing to either index
    from terracat.streaming.refresh import index_batch
    index_batch(ds, idx, aidx, vs, cat)
    assert spark.read.parquet(idx).count() == 5 and spark.read.parquet(aidx).count() == 3


def test_write_distributed_randomly_spreads_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "random")
    tables.write_distributed_randomly(spark.range(0, 4000).withColumn("k", F.lit(1)), path, 4)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 4000 and max(sizes) - min(sizes) <= 4   # even round robin


def test_index_batches_do_not_depend_on_batching(spark, tmp_dir):
    """Repeated rows of a source, one batch or several: the same index rows; new
    variable files are seen by later batches."""
    from terracat.plans import driver_tables as dt
    from terracat.streaming.refresh import index_batch
    from tests.conftest import SF_SMALL
    ds = dt.data_sources(spark, SF_SMALL).where("data_source_uuid <= 30")
    vs = dt.variable_rows(spark, SF_SMALL).selectExpr("l_orderkey * 10 + l_linenumber AS variable_source_id",
                                                      "data_source_uuid", "geom_dependency_uuid")
    vs = vs.dropDuplicates(["variable_source_id"])
    results = []
    for n, batches in enumerate([[ds.unionByName(ds)], [ds.where("data_source_uuid % 2 = 0"), ds, ds]]):
        at = f"{tmp_dir}/{n}"
        vs.write.parquet(at + "/vs")
        for b in batches:
            index_batch(b, at + "/gi", at + "/ai", at + "/vs", at + "/cat")
        gi, ai = spark.read.parquet(at + "/gi"), spark.read.parquet(at + "/ai")
        assert gi.count() == gi.select("geom_index_id").distinct().count() == gi.select("data_source_id").distinct().count()
        named = ai.join(gi.select(F.col("geom_index_id").alias("attr_of_geom_index_id"), F.col("data_source_id").alias("g")),
                        "attr_of_geom_index_id")
        results.append((sorted(r.data_source_id for r in gi.collect()),
                        sorted((r.variable_source_id, r.g) for r in named.collect())))
    assert results[0] == results[1] and results[0][1]


def test_batches_and_loads_leave_no_scratch(spark, tmp_dir):
    from glob import glob

    from terracat.plans import driver_tables as dt
    from terracat.plans.load import load_vocabulary_files
    from terracat.session import checkpoint_root
    from terracat.streaming.refresh import index_batch
    from tests.conftest import SF_SMALL
    from tests.fixtures import vocabulary_files
    folders = lambda: set(glob(checkpoint_root(spark).removeprefix("file://") + "/terracat-tables/*"))
    ds = dt.data_sources(spark, SF_SMALL)
    before = folders()
    for n in range(4):
        index_batch(ds.where(F.col("data_source_uuid") % 4 == n), tmp_dir + "/gi")
    vocabulary_files(tmp_dir + "/csv")
    loaded = load_vocabulary_files(spark, tmp_dir + "/csv", tmp_dir + "/out")
    assert folders() == before and loaded["concept_relationship"].count() == 12
    assert not glob(tmp_dir + "/out/vocabulary/*loaded*")

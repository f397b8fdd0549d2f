import os

from pyspark.sql import functions as F

from terracat.plans import catalog
from terracat.plans.load import load_catalog
from terracat.sources import read_delimited

from .fixtures import data_source_csv, variable_source_csv


def _catalog(spark, tmp_dir):
    ds = read_delimited(spark, data_source_csv(os.path.join(tmp_dir, "ds.csv")), "data_source")
    vs = read_delimited(spark, variable_source_csv(os.path.join(tmp_dir, "vs.csv")), "variable_source")
    return ds, vs


def test_geom_index_rows(spark, tmp_dir):
    ds, _ = _catalog(spark, tmp_dir)
    gi = {r.data_source_id: r for r in catalog.build_geom_index(ds).collect()}
    assert sorted(gi) == [1, 4, 5, 6, 7]                 # NULL and blank geometry types excluded
    assert [gi[k].geom_index_id for k in (1, 4, 5, 6, 7)] == [1, 2, 3, 4, 5]
    assert gi[1].database_schema == "us_census_tiger_line" and gi[1].table_name == "counties_2020"
    assert gi[6].table_name == "counties_2020"            # two datasets, one slug
    assert gi[4].database_schema == "epa_air_quality" and gi[4].table_name == "pm2_5_daily"
    assert gi[5].database_schema == "météo_france_données" and gi[5].table_name == "stations_été"
    assert gi[1].table_desc == "US Census TIGER/Line Counties 2020"
    assert len(gi[7].table_desc) > 255                    # reported by the length rule, not cut
    assert gi[1].data_type_name == "polygon" and gi[1].geom_type_source_value == "county"
    assert gi[1].data_type_id is None and gi[1].geom_type_concept_id is None


def test_attr_index_rows(spark, tmp_dir):
    ds, vs = _catalog(spark, tmp_dir)
    gi = catalog.build_geom_index(ds)
    ai = [tuple(r) for r in catalog.build_attr_index(ds, vs, gi).orderBy("attr_index_id").collect()]
    # vs2 NULL dependency, vs3 unindexed dependency, vs4 source without attributes,
    # vs6 NULL has_attributes: all dropped
    assert ai == [(1, 1, 1, "us_census_tiger_line", "counties_2020", 1),
                  (2, 5, 3, "météo_france_données", "stations_été", 5),
                  (3, 7, 2, "météo_france_données", "stations_été", 5)]


def test_geom_index_skips_already_indexed_and_continues_ids(spark, tmp_dir):
    ds, _ = _catalog(spark, tmp_dir)
    first = catalog.build_geom_index(ds.where(F.col("data_source_uuid") <= 4))
    added = catalog.refresh_geom_index(first, ds)
    assert [(r.data_source_id, r.geom_index_id) for r in added.orderBy("geom_index_id").collect()] == \
        [(5, 3), (6, 4), (7, 5)]
    # refreshing again adds nothing
    again = catalog.refresh_geom_index(first.unionByName(added), ds)
    assert again.count() == 0


def test_captured_column_literal_form_is_empty_when_index_not_empty(spark, tmp_dir):
    """The load script's NOT IN subquery binds to the outer row; with a
    non-empty index it rejects every row, so we build the intended anti join."""
    ds, _ = _catalog(spark, tmp_dir)
    ds.createOrReplaceTempView("t_data_source")
    catalog.build_geom_index(ds).createOrReplaceTempView("t_geom_index")
    literal = spark.sql("""SELECT * FROM t_data_source WHERE geom_type <> '' AND geom_type IS NOT NULL
                           AND data_source_uuid NOT IN (SELECT data_source_uuid FROM t_geom_index)""")
    assert literal.count() == 0


def test_load_catalog_writes_and_refreshes(spark, tmp_dir):
    ds_path = data_source_csv(os.path.join(tmp_dir, "ds.csv"))
    vs_path = variable_source_csv(os.path.join(tmp_dir, "vs.csv"))
    out = load_catalog(spark, ds_path, vs_path, os.path.join(tmp_dir, "out"))
    assert out["geom_index"].count() == 5 and out["attr_index"].count() == 3
    before = sorted(tuple(r) for r in out["attr_index"].collect())
    # re-run is idempotent
    out2 = load_catalog(spark, ds_path, vs_path, os.path.join(tmp_dir, "out"))
    assert sorted(tuple(r) for r in out2["attr_index"].collect()) == before


def test_geom_index_scan_pushdown_and_pruning(spark, tmp_dir):
    ds, _ = _catalog(spark, tmp_dir)
    path = os.path.join(tmp_dir, "ds_parquet")
    ds.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = catalog.geom_index_rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "IsNotNull(geom_type)" in pushed and "Not(EqualTo(geom_type,))" in pushed
    # 6 of the 16 catalog columns are read
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(
        ["data_source_uuid", "org_id", "org_set_id", "dataset_name", "geom_type", "boundary_type"])


def test_attr_index_refresh_numbers_after_existing(spark, tmp_dir):
    ds, vs = _catalog(spark, tmp_dir)
    gi = catalog.build_geom_index(ds)
    first = catalog.build_attr_index(ds, vs.where("variable_source_id <= 5"), gi)
    added = catalog.refresh_attr_index(first, ds, vs, gi)
    assert [(r.attr_index_id, r.variable_source_id) for r in first.orderBy("attr_index_id").collect()] == \
        [(1, 1), (2, 5)]
    assert [(r.attr_index_id, r.variable_source_id) for r in added.collect()] == [(3, 7)]


def test_check_loaded_catalog(spark, tmp_dir):
    from terracat.plans.load import check_loaded
    out = load_catalog(spark, data_source_csv(os.path.join(tmp_dir, "ds.csv")),
                       variable_source_csv(os.path.join(tmp_dir, "vs.csv")), os.path.join(tmp_dir, "out"))
    summary = {(r.table_name, r.rule, r.column_name): r.n_violations for r in check_loaded(out).collect()}
    assert summary[("geom_index", "length<=255", "table_desc")] == 1        # reported, not truncated
    assert summary[("data_source", "length<=100", "org_id")] == 1          # the 120-character org
    assert summary[("geom_index", "primary key", "geom_index_id")] == 0
    assert summary[("attr_index", "references geom_index.geom_index_id", "attr_of_geom_index_id")] == 0
    assert summary[("variable_source", "references data_source.data_source_uuid", "geom_dependency_uuid")] == 0
    assert summary[("data_source", "unique", "org_id,org_set_id,dataset_name")] == 0


def test_load_catalog_refresh_appends_new_sources(spark, tmp_dir):
    from .fixtures import DS_HEADER
    full = data_source_csv(os.path.join(tmp_dir, "ds_full.csv"))
    lines = open(full, encoding="utf-8").read().split("\n")
    # the first arrival holds sources 1-4 (row 1 spans two lines: quoted newline)
    first = os.path.join(tmp_dir, "ds_first.csv")
    with open(first, "w", encoding="utf-8") as fh:
        fh.write("\n".join([DS_HEADER] + lines[1:6]) + "\n")
    vs_path = variable_source_csv(os.path.join(tmp_dir, "vs.csv"))
    out_dir = os.path.join(tmp_dir, "out")
    a = load_catalog(spark, first, vs_path, out_dir)
    assert sorted((r.data_source_id, r.geom_index_id) for r in a["geom_index"].collect()) == [(1, 1), (4, 2)]
    b = load_catalog(spark, full, vs_path, out_dir, refresh=True)
    assert sorted((r.data_source_id, r.geom_index_id) for r in b["geom_index"].collect()) == \
        [(1, 1), (4, 2), (5, 3), (6, 4), (7, 5)]
    assert sorted((r.attr_index_id, r.variable_source_id) for r in b["attr_index"].collect()) == \
        [(1, 1), (2, 5), (3, 7)]

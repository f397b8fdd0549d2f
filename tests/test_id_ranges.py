import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from terracat.operators.id_ranges import ID_MAX, IdRanges, IdsExhausted
from terracat.plans import catalog
from terracat.plans import integrity as ic
from terracat.sources import read_delimited

from .fixtures import data_source_csv, variable_source_csv


def test_writers_at_once_share_no_unit(spark, tmp_dir):
    def writer(k):
        ids = IdRanges(spark, os.path.join(tmp_dir, "r"), unit=10)
        return [ids.reserve(n) for n in (1, 25, 10, 11)]
    with ThreadPoolExecutor(4) as pool:
        got = [u for w in pool.map(writer, range(4)) for units in w for u in units]
    assert len(got) == len(set(got)) == 4 * (1 + 3 + 1 + 2) and {u % 10 for u in got} == {1}
    assert max(got) == 10 * len(got) - 9  # no unit was skipped


def test_bounded_and_no_cycling(spark, tmp_dir):
    ids = IdRanges(spark, os.path.join(tmp_dir, "r"), unit=10, high=35)
    assert ids.reserve(0) == [] and ids.reserve(20) == [1, 11]
    with pytest.raises(IdsExhausted):
        ids.reserve(16)  # 21 to 36
    assert ids.reserve(5) == [31]  # what the failed call claimed stays unused
    with pytest.raises(IdsExhausted):
        ids.reserve(1)


def test_rows_fill_units_in_order(spark, tmp_dir):
    ids = IdRanges(spark, os.path.join(tmp_dir, "r"), unit=7)
    rows = spark.range(20).select((F.col("id") * 3).alias("k"))
    first = {r.k: r.i for r in ids.number(rows, ["k"], "i").collect()}
    assert first == {3 * k: k + 1 for k in range(20)}
    second = {r.i for r in ids.number(rows, ["k"], "i").collect()}
    assert second == set(range(22, 42)) and ids.number(rows.limit(0), ["k"], "i").count() == 0


def test_interleaved_refreshes_have_unique_ids(spark, tmp_dir):
    """Both read the same index before either writes."""
    ds = read_delimited(spark, data_source_csv(os.path.join(tmp_dir, "ds.csv")), "data_source")
    vs = read_delimited(spark, variable_source_csv(os.path.join(tmp_dir, "vs.csv")), "variable_source")
    ids, attr_ids = (IdRanges(spark, os.path.join(tmp_dir, n), unit=100) for n in ("g", "a"))
    one = catalog.reserved_geom_index(None, ds.where("data_source_uuid <= 4"), ids)
    two = catalog.reserved_geom_index(None, ds.where("data_source_uuid > 4"), ids)
    geom = one.unionByName(two)
    assert sorted((r.data_source_id, r.geom_index_id) for r in geom.collect()) == [(1, 1), (4, 2), (5, 101), (6, 102), (7, 103)]
    a = catalog.reserved_attr_index(None, ds, vs.where("variable_source_id <= 4"), geom, attr_ids)
    b = catalog.reserved_attr_index(None, ds, vs.where("variable_source_id > 4"), geom, attr_ids)
    attr = a.unionByName(b)
    assert sorted(r.attr_index_id for r in attr.collect()) == [1, 101, 102]
    again = catalog.reserved_attr_index(attr, ds, vs, geom, attr_ids)
    assert again.count() == 0
    for index, key in ((geom, "geom_index_id"), (attr, "attr_index_id")):
        assert ic.duplicate_keys(index, [key]).count() == 0
        bounds = ic.id_bounds(index, key).first()
        assert bounds.n_out_of_bounds == 0 and bounds.max_id <= ID_MAX

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from terracat.contracts import CONTRACTS
from terracat.sources import export_csv, read_delimited

from .fixtures import DATA_SOURCE_ROWS, data_source_csv, vocabulary_files, write


def test_catalog_csv_nulls_quotes_newlines(spark, tmp_dir):
    path = data_source_csv(os.path.join(tmp_dir, "data_source.csv"))
    df = read_delimited(spark, path, "data_source")
    assert df.columns == CONTRACTS["data_source"].column_names
    got = {r.data_source_uuid: r for r in df.collect()}
    assert len(got) == len(DATA_SOURCE_ROWS)
    assert got[1].geom_spec == '[{"op": "rename", "columns": {"a": "b, c"}}]\n'   # commas, quotes, newline
    assert got[2].geom_spec == ""          # quoted empty -> empty text
    assert got[3].geom_spec is None        # unquoted blank -> NULL
    assert got[2].geom_type == "" and got[1].geom_type == "polygon"
    assert got[3].has_attributes is None and got[4].has_attributes == 0
    assert got[5].org_id == "Météo-France"


def test_short_row_and_bad_number_fail(spark, tmp_dir):
    short = write(os.path.join(tmp_dir, "short.csv"), "domain_id,domain_name,domain_concept_id\nPlace,Place\n")
    with pytest.raises(Exception):
        read_delimited(spark, short, "domain_fragment").collect()
    bad = write(os.path.join(tmp_dir, "bad.csv"), "domain_id,domain_name,domain_concept_id\nPlace,Place,abc\n")
    with pytest.raises(Exception):
        read_delimited(spark, bad, "domain_fragment").collect()
    kept = read_delimited(spark, bad, "domain_fragment", mode="PERMISSIVE").collect()
    assert kept[0].domain_concept_id is None


def test_dates_bom_and_date_format(spark, tmp_dir):
    files = vocabulary_files(os.path.join(tmp_dir, "vocab"))
    v = read_delimited(spark, files["vocabulary"], "vocabulary_fragment")
    assert sorted(r.vocabulary_id for r in v.collect()) == ["GIS", "None", "SDOH"]  # BOM stripped
    c = read_delimited(spark, files["concept"], "concept_fragment")
    assert c.where(F.col("concept_id") == 2000000100).first().valid_start_date == dt.date(1970, 1, 1)
    assert c.where(F.col("concept_id") == 2000000102).first().concept_name == ""
    compact = write(os.path.join(tmp_dir, "compact.csv"),
                    "concept_id_1,concept_id_2,concept_code_1,concept_code_2,vocabulary_id_1,vocabulary_id_2,"
                    "relationship_id,valid_start_date,valid_end_date,invalid_reason\n"
                    "1,2,a,b,V,V,Is a,20200101,20991231,\n")
    with pytest.raises(Exception):
        read_delimited(spark, compact, "concept_relationship_fragment").collect()
    r = read_delimited(spark, compact, "concept_relationship_fragment", date_format="yyyyMMdd").first()
    assert r.valid_start_date == dt.date(2020, 1, 1)


def test_export_round_trip(spark, tmp_dir):
    path = data_source_csv(os.path.join(tmp_dir, "data_source.csv"))
    df = read_delimited(spark, path, "data_source")
    out = os.path.join(tmp_dir, "export")
    export_csv(df, out, single_file=True)
    back = read_delimited(spark, out, "data_source")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_quoted_empty_number_is_rejected_like_a_database_load(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "q.csv"),
                 'domain_id,domain_name,domain_concept_id\nPlace,Place,""\nX,Y,\n')
    with pytest.raises(Exception):          # '' is not an integer
        read_delimited(spark, path, "domain_fragment").collect()
    rows = read_delimited(spark, path, "domain_fragment", mode="PERMISSIVE").collect()
    assert [r.domain_concept_id for r in rows] == [None, None]


def test_columns_are_positional_header_names_ignored(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "h.csv"), "a,b,c\nPlace,Place domain,7\n")
    r = read_delimited(spark, path, "domain_fragment").first()
    assert (r.domain_id, r.domain_name, r.domain_concept_id) == ("Place", "Place domain", 7)


def test_exported_files_are_bounded(spark, tmp_dir, monkeypatch):
    """One task's rows are dealt over files that several tasks can read."""
    import os

    from terracat.sources import delimited
    monkeypatch.setattr(delimited, "FILE_ROWS", 10, raising=False)
    df = spark.range(0, 25, 1, 1).selectExpr("id AS vocabulary_concept_id")
    for single, files in ((False, 3), (True, 1)):
        delimited.export_csv(df, f"{tmp_dir}/{single}", single_file=single)
        assert len([f for f in os.listdir(f"{tmp_dir}/{single}") if f.endswith(".csv")]) == files
        assert spark.read.csv(f"{tmp_dir}/{single}", header=True).count() == 25

import os

from terracat.contracts import contracts_from_spec
from terracat.plans import integrity as ic

from .fixtures import write

SPEC = """cdmTableName,cdmFieldName,isRequired,cdmDatatype,userGuidance,etlConventions,isPrimaryKey,isForeignKey,fkTableName,fkFieldName
site,site_id,Yes,int4,,,Yes,No,,
site,site_name,Yes,varchar(10),,"free text, short",No,No,,
site,parent_id,No,int4,,,No,Yes,site,site_id
reading,reading_id,Yes,serial4,,,Yes,No,,
reading,site_id,Yes,numeric,,,No,Yes,site,site_id
reading,value,No,float8,,,No,No,,
reading,shape,No,geometry,,,No,No,,
"""


def test_contracts_from_spec(spark, tmp_dir):
    con = contracts_from_spec(spark, write(os.path.join(tmp_dir, "spec.csv"), SPEC))
    site, reading = con["site"], con["reading"]
    assert site.column_names == ["site_id", "site_name", "parent_id"]
    assert site.required == ["site_id", "site_name"] and site.bounded == [("site_name", 10)]
    assert site.primary_key == ("site_id",)
    assert [(f.columns, f.parent) for f in site.foreign_keys] == [(("parent_id",), "site")]
    assert [c.type for c in reading.columns] == ["int", "long", "double", "binary"]
    # the generated contracts drive the same integrity jobs
    s = spark.createDataFrame([(1, "a", None), (2, "b" * 11, 3)], "site_id int, site_name string, parent_id int")
    r = spark.createDataFrame([(1, 1, 1.0, None), (1, 9, None, None)],
                              "reading_id int, site_id long, value double, shape binary")
    got = {(x.table_name, x.rule, x.column_name): x.n_violations
           for x in ic.check_tables({"site": s, "reading": r}, contracts=con).collect()}
    assert got[("site", "length<=10", "site_name")] == 1
    assert got[("site", "references site.site_id", "parent_id")] == 1        # self-reference, orphan 3
    assert got[("reading", "references site.site_id", "site_id")] == 1
    assert got[("reading", "primary key", "reading_id")] == 1


def test_spec_keeps_numerics_exact_and_honours_the_table_list(spark, tmp_dir):
    from terracat.contracts import contracts_from_spec
    from terracat.plans.integrity import check_tables
    from terracat.plans.staging import conform
    head = "cdmTableName,cdmFieldName,isRequired,cdmDatatype,isPrimaryKey,isForeignKey,fkTableName,fkFieldName\n"
    with open(tmp_dir + "/fields.csv", "w") as f:
        f.write(head + "measure,id,Yes,numeric,Yes,No,,\nmeasure,amount,No,numeric,No,No,,\n"
                "measure,concept_id,No,int4,No,Yes,concept,concept_id\nother,id,Yes,int4,Yes,No,,\n")
    with open(tmp_dir + "/tables.csv", "w") as f:
        f.write("cdmTableName\nmeasure\n")
    spec = contracts_from_spec(spark, tmp_dir + "/fields.csv", tables_path=tmp_dir + "/tables.csv")
    assert set(spec) == {"measure"}
    rows = conform(spark.createDataFrame([(1, "2.75", 5)], "id int, amount string, concept_id int"), spec["measure"])
    assert rows.schema["id"].dataType.simpleString() == "bigint" and float(rows.first().amount) == 2.75
    concept = spark.createDataFrame([(4,)], "concept_id int")
    found = check_tables({"measure": rows, "concept": concept}, contracts=spec).where("table_name = 'measure'")
    assert {r.rule: r.n_violations for r in found.collect()}["references concept.concept_id"] == 1

import pytest
from pyspark.errors import PySparkException

from terracat.plans import recipes

from .conftest import rows

ROWS = "site long, data_source_uuid long, temp string, flag string, note string, variable_name string"
VARS = "variable_source_id long, data_source_uuid long, variable_name string, attr_spec string"


def staged(spark, data, variables, **kw):
    return recipes.stage_variables(spark.createDataFrame(data, ROWS), spark.createDataFrame(variables, VARS), ["site"], **kw)


DATA = [(1, 10, "20.5", "A", " Mild ", "clash"), (2, 10, None, "B", None, None), (3, 10, "n/a", None, "x", ""), (4, 20, "7", "A", "", "v"), (5, None, "1", "A", "a", "v")]


def test_each_variable_by_its_spec(spark):
    variables = [
        (100, 10, "celsius", '[{"op": "column", "name": "temp"}]'),
        (101, 10, "fahrenheit", '[{"op": "column", "name": "temp"}, {"op": "scale", "by": "1.8", "plus": 32}, {"op": "round", "digits": "1"}]'),
        (102, 10, "note", '[{"op": "present", "column": "note"}, {"op": "column", "name": "note"}, {"op": "trim"}, {"op": "lower"}]'),
        (103, 20, "grade", '[{"op": "when", "column": "flag", "equals": "A"}, {"op": "column", "name": "flag"}, {"op": "recode", "from": "A", "to": "good"}]'),
        (104, 20, "kind", '{"op": "constant", "value": "station"}'),
        (105, 20, "gone", '[{"op": "column", "name": "no such column"}, {"op": "default", "value": "0"}]'),
        (106, 10, "nothing", "{}"), (107, 10, "nothing", None), (108, None, "no source", '[{"op": "column", "name": "temp"}]')]
    got = rows(staged(spark, DATA, variables), "site", "variable_source_record_id", "attr_source_value", "value_source_value", "value_as_number", "value_as_string")
    assert got == sorted([
        (1, 100, "celsius", "20.5", 20.5, None), (2, 100, "celsius", None, None, None), (3, 100, "celsius", "n/a", None, "n/a"),
        (1, 101, "fahrenheit", "20.5", 68.9, None), (2, 101, "fahrenheit", None, None, None), (3, 101, "fahrenheit", "n/a", None, None),
        (1, 102, "note", " Mild ", None, "mild"), (3, 102, "note", "x", None, "x"),
        (4, 103, "grade", "A", None, "good"), (4, 104, "kind", "station", None, "station"), (4, 105, "gone", None, 0.0, None),
    ], key=lambda t: tuple((v is None, str(v)) for v in t))


def test_one_scan_whatever_the_number_of_variables(spark, tmp_dir):
    path = tmp_dir + "/rows"
    spark.createDataFrame(DATA, ROWS).write.parquet(path)
    for n in (2, 300):
        variables = [(k, 10 * (k % 3), f"v{k}", '[{"op": "column", "name": "temp"}, {"op": "scale", "by": "%d"}]' % k if k % 2 else '[{"op": "column", "name": "flag"}]') for k in range(n)]
        out = recipes.stage_variables(spark.read.parquet(path), spark.createDataFrame(variables, VARS), ["site"])
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert out.count() == 3 * 100 + 1 * 100


def test_wrong_specs_are_errors(spark):
    with pytest.raises(ValueError, match="unknown recipe step 'fly'"):
        staged(spark, DATA, [(1, 10, "v", '[{"op": "fly"}]')])
    for spec in ("[{", '[{"name": "temp"}]'):
        with pytest.raises(PySparkException, match="attr_spec of variable 77"):
            staged(spark, DATA, [(77, 10, "v", spec)]).collect()


def test_empty_tables(spark):
    spec = '[{"op": "column", "name": "temp"}]'
    assert staged(spark, [], [(1, 10, "v", spec)]).count() == 0 == staged(spark, DATA, []).count()
    assert staged(spark, DATA, []).columns == ["site", "data_source_uuid", "variable_source_record_id", "attr_source_value",
                                               "value_source_value", "value_as_number", "value_as_string"]

"""Attribute recipes from the catalog: every variable says in its ``attr_spec``
how its value is made from its source's rows.

A spec is a JSON list of steps ``{"op": name, ...parameters}`` (a single object
counts as one step).  There may be millions of variables but few *shapes* (the
sequence of op names): each shape is compiled once, into an expression whose
parameters are looked up in the variable's row.  All variables of all sources
are then staged by one plan that scans the rows once: rows meet their source's
variables, and the shape picks the expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parse_number

#: Shapes that one plan may hold.
MOST_SHAPES = 200

#: op -> f(value, parameter, cell): the new value; ``parameter(name)`` is the step's
#: parameter and ``cell(column)`` the row's text in a column.  Values are text.
ATTR_OPS: dict[str, Callable[[Column, Callable[[str], Column], Callable[[Column], Column]], Column]] = {}
#: op -> f(parameter, cell): whether the row has the variable at all.
ROW_OPS: dict[str, Callable[[Callable[[str], Column], Callable[[Column], Column]], Column]] = {}


def attr_op(name: str):
    def deco(fn):
        ATTR_OPS[name] = fn
        return fn
    return deco


def row_op(name: str):
    def deco(fn):
        ROW_OPS[name] = fn
        return fn
    return deco


def _number(value: Column) -> Column:
    return parse_number(value)


@attr_op("column")
def _column(value, parameter, cell):
    return cell(parameter("name"))


@attr_op("constant")
def _constant(value, parameter, cell):
    return parameter("value")


@attr_op("scale")
def _scale(value, parameter, cell):
    """Times ``by`` (1) plus ``plus`` (0); text that is no number becomes NULL."""
    by, plus = (F.coalesce(_number(parameter(p)), F.lit(d)) for p, d in (("by", 1.0), ("plus", 0.0)))
    return (_number(value) * by + plus).cast("string")


@attr_op("round")
def _round(value, parameter, cell):
    unit = F.pow(F.lit(10.0), F.coalesce(_number(parameter("digits")), F.lit(0.0)))
    return (F.floor(_number(value) * unit + 0.5) / unit).cast("string")


@attr_op("lower")
def _lower(value, parameter, cell):
    return F.lower(value)


@attr_op("trim")
def _trim(value, parameter, cell):
    return F.trim(value)


@attr_op("default")
def _default(value, parameter, cell):
    return F.coalesce(value, parameter("value"))


@attr_op("recode")
def _recode(value, parameter, cell):
    return F.when(value == parameter("from"), parameter("to")).otherwise(value)


@row_op("when")
def _when(parameter, cell):
    return F.coalesce(cell(parameter("column")) == parameter("equals"), F.lit(False))


@row_op("present")
def _present(parameter, cell):
    return cell(parameter("column")).isNotNull()


def parsed_specs(variables: DataFrame) -> DataFrame:
    """variable_source_id, data_source_uuid, variable_name, steps (array of maps)
    and shape.  A blank spec has no steps; text that is not JSON is an error
    naming the variable."""
    text = F.trim(F.coalesce("attr_spec", F.lit("")))
    text = F.when((text == "") | (text == "{}"), F.lit("[]")).when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    steps = F.from_json(text, "array<map<string,string>>")
    wrong = F.raise_error(F.concat(F.lit("attr_spec of variable "), F.col("variable_source_id").cast("string"), F.lit(" is not a list of steps")))
    steps = F.when(steps.isNull() | F.exists(steps, lambda s: s.isNull() | s["op"].isNull()), wrong.cast("array<map<string,string>>")).otherwise(steps)
    out = variables.select("variable_source_id", "data_source_uuid", "variable_name", steps.alias("steps"))
    return out.withColumn("shape", F.array_join(F.transform("steps", lambda s: s["op"]), ">"))


def _compiled(shape: str, steps: Column, cell: Callable[[Column], Column]) -> tuple[Column, Column, Column]:
    """(kept, raw text, final text) of a shape over the variable's ``steps``."""
    kept, raw, value = F.lit(True), F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, op in enumerate(shape.split(">") if shape else []):
        def parameter(name: str, at: int = at) -> Column:
            return F.try_element_at(steps[at], F.lit(name))
        if op in ROW_OPS:
            kept = kept & ROW_OPS[op](parameter, cell)
        elif op in ATTR_OPS:
            value = ATTR_OPS[op](value, parameter, cell)
            raw = value if op in ("column", "constant") else raw
        else:
            raise ValueError(f"unknown recipe step {op!r}")
    return kept, raw, value


def stage_variables(rows: DataFrame, variables: DataFrame, id_cols: list[str]) -> DataFrame:
    """Attribute rows of every variable: ``id_cols``, data_source_uuid,
    variable_source_record_id, attr_source_value (the variable's name),
    value_source_value (the source's text), value_as_number and
    value_as_string (what the recipe made of it).

    ``rows``: the rows of all sources, with data_source_uuid; ``variables``: the
    catalog's variables.  A row op that fails leaves the row out; a missing
    column or a value that a step cannot read gives NULL values.  Variables
    without steps have no rows.  Rows meet variables in an equality join on the
    source, whose skew (a source with a third of the rows) Spark splits."""
    specs = parsed_specs(variables).where("shape <> ''")
    shapes = sorted(r["shape"] for r in specs.select("shape").distinct().limit(MOST_SHAPES + 1).collect())
    if len(shapes) > MOST_SHAPES:
        raise ValueError(f"more than {MOST_SHAPES} recipe shapes; stage the sources in several runs")
    names = [c for c in rows.columns if c not in (*id_cols, "data_source_uuid")]
    cells = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]) if names else F.lit(None).cast("map<string,string>")
    wide = rows.select(*id_cols, "data_source_uuid", cells.alias("__cells"))
    met = wide.join(specs, "data_source_uuid")
    kept, raw, value = F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string")
    for shape in shapes:
        k, r, v = _compiled(shape, F.col("steps"), lambda c: F.try_element_at(F.col("__cells"), c))
        this = F.col("shape") == shape
        kept, raw, value = (F.when(this, new).otherwise(old) for new, old in ((k, kept), (r, raw), (v, value)))
    made = met.where(kept).select(*id_cols, "data_source_uuid", F.col("variable_source_id").alias("variable_source_record_id"),
                                  F.col("variable_name").alias("attr_source_value"), raw.alias("value_source_value"), value.alias("__value"))
    number = parse_number("__value")
    return made.select(*id_cols, "data_source_uuid", "variable_source_record_id", "attr_source_value", "value_source_value",
                       number.alias("value_as_number"), F.when(number.isNull(), F.col("__value")).alias("value_as_string"))

"""Registered queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name] = (spark_fn, oracle_sql_or_None)``; ``spark_fn(spark, sf_dir)``
returns a DataFrame whose column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import CONTRACTS
from .functions.columns import MINTED_ID_THRESHOLD, id_text, slug
from .operators.id_ranges import IdRanges
from .operators.ids import dense_id
from .plans import catalog
from .plans import driver_tables as dt
from .plans import integrity as ic
from .plans import staging as stg
from .plans import violations as vio
from .plans import vocabulary as voc
from .plans.catalog import schema_slug, table_slug
from .plans.appends import Appends
from .plans.recipes import stage_variables
from .plans.load import FRAGMENT_FILES, load_published, load_vocabulary_files
from .session import scratch_path
from .sources.delimited import export_csv, read_delimited
from .sources.tables import materialize, write_bucketed, write_clustered, write_interleaved
from .streaming.arrivals import start_arrivals
from .streaming.refresh import start_geom_index_refresh

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def sql_slug(expr: str) -> str:
    """DuckDB form of the identifier normaliser (RE2 has no look-ahead, so
    runs are collapsed and the edges trimmed instead)."""
    return (r"trim(regexp_replace(regexp_replace(lower(" + expr + r"), '[^\p{L}\p{N}_]', '_', 'g'),"
            r" '_+', '_', 'g'), '_')")


def _cte(**views: str) -> str:
    """A WITH clause.  The edge views are read several times: computed once."""
    once = ("edge_fragment", "turned")
    return "WITH " + ",\n".join(f"{k} AS {'MATERIALIZED ' * (k in once)}({v})" for k, v in views.items()) + "\n"


# --------------------------------------------------------------- catalog
GEOM_INDEX_SQL = f"""
SELECT CAST(row_number() OVER (ORDER BY data_source_uuid) AS BIGINT) AS geom_index_id,
       CAST(NULL AS BIGINT) AS data_type_id,
       geom_type AS data_type_name,
       CAST(NULL AS BIGINT) AS geom_type_concept_id,
       boundary_type AS geom_type_source_value,
       {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema,
       {sql_slug("concat(dataset_name)")} AS table_name,
       concat_ws(' ', org_id, org_set_id, dataset_name) AS table_desc,
       CAST(data_source_uuid AS BIGINT) AS data_source_id
FROM ds
WHERE geom_type <> '' AND geom_type IS NOT NULL
"""


@register("geom_index", _cte(ds=dt.DATA_SOURCES_SQL) + GEOM_INDEX_SQL)
def q_geom_index(spark, d):
    return catalog.build_geom_index(dt.data_sources(spark, d))


ATTR_INDEX_SQL = f"""
SELECT CAST(row_number() OVER (ORDER BY variable_source_id, attr_of_geom_index_id) AS BIGINT) AS attr_index_id, *
FROM (SELECT CAST(v.variable_source_id AS BIGINT) AS variable_source_id, g.geom_index_id AS attr_of_geom_index_id,
             s.database_schema, s.table_name, s.data_source_id
      FROM (SELECT data_source_uuid, {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema,
                   {sql_slug("concat(dataset_name)")} AS table_name, CAST(data_source_uuid AS BIGINT) AS data_source_id
            FROM ds WHERE has_attributes = 1) s, vs v, gi g
      WHERE v.data_source_uuid = s.data_source_uuid AND v.geom_dependency_uuid = g.data_source_id) rows
"""


@register("attr_index", _cte(ds=dt.DATA_SOURCES_SQL, vs=dt.VARIABLE_SOURCES_SQL, gi=GEOM_INDEX_SQL)
          + ATTR_INDEX_SQL)
def q_attr_index(spark, d):
    ds = dt.data_sources(spark, d)
    gi = catalog.build_geom_index(ds)
    vs = dt.variable_sources(spark, d, columns=["data_source_uuid", "geom_dependency_uuid"])
    return catalog.build_attr_index(ds, vs, gi)


# ------------------------------------------------------------- scalar
@register("slug_text", f"SELECT doc_id, {sql_slug('text')} AS text_slug FROM documents")
def q_slug_text(spark, d):
    return dt.table(spark, d, "documents").select("doc_id", slug("text").alias("text_slug"))


@register("dense_ids", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS variable_source_id
FROM lineitem
""")
def q_dense_ids(spark, d):
    li = dt.table(spark, d, "lineitem").select(*dt.VARIABLE_ORDER)
    return dense_id(li, dt.VARIABLE_ORDER, "variable_source_id")


# ------------------------------------------------------ vocabulary

#: label, dimension view, its columns' stem, view of the keys it held before (None: no test)
_KINDS = (("Vocabulary", "vf", "vocabulary", "ve"), ("Concept Class", "cf", "concept_class", "ce"),
          ("Domain", "df", "domain", "de"), ("Relationship", "rf", "relationship", None))


def _metadata_sql(kinds) -> str:
    """Metadata concepts: the new keys of each dimension as (label, id, name), then
    one projection that fills in what all of them share."""
    new = []
    for label, view, stem, held in kinds:
        keys = f"SELECT {stem}_id FROM {view}" + (f" EXCEPT SELECT {stem}_id FROM {held}" if held else "")
        new.append(f"SELECT '{label}' AS label, {stem}_concept_id AS id, {stem}_name AS name FROM {view} "
                   f"SEMI JOIN ({keys}) k USING ({stem}_id)")
    return ("SELECT id AS concept_id, name AS concept_name, shared.*, label AS vocabulary_id, label AS concept_class_id FROM ("
            + " UNION ALL ".join(new) + ") n, (VALUES ('Metadata', CAST(NULL AS VARCHAR), 'OMOP generated', DATE '1970-01-01', "
            "DATE '2099-12-31', CAST(NULL AS VARCHAR))) AS shared(domain_id, standard_concept, concept_code, valid_start_date, "
            "valid_end_date, invalid_reason)")


PROMOTE_SQL = _cte(
    vf=dt.VOCABULARY_FRAGMENT_SQL, ve=dt.EXISTING_VOCABULARY_SQL,
    cf=dt.CONCEPT_CLASS_FRAGMENT_SQL, ce=dt.EXISTING_CONCEPT_CLASSES_SQL,
    df=dt.DOMAIN_FRAGMENT_SQL, de=dt.EXISTING_DOMAINS_SQL,
    edge_fragment=dt.EDGE_FRAGMENT_SQL, rf=dt.RELATIONSHIP_FRAGMENT_SQL) + _metadata_sql(_KINDS)


def _metadata_fragments(spark, d):
    frags = {
        "vocabulary": dt.vocabulary_fragment(spark, d),
        "concept_class": dt.concept_class_fragment(spark, d),
        "domain": dt.domain_fragment(spark, d),
        "relationship": dt.relationship_fragment(dt.edge_labels(spark, d)),
    }
    existing = {
        "vocabulary": dt.existing_vocabulary(spark, d),
        "concept_class": dt.existing_concept_classes(spark, d),
        "domain": dt.existing_domains(spark, d),
    }
    return frags, existing


@register("promote_concepts", PROMOTE_SQL)
def q_promote_concepts(spark, d):
    frags, existing = _metadata_fragments(spark, d)
    return voc.promote_all(frags, existing)


@register("new_dimension_rows", _cte(vf=dt.VOCABULARY_FRAGMENT_SQL, ve=dt.EXISTING_VOCABULARY_SQL)
          + "SELECT * FROM vf WHERE vocabulary_id NOT IN (SELECT vocabulary_id FROM ve)")
def q_new_dimension_rows(spark, d):
    return voc.new_dimension_rows(dt.vocabulary_fragment(spark, d), dt.existing_vocabulary(spark, d),
                                  "vocabulary_id")


@register("load_concepts", _cte(cf=dt.CONCEPT_FRAGMENT_SQL) + """
SELECT concept_id, left(concept_name, 255) AS concept_name, domain_id, vocabulary_id, concept_class_id,
       standard_concept, concept_code, valid_start_date, valid_end_date, invalid_reason
FROM cf""")
def q_load_concepts(spark, d):
    return voc.load_concepts(dt.concept_fragment(spark, d))


@register("load_edges", _cte(edge_fragment=dt.EDGE_FRAGMENT_SQL) + """
SELECT concept_id_1, concept_id_2, relationship_id, valid_start_date, valid_end_date, invalid_reason
FROM edge_fragment""")
def q_load_edges(spark, d):
    return voc.load_concept_relationships(dt.edge_fragment(spark, d))


@register("load_relationships", _cte(edge_fragment=dt.EDGE_FRAGMENT_SQL, rf=dt.RELATIONSHIP_FRAGMENT_SQL)
          + "SELECT * FROM rf")
def q_load_relationships(spark, d):
    return voc.load_relationships(dt.relationship_fragment(dt.edge_labels(spark, d)))


def _reverse_views(edges: str, labels: str) -> dict[str, str]:
    """Views of the completion by its definition: every edge of a minted concept
    turned round, less those whose key is among the known edges.  The edges are
    computed once and the labels joined, so the SQL is two hash joins."""
    return {
        "turned": f"SELECT e.concept_id_2 AS concept_id_1, e.concept_id_1 AS concept_id_2, "
                  f"l.reverse_relationship_id AS relationship_id, e.valid_start_date, e.valid_end_date, e.invalid_reason "
                  f"FROM {edges} e LEFT JOIN {labels} l USING (relationship_id) WHERE e.concept_id_1 > {MINTED_ID_THRESHOLD}",
        "added": f"SELECT t.* FROM turned t ANTI JOIN {edges} k USING (concept_id_1, concept_id_2, relationship_id)",
    }


REVERSE_SQL = _cte(
    edge_fragment=dt.EDGE_FRAGMENT_SQL, rf=dt.RELATIONSHIP_FRAGMENT_SQL,
    **_reverse_views("edge_fragment", "rf")) + "SELECT * FROM added"


@register("reverse_edges", REVERSE_SQL)
def q_reverse_edges(spark, d):
    """The edges are needed twice (candidates, existing keys): written once."""
    edges = materialize(voc.load_concept_relationships(dt.edge_fragment(spark, d)), "edges")
    return voc.complete_reverse(edges, dt.relationship_fragment(dt.edge_labels(spark, d)))


@register("id_text_lookup", """
SELECT o.o_orderkey, CAST(c.c_custkey AS VARCHAR) AS customer_id_text, c.c_name
FROM orders o JOIN customer c ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)""")
def q_id_text_lookup(spark, d):
    o = dt.table(spark, d, "orders").select("o_orderkey", id_text("o_custkey").alias("k"))
    c = dt.table(spark, d, "customer").select(id_text("c_custkey").alias("customer_id_text"), "c_name")
    return o.join(c, o["k"] == c["customer_id_text"]).select("o_orderkey", "customer_id_text", "c_name")


@register("id_text_lookup_bucketed", QUERIES["id_text_lookup"][1])
def q_id_text_lookup_bucketed(spark, d):
    """The same lookup through a stored access path: customers bucketed by their id
    as text, so only the orders are shuffled."""
    c = dt.table(spark, d, "customer").select(id_text("c_custkey").alias("customer_id_text"), "c_name")
    path = scratch_path(spark, "customer_by_text")
    stored = write_bucketed(c, path.rsplit("/", 1)[-1].replace("-", "_"), "customer_id_text", 16, path)
    o = dt.table(spark, d, "orders").select("o_orderkey", id_text("o_custkey").alias("k"))
    return o.join(stored, o["k"] == stored["customer_id_text"]).select("o_orderkey", "customer_id_text", "c_name")


#: A minted part concept and a minted supplier concept.
_EITHER_END = (MINTED_ID_THRESHOLD + 1, dt.SUPPLIER_CONCEPT_BASE + 1)


@register("edges_by_either_end", _cte(edge_fragment=dt.EDGE_FRAGMENT_SQL) + f"""
SELECT concept_id_1, concept_id_2, relationship_id, valid_start_date, valid_end_date, invalid_reason
FROM edge_fragment WHERE concept_id_1 IN {_EITHER_END} OR concept_id_2 IN {_EITHER_END}""")
def q_edges_by_either_end(spark, d):
    """All edges stored in interleaved order of both ends, then looked up by either
    end: each half of the lookup reads the files whose bounds hold the ids."""
    path = scratch_path(spark, "edges_interleaved")
    write_interleaved(voc.load_concept_relationships(dt.edge_fragment(spark, d)), path, ["concept_id_1", "concept_id_2"], 64)
    edges = spark.read.parquet(path)
    first = edges.where(F.col("concept_id_1").isin(*_EITHER_END))
    second = edges.where(F.col("concept_id_2").isin(*_EITHER_END) & ~F.col("concept_id_1").isin(*_EITHER_END))
    return first.unionByName(second)


# ------------------------------------------------------------ integrity


def _column_rule_sql(view: str, table: str, rule: str, column: str, cond: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS n_violations FROM {view}")


def _required_sql(view, contract, present):
    return [_column_rule_sql(view, contract.name, "required", c, f"{c} IS NULL")
            for c in contract.required if c in present]


def _length_sql(view, contract, present):
    return [_column_rule_sql(view, contract.name, f"length<={n}", c, f"length({c}) > {n}")
            for c, n in contract.bounded if c in present]


_DS_COLUMNS = CONTRACTS["data_source"].column_names
_CONCEPT_COLUMNS = CONTRACTS["concept"].column_names


@register("check_required", _cte(ds=dt.DATA_SOURCES_SQL, cf=dt.CONCEPT_FRAGMENT_SQL)
          + "\nUNION ALL\n".join(_required_sql("ds", CONTRACTS["data_source"], _DS_COLUMNS)
                                 + _required_sql("cf", CONTRACTS["concept"], _CONCEPT_COLUMNS)))
def q_check_required(spark, d):
    return (ic.check_required(dt.data_sources(spark, d), "data_source", CONTRACTS["data_source"].required)
            .unionByName(ic.check_required(dt.concept_fragment(spark, d), "concept",
                                           CONTRACTS["concept"].required)))


@register("check_length", _cte(ds=dt.DATA_SOURCES_SQL, cf=dt.CONCEPT_FRAGMENT_SQL)
          + "\nUNION ALL\n".join(_length_sql("ds", CONTRACTS["data_source"], _DS_COLUMNS)
                                 + _length_sql("cf", CONTRACTS["concept"], _CONCEPT_COLUMNS)))
def q_check_length(spark, d):
    return (ic.check_length(dt.data_sources(spark, d), "data_source", CONTRACTS["data_source"].bounded)
            .unionByName(ic.check_length(dt.concept_fragment(spark, d), "concept",
                                         CONTRACTS["concept"].bounded)))


@register("check_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_check_key(spark, d):
    return ic.duplicate_keys(dt.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_unique_catalog", _cte(ds=dt.DATA_SOURCES_SQL) + """
SELECT org_id, org_set_id, dataset_name, count(*) AS n FROM ds
WHERE org_id IS NOT NULL AND org_set_id IS NOT NULL AND dataset_name IS NOT NULL
GROUP BY org_id, org_set_id, dataset_name HAVING count(*) > 1""")
def q_check_unique_catalog(spark, d):
    return ic.duplicate_keys(dt.data_sources(spark, d), ["org_id", "org_set_id", "dataset_name"])


@register("check_unique_slug", _cte(ds=dt.DATA_SOURCES_SQL) + f"""
SELECT database_schema, table_name, count(*) AS n FROM (
  SELECT {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema,
         {sql_slug("concat(dataset_name)")} AS table_name FROM ds) s
GROUP BY database_schema, table_name HAVING count(*) > 1""")
def q_check_unique_slug(spark, d):
    ds = dt.data_sources(spark, d).select(schema_slug().alias("database_schema"),
                                          table_slug().alias("table_name"))
    return ic.duplicate_keys(ds, ["database_schema", "table_name"])


@register("check_reference", """
SELECT doc_id, count(*) AS n FROM documents
WHERE doc_id IN (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
GROUP BY doc_id""")
def q_check_reference(spark, d):
    """Documents without a label: both whole tables."""
    return ic.orphan_keys(dt.table(spark, d, "documents"), ["doc_id"], dt.table(spark, d, "labels"), ["doc_id"])


@register("check_id_bounds", """
SELECT count(*) AS n_rows, CAST(min(id) AS BIGINT) AS min_id, CAST(max(id) AS BIGINT) AS max_id,
       count(*) FILTER (WHERE id IS NULL OR id < 1 OR id > 2147483647) AS n_out_of_bounds
FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id FROM lineitem) t""")
def q_check_id_bounds(spark, d):
    return ic.id_bounds(q_dense_ids(spark, d), "variable_source_id")


# -------------------------------------------------------------- staging

_LINE_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_EAV_SQL = "\nUNION ALL\n".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{m}' AS attr_source_value, "
    f"{m} AS value_as_number FROM lineitem" for m in _MEASURES)


@register("eav", _EAV_SQL)
def q_eav(spark, d):
    li = dt.table(spark, d, "lineitem")
    return stg.wide_to_eav(li, _LINE_IDS, _MEASURES, value_col="value_as_number")


_NUMERIC_SQL_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_PART_TEXT = {"p_size": "CAST(p_size AS VARCHAR)", "p_brand": "p_brand", "p_type": "p_type",
              "p_name": "p_name"}


@register("eav_typed", "WITH e AS (" + "\nUNION ALL\n".join(
    f"SELECT p_partkey, '{k}' AS attr_source_value, {v} AS value_source_value FROM part"
    for k, v in _PART_TEXT.items()) + f""")
SELECT p_partkey, attr_source_value, value_source_value,
       CASE WHEN regexp_matches(value_source_value, '{_NUMERIC_SQL_PATTERN}')
            THEN TRY_CAST(trim(value_source_value) AS DOUBLE) END AS value_as_number,
       CASE WHEN NOT regexp_matches(value_source_value, '{_NUMERIC_SQL_PATTERN}')
              OR TRY_CAST(trim(value_source_value) AS DOUBLE) IS NULL
            THEN value_source_value END AS value_as_string
FROM e""")
def q_eav_typed(spark, d):
    p = dt.table(spark, d, "part")
    eav = stg.wide_to_eav(p, ["p_partkey"], list(_PART_TEXT), value_col="value_source_value",
                          value_type="string")
    return stg.type_eav_values(eav)


def _line_attr(spark, d):
    """lineitem measures as attribute rows of supplier geometries."""
    li = dt.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("geom_record_id"),
        F.col("l_partkey").alias("variable_source_record_id"), *_MEASURES)
    return stg.wide_to_eav(li, ["l_orderkey", "l_linenumber", "geom_record_id", "variable_source_record_id"],
                           _MEASURES, value_col="value_as_number")


@register("eav_enriched", "WITH e AS (" + "\nUNION ALL\n".join(
    f"SELECT l_orderkey, l_linenumber, l_suppkey AS geom_record_id, l_partkey AS variable_source_record_id, "
    f"'{m}' AS attr_source_value, {m} AS value_as_number FROM lineitem" for m in _MEASURES) + """)
SELECT e.*, s.s_name AS geom_name, p.p_name AS variable_name
FROM e JOIN supplier s ON s.s_suppkey = e.geom_record_id
       JOIN part p ON p.p_partkey = e.variable_source_record_id""")
def q_eav_enriched(spark, d):
    geom = dt.table(spark, d, "supplier").select(F.col("s_suppkey").alias("geom_record_id"),
                                                 F.col("s_name").alias("geom_name"))
    var = dt.table(spark, d, "part").select(F.col("p_partkey").alias("variable_source_id"),
                                            F.col("p_name").alias("variable_name"))
    return stg.attach_geometry(_line_attr(spark, d), geom, var)


_DECODE_SQL = f"""
WITH concept AS (
  SELECT p_partkey AS concept_id, p_name AS concept_name FROM part
  UNION ALL
  SELECT {dt.SUPPLIER_CONCEPT_BASE} + s_suppkey, s_name FROM supplier),
a AS (
  SELECT l_orderkey, l_linenumber,
         l_partkey AS attr_concept_id,
         {dt.SUPPLIER_CONCEPT_BASE} + l_suppkey AS value_as_concept_id,
         CASE WHEN l_linestatus = 'O' THEN l_partkey END AS unit_concept_id,
         CASE WHEN l_returnflag = 'A' THEN {dt.SUPPLIER_CONCEPT_BASE} + l_suppkey END AS qualifier_concept_id,
         l_orderkey AS attr_source_concept_id
  FROM lineitem)
SELECT a.*, c1.concept_name AS attr_concept_id_name, c2.concept_name AS value_as_concept_id_name,
       c3.concept_name AS unit_concept_id_name, c4.concept_name AS qualifier_concept_id_name,
       c5.concept_name AS attr_source_concept_id_name
FROM a
LEFT JOIN concept c1 ON c1.concept_id = a.attr_concept_id
LEFT JOIN concept c2 ON c2.concept_id = a.value_as_concept_id
LEFT JOIN concept c3 ON c3.concept_id = a.unit_concept_id
LEFT JOIN concept c4 ON c4.concept_id = a.qualifier_concept_id
LEFT JOIN concept c5 ON c5.concept_id = a.attr_source_concept_id
"""


@register("eav_decoded", _DECODE_SQL)
def q_eav_decoded(spark, d):
    base = F.lit(dt.SUPPLIER_CONCEPT_BASE)
    concept = (dt.table(spark, d, "part").select(F.col("p_partkey").alias("concept_id"),
                                                 F.col("p_name").alias("concept_name"))
               .unionByName(dt.table(spark, d, "supplier").select(
                   (base + F.col("s_suppkey")).alias("concept_id"), F.col("s_name").alias("concept_name"))))
    a = dt.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_partkey").alias("attr_concept_id"),
        (base + F.col("l_suppkey")).alias("value_as_concept_id"),
        F.when(F.col("l_linestatus") == "O", F.col("l_partkey")).alias("unit_concept_id"),
        F.when(F.col("l_returnflag") == "A", base + F.col("l_suppkey")).alias("qualifier_concept_id"),
        F.col("l_orderkey").alias("attr_source_concept_id"))
    return stg.decode_concepts(a, concept)


VALID_ON_DATE = "1998-06-30"


@register("valid_on", f"""
SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS attr_start_date,
       CAST(l.l_shipdate AS DATE) AS attr_end_date
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE CAST(o.o_orderdate AS DATE) <= DATE '{VALID_ON_DATE}' AND DATE '{VALID_ON_DATE}' <= CAST(l.l_shipdate AS DATE)""")
def q_valid_on(spark, d):
    li = dt.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                               F.col("l_shipdate").cast("date").alias("attr_end_date"))
    o = dt.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                            F.col("o_orderdate").cast("date").alias("attr_start_date"))
    periods = li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "attr_start_date", "attr_end_date")
    return stg.valid_on(periods, VALID_ON_DATE)


def staged_events(spark, d):
    """events staged as attribute rows, one source per event type."""
    ev = dt.table(spark, d, "events").select(
        F.col("event_id").alias("attr_record_id"), F.col("user_id").alias("geom_record_id"),
        F.lit(0).alias("variable_source_record_id"),
        F.col("ts").cast("date").alias("attr_start_date"), F.col("ts").cast("date").alias("attr_end_date"),
        F.col("value").alias("value_as_number"), F.lit("value").alias("attr_source_value"),
        F.col("props").alias("value_source_value"),
        F.lit("web").alias("org_id"), F.lit("events").alias("org_set_id"),
        F.col("event_type").alias("dataset_name"))
    # event and user ids stay 64-bit (the template's int4 would overflow at scale)
    return stg.conform(stg.with_location(ev), "attr_template", keep=stg.PARTITION_COLUMNS,
                       types={"attr_record_id": "long", "geom_record_id": "long"})


STAGED_SELECTION = ("click", "purchase")


@register("staged_read", f"""
SELECT event_id AS attr_record_id, user_id AS geom_record_id, 0 AS variable_source_record_id,
       CAST(ts AS DATE) AS attr_start_date, CAST(ts AS DATE) AS attr_end_date,
       value AS value_as_number, 'value' AS attr_source_value, props AS value_source_value,
       'web_events' AS database_schema, {sql_slug("concat(event_type)")} AS table_name
FROM events
WHERE {sql_slug("concat(event_type)")} IN {STAGED_SELECTION}""")
def q_staged_read(spark, d):
    staged = staged_events(spark, d)
    path = scratch_path(spark, "staged_events")
    stg.write_staged(staged, path)
    stored = stg.read_staged(spark, path)
    index = stored.select(*stg.PARTITION_COLUMNS).distinct()
    out = stg.read_indexed(stored, index, F.col("table_name").isin(*STAGED_SELECTION))
    return out.select("attr_record_id", "geom_record_id", "variable_source_record_id", "attr_start_date",
                      "attr_end_date", "value_as_number", "attr_source_value", "value_source_value",
                      *stg.PARTITION_COLUMNS)


@register("index_refresh", _cte(ds=dt.DATA_SOURCES_SQL) + f"""
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN boundary_type IS NULL THEN 0 ELSE 1 END, data_source_uuid)
            AS BIGINT) AS geom_index_id,
       CAST(NULL AS BIGINT) AS data_type_id, geom_type AS data_type_name,
       CAST(NULL AS BIGINT) AS geom_type_concept_id, boundary_type AS geom_type_source_value,
       {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema,
       {sql_slug("concat(dataset_name)")} AS table_name,
       concat_ws(' ', org_id, org_set_id, dataset_name) AS table_desc,
       CAST(data_source_uuid AS BIGINT) AS data_source_id
FROM ds WHERE geom_type <> '' AND geom_type IS NOT NULL""")
def q_index_refresh(spark, d):
    ds = dt.data_sources(spark, d)
    first = catalog.build_geom_index(ds.where(F.col("boundary_type").isNull()))
    added = catalog.refresh_geom_index(first, ds)
    return first.unionByName(added)


@register("index_refresh_stream", QUERIES["index_refresh"][1])
def q_index_refresh_stream(spark, d):
    """The same two arrivals, fed through the streaming refresh: the first
    files are indexed by one run, the later ones by a second run that
    resumes from the stream checkpoint."""
    ds = dt.data_sources(spark, d)
    src, idx, ckpt = (scratch_path(spark, n) for n in ("ds_stream", "ds_index", "ds_stream_ckpt"))
    for arrival in (F.col("boundary_type").isNull(), F.col("boundary_type").isNotNull()):
        ds.where(arrival).write.mode("append").parquet(src)
        start_geom_index_refresh(spark, src, idx, ckpt, schema=ds.schema).awaitTermination()
    return spark.read.parquet(idx)


# ------------------------------------------- whole vocabulary: load, then validate
_VOCAB_TABLES = ("vocabulary", "concept_class", "domain", "relationship", "concept", "concept_relationship")


def loaded_vocabulary(spark, d):
    """Every driver fragment loaded into the six vocabulary tables."""
    edges = dt.edge_fragment(spark, d)
    frags = {"vocabulary": dt.vocabulary_fragment(spark, d),
             "concept_class": dt.concept_class_fragment(spark, d),
             "domain": dt.domain_fragment(spark, d),
             "relationship": dt.relationship_fragment(dt.edge_labels(spark, d)),
             "concept": dt.concept_fragment(spark, d),
             "concept_relationship": edges}
    return voc.load_vocabulary(frags)


def _vocabulary_tables_sql() -> dict[str, str]:
    """CTEs (in dependency order) for the six loaded tables ``<name>_t``."""
    promoted = _metadata_sql([(label, f"{stem}_t", stem, None) for label, _, stem, _ in _KINDS])
    columns = ", ".join(_CONCEPT_COLUMNS)
    return {
        "edge_fragment": dt.EDGE_FRAGMENT_SQL,
        "rf": dt.RELATIONSHIP_FRAGMENT_SQL,
        "vocabulary_t": dt.VOCABULARY_FRAGMENT_SQL,
        "concept_class_t": dt.CONCEPT_CLASS_FRAGMENT_SQL,
        "domain_t": dt.DOMAIN_FRAGMENT_SQL,
        "relationship_t": "SELECT * FROM rf",
        "cf": dt.CONCEPT_FRAGMENT_SQL,
        "concept_t": f"SELECT {columns} FROM ({promoted}) p" + """
UNION ALL
SELECT concept_id, left(concept_name, 255), domain_id, vocabulary_id, concept_class_id, standard_concept,
       concept_code, valid_start_date, valid_end_date, invalid_reason FROM cf""",
        **_reverse_views("edge_fragment", "rf"),
        "concept_relationship_t": "SELECT concept_id_1, concept_id_2, relationship_id, valid_start_date, valid_end_date, "
                                  "invalid_reason FROM edge_fragment UNION ALL SELECT * FROM added",
    }


def _integrity_sql(views: dict[str, str], tables: tuple[str, ...]) -> str:
    """The rule summary of ``integrity.check_tables`` as SQL over the CTEs
    ``<table>_t``, generated from the same contracts."""
    parts = []
    for t in tables:
        con = CONTRACTS[t]
        parts += _required_sql(f"{t}_t", con, con.column_names) + _length_sql(f"{t}_t", con, con.column_names)
        keys = [(con.primary_key, "primary key")] if con.primary_key else []
        keys += [(k, "unique") for k in con.unique_keys if k != con.primary_key]
        for key, rule in keys:
            cols = ", ".join(key)
            not_null = " AND ".join(f"{k} IS NOT NULL" for k in key)
            parts.append(f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{','.join(key)}' AS column_name, "
                         f"CAST(count(*) AS BIGINT) AS n_violations FROM (SELECT {cols} FROM {t}_t "
                         f"WHERE {not_null} GROUP BY {cols} HAVING count(*) > 1) d")
    for t in tables:
        for fk in CONTRACTS[t].foreign_keys:
            c, p, pc = fk.columns[0], fk.parent, fk.parent_columns[0]
            if fk.parent not in tables:
                parts.append(f"SELECT '{t}' AS table_name, 'references {p}.{pc} not checked' AS rule, "
                             f"'{c}' AS column_name, CAST(NULL AS BIGINT) AS n_violations")
                continue
            parts.append(f"SELECT '{t}' AS table_name, 'references {p}.{pc}' AS rule, '{c}' AS column_name, "
                         f"CAST(count(*) AS BIGINT) AS n_violations FROM {t}_t ch WHERE ch.{c} IS NOT NULL "
                         f"AND NOT EXISTS (SELECT 1 FROM {p}_t pa WHERE pa.{pc} = ch.{c})")
    return _cte(**views) + "\nUNION ALL\n".join(parts)


@register("vocabulary_integrity", _integrity_sql(_vocabulary_tables_sql(), _VOCAB_TABLES))
def q_vocabulary_integrity(spark, d):
    """Validate after load: the loaded tables are written once (shared
    checkpoint folder) and every rule reads the written files."""
    # the edge table is already written (edges and added reverses) by the load
    loaded = {k: (v if k == "concept_relationship" else materialize(v, f"vocab_{k}"))
              for k, v in loaded_vocabulary(spark, d).items()}
    return ic.check_tables(loaded)


# ---------------------------------------------------- files: export and load
@register("catalog_csv_roundtrip", _cte(ds=dt.DATA_SOURCES_SQL) + """
SELECT data_source_uuid, org_id, org_set_id, dataset_name, dataset_version,
       geom_type, geom_spec, boundary_type, CAST(has_attributes AS INTEGER) AS has_attributes,
       download_method, download_subtype, download_data_standard, download_filename, download_url,
       download_auth, documentation_url
FROM ds""")
def q_catalog_csv_roundtrip(spark, d):
    """The catalog conformed to its contract, exported as CSV (NULL vs empty
    text kept apart) and loaded back with the positional, typed reader."""
    path = scratch_path(spark, "data_source_csv")
    ids = {"data_source_uuid": "long"}      # part keys exceed int4 at large scale
    export_csv(stg.conform(dt.data_sources(spark, d), "data_source", types=ids), path)
    return read_delimited(spark, path, "data_source", types=ids)


@register("concepts_clustered", QUERIES["load_concepts"][1])
def q_concepts_clustered(spark, d):
    """Loaded concepts stored ordered by concept_id (range partitions, sorted
    files: min/max statistics serve key lookups) and read back."""
    path = scratch_path(spark, "concept_clustered")
    write_clustered(voc.load_concepts(dt.concept_fragment(spark, d)), path, ["concept_id"])
    return spark.read.parquet(path)


# --------------------------------------------- whole catalog: load, then validate
_CATALOG_TABLES = ("data_source", "variable_source", "geom_index", "attr_index")


@register("catalog_integrity", _integrity_sql(
    {"ds": dt.DATA_SOURCES_SQL, "data_source_t": "SELECT * FROM ds",
     "variable_source_t": dt.VARIABLE_SOURCES_SQL, "vs": "SELECT * FROM variable_source_t",
     "geom_index_t": GEOM_INDEX_SQL, "gi": "SELECT * FROM geom_index_t",
     "attr_index_t": ATTR_INDEX_SQL}, _CATALOG_TABLES))
def q_catalog_integrity(spark, d):
    """Every backbone contract rule over the catalog and both indexes
    (validate after load).  The three numbered tables already read their
    ids from files written by ``dense_id``; the catalog is a projection of
    one scan, so nothing else needs writing before the checks."""
    ds = dt.data_sources(spark, d)
    vs = dt.variable_sources(spark, d)
    gi = catalog.build_geom_index(ds)
    ai = catalog.build_attr_index(ds, vs, gi)
    return ic.check_tables({"data_source": ds, "variable_source": vs, "geom_index": gi, "attr_index": ai})


@register("index_refresh_attr", _cte(
    ds=dt.DATA_SOURCES_SQL, vs=dt.VARIABLE_SOURCES_SQL,
    gi="""SELECT data_source_uuid, boundary_type IS NULL AS first_g,
               row_number() OVER (ORDER BY boundary_type IS NOT NULL, data_source_uuid) AS geom_index_id FROM ds WHERE length(geom_type) > 0""",
    attributes=f"""SELECT data_source_uuid, boundary_type IS NULL AS first_a, {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema,
               {sql_slug("concat(dataset_name)")} AS table_name FROM ds WHERE has_attributes = 1""") + """
SELECT row_number() OVER (ORDER BY NOT (first_a AND first_g), variable_source_id) AS attr_index_id,
       CAST(variable_source_id AS BIGINT) AS variable_source_id, geom_index_id AS attr_of_geom_index_id, database_schema,
       table_name, CAST(vs.data_source_uuid AS BIGINT) AS data_source_id
FROM attributes JOIN vs USING (data_source_uuid) JOIN gi ON gi.data_source_uuid = vs.geom_dependency_uuid""")
def q_index_refresh_attr(spark, d):
    """Attribute index refreshed after new sources arrive: the first arrival
    (sources without a boundary type) is indexed, then the whole catalog;
    only variables not yet indexed are added, numbered after the first."""
    ds = dt.data_sources(spark, d)
    vs = dt.variable_sources(spark, d, columns=["data_source_uuid", "geom_dependency_uuid"])
    first_ds = ds.where(F.col("boundary_type").isNull())
    gi1 = catalog.build_geom_index(first_ds)
    ai1 = catalog.build_attr_index(first_ds, vs, gi1)
    gi = gi1.unionByName(catalog.refresh_geom_index(gi1, ds))
    return ai1.unionByName(catalog.refresh_attr_index(ai1, ds, vs, gi))


@register("index_refresh_attr_stream", QUERIES["index_refresh_attr"][1])
def q_index_refresh_attr_stream(spark, d):
    """The two arrivals of ``index_refresh_attr`` fed through the streaming
    refresh, which keeps the attribute index current next to the geom index."""
    ds = dt.data_sources(spark, d)
    vs = dt.variable_sources(spark, d, columns=["data_source_uuid", "geom_dependency_uuid"])
    src, gi, ai, cat, ckpt = (scratch_path(spark, n) for n in
                              ("ds_stream", "ds_gi", "ds_ai", "ds_catalog", "ds_stream_ckpt"))
    for arrival in (F.col("boundary_type").isNull(), F.col("boundary_type").isNotNull()):
        ds.where(arrival).write.mode("append").parquet(src)
        start_geom_index_refresh(spark, src, gi, ckpt, schema=ds.schema, attr_index_path=ai,
                                 variables=vs, catalog_path=cat).awaitTermination()
    return spark.read.parquet(ai)


_UNIT = 1 << 10


@register("index_refresh_reserved", _cte(ds=dt.DATA_SOURCES_SQL) + f"""
, rows AS (SELECT boundary_type IS NOT NULL AS later, data_source_uuid, geom_type, boundary_type,
                  {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema, {sql_slug("concat(dataset_name)")} AS table_name,
                  concat_ws(' ', org_id, org_set_id, dataset_name) AS table_desc FROM ds WHERE length(geom_type) > 0),
units AS (SELECT CAST(ceil(count(*) FILTER (WHERE NOT later) / {_UNIT}.0) AS BIGINT) AS first FROM rows)
SELECT row_number() OVER (PARTITION BY later ORDER BY data_source_uuid) + CASE WHEN later THEN first * {_UNIT} ELSE 0 END AS geom_index_id,
       CAST(NULL AS BIGINT) AS data_type_id, geom_type AS data_type_name, CAST(NULL AS BIGINT) AS geom_type_concept_id,
       boundary_type AS geom_type_source_value, database_schema, table_name, table_desc, CAST(data_source_uuid AS BIGINT) AS data_source_id
FROM rows, units""")
def q_index_refresh_reserved(spark, d):
    """Two refreshes that both start from the empty index, as if at the same time:
    each numbers its sources from a range of its own."""
    ds, ids = dt.data_sources(spark, d), IdRanges(spark, scratch_path(spark, "id_ranges"), _UNIT)
    one = catalog.reserved_geom_index(None, ds.where(F.col("boundary_type").isNull()), ids)
    two = catalog.reserved_geom_index(None, ds.where(F.col("boundary_type").isNotNull()), ids)
    return one.unionByName(two)


_RECIPES = (
    ("quantity", '[{"op": "column", "name": "l_quantity"}]'),
    ("price", '[{"op": "column", "name": "l_extendedprice"}, {"op": "scale", "by": "0.5", "plus": "1"}]'),
    ("returned discount", '[{"op": "when", "column": "l_returnflag", "equals": "R"}, {"op": "column", "name": "l_discount"}]'),
    ("status", '[{"op": "column", "name": "l_linestatus"}, {"op": "lower"}]'),
)


@register("staged_by_recipe", """
WITH v AS (SELECT s_suppkey, n, s_suppkey * 4 + n AS id FROM supplier, range(4) AS r(n) WHERE (s_suppkey + n) % 3 > 0),
e AS (SELECT l_orderkey, l_linenumber, l_suppkey AS data_source_uuid, v.id AS variable_source_record_id,
             list_value('quantity', 'price', 'returned discount', 'status')[n + 1] AS attr_source_value,
             list_value(CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR), l_linestatus)[n + 1]
                 AS value_source_value,
             CASE n WHEN 0 THEN l_quantity WHEN 1 THEN l_extendedprice * 0.5::DOUBLE + 1 WHEN 2 THEN l_discount END AS value_as_number,
             CASE n WHEN 3 THEN lower(l_linestatus) END AS value_as_string
      FROM lineitem JOIN v ON v.s_suppkey = l_suppkey WHERE n <> 2 OR l_returnflag = 'R')
SELECT * FROM e""")
def q_staged_by_recipe(spark, d):
    """Line items as the rows of one source per supplier; each source's variables
    carry recipes of their own (two or three of four kinds)."""
    n = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n")
    of = lambda k: F.element_at(F.array(*[F.lit(r[k]) for r in _RECIPES]), (F.col("n") + 1).cast("int"))
    variables = (dt.table(spark, d, "supplier").select("s_suppkey", n).where((F.col("s_suppkey") + F.col("n")) % 3 > 0)
                 .select((F.col("s_suppkey") * 4 + F.col("n")).cast("long").alias("variable_source_id"),
                         F.col("s_suppkey").alias("data_source_uuid"), of(0).alias("variable_name"), of(1).alias("attr_spec")))
    rows = dt.table(spark, d, "lineitem").withColumn("data_source_uuid", F.col("l_suppkey"))
    return stage_variables(rows, variables, ["l_orderkey", "l_linenumber"])


_LATE_STEP = """CASE WHEN sa AND ga THEN CASE WHEN variable_source_id % 2 = 0 THEN 1 ELSE 2 END ELSE 3 END"""


@register("late_variables_stream", _cte(ds=dt.DATA_SOURCES_SQL, vs=dt.VARIABLE_SOURCES_SQL) + f"""
, gi AS (SELECT row_number() OVER (ORDER BY boundary_type IS NOT NULL, data_source_uuid) AS geom_index_id,
                data_source_uuid, boundary_type IS NULL AS ga FROM ds WHERE length(geom_type) > 0),
attributes AS (SELECT data_source_uuid, boundary_type IS NULL AS sa, {sql_slug("concat(org_id, '_', org_set_id)")} AS database_schema,
                      {sql_slug("concat(dataset_name)")} AS table_name FROM ds WHERE has_attributes = 1),
complete AS (SELECT variable_source_id, geom_index_id, database_schema, table_name, vs.data_source_uuid, {_LATE_STEP} AS step
             FROM attributes JOIN vs USING (data_source_uuid) JOIN gi ON gi.data_source_uuid = vs.geom_dependency_uuid)
SELECT row_number() OVER (ORDER BY step, variable_source_id) AS attr_index_id, CAST(variable_source_id AS BIGINT) AS variable_source_id,
       geom_index_id AS attr_of_geom_index_id, database_schema, table_name, CAST(data_source_uuid AS BIGINT) AS data_source_id
FROM complete""")
def q_late_variables_stream(spark, d):
    """Sources and variables that arrive in three runs of one stream: sources
    without a boundary type with the even variables, then the odd variables, late
    for half of their sources, then the other sources.  What waited is indexed
    by the run that completes it; ids follow the runs."""
    ds = dt.data_sources(spark, d)
    vs = materialize(dt.variable_sources(spark, d, columns=["data_source_uuid", "geom_dependency_uuid"]), "late_variables")
    src, var, root, ckpt = (scratch_path(spark, n) for n in ("late_src", "late_var", "late_root", "late_ckpt"))
    early, even = F.col("boundary_type").isNull(), F.col("variable_source_id") % 2 == 0
    for run in (((ds.where(early), src), (vs.where(even), var)), ((vs.where(~even), var),), ((ds.where(~early), src),)):
        for rows, path in run:
            rows.write.mode("append").parquet(path)
        start_arrivals(spark, src, var, root, ckpt, ds.schema, vs.schema).awaitTermination()
    return spark.read.parquet(f"{root}/attr_index")


# ------------------------------------------ files: the six fragments
_FRAGMENT_VIEWS = {"vocabulary": dt.vocabulary_fragment, "concept_class": dt.concept_class_fragment,
                   "domain": dt.domain_fragment, "concept": dt.concept_fragment,
                   "concept_relationship": dt.edge_fragment}


@register("fragments_csv_roundtrip", _cte(**_vocabulary_tables_sql()) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST(count(DISTINCT {key}) AS BIGINT) AS n_keys, CAST(sum(length({text})) AS BIGINT) AS n_chars FROM {t}_t"
    for t, key, text in (("vocabulary", "vocabulary_id", "vocabulary_name"),
                         ("concept_class", "concept_class_id", "concept_class_name"),
                         ("domain", "domain_id", "domain_name"), ("relationship", "relationship_id", "relationship_name"),
                         ("concept", "concept_id", "concept_name"),
                         ("concept_relationship", "(concept_id_1, concept_id_2, relationship_id)", "relationship_id"))))
def q_fragments_csv_roundtrip(spark, d):
    """The six fragments exported as CSV and loaded by the real loader; each
    written table is summarised."""
    folder, out = scratch_path(spark, "fragments_csv"), scratch_path(spark, "fragments_out")
    frags = {k: f(spark, d) for k, f in _FRAGMENT_VIEWS.items()}
    frags["relationship"] = dt.relationship_fragment(dt.edge_labels(spark, d))
    for kind, name in FRAGMENT_FILES.items():
        export_csv(stg.conform(frags[kind], f"{kind}_fragment", strict=False), f"{folder}/{name}")
    loaded = load_vocabulary_files(spark, folder, out)
    keys = {"concept_relationship": ["concept_id_1", "concept_id_2", "relationship_id"]}
    text = {"concept_relationship": "relationship_id"}
    return reduce(DataFrame.unionByName, [df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*keys.get(t, [f"{t}_id"])).alias("n_keys"),
        F.sum(F.length(text.get(t, f"{t}_name"))).cast("long").alias("n_chars"))
        .select(F.lit(t).alias("table_name"), "n_rows", "n_keys", "n_chars") for t, df in loaded.items()])


def _export_fragments(spark, d) -> str:
    folder = scratch_path(spark, "fragments_csv")
    frags = {k: f(spark, d) for k, f in _FRAGMENT_VIEWS.items()}
    frags["relationship"] = dt.relationship_fragment(dt.edge_labels(spark, d))
    for kind, name in FRAGMENT_FILES.items():
        export_csv(stg.conform(frags[kind], f"{kind}_fragment", strict=False), f"{folder}/{name}")
    return folder


def _row_text_sql(table: str) -> str:
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in CONTRACTS[table].column_names)
    return f"SELECT '{table}' AS table_name, concat_ws('|', {cells}) AS row_text FROM {table}_t"


@register("rebuild_published", _cte(**_vocabulary_tables_sql()) + "\nUNION ALL\n".join(map(_row_text_sql, _VOCAB_TABLES)))
def q_rebuild_published(spark, d):
    """The six fragments exported as CSV, loaded and published twice: the second
    load is a full rebuild that becomes current only as a whole.  Every row of
    every current table, as text."""
    folder, root = _export_fragments(spark, d), scratch_path(spark, "published")
    for _ in range(2):
        tables = load_published(spark, folder, root, only="vocabulary", tolerate=lambda rule: True)
    texts = {t: [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in CONTRACTS[t].column_names] for t in _VOCAB_TABLES}
    return reduce(DataFrame.unionByName, [tables[t].select(F.lit(t).alias("table_name"), F.concat_ws("|", *texts[t]).alias("row_text"))
                                          for t in _VOCAB_TABLES])


@register("merged_vocabulary", _cte(vf=dt.VOCABULARY_FRAGMENT_SQL, ve=dt.EXISTING_VOCABULARY_SQL) + """
SELECT vocabulary_id, CAST(sum(old) AS BIGINT) AS n_old, CAST(sum(1 - old) AS BIGINT) AS n_new FROM (
  SELECT vocabulary_id, 1 AS old FROM ve UNION ALL
  SELECT vocabulary_id, 0 FROM vf ANTI JOIN ve USING (vocabulary_id)) t GROUP BY vocabulary_id""")
def q_merged_vocabulary(spark, d):
    """The vocabulary dimension after a load over existing rows: old rows stay,
    only new keys are added."""
    frag = dt.vocabulary_fragment(spark, d)
    old = dt.existing_vocabulary(spark, d)
    for f in frag.schema.fields:
        if f.name != "vocabulary_id":
            old = old.withColumn(f.name, F.lit(None).cast(f.dataType))
    table = voc.load_vocabulary({"vocabulary": frag}, {"vocabulary": old.select(*frag.columns)})["vocabulary"]
    return table.groupBy("vocabulary_id").agg(
        F.count_if(F.col("vocabulary_name").isNull()).alias("n_old"),
        F.count_if(F.col("vocabulary_name").isNotNull()).alias("n_new"))


# ------------------------------------- staging end to end through both indexes
_GEOM_IDS = 50


def _nation_catalog(spark, d):
    """A catalog with one source per nation (numeric dataset names) that has both
    geometries and attributes; a variable depends on another nation's geometries."""
    n = dt.table(spark, d, "nation")
    ds = n.select(F.col("n_nationkey").alias("data_source_uuid"), F.lit("geo").alias("org_id"),
                  F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("org_set_id"),
                  F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("dataset_name"),
                  F.lit("polygon").alias("geom_type"), F.lit("x").alias("boundary_type"), F.lit(1).alias("has_attributes"),
                  F.lit('[{"op": "filter", "condition": "geom_record_id >= 0"}]').alias("geom_spec"))
    vs = n.select((F.col("n_nationkey") + 1).cast("long").alias("variable_source_id"), F.col("n_name").alias("variable_name"),
                  F.col("n_nationkey").alias("data_source_uuid"),
                  F.pmod(F.col("n_nationkey") * 7, F.lit(25)).alias("geom_dependency_uuid"))
    return ds, vs


@register("staged_through_index", f"""
SELECT c.c_custkey AS attr_record_id, c.c_nationkey + 1 AS variable_source_record_id, g.geom_name,
       n.n_name AS variable_name, 'geo_r' || CAST(n.n_regionkey AS VARCHAR) AS database_schema,
       lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS table_name
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN (SELECT s_nationkey, s_suppkey % {_GEOM_IDS} AS r, min(s_name) AS geom_name FROM supplier GROUP BY 1, 2) g
  ON g.s_nationkey = (c.c_nationkey * 7) % 25 AND g.r = c.c_custkey % {_GEOM_IDS}""")
def q_staged_through_index(spark, d):
    """Geometries (suppliers) and attributes (customers) of every nation staged as
    one dataset each, then every customer attached to the geometry that its
    variable's index row points to; record ids restart in every source."""
    ds, vs = _nation_catalog(spark, d)
    gi = catalog.build_geom_index(ds)
    ai = catalog.build_attr_index(ds, vs, gi)
    place = stg.with_location(ds).select("data_source_uuid", *stg.PARTITION_COLUMNS)
    geom = (dt.table(spark, d, "supplier").groupBy("s_nationkey", (F.col("s_suppkey") % _GEOM_IDS).alias("geom_record_id"))
            .agg(F.min("s_name").alias("geom_name")).join(place, F.col("s_nationkey") == F.col("data_source_uuid"))
            .select("geom_record_id", "geom_name", *stg.PARTITION_COLUMNS))
    attr = (dt.table(spark, d, "customer").join(place, F.col("c_nationkey") == F.col("data_source_uuid"))
            .select(F.col("c_custkey").alias("attr_record_id"), (F.col("c_custkey") % _GEOM_IDS).alias("geom_record_id"),
                    (F.col("c_nationkey") + 1).cast("long").alias("variable_source_record_id"), *stg.PARTITION_COLUMNS))
    paths = [scratch_path(spark, n) for n in ("staged_geom", "staged_attr")]
    stg.write_staged(geom, paths[0])
    stg.write_staged(attr, paths[1])
    out = stg.attach_geometry(stg.read_indexed(stg.read_staged(spark, paths[1]), ai),
                              stg.read_indexed(stg.read_staged(spark, paths[0]), gi), vs,
                              sources=stg.geometry_sources(ai, gi))
    return out.select("attr_record_id", "variable_source_record_id", "geom_name", "variable_name", *stg.PARTITION_COLUMNS)


# ------------------------------------------------- every contract table
# Views for the contract tables that no other query fills: source table and
# the expression of each column (one text for both engines); columns not
# named are NULL.
_DATES = {"valid_start_date": "DATE '1970-01-01'", "valid_end_date": "DATE '2099-12-31'"}
_MORE_TABLES = {
    "attr_template": ("lineitem", {
        "attr_record_id": "l_orderkey", "geom_record_id": "l_suppkey", "variable_source_record_id": "l_linenumber",
        "attr_concept_id": "l_partkey", "attr_start_date": "CAST(l_shipdate AS DATE)",
        "attr_end_date": "CAST(l_shipdate AS DATE)", "value_as_number": "l_quantity", "value_as_concept_id": "l_suppkey",
        "unit_concept_id": "CASE WHEN l_linestatus = 'O' THEN l_partkey END", "qualifier_concept_id": "l_orderkey",
        "attr_source_concept_id": "CASE WHEN l_returnflag = 'A' THEN l_orderkey END", "attr_source_value": "l_returnflag",
        "value_source_value": "CASE WHEN l_linestatus = 'F' THEN l_returnflag END"}),
    "geom_template": ("supplier", {
        "geom_record_id": "s_suppkey", "geom_name": "s_name", "geom_source_coding": "'code'", "geom_source_value": "s_name",
        "geom_local_epsg": "CASE WHEN s_acctbal > 0 THEN 4326 END"}),
    "concept_synonym": ("part", {"concept_id": "p_partkey", "concept_synonym_name": "p_name", "language_concept_id": "p_size"}),
    "concept_ancestor": ("orders", {
        "ancestor_concept_id": "o_custkey", "descendant_concept_id": "o_orderkey", "min_levels_of_separation": "0"}),
    "source_to_concept_map": ("customer", {
        "source_code": "c_name", "source_concept_id": "0", "source_vocabulary_id": "'CUST' || CAST(c_custkey AS STRING)",
        "target_concept_id": "c_nationkey", "target_vocabulary_id": "c_mktsegment", **_DATES}),
    "drug_strength": ("lineitem", {
        "drug_concept_id": "l_partkey", "ingredient_concept_id": "l_suppkey", "amount_value": "l_quantity",
        "amount_unit_concept_id": "l_linenumber", "numerator_unit_concept_id": "l_orderkey", **_DATES}),
}


def _more_tables_sql() -> dict[str, str]:
    return {f"{t}_t": "SELECT " + ", ".join(f"{exprs.get(c, 'NULL')} AS {c}" for c in CONTRACTS[t].column_names)
            + f" FROM {source}" for t, (source, exprs) in _MORE_TABLES.items()}


_ALL_TABLES = (*_VOCAB_TABLES, *_CATALOG_TABLES, *_MORE_TABLES)


def _all_tables_sql() -> dict[str, str]:
    return {**_vocabulary_tables_sql(), "ds": dt.DATA_SOURCES_SQL, "data_source_t": "SELECT * FROM ds",
            "variable_source_t": dt.VARIABLE_SOURCES_SQL, "vs": "SELECT * FROM variable_source_t",
            "geom_index_t": GEOM_INDEX_SQL, "gi": "SELECT * FROM geom_index_t", "attr_index_t": ATTR_INDEX_SQL,
            **_more_tables_sql()}


def _all_tables(spark, d):
    tables = {k: (v if k == "concept_relationship" else materialize(v, f"vocab_{k}"))
              for k, v in loaded_vocabulary(spark, d).items()}
    ds = dt.data_sources(spark, d)
    vs = dt.variable_sources(spark, d)
    gi = catalog.build_geom_index(ds)
    tables |= {"data_source": ds, "variable_source": vs, "geom_index": gi,
               "attr_index": catalog.build_attr_index(ds, vs, gi)}
    for name, (source, exprs) in _MORE_TABLES.items():
        shaped = dt.table(spark, d, source).selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])
        ids = {c.name: "long" for c in CONTRACTS[name].columns if c.type == "int"}  # keys exceed int4 at scale
        tables[name] = stg.conform(shaped, name, strict=False, types=ids)
    return tables


@register("full_integrity", _integrity_sql(_all_tables_sql(), _ALL_TABLES))
def q_full_integrity(spark, d):
    """Every rule of all 16 contract tables, with all 37 foreign keys."""
    return ic.check_tables(_all_tables(spark, d))


def _key_sql(columns: tuple[str, ...]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) or "''"


def _violating_sql(views: dict[str, str], tables: tuple[str, ...]) -> str:
    """The broken rows of every rule, rule by rule, from the contracts."""
    parts = []

    def part(t: str, rule: str, column: str, key: str, where: str, having: str = "count(*) > 0") -> None:
        parts.append(f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, {key} AS key, "
                     f"CAST(count(*) AS BIGINT) AS n FROM {t}_t ch WHERE {where} GROUP BY ALL HAVING {having}")
    for t in tables:
        con = CONTRACTS[t]
        own = _key_sql(con.primary_key or ())
        for c in con.required:
            part(t, "required", c, own, f"{c} IS NULL")
        for c, n in con.bounded:
            part(t, f"length<={n}", c, own, f"length({c}) > {n}")
        for key in dict.fromkeys([*([con.primary_key] if con.primary_key else []), *con.unique_keys]):
            part(t, "primary key" if key == con.primary_key else "unique", ",".join(key), _key_sql(key),
                 " AND ".join(f"{k} IS NOT NULL" for k in key), "count(*) > 1")
        for fk in con.foreign_keys:
            c, p, pc = fk.columns[0], fk.parent, fk.parent_columns[0]
            if p in tables:
                part(t, f"references {p}.{pc}", c, f"CAST(ch.{c} AS VARCHAR)",
                     f"ch.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p}_t pa WHERE pa.{pc} = ch.{c})")
    return _cte(**views) + "\nUNION ALL\n".join(parts)


@register("violating_rows", _violating_sql(_all_tables_sql(), _ALL_TABLES))
def q_violating_rows(spark, d):
    """The rows behind every broken rule of all 16 contract tables."""
    return vio.violating_rows(_all_tables(spark, d))


_DELTA_TABLES = (*_VOCAB_TABLES, "concept_synonym", "concept_ancestor", "source_to_concept_map")


def _delta_views() -> dict[str, str]:
    views = {**_vocabulary_tables_sql(), **{k: v for k, v in _more_tables_sql().items() if k.removesuffix("_t") in _DELTA_TABLES}}
    return views


@register("integrity_delta", _violating_sql(_delta_views(), _DELTA_TABLES))
def q_integrity_delta(spark, d):
    """Nine tables that arrive in three appends, each judged by its own rows and
    the stored keys; rows of a table and its references go to different
    appends.  The open violations equal a full check of all rows."""
    tables = {k: (v if k == "concept_relationship" else materialize(v, f"vocab_{k}"))
              for k, v in loaded_vocabulary(spark, d).items()}
    for name in _DELTA_TABLES:
        if name in _MORE_TABLES:
            source, exprs = _MORE_TABLES[name]
            shaped = dt.table(spark, d, source).selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])
            ids = {c.name: "long" for c in CONTRACTS[name].columns if c.type == "int"}
            tables[name] = stg.conform(shaped, name, strict=False, types=ids)
    state = Appends(spark, scratch_path(spark, "delta_state"), {k: v.columns for k, v in tables.items()})
    for arrival in range(3):
        of = lambda df: F.pmod(F.xxhash64(*df.columns), F.lit(3))
        state.append(f"arrival {arrival}", {k: df.where(of(df) == arrival) for k, df in tables.items()})
    return state.open_violations()

"""Catalog- and vocabulary-shaped views over the driver's Parquet tables.

Every view reads whole tables; each is given twice, as a DataFrame and as an
SQL CTE body, so that the DuckDB oracles describe exactly the same input.

* data sources   <- part      (one catalog row per part)
* variables      <- lineitem  (one variable per line item)
* edge fragment  <- lineitem  (part -> supplier edges, some pre-reversed)
* relationship   <- the labels used by the edge fragment
* vocabulary / concept class / domain fragments <- customer / supplier / part
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MINTED_ID_THRESHOLD, date_lit, typed_null
from ..operators.ids import dense_id

SUPPLIER_CONCEPT_BASE = 2_100_000_000

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- data_source
def data_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("data_source_uuid"),
        F.col("p_brand").alias("org_id"),
        F.col("p_type").alias("org_set_id"),
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("dataset_name"),
        F.concat(F.lit("v"), F.col("p_size").cast("string")).alias("dataset_version"),
        F.when(F.col("p_type") == "ECONOMY", typed_null("string"))
         .when(F.col("p_type") == "SMALL", F.lit(""))
         .when(F.col("p_type") == "PROMO", F.lit("point"))
         .otherwise(F.lit("polygon")).alias("geom_type"),
        typed_null("string").alias("geom_spec"),
        F.when(F.col("p_size") > 25, F.lit("county")).alias("boundary_type"),
        F.when(F.col("p_size") <= 5, typed_null("int"))
         .when(F.col("p_size") <= 35, F.lit(1)).otherwise(F.lit(0)).alias("has_attributes"),
        F.lit("file").alias("download_method"),
        F.lit("zip").alias("download_subtype"),
        F.lit("shp").alias("download_data_standard"),
        F.concat(F.col("p_name"), F.lit(".zip")).alias("download_filename"),
        F.concat(F.lit("https://data.example/"), F.col("p_partkey").cast("string")).alias("download_url"),
        typed_null("string").alias("download_auth"),
        typed_null("string").alias("documentation_url"),
    )


DATA_SOURCES_SQL = """
SELECT p_partkey AS data_source_uuid,
       p_brand AS org_id,
       p_type AS org_set_id,
       p_name || ' ' || CAST(p_size AS VARCHAR) AS dataset_name,
       'v' || CAST(p_size AS VARCHAR) AS dataset_version,
       CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'SMALL' THEN ''
            WHEN p_type = 'PROMO' THEN 'point' ELSE 'polygon' END AS geom_type,
       CAST(NULL AS VARCHAR) AS geom_spec,
       CASE WHEN p_size > 25 THEN 'county' END AS boundary_type,
       CASE WHEN p_size <= 5 THEN NULL WHEN p_size <= 35 THEN 1 ELSE 0 END AS has_attributes,
       'file' AS download_method, 'zip' AS download_subtype, 'shp' AS download_data_standard,
       p_name || '.zip' AS download_filename,
       'https://data.example/' || CAST(p_partkey AS VARCHAR) AS download_url,
       CAST(NULL AS VARCHAR) AS download_auth,
       CAST(NULL AS VARCHAR) AS documentation_url
FROM part
"""

# ------------------------------------------------------------ variable_source
VARIABLE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def variable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables before their serial id is assigned (keeps the line keys)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *VARIABLE_ORDER,
        F.when(F.col("l_returnflag") == "N", typed_null("long"))
         .otherwise(F.col("l_suppkey")).alias("geom_dependency_uuid"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("variable_name"),
        F.concat(F.lit("status "), F.col("l_linestatus")).alias("variable_desc"),
        F.col("l_partkey").alias("data_source_uuid"),
        F.lit("{}").alias("attr_spec"),
    )


def variable_sources(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """variable_source with its serial id (dense, in line-key order);
    ``columns`` narrows what is numbered and materialised."""
    rows = variable_rows(spark, sf_dir)
    if columns:
        rows = rows.select(*dict.fromkeys([*VARIABLE_ORDER, *columns]))
    return dense_id(rows, VARIABLE_ORDER, "variable_source_id")


VARIABLE_SOURCES_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_suppkey END AS geom_dependency_uuid,
       'line_' || CAST(l_linenumber AS VARCHAR) AS variable_name,
       'status ' || l_linestatus AS variable_desc,
       l_partkey AS data_source_uuid,
       '{}' AS attr_spec,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS variable_source_id
FROM lineitem
"""

# ------------------------------------------------------- relationship labels
# label -> (name, hierarchical, defines ancestry, reverse label, concept id offset)
RELATIONSHIP_LABELS = {
    "Is a": ("Is a", "1", "1", "Subsumes", 1),
    "Mapped from": ("Mapped from", "0", "0", "Maps to", 2),
    "Maps to": ("Maps to", "0", "0", "Mapped from", 3),
    "Subsumes": ("Subsumes", "1", "1", "Is a", 4),
}
RELATIONSHIP_CONCEPT_BASE = 2_140_000_000


def _label_expr(line_status: str) -> F.Column:
    return F.when(F.col(line_status) == "F", F.lit("Is a")).otherwise(F.lit("Maps to"))


def _reverse_label_expr(label: F.Column) -> F.Column:
    expr = None
    for k, v in RELATIONSHIP_LABELS.items():
        expr = (F.when(label == k, F.lit(v[3])) if expr is None
                else expr.when(label == k, F.lit(v[3])))
    return expr


def edge_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-column concept_relationship fragment derived from every line item.

    forward: (2e9 + part, supplier concept, 'Is a' | 'Maps to'); the supplier
    concept is the plain supplier key for return flag 'N' (a standard concept)
    and a minted id otherwise.  Return flag 'A' lines, and 'N' lines with
    status 'O', also carry the already-reversed edge.
    """
    li = table(spark, sf_dir, "lineitem")
    # An edge is fixed by (part, supplier, standard-supplier flag, line
    # status); reduce the line items to those narrow keys first (map-side
    # partial aggregation), recording whether any of them carries the
    # reversed edge, then derive the text columns.  This gives the same set
    # as a DISTINCT over the ten wide columns, at a fraction of the shuffle.
    keyed = li.groupBy(
        "l_partkey", "l_suppkey", (F.col("l_returnflag") == "N").alias("std_b"), "l_linestatus",
    ).agg(F.max((F.col("l_returnflag") == "A")
                | ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))).alias("pre_reversed"))
    c1 = (F.lit(MINTED_ID_THRESHOLD) + F.col("l_partkey")).cast("long")
    c2 = F.when(F.col("std_b"), F.col("l_suppkey")) \
          .otherwise(F.lit(SUPPLIER_CONCEPT_BASE) + F.col("l_suppkey")).cast("long")
    base = keyed.select(
        c1.alias("a"), c2.alias("b"),
        F.col("l_partkey").cast("string").alias("code_a"),
        F.col("l_suppkey").cast("string").alias("code_b"),
        _label_expr("l_linestatus").alias("rel"), "pre_reversed")
    # both directions from the one aggregate: forward rows start at a part,
    # reversed rows at a supplier, so they are never equal
    fwd = F.struct(
        F.col("a").alias("concept_id_1"), F.col("b").alias("concept_id_2"),
        F.col("code_a").alias("concept_code_1"), F.col("code_b").alias("concept_code_2"),
        F.lit("Part").alias("vocabulary_id_1"), F.lit("Supplier").alias("vocabulary_id_2"),
        F.col("rel").alias("relationship_id"))
    rev = F.struct(
        F.col("b").alias("concept_id_1"), F.col("a").alias("concept_id_2"),
        F.col("code_b").alias("concept_code_1"), F.col("code_a").alias("concept_code_2"),
        F.lit("Supplier").alias("vocabulary_id_1"), F.lit("Part").alias("vocabulary_id_2"),
        _reverse_label_expr(F.col("rel")).alias("relationship_id"))
    return (base.select(F.explode(F.array(fwd, F.when(F.col("pre_reversed"), rev))).alias("e"))
            .where(F.col("e").isNotNull()).select("e.*")
            .withColumn("valid_start_date", date_lit("1970-01-01"))
            .withColumn("valid_end_date", date_lit("2099-12-31"))
            .withColumn("invalid_reason", typed_null("string")))


EDGE_FRAGMENT_SQL = f"""
WITH base AS (
  SELECT CAST({MINTED_ID_THRESHOLD} + l_partkey AS BIGINT) AS a,
         CAST(CASE WHEN l_returnflag = 'N' THEN l_suppkey ELSE {SUPPLIER_CONCEPT_BASE} + l_suppkey END AS BIGINT) AS b,
         CAST(l_partkey AS VARCHAR) AS code_a, CAST(l_suppkey AS VARCHAR) AS code_b,
         CASE WHEN l_linestatus = 'F' THEN 'Is a' ELSE 'Maps to' END AS rel,
         (l_returnflag = 'A') OR (l_returnflag = 'N' AND l_linestatus = 'O') AS pre_reversed
  FROM lineitem),
both_dirs AS (
  SELECT a AS concept_id_1, b AS concept_id_2, code_a AS concept_code_1, code_b AS concept_code_2,
         'Part' AS vocabulary_id_1, 'Supplier' AS vocabulary_id_2, rel AS relationship_id FROM base
  UNION
  SELECT b, a, code_b, code_a, 'Supplier', 'Part',
         CASE rel WHEN 'Is a' THEN 'Subsumes' WHEN 'Subsumes' THEN 'Is a'
                  WHEN 'Maps to' THEN 'Mapped from' WHEN 'Mapped from' THEN 'Maps to' END
  FROM base WHERE pre_reversed)
SELECT *, DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CAST(NULL AS VARCHAR) AS invalid_reason
FROM both_dirs
"""


def edge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relationship labels the edge fragment uses, straight from the
    line items (two columns read, reduced map-side): the same label set as
    ``edge_fragment(..).select("relationship_id")`` without building edges."""
    li = table(spark, sf_dir, "lineitem")
    pre_reversed = (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
    label = _label_expr("l_linestatus")
    both = F.array(label, F.when(pre_reversed, _reverse_label_expr(label)))
    return (li.select(F.explode(both).alias("relationship_id"))
            .where(F.col("relationship_id").isNotNull()).distinct())


def relationship_fragment(edges: DataFrame) -> DataFrame:
    """relationship rows for every label the edges use, plus their reverses
    (the distinct runs with map-side partial aggregation: a handful of rows
    leave each task)."""
    own = F.col("relationship_id")
    labels = edges.select(F.explode(F.array(own, _reverse_label_expr(own))).alias("l")).distinct()
    expr_name = expr_h = expr_d = expr_r = expr_id = None
    for k, (name, h, d, r, off) in RELATIONSHIP_LABELS.items():
        cond = F.col("l") == k
        expr_name = F.when(cond, name) if expr_name is None else expr_name.when(cond, name)
        expr_h = F.when(cond, h) if expr_h is None else expr_h.when(cond, h)
        expr_d = F.when(cond, d) if expr_d is None else expr_d.when(cond, d)
        expr_r = F.when(cond, r) if expr_r is None else expr_r.when(cond, r)
        expr_id = F.when(cond, off) if expr_id is None else expr_id.when(cond, off)
    return labels.select(
        F.col("l").alias("relationship_id"), expr_name.alias("relationship_name"),
        expr_h.alias("is_hierarchical"), expr_d.alias("defines_ancestry"),
        expr_r.alias("reverse_relationship_id"),
        (F.lit(RELATIONSHIP_CONCEPT_BASE) + expr_id).cast("long").alias("relationship_concept_id"))


RELATIONSHIP_FRAGMENT_SQL = f"""
WITH lab AS (
  SELECT relationship_id AS l FROM edge_fragment
  UNION
  SELECT CASE relationship_id WHEN 'Is a' THEN 'Subsumes' WHEN 'Subsumes' THEN 'Is a'
              WHEN 'Maps to' THEN 'Mapped from' WHEN 'Mapped from' THEN 'Maps to' END FROM edge_fragment)
SELECT l AS relationship_id, l AS relationship_name,
       CASE WHEN l IN ('Is a', 'Subsumes') THEN '1' ELSE '0' END AS is_hierarchical,
       CASE WHEN l IN ('Is a', 'Subsumes') THEN '1' ELSE '0' END AS defines_ancestry,
       CASE l WHEN 'Is a' THEN 'Subsumes' WHEN 'Subsumes' THEN 'Is a'
              WHEN 'Maps to' THEN 'Mapped from' WHEN 'Mapped from' THEN 'Maps to' END AS reverse_relationship_id,
       CAST({RELATIONSHIP_CONCEPT_BASE} + CASE l WHEN 'Is a' THEN 1 WHEN 'Mapped from' THEN 2
                                               WHEN 'Maps to' THEN 3 WHEN 'Subsumes' THEN 4 END
            AS BIGINT) AS relationship_concept_id
FROM lab
"""


# ------------------------------------------------- metadata dimension fragments
VOCABULARY_CONCEPT_BASE = 2_000_000_000
CLASS_CONCEPT_BASE = 2_050_000_000
DOMAIN_CONCEPT_BASE = 2_060_000_000


def vocabulary_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("vocabulary_id"),
        F.col("c_name").alias("vocabulary_name"),
        F.col("c_mktsegment").alias("vocabulary_reference"),
        F.col("c_nationkey").cast("string").alias("vocabulary_version"),
        (F.lit(VOCABULARY_CONCEPT_BASE) + F.col("c_custkey")).cast("long").alias("vocabulary_concept_id"))


VOCABULARY_FRAGMENT_SQL = f"""
SELECT 'CUST' || CAST(c_custkey AS VARCHAR) AS vocabulary_id, c_name AS vocabulary_name,
       c_mktsegment AS vocabulary_reference, CAST(c_nationkey AS VARCHAR) AS vocabulary_version,
       CAST({VOCABULARY_CONCEPT_BASE} + c_custkey AS BIGINT) AS vocabulary_concept_id
FROM customer
"""


def existing_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary rows already loaded: customers with an urgent order."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")).alias("vocabulary_id")).distinct()


EXISTING_VOCABULARY_SQL = """
SELECT DISTINCT 'CUST' || CAST(o_custkey AS VARCHAR) AS vocabulary_id
FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def concept_class_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("SUPP"), F.col("s_suppkey").cast("string")).alias("concept_class_id"),
        F.col("s_name").alias("concept_class_name"),
        (F.lit(CLASS_CONCEPT_BASE) + F.col("s_suppkey")).cast("long").alias("concept_class_concept_id"))


CONCEPT_CLASS_FRAGMENT_SQL = f"""
SELECT 'SUPP' || CAST(s_suppkey AS VARCHAR) AS concept_class_id, s_name AS concept_class_name,
       CAST({CLASS_CONCEPT_BASE} + s_suppkey AS BIGINT) AS concept_class_concept_id
FROM supplier
"""


def existing_concept_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0)
    return s.select(F.concat(F.lit("SUPP"), F.col("s_suppkey").cast("string")).alias("concept_class_id"))


EXISTING_CONCEPT_CLASSES_SQL = """
SELECT 'SUPP' || CAST(s_suppkey AS VARCHAR) AS concept_class_id FROM supplier WHERE s_acctbal < 0
"""


def domain_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("PART"), F.col("p_partkey").cast("string")).alias("domain_id"),
        F.col("p_name").alias("domain_name"),
        (F.lit(DOMAIN_CONCEPT_BASE) + F.col("p_partkey")).cast("long").alias("domain_concept_id"))


DOMAIN_FRAGMENT_SQL = f"""
SELECT 'PART' || CAST(p_partkey AS VARCHAR) AS domain_id, p_name AS domain_name,
       CAST({DOMAIN_CONCEPT_BASE} + p_partkey AS BIGINT) AS domain_concept_id
FROM part
"""


def existing_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").where(F.col("p_size") < 5)
    return p.select(F.concat(F.lit("PART"), F.col("p_partkey").cast("string")).alias("domain_id"))


EXISTING_DOMAINS_SQL = """
SELECT 'PART' || CAST(p_partkey AS VARCHAR) AS domain_id FROM part WHERE p_size < 5
"""


# ------------------------------------------------------------ concept fragment
def concept_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-column concept fragment: one concept per document (whole text as
    the name; the load step cuts it)."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("concept_id"),
        F.col("text").alias("concept_name"),
        F.col("lang").alias("domain_id"),
        F.col("source").alias("vocabulary_id"),
        F.lit("Document").alias("concept_class_id"),
        F.when(F.col("n_chars") > 1000, F.lit("S")).alias("standard_concept"),
        F.col("doc_id").cast("string").alias("concept_code"),
        date_lit("1970-01-01").alias("valid_start_date"),
        date_lit("2099-12-31").alias("valid_end_date"),
        typed_null("string").alias("invalid_reason"))


CONCEPT_FRAGMENT_SQL = """
SELECT doc_id AS concept_id, text AS concept_name, lang AS domain_id, source AS vocabulary_id,
       'Document' AS concept_class_id,
       CASE WHEN n_chars > 1000 THEN 'S' END AS standard_concept,
       CAST(doc_id AS VARCHAR) AS concept_code,
       DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CAST(NULL AS VARCHAR) AS invalid_reason
FROM documents
"""

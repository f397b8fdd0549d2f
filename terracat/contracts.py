"""Table contracts: column order, Spark type, required flag, length bound,
primary keys, unique keys and foreign keys of the catalog and vocabulary
tables.  A contract gives a ``StructType`` for readers and the rule list the
integrity jobs check (Parquet tables do not enforce NOT NULL or keys).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str            # Spark SQL type name
    required: bool
    max_len: int | None  # varchar(n) bound; None = unbounded text


@dataclass(frozen=True)
class Contract:
    name: str
    namespace: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    unique_keys: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple["ForeignKey", ...] = field(default=())

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")

    def schema(self, all_nullable: bool = True) -> T.StructType:
        """StructType for readers; nullable everywhere by default because
        NOT NULL is checked by a job, not trusted to the reader."""
        return T.StructType([
            T.StructField(c.name, _spark_type(c.type), True if all_nullable else not c.required)
            for c in self.columns
        ])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def bounded(self) -> list[tuple[str, int]]:
        return [(c.name, c.max_len) for c in self.columns if c.max_len]


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
    "decimal": T.DecimalType(38, 18),
}


def _spark_type(name: str) -> T.DataType:
    return _TYPES[name]


def spark_type(name: str) -> T.DataType:
    """Spark type for a contract type name (int, long, double, string, date,
    binary, decimal)."""
    return _TYPES[name]


def _parse(spec: str) -> tuple[Column, ...]:
    """Rows of ``name type [!] [n]``: ``!`` marks a required column and a
    trailing number is the varchar bound."""
    cols = []
    for line in spec.strip().splitlines():
        parts = line.split()
        name, typ = parts[0], parts[1]
        required = "!" in parts[2:]
        bound = next((int(p) for p in parts[2:] if p.isdigit()), None)
        cols.append(Column(name, typ, required, bound))
    return tuple(cols)


# ---------------------------------------------------------------------------
# The declared columns of every table, in declaration order.
# Types: int4/serial4 -> int, numeric ids -> long, numeric measures ->
# decimal, float8 -> double, varchar/text -> string, geometry -> binary (WKB).
# "!" = NOT NULL, a number = varchar(n).

_BACKBONE = {
    "data_source": """
        data_source_uuid int !
        org_id string ! 100
        org_set_id string ! 100
        dataset_name string ! 100
        dataset_version string ! 100
        geom_type string 100
        geom_spec string
        boundary_type string 100
        has_attributes int
        download_method string ! 100
        download_subtype string ! 100
        download_data_standard string ! 100
        download_filename string ! 100
        download_url string ! 255
        download_auth string 100
        documentation_url string 255
    """,
    "variable_source": """
        variable_source_id int !
        geom_dependency_uuid int
        variable_name string !
        variable_desc string !
        data_source_uuid int !
        attr_spec string !
    """,
    "attr_index": """
        attr_index_id long !
        variable_source_id long !
        attr_of_geom_index_id long !
        database_schema string ! 255
        table_name string ! 255
        data_source_id long !
    """,
    "geom_index": """
        geom_index_id long !
        data_type_id long
        data_type_name string ! 255
        geom_type_concept_id long
        geom_type_source_value string 255
        database_schema string ! 255
        table_name string ! 255
        table_desc string ! 255
        data_source_id long !
    """,
    "attr_template": """
        attr_record_id int !
        geom_record_id int !
        variable_source_record_id int !
        attr_concept_id int
        attr_start_date date !
        attr_end_date date !
        value_as_number double
        value_as_string string
        value_as_concept_id int
        unit_concept_id int
        unit_source_value string
        qualifier_concept_id int
        qualifier_source_value string
        attr_source_concept_id int
        attr_source_value string !
        value_source_value string !
    """,
    "geom_template": """
        geom_record_id int !
        geom_name string !
        geom_source_coding string !
        geom_source_value string !
        geom_wgs84 binary
        geom_local_epsg int !
        geom_local_value binary !
    """,
}

_VOCABULARY = {
    "concept": """
        concept_id int !
        concept_name string ! 255
        domain_id string ! 20
        vocabulary_id string ! 20
        concept_class_id string ! 20
        standard_concept string 1
        concept_code string ! 50
        valid_start_date date !
        valid_end_date date !
        invalid_reason string 1
    """,
    "vocabulary": """
        vocabulary_id string ! 20
        vocabulary_name string ! 255
        vocabulary_reference string 255
        vocabulary_version string 255
        vocabulary_concept_id int !
    """,
    "domain": """
        domain_id string ! 20
        domain_name string ! 255
        domain_concept_id int !
    """,
    "concept_class": """
        concept_class_id string ! 20
        concept_class_name string ! 255
        concept_class_concept_id int !
    """,
    "concept_relationship": """
        concept_id_1 int !
        concept_id_2 int !
        relationship_id string ! 20
        valid_start_date date !
        valid_end_date date !
        invalid_reason string 1
    """,
    "relationship": """
        relationship_id string ! 20
        relationship_name string ! 255
        is_hierarchical string ! 1
        defines_ancestry string ! 1
        reverse_relationship_id string ! 20
        relationship_concept_id int !
    """,
    "concept_synonym": """
        concept_id int !
        concept_synonym_name string ! 1000
        language_concept_id int !
    """,
    "concept_ancestor": """
        ancestor_concept_id int !
        descendant_concept_id int !
        min_levels_of_separation int !
        max_levels_of_separation int !
    """,
    "source_to_concept_map": """
        source_code string ! 50
        source_concept_id int !
        source_vocabulary_id string ! 20
        source_code_description string 255
        target_concept_id int !
        target_vocabulary_id string ! 20
        valid_start_date date !
        valid_end_date date !
        invalid_reason string 1
    """,
    "drug_strength": """
        drug_concept_id int !
        ingredient_concept_id int !
        amount_value decimal
        amount_unit_concept_id int
        numerator_value decimal
        numerator_unit_concept_id int
        denominator_value decimal
        denominator_unit_concept_id int
        box_size int
        valid_start_date date !
        valid_end_date date !
        invalid_reason string 1
    """,
}

# Load-time shapes of the six vocabulary fragment files.
_FRAGMENTS = {
    "vocabulary_fragment": """
        vocabulary_id string ! 20
        vocabulary_name string 255
        vocabulary_reference string 255
        vocabulary_version string 255
        vocabulary_concept_id int
    """,
    "concept_class_fragment": """
        concept_class_id string ! 20
        concept_class_name string 255
        concept_class_concept_id int
    """,
    "domain_fragment": """
        domain_id string ! 20
        domain_name string 255
        domain_concept_id int
    """,
    "concept_fragment": """
        concept_id int
        concept_name string
        domain_id string
        vocabulary_id string
        concept_class_id string
        standard_concept string
        concept_code string
        valid_start_date date
        valid_end_date date
        invalid_reason string
    """,
    "relationship_fragment": """
        relationship_id string ! 20
        relationship_name string 255
        is_hierarchical string 1
        defines_ancestry string 1
        reverse_relationship_id string 20
        relationship_concept_id int
    """,
    "concept_relationship_fragment": """
        concept_id_1 int
        concept_id_2 int
        concept_code_1 string
        concept_code_2 string
        vocabulary_id_1 string
        vocabulary_id_2 string
        relationship_id string
        valid_start_date date
        valid_end_date date
        invalid_reason string
    """,
}

_PRIMARY_KEYS = {
    "data_source": ("data_source_uuid",),
    "variable_source": ("variable_source_id",),
    "attr_index": ("attr_index_id",),
    "geom_index": ("geom_index_id",),
    "attr_template": ("attr_record_id",),
    "geom_template": ("geom_record_id",),
    "concept": ("concept_id",),
    "vocabulary": ("vocabulary_id",),
    "domain": ("domain_id",),
    "concept_class": ("concept_class_id",),
    "concept_relationship": ("concept_id_1", "concept_id_2", "relationship_id"),
    "relationship": ("relationship_id",),
    "concept_ancestor": ("ancestor_concept_id", "descendant_concept_id"),
    "source_to_concept_map": ("source_vocabulary_id", "target_concept_id", "source_code", "valid_end_date"),
    "drug_strength": ("drug_concept_id", "ingredient_concept_id"),
}

_UNIQUE_KEYS = {
    "concept": (("concept_id",),),
    "vocabulary": (("vocabulary_id",),),
    "domain": (("domain_id",),),
    "concept_class": (("concept_class_id",),),
    "relationship": (("relationship_id",),),
    # catalog row validity: one row per (organisation, set, dataset name)
    "data_source": (("org_id", "org_set_id", "dataset_name"),),
}

# (child table, child column, parent table, parent column)
_FOREIGN_KEYS = """
variable_source geom_dependency_uuid data_source data_source_uuid
variable_source data_source_uuid data_source data_source_uuid
attr_index variable_source_id variable_source variable_source_id
attr_index attr_of_geom_index_id geom_index geom_index_id
attr_index data_source_id data_source data_source_uuid
geom_index geom_type_concept_id concept concept_id
geom_index data_source_id data_source data_source_uuid
attr_template geom_record_id geom_template geom_record_id
attr_template variable_source_record_id variable_source variable_source_id
attr_template attr_concept_id concept concept_id
attr_template value_as_concept_id concept concept_id
attr_template unit_concept_id concept concept_id
attr_template qualifier_concept_id concept concept_id
attr_template attr_source_concept_id concept concept_id
concept domain_id domain domain_id
concept concept_class_id concept_class concept_class_id
concept vocabulary_id vocabulary vocabulary_id
vocabulary vocabulary_concept_id concept concept_id
domain domain_concept_id concept concept_id
concept_class concept_class_concept_id concept concept_id
concept_relationship concept_id_1 concept concept_id
concept_relationship concept_id_2 concept concept_id
concept_relationship relationship_id relationship relationship_id
relationship relationship_concept_id concept concept_id
relationship reverse_relationship_id relationship relationship_id
concept_synonym concept_id concept concept_id
concept_synonym language_concept_id concept concept_id
concept_ancestor ancestor_concept_id concept concept_id
concept_ancestor descendant_concept_id concept concept_id
source_to_concept_map source_vocabulary_id vocabulary vocabulary_id
source_to_concept_map target_vocabulary_id vocabulary vocabulary_id
source_to_concept_map target_concept_id concept concept_id
drug_strength drug_concept_id concept concept_id
drug_strength ingredient_concept_id concept concept_id
drug_strength amount_unit_concept_id concept concept_id
drug_strength numerator_unit_concept_id concept concept_id
drug_strength denominator_unit_concept_id concept concept_id
"""
# ---------------------------------------------------------------------------


def _foreign_keys() -> dict[str, tuple[ForeignKey, ...]]:
    out: dict[str, list[ForeignKey]] = {}
    for line in _FOREIGN_KEYS.strip().splitlines():
        child, col, parent, pcol = line.split()
        fk = ForeignKey(f"fk_{child}_{col}", child, (col,), parent, (pcol,))
        out.setdefault(child, []).append(fk)
    return {k: tuple(v) for k, v in out.items()}


def _build() -> dict[str, Contract]:
    fks = _foreign_keys()
    out = {}
    for ns, specs in (("backbone", _BACKBONE), ("vocabulary", _VOCABULARY), ("vocabulary", _FRAGMENTS)):
        for name, spec in specs.items():
            out[name] = Contract(
                name=name, namespace=ns, columns=_parse(spec),
                primary_key=_PRIMARY_KEYS.get(name, ()),
                unique_keys=_UNIQUE_KEYS.get(name, ()),
                foreign_keys=fks.get(name, ()),
            )
    return out


CONTRACTS: dict[str, Contract] = _build()
BACKBONE_TABLES = tuple(_BACKBONE)
VOCABULARY_TABLES = tuple(_VOCABULARY)
FRAGMENT_TABLES = tuple(_FRAGMENTS)


def contract(name: str) -> Contract:
    return CONTRACTS[name]


# Spec type names (as written in field-level spec files) -> contract types.
_SPEC_TYPES = {"int4": "int", "integer": "int", "serial4": "int", "int8": "long", "bigint": "long",
               "numeric": "decimal", "float8": "double", "double precision": "double", "text": "string",
               "varchar": "string", "date": "date", "geometry": "binary"}


def _spec_type(raw: str) -> tuple[str, int | None]:
    t = raw.strip().lower()
    if t.startswith("varchar(") and t.endswith(")"):
        return "string", int(t[len("varchar("):-1])
    return _SPEC_TYPES[t], None


def contracts_from_spec(spark, path: str, namespace: str = "backbone", tables_path: str | None = None
                        ) -> dict[str, Contract]:
    """Contracts from a field-level spec CSV with columns ``cdmTableName,
    cdmFieldName, isRequired, cdmDatatype, isPrimaryKey, isForeignKey,
    fkTableName, fkFieldName`` (header names matter here).  The spec is
    metadata (one row per column), so it is collected to the driver.
    NUMERIC columns stay exact (decimal), but for keys, which are long.
    ``tables_path`` names a table-level spec CSV (column ``cdmTableName``): only the
    tables it lists get a contract."""
    listed = None
    if tables_path is not None:
        listed = {r[0].strip() for r in spark.read.option("header", True).option("quote", '"').option("escape", '"')
                  .option("multiLine", True).csv(tables_path).select("cdmTableName").collect() if r[0]}
    rows = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path)
            .select("cdmTableName", "cdmFieldName", "isRequired", "cdmDatatype", "isPrimaryKey",
                    "isForeignKey", "fkTableName", "fkFieldName")
            .collect())
    cols: dict[str, list[Column]] = {}
    pks: dict[str, list[str]] = {}
    fks: dict[str, list[ForeignKey]] = {}
    for r in rows:
        table, name = r.cdmTableName.strip(), r.cdmFieldName.strip()
        if listed is not None and table not in listed:
            continue
        typ, bound = _spec_type(r.cdmDatatype)
        key = (r.isPrimaryKey or "").strip() == "Yes" or (r.isForeignKey or "").strip() == "Yes"
        typ = "long" if typ == "decimal" and key else typ
        cols.setdefault(table, []).append(Column(name, typ, (r.isRequired or "").strip() == "Yes", bound))
        if (r.isPrimaryKey or "").strip() == "Yes":
            pks.setdefault(table, []).append(name)
        if (r.isForeignKey or "").strip() == "Yes" and r.fkTableName:
            fks.setdefault(table, []).append(ForeignKey(f"fk_{table}_{name}", table, (name,),
                                                        r.fkTableName.strip(), (r.fkFieldName.strip(),)))
    return {t: Contract(t, namespace, tuple(c), tuple(pks.get(t, ())), (), tuple(fks.get(t, ())))
            for t, c in cols.items()}

"""End-to-end jobs from files to tables (the two entry points of the load
script): catalog files -> indexes, and vocabulary fragments -> vocabulary
tables, each followed by the integrity checks of the written tables.

Tables are written as Parquet under ``out_dir/<namespace>/<table>``; every
write overwrites, so a re-run reproduces the same tables.  Tables that a
later step reads (the geom index, the edge table) are read back from the
written files, which cuts lineage and keeps ids stable.

``load_published`` does the same into a new version of the tables and makes it
current only after it passed the audit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from ..session import scratch_scope
from ..sources.delimited import read_delimited, read_fragment
from ..sources.published import current, publish, read_published
from ..sources.tables import ensure_namespace, materialize, read_if_exists, write_clustered
from . import catalog, integrity
from . import vocabulary as voc

# ---------------------------------------------------------------------------
# The file names of the six vocabulary fragments.
FRAGMENT_FILES = {
    "vocabulary": "gis_vocabulary_fragment.csv",
    "concept_class": "gis_concept_class_fragment.csv",
    "domain": "gis_domain_fragment.csv",
    "concept": "gis_concept_fragment.csv",
    "relationship": "gis_relationship_fragment.csv",
    "concept_relationship": "gis_concept_relationship_fragment.csv",
}
# ---------------------------------------------------------------------------
# access keys each table is clustered by when written
CLUSTER_KEYS = {
    "concept": ["concept_id"], "vocabulary": ["vocabulary_id"], "domain": ["domain_id"],
    "concept_class": ["concept_class_id"], "relationship": ["relationship_id"],
    "concept_relationship": ["concept_id_1", "concept_id_2", "relationship_id"],
    "geom_index": ["geom_index_id"], "attr_index": ["attr_index_id"],
    "data_source": ["data_source_uuid"], "variable_source": ["variable_source_id"],
}


def _path(out_dir: str, namespace: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{namespace}/{name}"


def _write_and_reload(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    write_clustered(df, path, keys)
    return spark.read.parquet(path)


def load_catalog(spark: SparkSession, data_source_path: str, variable_source_path: str, out_dir: str,
                 refresh: bool = False, previous: dict[str, DataFrame] | None = None, **csv_options) -> dict[str, DataFrame]:
    """Catalog files -> data_source, variable_source, geom_index, attr_index.

    ``refresh=False`` rebuilds both indexes.  ``refresh=True`` keeps the
    indexes already in ``out_dir`` and appends rows for sources and
    variables that are not indexed yet, numbered after the largest
    existing ids (the catalog files hold the whole current catalog).  With
    ``previous`` (tables stored elsewhere) their indexes are continued: old and
    added rows are written to ``out_dir``."""
    ds = read_delimited(spark, data_source_path, "data_source", **csv_options)
    vs = read_delimited(spark, variable_source_path, "variable_source", **csv_options)
    out = {"data_source": _write_and_reload(spark, ds, _path(out_dir, "backbone", "data_source"),
                                            CLUSTER_KEYS["data_source"]),
           "variable_source": _write_and_reload(spark, vs, _path(out_dir, "backbone", "variable_source"),
                                                CLUSTER_KEYS["variable_source"])}
    gi_path, ai_path = _path(out_dir, "backbone", "geom_index"), _path(out_dir, "backbone", "attr_index")
    if previous and "geom_index" in previous:
        gi, ai = previous["geom_index"], previous["attr_index"]
        gi = gi.unionByName(catalog.refresh_geom_index(gi, out["data_source"]))
        out["geom_index"] = _write_and_reload(spark, gi, gi_path, CLUSTER_KEYS["geom_index"])
        ai = ai.unionByName(catalog.refresh_attr_index(ai, out["data_source"], out["variable_source"], out["geom_index"]))
        out["attr_index"] = _write_and_reload(spark, ai, ai_path, CLUSTER_KEYS["attr_index"])
        return out
    old_gi = read_if_exists(spark, gi_path) if refresh else None
    old_ai = read_if_exists(spark, ai_path) if refresh else None
    if old_gi is None:
        gi = catalog.build_geom_index(out["data_source"])
        out["geom_index"] = _write_and_reload(spark, gi, gi_path, CLUSTER_KEYS["geom_index"])
    else:
        # appending next to the files being read is safe (nothing is replaced)
        catalog.refresh_geom_index(old_gi, out["data_source"]).write.mode("append").parquet(gi_path)
        out["geom_index"] = spark.read.parquet(gi_path)
    if old_ai is None:
        ai = catalog.build_attr_index(out["data_source"], out["variable_source"], out["geom_index"])
        out["attr_index"] = _write_and_reload(spark, ai, ai_path, CLUSTER_KEYS["attr_index"])
    else:
        catalog.refresh_attr_index(old_ai, out["data_source"], out["variable_source"],
                                   out["geom_index"]).write.mode("append").parquet(ai_path)
        out["attr_index"] = spark.read.parquet(ai_path)
    return out


def load_vocabulary_files(spark: SparkSession, fragment_dir: str, out_dir: str,
                          existing: dict[str, DataFrame] | None = None, optional: tuple[str, ...] = (),
                          **csv_options) -> dict[str, DataFrame]:
    """Six fragment files -> vocabulary tables (reverse edges completed).

    Spark resolves the paths, so any file system it reads will do.  A missing
    file is an error, raised before anything is written, unless its kind is
    named in ``optional``."""
    frags = {}
    for kind, name in FRAGMENT_FILES.items():
        try:
            frags[kind] = read_fragment(spark, f"{fragment_dir.rstrip('/')}/{name}", kind, **csv_options)
        except AnalysisException as exc:
            if kind not in optional or "PATH_NOT_FOUND" not in str(exc):
                raise
    with scratch_scope(spark):  # the edges written for the reverse completion, and the copies below
        # every file is parsed once: the dimensions are read again for their concepts, and
        # a clustered write reads its rows twice (borders of the ranges, rows)
        frags = {kind: materialize(df, f"fragment_{kind}") if kind in voc.METADATA_KINDS else df for kind, df in frags.items()}
        tables = voc.load_vocabulary(frags, existing)
        # the existing rows may be those of out_dir: no plan may read files that
        # another table's write replaces, so all are written aside first
        aside = tables if existing else [name for name in ("concept",) if name in tables]
        tables |= {name: materialize(tables[name], f"vocab_{name}") for name in aside}
        return {name: _write_and_reload(spark, df, _path(out_dir, "vocabulary", name), CLUSTER_KEYS[name])
                for name, df in tables.items()}


def audit(tables: dict[str, DataFrame], tolerate: Callable[[Row], bool] | None = None) -> list[Row]:
    """The broken rules of the tables (a row per rule); raises IntegrityError on
    those that ``tolerate`` does not accept (None: on every one)."""
    bad = integrity.check_tables(tables).where("n_violations > 0").collect()  # bounded by the rules
    refused = [r for r in bad if tolerate is None or not tolerate(r)]
    if refused:
        raise integrity.IntegrityError("; ".join(f"{r.table_name}.{r.column_name} {r.rule}: {r.n_violations}" for r in refused))
    return bad


def load_published(spark: SparkSession, csv_dir: str, root: str, only: str | None = None, refresh: bool = False,
                   tolerate: Callable[[Row], bool] | None = None, **csv_options) -> dict[str, DataFrame]:
    """Load the files into a new version of the tables under ``root``, audit all of
    it, and only then make it current (``sources.published``).  A missing or
    unreadable file, a bad row in any of them or a broken rule (that
    ``tolerate`` does not accept) raises and leaves the current version, every
    table of it, as it was.  ``only`` is "catalog" or "vocabulary"; the tables of
    the other group are carried over and audited with the new ones.
    ``refresh`` continues the current version's tables."""
    folder_of = csv_dir.rstrip("/")

    def write(folder: str) -> dict[str, str]:
        old = read_published(spark, root) if refresh else {}
        loaded = {}
        if only != "vocabulary":
            loaded["backbone"] = load_catalog(spark, f"{folder_of}/data_source.csv", f"{folder_of}/variable_source.csv",
                                              folder, previous=old, **csv_options)
        if only != "catalog":
            existing = {k: v for k, v in old.items() if k in FRAGMENT_FILES} or None
            loaded["vocabulary"] = load_vocabulary_files(spark, csv_dir, folder, existing, **csv_options)
        return {name: _path(folder, group, name) for group, tables in loaded.items() for name in tables}
    return publish(spark, root, write, audit=lambda tables: audit(tables, tolerate))


def point_tables(spark: SparkSession, root: str, namespace: str) -> list[str]:
    """Let the metastore tables ``namespace.<name>`` read the current version:
    created where absent, else their location is switched."""
    ensure_namespace(spark, namespace)
    names = []
    for name, path in current(spark, root)[1].items():
        table = f"`{namespace}`.`{name}`"
        if spark.catalog.tableExists(f"{namespace}.{name}"):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(f"{namespace}.{name}")
        else:
            spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
        names.append(f"{namespace}.{name}")
    return names


def check_loaded(tables: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Integrity summary of loaded tables (validate after load)."""
    return integrity.check_tables(tables, strict=strict)

"""Index refresh for sources and variables that arrive in any order.

The state under one folder: ``catalog`` (sources seen, appended), ``geom_index``
and ``attr_index`` (appended), and ``pending``: the variables that still wait
for a data source or for the geometries they depend on.  Each batch indexes its
new sources, then offers to the attribute index its new variables and those
pending ones whose source or dependency has just arrived.  The work follows the
batch and the pending set, not all variables ever seen.

A variable leaves the pending set when it is indexed or can no longer be: its
dependency is NULL, its source is known to have no attributes, or the source it
depends on is known to have no geometry.

Replays: sources, index rows and pending rows are checked against what is
stored before they are added, and the pending set is published as a whole, so a
batch that was written in part adds only the rest when it runs again.  The
index of all arrivals holds the same variables whatever their order; ids count
the rows in the order they became complete.

Several rows of one source or variable in a batch count once (the smallest by
all columns); across batches the first one counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import anti_join
from ..plans.catalog import build_attr_index, build_geom_index, next_id
from ..session import scratch_scope
from ..sources.published import current, prune, publish
from ..sources.tables import materialize, read_if_exists

PENDING_COLUMNS = ["variable_source_id", "data_source_uuid", "geom_dependency_uuid"]


def _first_rows(rows: DataFrame, key: str) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("__row"))
            .select(key, "__row.*").select(*rows.columns))


def pending_variables(spark: SparkSession, root: str) -> DataFrame | None:
    paths = current(spark, f"{root}/pending")[1]
    return spark.read.parquet(paths["pending"]) if paths else None


def add_sources(spark: SparkSession, batch: DataFrame, root: str) -> DataFrame:
    """Keep and index the batch's new sources; returns the batch's source ids."""
    batch = _first_rows(batch, "data_source_uuid")
    seen = read_if_exists(spark, f"{root}/catalog")
    fresh = materialize(batch if seen is None else anti_join(batch, seen, "data_source_uuid"), "arrived_sources")
    # index first: a batch that fails between the two writes offers its sources again
    build_geom_index(fresh, existing=read_if_exists(spark, f"{root}/geom_index")).write.mode("append").parquet(f"{root}/geom_index")
    fresh.write.mode("append").parquet(f"{root}/catalog")
    return batch.select(F.col("data_source_uuid").cast("long").alias("__source"))


def add_variables(spark: SparkSession, batch: DataFrame | None, arrived: DataFrame | None, root: str) -> None:
    """Offer the batch's new variables, and the pending ones that wait for one of
    the ``arrived`` sources, to the attribute index; store who still waits."""
    sources, geom_index = (read_if_exists(spark, f"{root}/{t}") for t in ("catalog", "geom_index"))
    attr = read_if_exists(spark, f"{root}/attr_index")
    waiting = pending_variables(spark, root)
    offers = []
    if batch is not None:
        fresh = _first_rows(batch.select(*[F.col(c).cast("long").alias(c) for c in PENDING_COLUMNS]), "variable_source_id")
        for known in (attr, waiting):
            if known is not None:
                fresh = anti_join(fresh, known, "variable_source_id")
        offers.append(fresh)
    if waiting is not None and arrived is not None:
        keys = F.explode(F.array_distinct(F.array("data_source_uuid", "geom_dependency_uuid"))).alias("__key")
        offers.append(waiting.select(*PENDING_COLUMNS, keys).join(arrived, F.col("__key") == F.col("__source"), "left_semi")
                      .drop("__key").distinct())
    if not offers:
        return
    offered = materialize(reduce(DataFrame.unionByName, offers), "offered_variables")
    done = None
    if sources is not None:
        able = offered if attr is None else anti_join(offered, attr, "variable_source_id")
        added = build_attr_index(sources, able, geom_index)
        start = 1 if attr is None else next_id(attr, "attr_index_id")
        added.withColumn("attr_index_id", F.col("attr_index_id") + F.lit(start - 1)).write.mode("append").parquet(f"{root}/attr_index")
        done = spark.read.parquet(f"{root}/attr_index").select("variable_source_id")
    still = _still_waiting(offered, sources)
    if done is not None:
        still = anti_join(still, done, "variable_source_id")
    untouched = None if waiting is None else anti_join(waiting, offered, "variable_source_id")
    rows = still if untouched is None else untouched.unionByName(still)

    def write(folder: str) -> dict[str, str]:
        rows.select(*PENDING_COLUMNS).write.parquet(f"{folder}/pending")
        return {"pending": f"{folder}/pending"}
    publish(spark, f"{root}/pending", write)
    prune(spark, f"{root}/pending")


def _still_waiting(variables: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Variables that a later arrival can still complete."""
    open_ = variables.where(F.col("geom_dependency_uuid").isNotNull() & F.col("data_source_uuid").isNotNull())
    if sources is None:
        return open_
    key = F.col("data_source_uuid").cast("long")
    useless = sources.where(F.coalesce(F.col("has_attributes") != 1, F.lit(True))).select(key.alias("key"))
    shapeless = sources.where(F.coalesce(F.col("geom_type") == "", F.lit(True))).select(key.alias("key"))
    return anti_join(anti_join(open_, useless, "data_source_uuid", "key"), shapeless, "geom_dependency_uuid", "key")


def arrive(spark: SparkSession, root: str, sources: DataFrame | None = None, variables: DataFrame | None = None) -> None:
    """One batch: sources, variables, or both."""
    root = root.rstrip("/")
    with scratch_scope(spark):
        arrived = None if sources is None else add_sources(spark, sources, root)
        add_variables(spark, variables, arrived, root)


def start_arrivals(spark: SparkSession, source_dir: str, variable_dir: str, root: str, checkpoint_location: str,
                   source_schema: T.StructType, variable_schema: T.StructType, files_per_batch: int | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Watch a folder of source files and one of variable files (Parquet) and keep
    both indexes under ``root`` complete.  One query reads both streams, so one
    checkpoint holds the progress of both."""
    def stream(folder: str, schema: T.StructType, kind: str, other: str, other_schema: T.StructType) -> DataFrame:
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        rows = reader.parquet(folder)
        return rows.select(F.struct(*rows.columns).alias(kind), F.lit(None).cast(other_schema).alias(other))
    both = stream(source_dir, source_schema, "source", "variable", variable_schema).unionByName(
        stream(variable_dir, variable_schema, "variable", "source", source_schema))

    def each(batch: DataFrame, epoch_id: int) -> None:
        def part(kind: str) -> DataFrame | None:
            rows = batch.where(F.col(kind).isNotNull()).select(f"{kind}.*")
            return rows if rows.limit(1).count() else None
        arrive(batch.sparkSession, root, part("source"), part("variable"))
    writer = both.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

"""Streaming form of the index refresh: catalog rows arriving as files are
indexed batch by batch (``foreachBatch``), each batch numbered after the
largest id already written.

No state store, watermark or window is needed: the index table itself is
the state.  Each micro-batch anti-joins its sources against the index, so a
batch replayed after a failure (written but not yet committed by the
checkpoint) adds nothing the second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import CONTRACTS
from ..operators.relational import anti_join
from ..plans.catalog import build_attr_index, build_geom_index, refresh_attr_index
from ..sources.delimited import csv_options
from ..session import scratch_scope
from ..sources.tables import read_if_exists


def index_batch(batch: DataFrame, index_path: str, attr_index_path: str | None = None,
                variables: DataFrame | str | None = None, catalog_path: str | None = None) -> None:
    """Append geom index rows for the not-yet-indexed sources of one batch.

    With ``attr_index_path``, ``variables`` and ``catalog_path`` the batch's
    catalog rows are also kept (``catalog_path``, sources not seen before)
    and the attribute index is refreshed: variables not yet indexed whose source
    or geometry dependency is in the batch are added, numbered after the existing ids.
    ``variables`` is a path or a frame; a path is read again in every batch, so
    files that arrived since are seen (a variable that arrives after both its
    sources is indexed with the next batch that holds one of them).

    Of several rows of one source the smallest (by all columns, in order) counts, so
    the result does not depend on how the files were batched, as long as rows
    of one source arrive together or an earlier batch held it."""
    spark = batch.sparkSession
    with scratch_scope(spark):
        _index_batch(spark, batch, index_path, attr_index_path, variables, catalog_path)


def _index_batch(spark: SparkSession, batch: DataFrame, index_path: str, attr_index_path: str | None,
                 variables: DataFrame | str | None, catalog_path: str | None) -> None:
    first = F.min(F.struct(*[c for c in batch.columns if c != "data_source_uuid"])).alias("__row")
    batch = batch.groupBy("data_source_uuid").agg(first).select("data_source_uuid", "__row.*").select(*batch.columns)
    existing = read_if_exists(spark, index_path)
    rows = build_geom_index(batch, existing=existing)
    rows.write.mode("append").parquet(index_path)
    if attr_index_path is None or variables is None or catalog_path is None:
        return
    seen = read_if_exists(spark, catalog_path)
    new_sources = batch if seen is None else anti_join(batch, seen, "data_source_uuid")
    new_sources.write.mode("append").parquet(catalog_path)
    sources = spark.read.parquet(catalog_path)
    geom_index = spark.read.parquet(index_path)
    attr = read_if_exists(spark, attr_index_path)
    if isinstance(variables, str):
        variables = spark.read.parquet(variables)
    # work in proportion to the batch: only variables that touch its sources
    touched = batch.select(F.col("data_source_uuid").cast("long").alias("__source"))
    variables = _touching(variables, touched)
    added = (build_attr_index(sources, variables, geom_index) if attr is None
             else refresh_attr_index(attr, sources, variables, geom_index))
    added.write.mode("append").parquet(attr_index_path)


def start_geom_index_refresh(spark: SparkSession, source_dir: str, index_path: str,
                             checkpoint_location: str, files_per_batch: int | None = None,
                             available_now: bool = True, file_format: str = "parquet",
                             schema=None, attr_index_path: str | None = None,
                             variables: DataFrame | str | None = None, catalog_path: str | None = None,
                             **csv_opts) -> StreamingQuery:
    """Watch ``source_dir`` for new catalog files and keep ``index_path``
    (a Parquet geom index) up to date, and with ``attr_index_path``,
    ``variables`` (the variable_source table, or its path) and ``catalog_path``
    also the attribute index.  CSV files are read with the same database-load
    semantics as the batch reader (``csv_opts`` as for ``read_delimited``)."""
    reader = spark.readStream.schema(schema or _source_schema(spark, source_dir, file_format))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.options(**csv_options(**csv_opts))
    stream = reader.format(file_format).load(source_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch_id: index_batch(df, index_path, attr_index_path, variables,
                                                             catalog_path))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _source_schema(spark: SparkSession, source_dir: str, file_format: str):
    if file_format == "parquet":
        return spark.read.parquet(source_dir).schema
    return CONTRACTS["data_source"].schema()


def _touching(variables: DataFrame, touched: DataFrame) -> DataFrame:
    """Variables whose data source or geometry dependency is in ``touched``."""
    by = lambda c: variables.join(touched, F.col(c).cast("long") == F.col("__source"), "left_semi")
    return by("data_source_uuid").unionByName(by("geom_dependency_uuid")).dropDuplicates(["variable_source_id"])


def ordered_index(index: DataFrame) -> DataFrame:
    return index.orderBy(F.col("geom_index_id"))

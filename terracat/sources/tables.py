"""Table lifecycle and writers: namespaces, tables from contracts, full
rebuild vs positional append, clustered and random-distribution writes, and
materialisation into the shared checkpoint folder to cut lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CONTRACTS, Contract
from ..session import scratch_path

_SQL_TYPES = {"int": "INT", "long": "BIGINT", "double": "DOUBLE", "string": "STRING",
              "date": "DATE", "binary": "BINARY", "decimal": "DECIMAL(38,18)"}


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{namespace}`")


def table_ddl(contract: Contract | str) -> str:
    con = CONTRACTS[contract] if isinstance(contract, str) else contract
    return ", ".join(f"`{c.name}` {_SQL_TYPES[c.type]}" for c in con.columns)


def create_from_contract(spark: SparkSession, contract: Contract | str, namespace: str | None = None,
                         location: str | None = None, partitioned_by: list[str] | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS for a contract (Parquet).  NOT NULL, keys
    and lengths are not declared: Parquet tables do not enforce them, the
    integrity jobs check them."""
    con = CONTRACTS[contract] if isinstance(contract, str) else contract
    ns = namespace or con.namespace
    ensure_namespace(spark, ns)
    name = f"`{ns}`.`{con.name}`"
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({table_ddl(con)}) USING parquet"
    if partitioned_by:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partitioned_by) + ")"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return f"{ns}.{con.name}"


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rebuild(df: DataFrame, table: str) -> None:
    """Empty the table, then fill it (positional, like INSERT .. SELECT)."""
    df.write.insertInto(table, overwrite=True)


def append_rows(df: DataFrame, table: str) -> None:
    """Positional bag append; no dedup."""
    df.write.insertInto(table, overwrite=False)


def write_clustered(df: DataFrame, path: str, keys: list[str], num_partitions: int | None = None,
                    mode: str = "overwrite") -> None:
    """Store rows ordered by an access key: range partitions on ``keys`` and
    sorted inside each file, so Parquet min/max statistics let readers skip
    files and row groups for key lookups.  Without ``num_partitions`` AQE
    sizes the ranges (advisory partition size) from the data."""
    ranged = df.repartitionByRange(*([num_partitions] if num_partitions else []), *keys)
    ranged.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


#: Rows whose keys place the borders of the ranges, and ranges per key at most.
BORDER_ROWS, MOST_BITS = 20_000, 6


def interleaved_order(df: DataFrame, keys: list[str], bits: int) -> Column:
    """Morton code of the rows: every key is ranked among 2**bits ranges of about
    equal size and the ranks' bits are interleaved, so rows close in any of the
    keys lie in few stretches of the order.  The borders come from a random
    sample of bounded size; they shape the layout, never the rows."""
    sample = df.select(*keys).orderBy(F.rand(17)).limit(BORDER_ROWS)
    parts = 1 << bits
    code = F.lit(0).cast("long")
    sorted_keys = sample.agg(*[F.sort_array(F.collect_list(k)).alias(k) for k in keys]).first()
    for at, key in enumerate(keys):
        values = sorted_keys[key]
        borders = sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []
        # a NULL key is in the first range
        rank = reduce(lambda a, b: a + b, [F.coalesce((F.col(key) >= F.lit(b)).cast("int"), F.lit(0)) for b in borders], F.lit(0))
        for bit in range(bits):
            code = code + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1).cast("long"), bit * len(keys) + at)
    return code


def write_interleaved(df: DataFrame, path: str, keys: list[str], num_partitions: int, mode: str = "overwrite") -> None:
    """Store rows so that a lookup on *any* of the keys finds them in few files:
    file statistics bound every key, not only the leading one of a sort."""
    bits = max(1, min(MOST_BITS, -(-num_partitions.bit_length() // len(keys))))
    coded = df.withColumn("__order", interleaved_order(df, keys, bits))
    (coded.repartitionByRange(num_partitions, "__order", *keys).sortWithinPartitions("__order", *keys).drop("__order")
     .write.mode(mode).parquet(path))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store rows hashed and sorted on ``key`` as a table: equality joins on the key
    read it without a shuffle.  Each task writes whole buckets."""
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def write_distributed_randomly(df: DataFrame, path: str, num_partitions: int,
                               mode: str = "overwrite") -> None:
    """Even spread without a key (round robin)."""
    df.repartition(num_partitions).write.mode(mode).parquet(path)


#: Whether Spark removes a query's shuffle files when the query ends (off by default).
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, last_use: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    back: cuts lineage (a lost executor re-reads files instead of
    recomputing) and fixes any non-deterministic values once.  ``last_use`` says
    that ``df`` is not computed from again: its shuffle files are removed at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    if last_use:
        spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if last_use:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a materialised table that is not read again."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(conf).delete(at, True)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when the path does not exist.
    Any other read error is raised: an unreadable table must not be taken
    for an empty one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise

"""Delimited-file reader with the semantics of a database CSV load.

* columns are positional, typed by the target contract, header line skipped
  (header names are not matched);
* an unquoted empty field is NULL, a quoted empty field ``""`` is the empty
  string (Spark's default makes both NULL: a sentinel ``nullValue`` that
  never occurs in data restores the distinction);
* quotes are escaped by doubling them, and quoted fields may hold commas,
  quotes and newlines (``multiLine``; such a file is split per file, not
  per block, so parallelism comes from the number of files);
* a bad row (short, long, unparsable number or date) fails the load
  (``FAILFAST``), or is kept with NULLs under ``mode='PERMISSIVE'``;
* a leading byte-order mark is ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..contracts import CONTRACTS, Contract, spark_type

# Never present in real text: makes Spark keep quoted "" as '' while an
# unquoted empty field still reads as NULL.
NULL_SENTINEL = "\u0001"
#: Rows of an exported file at most: a file that holds newlines in its fields is read by one task.
FILE_ROWS = 100_000


def csv_options(sep: str = ",", header: bool = True, mode: str = "FAILFAST",
                date_format: str | None = None, encoding: str = "UTF-8",
                multi_line: bool = True) -> dict[str, str]:
    """Reader options giving database-load CSV semantics (batch and stream)."""
    opts = {"header": str(header).lower(), "sep": sep, "quote": '"', "escape": '"',
            "multiLine": str(multi_line).lower(), "mode": mode, "nullValue": NULL_SENTINEL,
            "encoding": encoding, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if date_format:
        opts["dateFormat"] = date_format
    return opts


def reader(spark: SparkSession, schema: T.StructType, **options):
    return spark.read.schema(schema).options(**csv_options(**options))


def read_delimited(spark: SparkSession, path: str | list[str], contract: Contract | str,
                   types: dict[str, str] | None = None, **options) -> DataFrame:
    """Read delimited file(s) into the columns of ``contract`` (in order).

    ``types`` overrides column types (e.g. 64-bit ids); ``options``: ``sep``,
    ``header``, ``mode`` ('FAILFAST' | 'PERMISSIVE'), ``date_format`` (e.g.
    'yyyyMMdd' for compact dates), ``encoding``.
    """
    con = CONTRACTS[contract] if isinstance(contract, str) else contract
    schema = con.schema()
    if types:
        schema = T.StructType([T.StructField(f.name, spark_type(types[f.name]) if f.name in types
                                             else f.dataType, True) for f in schema])
    return reader(spark, schema, **options).csv(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite",
               single_file: bool = False) -> None:
    """Write a table as CSV with a header, readable by ``read_delimited``:
    NULL -> unquoted empty, '' -> quoted empty, embedded quotes doubled,
    edge whitespace and newlines kept (Spark's writer trims by default).
    A task writes files of ``FILE_ROWS`` rows, so readers share the work however
    much it was given; ``single_file`` makes one file (only for small catalog tables)."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode)
        .option("maxRecordsPerFile", 0 if single_file else FILE_ROWS)
        .option("header", True).option("sep", sep)
        .option("quote", '"').option("escape", '"')
        .option("nullValue", "").option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))


def read_fragment(spark: SparkSession, path: str, kind: str, **options) -> DataFrame:
    """One of the six vocabulary fragment files (``kind`` = vocabulary,
    concept_class, domain, concept, relationship, concept_relationship)."""
    return read_delimited(spark, path, f"{kind}_fragment", **options)

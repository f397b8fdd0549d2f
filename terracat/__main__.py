"""Command line: load catalog and vocabulary files into Parquet tables, then
validate them.

    python -m terracat load --csv-dir /csv --out /shared/tables [--strict]

``--csv-dir`` (any path that Spark reads) holds ``data_source.csv`` and
``variable_source.csv`` (the catalog) and the six ``gis_*_fragment.csv``
vocabulary files; ``--only`` loads one of the two groups.  A missing file is an
error before any write.  The integrity summary lists every rule with
violations and every reference it could not check.  ``--publish`` loads into a
new version of the tables under ``--out`` and makes it current at the end, so a
failed load leaves the old tables; ``--strict`` publishes only if no rule is
violated and exits non-zero otherwise.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.load import check_loaded, load_catalog, load_published, load_vocabulary_files
from .session import get_session
from .sources.delimited import read_delimited
from .sources.tables import read_if_exists

VOCABULARY_TABLES = ("vocabulary", "concept_class", "domain", "relationship", "concept", "concept_relationship")


def load(args: argparse.Namespace) -> int:
    spark = get_session(args.master, app="terracat-load", cluster=args.cluster)
    csv_opts = {"date_format": args.date_format} if args.date_format else {}
    if args.publish or args.strict:
        return load_version(spark, args, csv_opts)
    tables = {}
    folder, out = args.csv_dir.rstrip("/"), args.out.rstrip("/")
    try:
        if args.only != "vocabulary":  # a missing catalog file stops the load before the vocabulary is written
            for name in ("data_source", "variable_source"):
                read_delimited(spark, f"{folder}/{name}.csv", name, **csv_opts)
        if args.only != "catalog":
            existing = None
            if args.refresh:
                found = {k: read_if_exists(spark, f"{out}/vocabulary/{k}") for k in VOCABULARY_TABLES}
                existing = {k: v for k, v in found.items() if v is not None} or None
            tables.update(load_vocabulary_files(spark, folder, out, existing=existing, **csv_opts))
        if args.only != "vocabulary":
            tables.update(load_catalog(spark, f"{folder}/data_source.csv", f"{folder}/variable_source.csv", out,
                                       refresh=args.refresh, **csv_opts))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        print(f"missing file: {exc}", file=sys.stderr)
        return 2
    report(tables)
    return 0


def load_version(spark: SparkSession, args: argparse.Namespace, csv_opts: dict) -> int:
    """Load into a new published version; ``--strict`` refuses every violation."""
    try:
        tables = load_published(spark, args.csv_dir, args.out, only=args.only, refresh=args.refresh,
                                tolerate=None if args.strict else lambda row: True, **csv_opts)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        print(f"missing file: {exc}", file=sys.stderr)
        return 2
    report(tables)
    return 0


def report(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        print(f"{name}: {df.count()} rows")
    summary = check_loaded(tables)
    for r in summary.where(F.col("n_violations").isNull()).orderBy("table_name", "column_name").collect():
        print(f"NOT CHECKED {r.table_name}.{r.column_name} {r.rule}")
    bad = summary.where(F.col("n_violations") > 0).orderBy("table_name", "rule", "column_name")
    rows = bad.collect()  # one row per violated rule: bounded by the rule count
    for r in rows:
        print(f"VIOLATION {r.table_name}.{r.column_name} {r.rule}: {r.n_violations}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="terracat")
    sub = p.add_subparsers(dest="command", required=True)
    lp = sub.add_parser("load", help="load catalog and vocabulary files, then validate")
    lp.add_argument("--csv-dir", required=True)
    lp.add_argument("--out", required=True, help="shared folder for the Parquet tables")
    lp.add_argument("--only", choices=("catalog", "vocabulary"), help="load one group of files")
    lp.add_argument("--strict", action="store_true", help="publish only if no rule is violated, else fail and keep the old tables")
    lp.add_argument("--publish", action="store_true", help="load into a new version and make it current at the end")
    lp.add_argument("--refresh", action="store_true",
                    help="keep the tables in --out: index only new sources and variables, add only new "
                         "vocabulary keys (concepts and edges are appended, as in the load script)")
    lp.add_argument("--date-format", default=None, help="date pattern of the files, e.g. yyyyMMdd")
    lp.add_argument("--master", default=None)
    lp.add_argument("--cluster", action="store_true", help="use the large-cluster session profile")
    args = p.parse_args(argv)
    return load(args)


if __name__ == "__main__":
    sys.exit(main())

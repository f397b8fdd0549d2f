"""Sets of tables that change all at once.

A version of the set is written to folders of its own; one small marker file
(``_published/<number>.json``, a map from table to folder) makes it the current
one.  Readers take the newest complete marker, so they see all of a version or
all of the one before, whatever fails in between.  A marker is created
exclusively: of two writers that publish the same number one gets an error and
its version stays unpublished.  Superseded folders stay until ``prune``, for
readers that hold the older version.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

_MARKERS = "_published"


class PublishConflict(Exception):
    """Another writer published first."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def create_exclusively(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file; False if it exists already.  On a local folder the
    creation itself is atomic, elsewhere it is as atomic as the file system's
    create without overwrite (HDFS: atomic)."""
    jvm = spark.sparkContext._jvm
    fs, path_of = _fs(spark, path)
    at = fs.makeQualified(path_of(path))
    fs.mkdirs(at.getParent())
    if at.toUri().getScheme() == "file":
        try:
            with open(at.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    if fs.exists(at):
        return False
    try:
        out = fs.create(at, False)
    except Exception as exc:  # a py4j error that wraps the file system's
        if "exist" in str(exc).lower():
            return False
        raise
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none if it does not exist."""
    fs, path_of = _fs(spark, folder)
    if not fs.exists(path_of(folder)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path_of(folder)))


def remove(spark: SparkSession, path: str) -> None:
    fs, path_of = _fs(spark, path)
    fs.delete(path_of(path), True)


def _text(spark: SparkSession, path: str) -> str:
    fs, path_of = _fs(spark, path)
    source = fs.open(path_of(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def versions(spark: SparkSession, root: str) -> list[tuple[int, dict[str, str]]]:
    """(number, folders by table) of all published versions, oldest first."""
    out = []
    for name in names_in(spark, f"{root.rstrip('/')}/{_MARKERS}"):
        number = name.removesuffix(".json")
        if not number.isdigit():
            continue
        try:
            out.append((int(number), json.loads(_text(spark, f"{root.rstrip('/')}/{_MARKERS}/{name}"))))
        except ValueError:  # still being written
            continue
    return out


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number and folders of the current version; (0, {}) if there is none."""
    return (versions(spark, root) or [(0, {})])[-1]


def read_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in current(spark, root)[1].items()}


def publish(spark: SparkSession, root: str, write: Callable[[str], dict[str, str]],
            audit: Callable[[dict[str, DataFrame]], None] | None = None, drop: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Write a new version, audit it, make it current.

    ``write(folder)`` writes the tables somewhere below ``folder`` and returns
    their folders by name; tables of the current version that it does not name
    are kept, but for those to ``drop``.  ``audit(tables)`` sees the whole new version and raises to refuse
    it.  When anything fails the new folder is removed and the version before
    stays as it was."""
    root = root.rstrip("/")
    number, before = current(spark, root)
    folder = f"{root}/v{number + 1:08d}-{os.urandom(4).hex()}"
    try:
        paths = {**{k: p for k, p in before.items() if k not in set(drop)}, **write(folder)}
        tables = {name: spark.read.parquet(path) for name, path in paths.items()}
        if audit:
            audit(tables)
        if not create_exclusively(spark, f"{root}/{_MARKERS}/{number + 1:08d}.json", json.dumps(paths)):
            raise PublishConflict(f"version {number + 1} of {root} was published by another writer")
    except BaseException:
        remove(spark, folder)
        raise
    return tables


def prune(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove markers and folders that none of the newest ``keep`` versions names."""
    root = root.rstrip("/")
    every = versions(spark, root)
    used = {path for _, paths in every[-keep:] for path in paths.values()}
    oldest = every[-keep:][0][0] if every else 0
    for number, _ in every[:-keep]:
        remove(spark, f"{root}/{_MARKERS}/{number:08d}.json")
    for name in names_in(spark, root):
        folder = f"{root}/{name}"
        if name[:1] == "v" and name[1:9].isdigit() and int(name[1:9]) < oldest and not any(
                p == folder or p.startswith(folder + "/") for p in used):
            remove(spark, folder)

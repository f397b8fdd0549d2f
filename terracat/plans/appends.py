"""Integrity kept current while rows are appended: the rows that arrive are
checked against what is stored about the keys, never against the old tables.

State under one folder (a published set, so an append changes all of it or
nothing):

* ``keys-<append>``: key values (rule_id, key, n) that an append brought,
  ordered by rule and key, so file statistics bound them;
* ``sketch-<append>``: a bit table of those keys (``bits`` positions per rule, as
  64-bit words): a key whose bit is clear was never stored;
* ``open``: the violations as they stand.

An append makes the events of its rows (one scan of them).  Column rules are
judged at once.  Values whose bit is clear are new, hence no duplicates, and as
references orphans; only the rest, the candidates, are looked up, between their
smallest and largest value in the stored keys.  Orphans stored as open
are resolved when the append brings their parent.  The result equals a full
check of all rows (``violations.violating_rows``) at any point.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CONTRACTS, Contract
from ..session import scratch_scope
from ..sources.published import current, publish
from ..sources.tables import materialize
from . import violations as vio

#: Positions of the bit table per key rule.
BITS = 1 << 26
#: Stored append sets are merged into one when there are so many.
MERGE_AT = 16


def _word(key: Column, bits: int) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.floor(place / 64).cast("long"), (place % 64).cast("int")


def _sketch(keys: DataFrame, bits: int) -> DataFrame:
    word, bit = _word(F.col("key"), bits)
    one = F.expr("shiftleft(1L, bit)")
    return (keys.select("rule_id", word.alias("word"), bit.alias("bit")).groupBy("rule_id", "word")
            .agg(F.bit_or(one).alias("set")))


def _stored(spark: SparkSession, paths: dict[str, str], kind: str) -> DataFrame | None:
    found = [p for name, p in sorted(paths.items()) if name.startswith(f"{kind}-")]
    return spark.read.parquet(*found) if found else None


def candidates(values: DataFrame, sketch: DataFrame, bits: int, rule: str) -> DataFrame:
    """Rows of ``values`` (columns ``rule`` and key) whose bit is set."""
    word, bit = _word(F.col("key"), bits)
    merged = sketch.select(F.col("rule_id").alias("__rule"), F.col("word").alias("__word"), "set")
    near = values.withColumn("__word_of", word).withColumn("__bit", bit)
    hit = near.join(merged, (F.col(rule) == F.col("__rule")) & (F.col("__word_of") == F.col("__word"))
                    & (F.expr("shiftright(set, __bit) & 1L") == 1), "left_semi")
    return hit.drop("__word_of", "__bit")


def _lookup(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored keys (rule_id, key, n summed) that are wanted.  The wanted keys'
    range per rule (one row per rule) is pushed into the scan."""
    ranges = wanted.groupBy("rule_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()
    if not ranges:
        return stored.limit(0).select("rule_id", "key", F.col("n").alias("stored_n"))
    between = [(F.col("rule_id") == r["rule_id"]) & F.col("key").between(r["low"], r["high"]) for r in ranges]
    part = stored.where(reduce(lambda a, b: a | b, between))
    part = part.join(wanted.select("rule_id", "key").distinct(), ["rule_id", "key"], "left_semi")
    return part.groupBy("rule_id", "key").agg(F.sum("n").alias("stored_n"))


class Appends:
    """The integrity state of a set of tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str, columns: dict[str, list[str]],
                 contracts: dict[str, Contract] | None = None, bits: int = BITS):
        self.spark, self.root, self.bits = spark, root.rstrip("/"), bits
        self.contracts = {**CONTRACTS, **(contracts or {})}
        self.rules = vio.rules_of(columns, self.contracts)

    def open_violations(self) -> DataFrame:
        """(table_name, rule, column_name, key, n) over all rows appended so far."""
        paths = current(self.spark, self.root)[1]
        if "open" not in paths:
            return vio.named(self.spark.createDataFrame([], "rule_id int, key string, n long"), self.rules)
        return vio.named(self.spark.read.parquet(paths["open"]), self.rules)

    def append(self, name: str, tables: dict[str, DataFrame]) -> bool:
        """Take in the new rows of any of the tables.  ``name`` identifies the
        append; one that was taken in before is left alone (returns False)."""
        spark = self.spark
        number, paths = current(spark, self.root)
        if "done" in paths and spark.read.parquet(paths["done"]).where(F.col("name") == name).limit(1).count():
            return False
        with scratch_scope(spark):
            found = materialize(vio.events(tables, self.rules, self.contracts), "append_events")
            publish(spark, self.root, lambda folder: self._write(folder, name, number, paths, found))
        if sum(k.startswith("keys-") for k in current(spark, self.root)[1]) >= MERGE_AT:
            self.merge()
        return True

    def _write(self, folder: str, name: str, number: int, paths: dict[str, str], found: DataFrame) -> dict[str, str]:
        spark, rules = self.spark, self.rules
        keys = vio.key_events(found, rules)
        refs = vio.with_parent(vio.reference_events(found, rules), rules)
        stored, sketch = _stored(spark, paths, "keys"), _stored(spark, paths, "sketch")
        columns = found.where(F.col("rule_id").isin([k for k, r in enumerate(rules) if r.kind == "column"]))
        # references whose parent is not in this append
        before = spark.read.parquet(paths["open"]) if "open" in paths else None
        own = refs.select("rule_id", "key", "n", F.lit(True).alias("new"))
        if before is not None:  # an orphan may have found its parent: asked together with the new references
            own = own.unionByName(vio.reference_events(before, rules).select("rule_id", "key", "n", F.lit(False).alias("new")))
        missing = materialize(vio.orphans(own, keys, rules), "append_missing")
        waiting, missing = missing.where(~F.col("new")).drop("new"), missing.where("new").drop("new")
        twice = vio.key_events(keys, rules, True).where(F.col("n") > 1)
        if stored is not None:
            # each is read more than once: few rows are written instead of all keys being shuffled again
            again = materialize(candidates(keys, sketch, self.bits, "rule_id"), "append_again")
            old_keys = _lookup(stored, again)
            again = materialize(again.join(old_keys, ["rule_id", "key"]).select(
                "rule_id", "key", (F.col("n") + F.col("stored_n")).alias("n")), "append_twice")
            asked = materialize(candidates(vio.with_parent(missing, rules), sketch, self.bits, "parent_id"), "append_asked")
            parents = _lookup(stored, asked.select(F.col("parent_id").alias("rule_id"), "key"))
            missing = vio.orphans(missing, materialize(parents, "append_parents"), rules)
            twice = twice.join(again, ["rule_id", "key"], "left_anti").unionByName(vio.key_events(again, rules, True))
        now = columns.unionByName(missing)
        if before is not None:
            # a key seen again is counted anew with its stored rows
            kept = vio.key_events(before, rules).join(twice, ["rule_id", "key"], "left_anti")
            still = before.where(F.col("rule_id").isin([k for k, r in enumerate(rules) if r.kind == "column"]))
            now = now.unionByName(still).unionByName(waiting)
            twice = twice.unionByName(kept)
        now = now.groupBy("rule_id", "key").agg(F.sum("n").alias("n")).unionByName(twice)
        now.write.parquet(f"{folder}/open")
        keys.repartitionByRange("rule_id", "key").sortWithinPartitions("rule_id", "key").write.parquet(f"{folder}/keys")
        _sketch(keys, self.bits).write.parquet(f"{folder}/sketch")
        done = spark.createDataFrame([(name,)], "name string")
        if "done" in paths:
            done = done.unionByName(spark.read.parquet(paths["done"]))
        done.coalesce(1).write.parquet(f"{folder}/done")
        return {"open": f"{folder}/open", "done": f"{folder}/done", f"keys-{number + 1:08d}": f"{folder}/keys",
                f"sketch-{number + 1:08d}": f"{folder}/sketch"}

    def merge(self) -> None:
        """One key set and one sketch in place of many, in a new version."""
        paths = current(self.spark, self.root)[1]

        def write(folder: str) -> dict[str, str]:
            keys, sketch = _stored(self.spark, paths, "keys"), _stored(self.spark, paths, "sketch")
            (keys.groupBy("rule_id", "key").agg(F.sum("n").alias("n")).repartitionByRange("rule_id", "key")
             .sortWithinPartitions("rule_id", "key").write.parquet(f"{folder}/keys"))
            sketch.groupBy("rule_id", "word").agg(F.bit_or("set").alias("set")).write.parquet(f"{folder}/sketch")
            return {"keys-00000000": f"{folder}/keys", "sketch-00000000": f"{folder}/sketch"}
        gone = [k for k in paths if k.startswith(("keys-", "sketch-"))]
        publish(self.spark, self.root, write, drop=gone)

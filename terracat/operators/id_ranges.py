"""Surrogate ids for writers that work at the same time.

Ids are reserved in units of ``unit``: unit k is the ids from ``low + k * unit``.
A unit belongs to whoever creates the file of its number in the shared folder
first (creation is exclusive), so no two writers ever hold the same id and no
lock is held while rows are written.  A writer that fails leaves its units
unused, as a sequence does; ids are not reused and do not cycle: when the
bound would be passed an error is raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.published import create_exclusively, names_in
from .ids import dense_id

ID_MAX = 2_147_483_647


class IdsExhausted(Exception):
    pass


class IdRanges:
    def __init__(self, spark: SparkSession, folder: str, unit: int = 1 << 20, low: int = 1, high: int = ID_MAX):
        self.spark, self.folder, self.unit, self.low, self.high = spark, folder.rstrip("/"), unit, low, high

    def reserve(self, n: int) -> list[int]:
        """First ids of the units that hold ``n`` ids, ascending.  Other writers may
        claim units in between, so the units need not follow each other."""
        got: list[int] = []
        taken = names_in(self.spark, self.folder)
        at = int(taken[-1]) + 1 if taken else 0
        while n > len(got) * self.unit:
            needed = min(self.unit, n - len(got) * self.unit)
            if self.low + at * self.unit + needed - 1 > self.high:
                raise IdsExhausted(f"{needed} more ids do not fit below {self.high}")
            if create_exclusively(self.spark, f"{self.folder}/{at:012d}"):
                got.append(self.low + at * self.unit)
            at += 1
        return got

    def number(self, rows: DataFrame, order_by: list[str], name: str) -> DataFrame:
        """``rows`` (read twice: a stored table) with ids from units reserved now, in
        order inside each unit.  One row per unit is broadcast."""
        starts = self.reserve(rows.count())
        if not starts:
            return rows.withColumn(name, F.lit(None).cast("long"))
        units = self.spark.createDataFrame(list(enumerate(starts)), "__unit long, __start long")
        numbered = dense_id(rows, order_by, "__at", start=0).withColumn("__unit", F.floor(F.col("__at") / self.unit))
        return (numbered.join(F.broadcast(units), "__unit")
                .withColumn(name, F.col("__start") + F.col("__at") % self.unit).drop("__unit", "__at", "__start"))

"""Relational building blocks shared by the catalog and vocabulary jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pairs(left_keys, right_keys):
    if isinstance(left_keys, str):
        left_keys = [left_keys]
    right_keys = left_keys if right_keys is None else (
        [right_keys] if isinstance(right_keys, str) else right_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("key lists differ in length")
    return list(left_keys), list(right_keys)


def anti_join(left: DataFrame, right: DataFrame, left_keys, right_keys=None, also=None) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (NOT EXISTS).

    Used for ``NOT IN`` over non-null keys and for ``LEFT JOIN .. IS NULL``;
    Catalyst does not rewrite the latter, so we write the anti join.  Only
    the key columns of ``right`` are read.  The side sizes are left to AQE:
    it broadcasts ``right`` when its runtime size is small and otherwise
    shuffles both sides on the key.  ``also`` is an extra condition on
    ``left``'s columns added to the join condition.
    """
    lk, rk = _pairs(left_keys, right_keys)
    aliased = [f"__anti_k{i}" for i in range(len(rk))]
    r = right.select(*[F.col(c) for c in rk]).toDF(*aliased)
    cond = reduce(lambda a, b: a & b, [left[l] == r[a] for l, a in zip(lk, aliased)])
    if also is not None:
        cond = cond & also
    return left.join(r, cond, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, left_keys, right_keys=None) -> DataFrame:
    """Rows of ``left`` with at least one match in ``right`` (EXISTS)."""
    lk, rk = _pairs(left_keys, right_keys)
    aliased = [f"__semi_k{i}" for i in range(len(rk))]
    r = right.select(*[F.col(c) for c in rk]).toDF(*aliased)
    cond = reduce(lambda a, b: a & b, [left[l] == r[a] for l, a in zip(lk, aliased)])
    return left.join(r, cond, "left_semi")


def append(target_columns: list[str], *frames: DataFrame) -> DataFrame:
    """Positional bag append (``INSERT INTO t SELECT ...``): each frame's
    columns are taken in order and renamed to the target's; no dedup."""
    renamed = [f.toDF(*target_columns) for f in frames]
    return reduce(DataFrame.union, renamed)

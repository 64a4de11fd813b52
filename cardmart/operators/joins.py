"""Join operators: existence flag, semi / anti joins, FK orphans, seed-if-absent.

All are equi-joins that Catalyst plans as hash or sort-merge joins; nothing
here broadcasts by hint.  AQE converts a join to broadcast only after it has
*measured* the small side at runtime (``spark.sql.adaptive.autoBroadcastJoinThreshold``),
which is the size check; above it the join stays sort-merge and AQE splits
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def existence_flag(df: DataFrame, other: DataFrame, key: str | Sequence[str],
                   name: str) -> DataFrame:
    """``EXISTS (SELECT 1 FROM other WHERE other.key = df.key)`` as a boolean column.

    ``other`` is reduced to its distinct non-NULL keys first (partial
    aggregation map-side), so the join is at most 1:1 -- no fan-out of ``df``
    and no hot key however many rows of ``other`` share one key.
    """
    ks = _keys(key)
    hits = (other.select(*ks).dropna(subset=ks).distinct()
            .withColumn(name, F.lit(True)))
    return (df.join(hits, ks, "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))


def _distinct_keys(other: DataFrame, ks: list[str]) -> DataFrame:
    """The lookup side reduced to its distinct keys (partial aggregate map-side): a key
    that holds a third of ``other`` becomes one row before the join.  (AQE's skew
    handling splits only the streamed side of a semi / anti join.)"""
    return other.select(*ks).distinct()


def semi(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with a match in ``other`` (J10, positive EXISTS)."""
    ks = _keys(key)
    return df.join(_distinct_keys(other, ks), ks, "left_semi")


def anti(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a match in ``other`` (J08, NOT EXISTS)."""
    ks = _keys(key)
    return df.join(_distinct_keys(other, ks), ks, "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (J09, the ``relationships`` data test)."""
    p = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(p, fk, "left_anti")


def seed_if_absent(target: DataFrame, seed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``INSERT ... SELECT ... WHERE NOT EXISTS``: the seed rows to append."""
    return anti(seed, target, key)

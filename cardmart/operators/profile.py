"""Column profiles without a full sort (Q08): exact quantiles, and values with a large share.

* ``exact_quantiles`` narrows a range of values pass by pass: a histogram of ``bins`` equal bins per wanted
  rank, counted by one aggregate, tells in which bin the rank lies; that bin is the next range.  It ends
  when a bin holds one value.  Each pass is a scan and at most groups x ranks x bins sums.
* ``heavy_values`` keeps Misra-Gries counters in every task: a value with more than 1/k of all rows has
  more than 1/k of the rows of at least one task, so it is among that task's counters.  An exact second pass
  counts the candidates, so the result has every value above the share and no other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float], group: str, bins: int = 256) -> dict:
    """{group: [value of rank ceil(share * n) for each share]} of a decimal or integer column; NULLs are left out.

    Groups must be few (their sums are gathered): a known small set of types.
    """
    scale = getattr(df.schema[column].dataType, "scale", 0)
    unit = F.col(column).cast(f"decimal(38,{scale})") * F.lit(10 ** scale).cast("decimal(38,0)")
    base = df.where(F.col(column).isNotNull()).select(F.col(group).alias("g"), unit.cast("decimal(38,0)").cast("long").alias("x"))
    start = base.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    # For each group and share: the range that holds the rank, and the rank within it.
    todo = {(r["g"], i): [r["lo"], r["hi"], max(1, math.ceil(share * r["n"]))] for r in start for i, share in enumerate(shares)}
    while any(lo < hi for lo, hi, _ in todo.values()):
        ranges = [(g, i, lo, hi, max(1, -(-(hi - lo + 1) // bins))) for (g, i), (lo, hi, _) in todo.items() if lo < hi]
        table = df.sparkSession.createDataFrame(ranges, f"g {df.schema[group].dataType.simpleString()}, i int, lo long, hi long, width long")
        found = (base.join(F.broadcast(table), "g").where("x between lo and hi")  # a row for each group and share
                 .groupBy("g", "i", F.expr("(x - lo) div width").alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("g", "i", "bin").collect())
        for g, i, lo, hi, width in ranges:
            rank = todo[g, i][2]
            for r in found:
                if (r["g"], r["i"]) == (g, i):
                    if rank <= r["n"]:
                        at = lo + r["bin"] * width
                        todo[g, i] = [at, min(hi, at + width - 1), rank]
                        break
                    rank -= r["n"]
    value = lambda x: Decimal(x).scaleb(-scale) if scale else x
    return {r["g"]: [value(todo[r["g"], i][0]) for i in range(len(shares))] for r in start}


def heavy_values(df: DataFrame, column: str, share: float) -> DataFrame:
    """``column``, n, total: every value that more than ``share`` of the rows have (NULLs are not counted)."""
    slots = math.ceil(1 / share)
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, schema = {}, None
        for b in batches:
            schema = b.schema
            for x in b.column(0).value_counts().to_pylist():
                kept[x["values"]] = kept.get(x["values"], 0) + x["counts"]
            while len(kept) > slots:  # take the smallest count from all
                least = min(kept.values())
                kept = {v: n - least for v, n in kept.items() if n > least}
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(list(kept), schema.field(0).type)], schema=schema)

    found = values.mapInArrow(count, f"value {df.schema[column].dataType.simpleString()}").distinct()
    total = values.agg(F.count(F.lit(1)).alias("total"))
    counts = values.join(found, "value", "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    # The total is one row.
    return counts.crossJoin(F.broadcast(total)).where(F.col("n") > F.col("total") * share).select(F.col("value").alias(column), "n", "total")


def hours(df: DataFrame, column: str) -> DataFrame:
    """Rows of each hour of the day."""
    return df.groupBy(F.hour(column).alias("hour")).agg(F.count(F.lit(1)).alias("n"))

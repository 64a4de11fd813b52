"""Declarative data tests, parity and profiling.

A test is data -- ``Check(model, column, kind, to_model, to_column)`` -- and a
suite run is one aggregate over the tested columns of all models, each model
read once; the result is one row per test with its failure count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmart.operators.joins import orphans


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str                      # unique | not_null | relationships
    to_model: str | None = None
    to_column: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_model}_{self.to_column}"
        return f"{self.kind}_{self.model}_{self.column}"


def _u(m: str, c: str) -> list[Check]:
    return [Check(m, c, "unique"), Check(m, c, "not_null")]


# The ledger's test suite: 14 source, 4 staging, 6 intermediate, 14 mart tests.
LEDGER_CHECKS: list[Check] = [
    *_u("raw_transactions", "transaction_id"),
    Check("raw_transactions", "card_id", "not_null"),
    Check("raw_transactions", "merchant_id", "not_null"),
    *_u("raw_gateway_log", "gateway_log_id"),
    Check("raw_gateway_log", "transaction_id", "not_null"),
    *_u("raw_card_master", "card_id"),
    *_u("raw_merchant_master", "merchant_id"),
    *_u("dispute_memos", "dispute_id"),
    Check("dispute_memos", "transaction_id", "not_null"),
    *_u("stg_transactions", "transaction_id"),
    *_u("stg_gateway_log", "gateway_log_id"),
    *_u("int_transactions_enriched", "transaction_id"),
    *_u("int_settlements", "transaction_id"),
    *_u("int_fees", "transaction_id"),
    *_u("dim_merchant", "merchant_id"),
    *_u("dim_card", "card_id"),
    *_u("dim_mcc", "mcc_code"),
    *_u("dim_currency", "currency_code"),
    *_u("fact_payment_ledger", "transaction_id"),
    Check("fact_payment_ledger", "card_id", "relationships", "dim_card", "card_id"),
    Check("fact_payment_ledger", "merchant_id", "relationships", "dim_merchant", "merchant_id"),
    Check("fact_payment_ledger", "mcc_code", "relationships", "dim_mcc", "mcc_code"),
    Check("fact_payment_ledger", "currency_code", "relationships", "dim_currency", "currency_code"),
]


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Q01: non-NULL values that occur more than once (one row per duplicated value)."""
    return (df.select(column).filter(F.col(column).isNotNull())
            .groupBy(column).count().filter(F.col("count") > 1))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Q02: rows where the column is NULL."""
    return df.filter(F.col(column).isNull())


def relationship_failures(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose FK has no parent."""
    return orphans(child, fk, parent, pk)


def run_suite(models: Mapping[str, DataFrame], checks: Sequence[Check] = LEDGER_CHECKS) -> DataFrame:
    """Q04: one row per test -- name, model, column, kind, failures, status.

    Every model is read once, however many tests it has:

    * each tested column (also one that a relationship refers to) gives a number, the hash of its value
      and, where a relationship compares it, the value; ONE aggregate counts them, map-side first;
    * NULLs, repeated hashes and compared values, which is all that can make a test fail, go on to a
      second aggregate by (test, compared value), which finds values without a parent;
    * two values may share a hash, so a column with repeated hashes is counted again by its values.

    Values are compared as strings (keys are ids).  The failures, a number a test, are gathered.
    """
    spark = next(iter(models.values())).sparkSession
    related = [c for c in checks if c.kind == "relationships"]
    compared = {(c.model, c.column) for c in related} | {(c.to_model, c.to_column) for c in related}
    columns = sorted({(c.model, c.column) for c in checks} | compared)
    at = {pair: i for i, pair in enumerate(columns)}

    def values(model: str) -> DataFrame:
        mine = [c for m, c in columns if m == model]
        tagged = [F.struct(F.lit(at[model, c]).alias("e"), F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c))).alias("h"),
                           (F.col(c) if (model, c) in compared else F.lit(None).cast("string")).alias("v")) for c in mine]
        return models[model].select(*[F.col(c).cast("string").alias(c) for c in mine]).select(F.inline(F.array(*tagged)))

    counted = (reduce(DataFrame.unionByName, [values(m) for m in dict.fromkeys(m for m, _ in columns)])
               .groupBy("e", "h", "v").agg(F.count(F.lit(1)).alias("n"))
               .where((F.col("n") > 1) | F.col("h").isNull() | F.col("v").isNotNull()))
    is_null, none = F.col("h").isNull(), F.lit(None).cast("string")
    finds = []
    for i, c in enumerate(checks):
        def find(pair, when: Column, v: Column, n: Column, parent: bool = False) -> None:
            finds.append(F.when((F.col("e") == at[pair]) & when, F.struct(
                F.lit(i).alias("test"), v.alias("v"), n.cast("long").alias("n"), F.lit(parent).alias("parent"))))  # noqa: B023

        if c.kind == "unique":
            find((c.model, c.column), ~is_null & (F.col("n") > 1), none, F.lit(1))
        elif c.kind == "not_null":
            find((c.model, c.column), is_null, none, F.col("n"))
        else:
            find((c.model, c.column), ~is_null, F.col("v"), F.col("n"))
            find((c.to_model, c.to_column), ~is_null, F.col("v"), F.lit(0), True)
    found = counted.select(F.inline(F.filter(F.array(*finds), lambda x: x.isNotNull())))
    met = found.groupBy("test", "v").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    failures = {r["test"]: r["n"] for r in met.where(~F.col("parent")).groupBy("test").agg(F.sum("n").alias("n")).collect()}
    for i, c in enumerate(checks):
        if c.kind == "unique" and failures.get(i) and (c.model, c.column) not in compared:
            key = models[c.model].select(F.col(c.column).cast("string").alias(c.column))
            failures[i] = unique_failures(key, c.column).count()
    rows = [(c.name, c.model, c.column, c.kind, failures.get(i, 0)) for i, c in enumerate(checks)]
    out = spark.createDataFrame(rows, "test_name string, model string, column_name string, test_kind string, failures long")
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of per-table counts, ordered by table name."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("tbl"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("tbl")


def counts_match(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Q05: row counts of paired tables side by side with an equality flag.

    Counts are tagged and unioned, then folded per pair by one aggregate --
    no join between the one-row results.
    """
    parts = []
    for name, (left, right) in pairs.items():
        for side, df in (("left", left), ("right", right)):
            parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("pair"), F.lit(side).alias("side"), "n"))
    folded = reduce(DataFrame.unionByName, parts).groupBy("pair").agg(
        F.sum(F.when(F.col("side") == "left", F.col("n"))).alias("left_rows"),
        F.sum(F.when(F.col("side") == "right", F.col("n"))).alias("right_rows"))
    return folded.withColumn("counts_equal", F.col("left_rows") == F.col("right_rows"))


def parity(a: DataFrame, b: DataFrame, drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows only in ``a`` and rows only in ``b`` (multiset difference both ways)."""
    cols = [c for c in a.columns if c not in drop]
    # One table of counts for both sides: each input is read once, and the two results share its shuffle.
    sides = a.select(*cols, F.lit(1).alias("__n")).unionAll(b.select(*cols, F.lit(-1).alias("__n")))
    more = sides.groupBy(*cols).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)

    def rows(n: Column) -> DataFrame:
        return more.where(n > 0).withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), n))).select(*cols)

    return rows(F.col("__n")), rows(-F.col("__n"))


def differing_buckets(a: DataFrame, b: DataFrame, key: Sequence[str], buckets: int = 256) -> list[int]:
    """Buckets of the key in which two tables differ, by order-free checksums of whole rows.

    Rows are counted and summed by two hashes per bucket before any exchange, so no row is shuffled;
    at most ``buckets`` sums of each table are gathered.  Equal multisets give equal sums.
    """
    cols = a.columns
    hashes = [F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.sum(F.xxhash64(F.lit(7), *reversed(cols)).cast("decimal(38,0)"))]

    def sums(df: DataFrame) -> dict:
        rows = df.groupBy(key_bucket(key, buckets).alias("bucket")).agg(F.count(F.lit(1)), *hashes).collect()
        return {r[0]: tuple(r)[1:] for r in rows}

    x, y = sums(a), sums(b.select(*cols))
    return sorted(k for k in x.keys() | y.keys() if x.get(k) != y.get(k))


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets).cast("long")).cast("int")


def parity_by_bucket(a: DataFrame, b: DataFrame, key: Sequence[str], drop: Sequence[str] = (),
                     buckets: int = 256) -> tuple[DataFrame, DataFrame]:
    """X02 at scale: as ``parity``, but only rows of buckets whose checksums differ are compared.

    Both tables need the same columns and types (types are aligned to those of ``a``).  Two builds that
    agree are read once and shuffle no rows; a few differing rows cost their buckets.
    """
    cols = [c for c in a.columns if c not in drop]
    a2 = a.select(*cols)
    b2 = b.select(*[F.col(c).cast(a.schema[c].dataType).alias(c) for c in cols])
    odd = differing_buckets(a2, b2, key, buckets)
    if not odd:
        return a2.limit(0), b2.limit(0)
    here = key_bucket(key, buckets).isin(odd)
    return parity(a2.where(here), b2.where(here))


def profile_amounts(transactions: DataFrame) -> DataFrame:
    """Q08: amount distribution per transaction type (count, min, quartiles, max)."""
    return transactions.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("amount").alias("min_amount"),
        F.percentile_approx(F.col("amount").cast("double"), [0.25, 0.5, 0.75], 10000)
        .alias("quartiles"),
        F.max("amount").alias("max_amount"))

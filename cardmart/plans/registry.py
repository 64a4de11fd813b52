"""Named sources and models resolved by reference.

A model is ``(inputs, function)``; ``ref(name)`` builds it from its inputs
(sources or other models) once per registry, so the whole graph is one lazy
plan.  ``as_views`` publishes every model as a temporary view (the "view"
materialisation) so plain Spark SQL can query them; ``temp_table`` is the
"temporary table" that later statements reuse: persisted once, so an
expensive column (a classifier's prediction) is computed a single time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from cardmart.plans import models as M


@dataclass
class Registry:
    spark: SparkSession
    sources: Mapping[str, DataFrame]
    models: dict[str, tuple[Sequence[str], Callable[..., DataFrame]]] = field(default_factory=dict)
    _built: dict[str, DataFrame] = field(default_factory=dict)

    def source(self, name: str) -> DataFrame:
        return self.sources[name]

    def ref(self, name: str) -> DataFrame:
        if name in self._built:
            return self._built[name]
        if name in self.sources:
            return self.sources[name]
        inputs, fn = self.models[name]
        df = fn(*[self.ref(i) for i in inputs])
        self._built[name] = df
        return df

    def as_views(self, names: Sequence[str] | None = None) -> list[str]:
        """Every source and model as a temp view of the same name."""
        names = list(names) if names is not None else [*self.sources, *self.models]
        for n in names:
            self.ref(n).createOrReplaceTempView(n)
        return names


def ledger_registry(spark: SparkSession, raw: Mapping[str, DataFrame]) -> Registry:
    """The ledger's models wired by name, as the declarative project wires them."""
    r = Registry(spark, raw)
    r.models.update({
        "stg_transactions": (["raw_transactions"], M.stg_transactions),
        "stg_gateway_log": (["raw_gateway_log"], M.stg_gateway_log),
        "int_transactions_enriched": (["stg_transactions", "raw_card_master",
                                       "raw_merchant_master"], M.int_transactions_enriched),
        "int_settlements": (["stg_gateway_log"], M.int_settlements),
        "int_fees": (["stg_gateway_log"], M.int_fees),
        "dim_merchant": (["raw_merchant_master"], M.dim_merchant),
        "dim_card": (["raw_card_master"], M.dim_card),
        "dim_mcc": (["raw_merchant_master"], M.dim_mcc),
        "dim_currency": (["raw_transactions"], M.dim_currency),
        "fact_payment_ledger": (["int_transactions_enriched", "stg_gateway_log",
                                 "dispute_memos"], M.fact_payment_ledger),
    })
    return r


def temp_table(df: DataFrame, name: str,
               level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist once and register as a temp view; later statements reuse it.
    (Persisted blocks lost with an executor are recomputed from lineage.)  A previous
    temp table of the same name is released first."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        spark.catalog.uncacheTable(name)
    out = df.persist(level)
    out.createOrReplaceTempView(name)
    return out

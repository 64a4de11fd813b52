"""Latest event per key.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC, id DESC) = 1``.

Plan shape: Catalyst's ``InferWindowGroupLimit`` inserts a *partial*
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one
row per key.  A key that holds a third of all events therefore reaches its
reducer as one row per map task, not as a third of the data -- the hot-key
case is collapsed map-side, like a partial aggregate.  Predicates on the
ranked output (e.g. "settled") stay *above* the window: filtering first would
pick an older event as "latest".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def desc_nulls_first(c: str | Column) -> Column:
    """DESC with NULLs ranked first: the source dialect's default (trap #11)."""
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column],
                   keep: Column | None = None, rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``key`` under ``order``; then apply ``keep`` (post-rank filter).

    ``order`` must be a total order inside a key (append a unique id as the
    last tie-break, trap #7); otherwise the winner is arbitrary.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1)
    if keep is not None:
        ranked = ranked.filter(keep)
    return ranked.drop(rank_col)


def gateway_order(ts: str = "gateway_timestamp", event_id: str = "gateway_log_id") -> list[Column]:
    """Final gateway event first: latest time (NULL time first), then larger event id."""
    return [desc_nulls_first(ts), F.col(event_id).desc()]


def latest_gateway_event(stg_gateway: DataFrame, columns: Sequence[str] | None = None,
                         settled_only: bool = False) -> DataFrame:
    """Final gateway event per transaction, optionally only when it settled."""
    cols = list(columns) if columns else stg_gateway.columns
    need = list(dict.fromkeys(["transaction_id", "gateway_timestamp", "gateway_log_id",
                               "settlement_amount", *cols]))
    keep = F.col("settlement_amount").isNotNull() if settled_only else None
    return latest_per_key(stg_gateway.select(*need), "transaction_id", gateway_order(),
                          keep=keep).select(*cols)

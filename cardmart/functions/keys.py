"""Column functions for keys, money and derived attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardmart.schemas import AMT


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(c: str | Column) -> Column:
    """Deterministic 60-bit surrogate key from the md5 of the id.

    Engine-independent (any SQL engine with md5 gives the same number), so
    keys are stable across rebuilds, engines and Spark versions.
    """
    return F.conv(F.substring(F.md5(col_(c).cast("string")), 1, 15), 16, 10).cast("long")


def signed_gross(transaction_type: str | Column, amount: str | Column) -> Column:
    """Refunds negative, everything else (incl. NULL type) positive (P06-P08, trap #2)."""
    a = F.abs(col_(amount))
    return F.when(col_(transaction_type).ilike("%REFUND%"), -a).otherwise(a)


def net_amount(settlement: str | Column, interchange: str | Column, scheme: str | Column,
               scale2: bool = False) -> Column:
    """settlement - interchange - scheme in decimals; ``scale2`` casts to decimal(12,2) (trap #3)."""
    n = col_(settlement) - col_(interchange) - col_(scheme)
    return n.cast(AMT) if scale2 else n


def load_time() -> Column:
    """One clock value per statement, as TIMESTAMP_NTZ in the session zone."""
    return F.current_timestamp().cast("timestamp_ntz")


def cross_border(card_currency: str | Column, merchant_currency: str | Column) -> Column:
    """Card currency differs from merchant currency."""
    return col_(card_currency) != col_(merchant_currency)


def load_batch_time(event_ts: str | Column, jitter_key: str | Column) -> Column:
    """Next day 02:00 + pmod(xxhash64(key), 3601) seconds (P21, generator flavour)."""
    secs = F.pmod(F.xxhash64(col_(jitter_key)), F.lit(3601)) + 26 * 3600
    return F.timestamp_add("SECOND", secs, F.date_trunc("DAY", col_(event_ts)))


def minus_minutes(ts: str | Column, minutes: int) -> Column:
    """DATEADD('minute', -n, ts)."""
    return col_(ts) - F.make_dt_interval(mins=F.lit(minutes))

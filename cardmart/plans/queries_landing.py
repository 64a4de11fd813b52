"""Landing of a given table through CSV files (S01, S02, S15) and the check of their headers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.schemas import RAW_GATEWAY_LOG
from cardmart.session import checkpoint_root
from cardmart.sources import csv_landing as L, driver_tables as DT
from cardmart.sources.headers import header_check

NAMES = RAW_GATEWAY_LOG.names


def _folder(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/landing/{uuid.uuid4().hex}"


@query("s02_landing", with_views(f"SELECT {', '.join(NAMES)} FROM raw_gateway_log", "raw_gateway_log"))
def s02(spark, sf_dir):
    """The gateway log written as CSV and landed again with its declared types, every row and value."""
    path = _folder(spark)
    L.write_csv(DT.raw_gateway_log(spark, sf_dir), path, NAMES)
    return L.load_csv(spark, path, RAW_GATEWAY_LOG)


#: Layouts in which the table is landed: columns in the order of the file.
LAYOUTS = {
    "same": NAMES,
    "missing": [n for n in NAMES if n != "scheme_fee"],
    "extra": [*NAMES, "note"],
    "swapped": [NAMES[1], NAMES[0], *NAMES[2:]],
    "mistyped": NAMES,
}


def _layout_rows() -> list[tuple]:
    out = []
    for layout, columns in LAYOUTS.items():
        for i, n in enumerate(columns):
            status = ("extra" if n not in NAMES else "out_of_order" if NAMES.index(n) != i
                      else "wrong_type" if layout == "mistyped" and n == "settlement_amount" else "match")
            out.append((layout, i, n, n if n in NAMES else None, status))
        out += [(layout, None, None, n, "missing") for n in NAMES if n not in columns]
    return out


def _layout_sql() -> str:
    lit = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"
    rows = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in _layout_rows())
    return f"""SELECT layout, CAST(position AS INTEGER) AS position, header_name, schema_name, status,
  (SELECT count(*) FROM raw_gateway_log) > 0 AS has_rows FROM (VALUES {rows}) v(layout, position, header_name, schema_name, status)"""


@query("s06_header_check", with_views(_layout_sql(), "raw_gateway_log"))
def s06(spark, sf_dir):
    """The gateway log landed whole in five layouts, as gzip files; every column of every file is judged, files of a layout alike."""
    path = _folder(spark)
    rows = DT.raw_gateway_log(spark, sf_dir).withColumn("note", F.lit("x"))
    for layout, columns in LAYOUTS.items():
        out = rows.withColumn("settlement_amount", F.lit("twelve")) if layout == "mistyped" else rows
        L.write_csv(out, f"{path}/{layout}", columns, compression="gzip", level="THREE")  # a third less time than the usual level, a seventh more bytes
    layout = F.regexp_extract("file_path", r"/([a-z]+)/[^/]*$", 1)
    return header_check(spark, path, RAW_GATEWAY_LOG).groupBy(
        layout.alias("layout"), "position", "header_name", "schema_name", "status").agg((F.count(F.lit(1)) > 0).alias("has_rows"))

"""Path access to semi-structured values (P18) with Spark's VARIANT type.

A path is written as in ``payload:items[0].tags[1]::string``: the column, a colon, steps by name or
``[position]``, and optionally the type to cast to.  An array in the column itself is read as in
``answers[0]:score::double``.  A step that is not there, or a value that does not
cast, gives NULL.  Names that are no plain words go into quotes: ``payload:"odd name"[0]``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

_STEP = r'(?:\w+|"[^"]+")'
_PATH = re.compile(rf'(?P<column>\w+)(?P<first>(?:\[\d+\])*)(?::(?P<steps>{_STEP}(?:\.{_STEP}|\[\d+\])*))?(?:::(?P<type>[\w(), ]+))?')


def json(text: str | Column) -> Column:
    """Text as a variant; text that is no JSON is NULL."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def path(expression: str) -> Column:
    """The value at a path; without a type it stays a variant."""
    found = _PATH.fullmatch(expression.strip())
    if found is None or not (found["first"] or found["steps"]):
        raise ValueError(f"not a path: {expression}")
    steps = found["first"] + re.sub(r'\."([^"]+)"', r'["\1"]', "." + found["steps"] if found["steps"] else "")
    return F.try_variant_get(F.col(found["column"]), "$" + steps, found["type"] or "variant")


def elements(df: DataFrame, variant: str, prefix: str = "") -> DataFrame:
    """One row for each element of the array (or field of the object) in a variant column: pos, key, value.

    Rows whose value is NULL, or no array or object, have no elements.
    """
    view = f"__elements_{id(df):x}"
    df.createOrReplaceTempView(view)
    try:
        return df.sparkSession.sql(f"SELECT t.*, e.pos AS {prefix}pos, e.key AS {prefix}key, e.value AS {prefix}value "
                                   f"FROM {view} t, LATERAL variant_explode(t.`{variant}`) e")
    finally:
        df.sparkSession.catalog.dropTempView(view)

"""Batch text function with safe failure.

``ai_map`` is the plug-in point for any external scorer or model:

1. pre-flight: estimate the token volume of the *distinct* inputs (T06) as one
   aggregate and refuse to run above a budget (the cost gate);
2. distinct inputs only cross into Python -- each text once, however many
   rows repeat it -- keyed by a SHA-256 of the text;
3. ``mapInPandas`` calls the function per input inside Arrow batches; a
   failing input yields ``ok=false`` and its error instead of failing the
   task (the "try" variant);
4. the JSON answer is parsed JVM-side with ``from_json`` into the declared
   schema and joined back to every row by the hash.  A hot input (one text
   on a third of the rows) is one row on the result side; AQE splits the
   skewed partition of the row side.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmart.functions.text import token_count


class BudgetExceeded(RuntimeError):
    pass


def ai_map(df: DataFrame, fn: Callable[[str], str], in_col: str, out_schema: str,
           result_col: str = "ai_result", max_input_tokens: int | None = None) -> DataFrame:
    """Apply ``fn(text) -> JSON text`` (an object; anything else is an error) to ``df[in_col]``; adds ``result_col`` as
    ``struct<ok, value: out_schema, error>``."""
    keyed = df.withColumn("_h", F.sha2(F.col(in_col), 256))
    inputs = keyed.select("_h", in_col).filter(F.col("_h").isNotNull()).dropDuplicates(["_h"])
    if max_input_tokens is not None:
        est = inputs.agg(F.sum(token_count(in_col))).first()[0] or 0
        if est > max_input_tokens:
            raise BudgetExceeded(f"{est} input tokens exceed the budget of {max_input_tokens}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raws, errs = [], []
            for text in pdf[in_col]:
                try:
                    raw = fn(text)
                    if not isinstance(json.loads(raw), dict):
                        raise ValueError("answer is not a JSON object")
                    raws.append(raw)
                    errs.append(None)
                except Exception as e:  # noqa: BLE001 -- one bad row must not abort the batch
                    raws.append(None)
                    errs.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"_h": pdf["_h"], "_raw": raws, "_err": errs})

    answered = inputs.mapInPandas(run, "_h string, _raw string, _err string")
    result = answered.select("_h", F.struct(
        F.col("_err").isNull().alias("ok"),
        F.from_json("_raw", out_schema, {"mode": "PERMISSIVE"}).alias("value"),
        F.col("_err").alias("error")).alias(result_col))
    return keyed.join(result, "_h", "left").drop("_h")


# --- a deterministic stand-in scorer (no model available offline) -------------------------------

_SEVERE = {"fraud", "fraudulent", "stolen", "unauthorized", "chargeback", "never", "refused",
           "damaged"}


def keyword_triage_json(text: str) -> str:
    """Triage a memo as JSON text; fails on empty input (exercises the safe path)."""
    if text is None or not text.strip():
        raise ValueError("empty memo")
    import re
    hits = sum(1 for w in re.findall(r"[a-z]+", text.lower()) if w in _SEVERE)
    sev = "HIGH" if hits >= 3 else "MEDIUM" if hits >= 1 else "LOW"
    return json.dumps({"severity": sev, "refund_recommended": sev != "LOW",
                       "recommended_action": "Manual review"})

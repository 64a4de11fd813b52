"""Benchmark of the headline workloads.

Runs each workload on the test tables at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every result is forced with the ``noop`` sink (full computation, no collect);
each workload runs ``$BENCH_REPEAT`` times (default 3) after one warm-up of
the whole set, and the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="cardmart-bench-")

    from pyspark.sql import functions as F

    from cardmart.session import get_spark, shuffle_partitions_for
    input_bytes = sum(os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir))
    spark = get_spark(f"local[{cpus}]",
                      shuffle_partitions=shuffle_partitions_for(input_bytes, cores=int(cpus)),
                      extra_conf={"spark.driver.memory": "16g",
                                  # release broadcasts / shuffle files of finished workloads
                                  # (the default periodic driver GC is every 30 minutes)
                                  "spark.cleaner.periodicGC.interval": "30s",
                                  "spark.checkpoint.dir": f"{scratch}/ckpt",
                                  "spark.local.dir": f"{scratch}/local"})

    from cardmart.plans.catalog import QUERIES, load_all
    load_all()
    from cardmart.functions.text import token_count
    from cardmart.operators.upsert import merge_df
    from cardmart.plans import models as M
    from cardmart.sources import driver_tables as DT

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def upsert_delta(share: float):
        """Merge a delta (``share`` of the rows, amounts changed) into staging."""
        def run():
            stg = M.stg_transactions(DT.raw_transactions(spark, sf_dir))
            bucket = F.pmod(F.xxhash64("transaction_id"), F.lit(1000))
            src = stg.filter(bucket < int(share * 1000)).withColumn(
                "amount", (F.col("amount") + 1).cast("decimal(12,2)"))
            noop(merge_df(stg, src, "transaction_id", inserted_at=None, updated_at=None))
        return run

    def q(name):
        return lambda: noop(QUERIES[name](spark, sf_dir))

    workloads = {
        "d08_settlements": q("d08_settlements"),
        "d10_fact": q("d10_fact"),
        "a02_fact_summary": q("a02_fact_summary"),
        "u01_upsert_10pct": upsert_delta(0.10),
        "u01_upsert_empty": upsert_delta(0.0),
        "q04_suite": q("q04_suite"),
        "t06_tokens_documents": lambda: noop(
            DT.read(spark, sf_dir, "documents").select("doc_id", token_count("text").alias("n"))),
        "t07_classify_documents": q("t07_classify_described"),
        "t08_eval": q("t08_eval"),
        "v04_topk": q("v04_topk"),
        "v06_pairs_exact": q("j07_pairs"),
        "t11_agg": q("t11_agg"),
    }
    # Landing of generated CSV files (the files are written once, untimed).
    from cardmart.schemas import RAW_SCHEMAS
    from cardmart.sources import csv_landing as L
    from cardmart.sources import generate as G
    gen_rows = int(os.environ.get("BENCH_GEN_ROWS", "200000"))
    params = G.GenParams(rows=gen_rows, merchants=600, cards=8000, disputes=2000)
    landing = f"{scratch}/landing"
    only = os.environ.get("BENCH_ONLY")
    if not only or re.search(only, "s02_csv_landing"):
        G.write_landing_files(G.generate(spark, params), landing)

    def land_all():
        for n, schema in RAW_SCHEMAS.items():
            noop(L.load_csv(spark, f"{landing}/{n}", schema))

    def generate_all():
        for df in G.generate(spark, params).values():
            noop(df)

    workloads["s02_csv_landing"] = land_all
    workloads["g01_g05_generate"] = generate_all

    if only:
        workloads = {k: v for k, v in workloads.items() if re.search(only, k)}

    for fn in workloads.values():  # warm-up: JIT, parquet footers, Python workers
        fn()
    times: dict[str, float] = {}
    for name, fn in workloads.items():
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(sf.group(1)) if sf else sf_dir,
                      "cpus": int(cpus), "repeat": repeat, "generated_rows": gen_rows}))
    spark.stop()


if __name__ == "__main__":
    main()

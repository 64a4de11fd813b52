"""Header check: statuses, odd files, and bytes read."""

import gzip
import os
import tempfile
from pathlib import Path

from pyspark.sql import functions as F, types as T

from cardmart.sources.headers import BLOCK, first_lines, header_check, heads

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("at", T.DateType())])


def test_statuses_and_odd_files(spark, scratch):
    files = {"same.csv": "id,name,at\n1,x,2024-01-01\n", "empty.csv": "", "header.csv": "id,name,at\n", "bom.csv": "﻿id,name,at\r\n2,y,\r\n",
             "swap.csv": "name,id,at\nx,1,2024-01-01\n", "more.csv": 'id,name,at,"odd, name"\n1,"a\nb",2024-01-01,z\n', "less.csv": "id,at\n1,2024-01-01\n",
             "type.csv": "id,name,at\nNULL,x,someday\n"}
    for name, text in files.items():
        with open(f"{scratch}/{name}", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    with gzip.open(f"{scratch}/packed.csv.gz", "wt") as f:
        f.write("id,name,at\nfive,x,2024-01-01\n" + "6,y,2024-01-01\n" * 20_000)
    got = {}
    for r in header_check(spark, scratch, SCHEMA).collect():
        got.setdefault(os.path.basename(r["file_path"]), set()).add((r["position"], r["header_name"], r["schema_name"], r["status"]))
    match = {(0, "id", "id", "match"), (1, "name", "name", "match"), (2, "at", "at", "match")}
    assert got == {  # a file without any byte is not listed
        "same.csv": match, "header.csv": match, "bom.csv": match,
        "swap.csv": {(0, "name", "name", "out_of_order"), (1, "id", "id", "out_of_order"), (2, "at", "at", "match")},
        "more.csv": match | {(3, "odd, name", None, "extra")},
        "less.csv": {(0, "id", "id", "match"), (1, "at", "at", "out_of_order"), (None, None, "name", "missing")},
        "type.csv": {(0, "id", "id", "match"), (1, "name", "name", "match"), (2, "at", "at", "wrong_type")},
        "packed.csv.gz": {(0, "id", "id", "wrong_type"), (1, "name", "name", "match"), (2, "at", "at", "match")}}


def test_bytes_read_do_not_grow_with_the_file(spark, scratch):
    for k, n in enumerate((10, 100_000)):
        with open(f"{scratch}/{k}.csv", "w") as f:
            f.write("id,name,at\n" + "1,some name,2024-01-01\n" * n)
    assert all(r["bytes_read"] <= BLOCK for r in heads(spark, scratch).collect())
    assert first_lines(f"{scratch}/1.csv")[0] == ["id,name,at", "1,some name,2024-01-01"]


def test_layouts_are_landed_packed(spark, monkeypatch):
    from cardmart.plans import queries_landing as Q
    from cardmart.schemas import RAW_GATEWAY_LOG
    folder = f"{tempfile.mkdtemp()}/landing"
    rows = spark.createDataFrame([tuple(None for _ in RAW_GATEWAY_LOG)], RAW_GATEWAY_LOG).withColumn("gateway_log_id", F.lit("g1"))
    monkeypatch.setattr(Q, "_folder", lambda spark: folder)
    monkeypatch.setattr(Q.DT, "raw_gateway_log", lambda spark, sf_dir: rows)
    found = Q.s06(spark, "").collect()
    assert {r["layout"] for r in found} == set(Q.LAYOUTS) and all(r["has_rows"] for r in found)
    files = [p for p in Path(folder).rglob("part-*")]
    assert len(files) >= len(Q.LAYOUTS) and all(p.name.endswith(".csv.gz") for p in files)

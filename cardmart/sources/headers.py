"""Header check of landed CSV files that reads the first lines only.

Spark lists the files (its binary source, without their contents); each task opens its files and reads
blocks of ``BLOCK`` bytes until the header and one row are there.  So the bytes read follow the number
of files and the width of a row, not the size of the files.  Gzip files are unpacked as far as needed.

Status of a column: ``match`` (same name and place), ``out_of_order`` (in both, at different places), ``missing``
(declared, not in the header), ``extra`` (in the header, not declared), ``wrong_type`` (a match whose value in
the first row does not convert to the declared type).  A file with a header only has no value to convert.
Spark's sources do not list files without any byte, so these have no rows here (nor when loaded).
"""

from __future__ import annotations

import csv
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cardmart.sources.csv_landing import NULL_TOKENS

BLOCK = 8192


def _open(path: str):
    from urllib.parse import unquote, urlparse

    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream(path, compression=None)
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream(unquote(urlparse(path).path), compression=None)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner, compression=None)


def first_lines(path: str, lines: int = 2) -> tuple[list[str], int]:
    """The first lines of a file, and the bytes read for them.  Line breaks inside quotes do not end a line."""
    unpack = zlib.decompressobj(31) if path.endswith(".gz") else None
    held, read = b"", 0
    with _open(path) as source:
        while True:
            block = source.read(BLOCK)
            read += len(block)
            held += unpack.decompress(block) if unpack else block
            ends, quoted = [], False
            for at, c in enumerate(held):
                if c == 0x22:
                    quoted = not quoted
                elif c == 0x0A and not quoted:
                    ends.append(at)
                    if len(ends) == lines:
                        break
            if len(ends) == lines or not block:
                break
    cuts = [0, *[e + 1 for e in ends]]
    out = [held[a:b].decode("utf-8", "replace").rstrip("\r\n") for a, b in zip(cuts, [*ends, len(held)])]
    return [x.lstrip("﻿") for x in out if x][:lines], read


def heads(spark: SparkSession, path: str) -> DataFrame:
    """file_path, header and sample (arrays of fields) and bytes_read of every file below a path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for p in b["path"].to_pylist():
                lines, read = first_lines(p)
                fields = [[x.strip() for x in row] for row in csv.reader(lines)]
                out.append({"file_path": p, "header": fields[0] if fields else [], "sample": fields[1] if len(fields) > 1 else None, "bytes_read": read})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("file_path", pa.string()), ("header", pa.list_(pa.string())), ("sample", pa.list_(pa.string())), ("bytes_read", pa.int64())])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").load(path).select("path")
    return files.mapInArrow(run, "file_path string, header array<string>, sample array<string>, bytes_read long")


def header_check(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """file_path, position (in the header; of a missing column: null), header_name, schema_name, status."""
    declared = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(i).alias("at")) for i, f in enumerate(schema.fields)])
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    found = heads(spark, path)
    empty = F.lit(None).cast("string")
    listed = F.transform("header", lambda h, i: F.struct(i.alias("position"), h.alias("header_name"), F.when(F.array_contains(names, h), h).alias("schema_name"),
                                                         F.get("sample", i).alias("value")))
    absent = F.transform(F.filter(declared, lambda d: ~F.array_contains("header", d["name"])), lambda d: F.struct(
        F.lit(None).cast("int").alias("position"), empty.alias("header_name"), d["name"].alias("schema_name"), empty.alias("value")))
    rows = found.select("file_path", F.inline(F.concat(listed, absent)))
    bad = F.lit(False)
    place = F.lit(None).cast("int")
    for i, f in enumerate(schema.fields):
        here = F.col("schema_name") == f.name
        place = F.when(here, F.lit(i)).otherwise(place)
        if not isinstance(f.dataType, T.StringType):
            bad = F.when(here, F.col("value").try_cast(f.dataType).isNull()).otherwise(bad)
    status = (F.when(F.col("position").isNull(), "missing").when(F.col("schema_name").isNull(), "extra")
              .when(F.col("position") != place, "out_of_order")
              .when(F.col("value").isNotNull() & ~F.col("value").isin(*NULL_TOKENS) & bad, "wrong_type").otherwise("match"))
    return rows.select("file_path", "position", "header_name", "schema_name", status.alias("status"))

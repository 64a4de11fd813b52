"""CSV landing: typed positional loads, validation report, header diff, listing, CSV sink
(S01-S06, S15).

The landing file format: comma separated, one header line, optional ``"``
enclosure (a doubled quote inside), blanks trimmed, and two NULL tokens --
the empty field and the text ``NULL``.  Spark's CSV reader has a single
``nullValue`` and keeps a quoted empty string as ``""``, so every column is
read as a string first, the NULL tokens are mapped to NULL, and only then is
each column cast to its declared type with ANSI casts (a bad value fails the
load loudly instead of silently becoming NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKENS = ("", "NULL")
CORRUPT = "_corrupt_record"


def _string_schema(schema: T.StructType, corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType(), True) for f in schema.fields]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def read_strings(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                 mode: str = "FAILFAST", check_header: bool = True,
                 multi_line: bool = False) -> DataFrame:
    """Every column as a string, NULL tokens already mapped to NULL.

    ``multi_line`` allows line breaks inside quoted fields, at the price of
    one task per file (the file cannot be split).  Off by default: a quoted
    line break then yields a malformed row, which FAILFAST rejects loudly.
    """
    corrupt = mode == "PERMISSIVE"
    reader = (spark.read.schema(_string_schema(schema, corrupt))
              .option("header", True)
              .option("enforceSchema", not check_header)  # False: header must match names
              .option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
              .option("multiLine", multi_line)
              .option("mode", mode))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.csv(path if isinstance(path, str) else list(path))
    cols = [F.when(F.trim(F.col(f.name)).isin(*NULL_TOKENS), F.lit(None).cast("string"))
            .otherwise(F.trim(F.col(f.name))).alias(f.name) for f in schema.fields]
    if corrupt:
        cols.append(F.col(CORRUPT))
    return df.select(*cols, F.col("_metadata.file_path").alias("_file"))


def typed(df: DataFrame, schema: T.StructType, safe: bool = False) -> DataFrame:
    """Cast string columns to the declared types (ANSI cast; ``safe`` uses try_cast)."""
    def cast(f: T.StructField) -> Column:
        c = F.col(f.name)
        return (c.try_cast(f.dataType) if safe else c.cast(f.dataType)).alias(f.name)
    return df.select(*[cast(f) for f in schema.fields])


def load_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             partitions: int | None = None, multi_line: bool = False) -> DataFrame:
    """Typed positional load that aborts on the first bad row (FAILFAST + ANSI casts).

    Gzip files are read natively but are not splittable (one task per file):
    pass ``partitions`` to spread the rows before downstream work.
    """
    df = typed(read_strings(spark, path, schema, "FAILFAST", multi_line=multi_line), schema)
    return df.repartition(partitions) if partitions else df


def land(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, out_path: str,
         partitions: int | None = None, multi_line: bool = False) -> int:
    """Load and append to the raw parquet table; returns rows landed."""
    df = load_csv(spark, path, schema, partitions, multi_line)
    from pyspark.sql import Observation
    obs = Observation("landed")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(out_path)
    return int(obs.get["rows"])


def validation_report(spark: SparkSession, path: str | Sequence[str],
                      schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Rejected rows without loading anything -- (file, column, value, reason).

    Malformed lines (wrong field count, broken quoting) come from the reader's
    corrupt-record column; values that do not convert to the column's type
    are found with ``try_cast`` (non-NULL in, NULL out).  The files are read once.
    """
    s = read_strings(spark, path, schema, "PERMISSIVE", multi_line=multi_line)
    # the corrupt-record column may not be read alone: reference the parsed fields too
    raw_line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.col(f.name) for f in schema.fields]))

    def error(when: Column, column: Column, value: Column, reason: str) -> Column:
        return F.when(when, F.struct(column.alias("column_name"), value.alias("value"), F.lit(reason).alias("reason")))

    errors = [error(F.col(CORRUPT).isNotNull(), F.lit(None).cast("string"), raw_line, "malformed row")]
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = F.col(CORRUPT).isNull() & F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            errors.append(error(bad, F.lit(f.name), F.col(f.name), f"not a valid {f.dataType.simpleString()}"))
    return s.select("_file", F.inline(F.filter(F.array(*errors), lambda e: e.isNotNull())))


def header_diff(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header of every file vs. declared schema by position: match / renamed / missing /
    extra, and names present in both but at another position (out of order)."""
    expected = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
    # The first line of a file is the first row of its first block.
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"), "value").filter("start = 0")
    first = lines.groupBy("file_path").agg(F.min_by("value", "row").alias("line"))
    parts = F.split(F.ltrim(F.col("line"), F.lit("\ufeff")), ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    named = first.select("file_path", F.transform(parts, lambda x: F.trim(F.trim(x), F.lit('"'))).alias("header"),
                         expected.alias("expected"))
    last = F.greatest(F.size("header"), F.size("expected")) - 1
    j = named.select("*", F.explode(F.sequence(F.lit(0), last)).alias("position")).withColumns({
        "header_name": F.get("header", F.col("position")), "schema_name": F.get("expected", F.col("position"))})
    status = (F.when(F.col("header_name") == F.col("schema_name"), "match")
              .when(F.col("header_name").isNull(), "missing")
              .when(F.col("schema_name").isNull(), "extra")
              .when(F.array_contains("expected", F.col("header_name")), "out_of_order")
              .otherwise("renamed"))
    return j.select("file_path", "position", "header_name", "schema_name", status.alias("status")) \
        .orderBy("file_path", "position")


def list_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every file under a landing path with size, modification time and row count (0 if it holds
    a header only).  The listing itself reads no file contents; the counts read the rows."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(_string_schema(schema))
    counts = (reader.csv(path).groupBy(F.col("_metadata.file_path").alias("file_path"))
              .agg(F.count(F.lit(1)).alias("rows")))
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"))
    return (files.join(counts, "file_path", "left")
            .withColumn("rows", F.coalesce("rows", F.lit(0).cast("long"))).orderBy("file_path"))


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None,
              compression: str | None = None, level: str | None = None) -> None:
    """CSV with a header line and a fixed column order.  ``level`` of gzip: BEST_SPEED, TWO, ... BEST_COMPRESSION."""
    w = df.select(*(columns or df.columns)).write.mode("overwrite").option("header", True) \
        .option("quote", '"').option("escape", '"').option("nullValue", "")
    if compression:
        w = w.option("compression", compression)
    if level:
        w = w.option("zlib.compress.level", level)
    w.csv(path)

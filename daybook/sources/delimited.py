"""Delimited text feeds: ``;`` separator, header line, decimal comma.

Columns are read as text under their header names (no schema inference,
so all-digit keys keep leading zeros), then typed by the name-driven
lenient rule, then projected to the declared feed schema.  Splitting and
parsing are Spark's CSV scan: files are split across tasks, nothing passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.constants import DELIMITED_SEPARATOR
from daybook.functions.coerce import coerce_by_name
from daybook.functions.filenames import batch_date_from_name, file_name_of_row


def read_delimited_text(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    sep: str = DELIMITED_SEPARATOR,
    columns: list[str] | None = None,
) -> DataFrame:
    """All-text columns named by the header (or by ``columns`` when given)."""
    reader = spark.read.option("sep", sep).option("header", True).option("mode", "PERMISSIVE")
    # Each file's header is held against the columns: files of another order are refused, not misread.
    reader = reader.option("enforceSchema", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def conform(df: DataFrame, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Project to ``schema``: matching names are cast leniently, missing ones are NULL.

    ``keep`` columns are passed through unchanged after the schema columns.
    """
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        c = F.col(f"`{src}`") if src else F.lit(None)
        cols.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep)


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    decimal_comma: bool = True,
    with_batch_date: bool = False,
    require_columns: bool = False,
) -> DataFrame:
    # Text under the header's own names (no positional schema, no inference).
    raw = read_delimited_text(spark, path, glob=glob)
    lacking = {n.lower() for n in schema.names} - {c.lower() for c in raw.columns}
    if require_columns and lacking:
        raise ValueError(f"{path}: the header lacks {sorted(lacking)}")
    if not with_batch_date:
        return conform(coerce_by_name(raw, decimal_comma=decimal_comma), schema)
    # The file name is carried under a name the date rule does not touch.
    raw = raw.withColumn("_source_file", file_name_of_row())
    typed = conform(coerce_by_name(raw, decimal_comma=decimal_comma), schema, keep=["_source_file"])
    return typed.withColumn("batch_date", batch_date_from_name(F.col("_source_file"))).drop("_source_file")


def write_delimited(df: DataFrame, path: str, decimal_comma: bool = True, mode: str = "overwrite") -> None:
    """Write a feed in the same format (decimal comma for decimal columns)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType) and decimal_comma:
            c = F.regexp_replace(c.cast("string"), r"\.", ",")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.cast("string").alias(f.name))
    df.select(*cols).write.mode(mode).option("sep", DELIMITED_SEPARATOR).option("header", True).csv(path)

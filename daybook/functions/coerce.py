"""Lenient, name-driven type coercion of staged feeds.

A column whose lower-cased name contains ``date`` becomes a timestamp; a
column named ``amount`` becomes DECIMAL(10,2).  Values that do not parse
become NULL instead of failing the batch.  Everything is a JVM-side
expression (``try_*``), so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.constants import DECIMAL_COMMA

AMOUNT_TYPE = T.DecimalType(10, 2)


def lenient_amount(c: Column, decimal_comma: bool = True) -> Column:
    """Text -> DECIMAL(10,2); ``1234,56`` -> 1234.56, rounding half up, bad text -> NULL.

    The default CSV locale would read ``1234,56`` as 123456; parsing the text
    ourselves avoids that silent x100 error.
    """
    txt = F.trim(c.cast("string"))
    if decimal_comma:
        txt = F.regexp_replace(txt, DECIMAL_COMMA, ".")
    # Parse with headroom, then round to scale 2; values beyond 10 digits -> NULL.
    wide = txt.try_cast(T.DecimalType(38, 10))
    return wide.try_cast(AMOUNT_TYPE)


def lenient_timestamp(c: Column) -> Column:
    """Text or timestamp -> TIMESTAMP_NTZ, unparsable -> NULL."""
    return c.try_cast("timestamp_ntz")


def coerce_by_name(df: DataFrame, decimal_comma: bool = True) -> DataFrame:
    """Apply the name-driven rule to every column of ``df`` (one projection)."""
    cols = []
    for f in df.schema.fields:
        name = f.name
        c = F.col(f"`{name}`")
        if "date" in name.lower():
            c = lenient_timestamp(c)
        elif name == "amount":
            c = lenient_amount(c, decimal_comma)
        cols.append(c.alias(name))
    return df.select(*cols)

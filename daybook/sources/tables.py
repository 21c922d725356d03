"""History tables in the catalog, with column defaults, filled by inserts that name only some columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.constants import LIVE, OPEN_UNTIL

#: SQL defaults of a history's bookkeeping columns, for inserts that leave them out.
HISTORY_DEFAULTS = {"effective_to": f"TIMESTAMP_NTZ '{OPEN_UNTIL}'", "deleted_flg": str(LIVE)}


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str, defaults: dict[str, str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over ``location``; an older table of that name must have the same columns and defaults."""
    defaults = defaults or {}
    if unknown := set(defaults) - set(schema.names):
        raise ValueError(f"{name}: defaults of unknown columns {sorted(unknown)}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")
    there = spark.table(name).schema
    wanted = {f.name: (f.dataType, defaults.get(f.name)) for f in schema}
    if {f.name: (f.dataType, f.metadata.get("CURRENT_DEFAULT")) for f in there} != wanted:
        raise ValueError(f"{name} is there with other columns or defaults: {there.simpleString()}")


def insert_partial(rows: DataFrame, name: str) -> None:
    """``INSERT INTO name (columns of rows)``; the other columns take their defaults, or NULL where they have none."""
    view = f"daybook_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        columns = ", ".join(f"`{c}`" for c in rows.columns)
        rows.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        rows.sparkSession.catalog.dropTempView(view)

"""Declared schemas of the feeds, dimensions, history tables and report.

Schemas are declared, never inferred: all-digit keys (card numbers,
accounts, passports) must stay strings and keep leading zeros.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
NTZ = T.TimestampNTZType()
DATE = T.DateType()
AMOUNT = T.DecimalType(10, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Feeds ----------------------------------------------------------------------
TRANSACTIONS = _struct(
    ("transaction_id", T.LongType()),
    ("transaction_date", NTZ),
    ("amount", AMOUNT),
    ("card_num", S),
    ("oper_type", S),
    ("oper_result", S),
    ("terminal", S),
)
# As read from a delimited file before lenient coercion: every column text.
TRANSACTIONS_RAW = _struct(*[(f.name, S) for f in TRANSACTIONS.fields])

TERMINALS = _struct(
    ("terminal_id", S),
    ("terminal_type", S),
    ("terminal_city", S),
    ("terminal_address", S),
)
TERMINAL_KEYS = ["terminal_id"]
TERMINAL_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]

BLACKLIST = _struct(("date", NTZ), ("passport", S))
BLACKLIST_KEYS = ["passport"]

# Seed dimensions --------------------------------------------------------------
CARDS = _struct(("card_num", S), ("account", S), ("create_dt", DATE), ("update_dt", DATE))
ACCOUNTS = _struct(
    ("account", S), ("valid_to", DATE), ("client", S), ("create_dt", DATE), ("update_dt", DATE)
)
CLIENTS = _struct(
    ("client_id", S),
    ("last_name", S),
    ("first_name", S),
    ("patronymic", S),
    ("date_of_birth", DATE),
    ("passport_num", S),
    ("passport_valid_to", DATE),
    ("phone", S),
    ("create_dt", DATE),
    ("update_dt", DATE),
)

# History bookkeeping columns ---------------------------------------------------
HIST_COLS = ["effective_from", "effective_to", "deleted_flg"]

REP_FRAUD = _struct(
    ("event_dt", DATE),
    ("passport", S),
    ("fio", S),
    ("phone", S),
    ("event_type", S),
    ("report_dt", DATE),
)
REP_FRAUD_COLS = [f.name for f in REP_FRAUD.fields]


def empty_frame(spark, schema: T.StructType):
    """An empty DataFrame with size statistics (0 rows).

    ``createDataFrame([])`` is an RDD scan whose size the planner cannot
    estimate, which blocks broadcast decisions for everything joined to it.
    """
    from pyspark.sql import functions as F

    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def history_schema(keys: list[str], attrs: list[str], base: T.StructType) -> T.StructType:
    """Schema of an SCD2 history table built over ``keys + attrs`` of ``base``."""
    by_name = {f.name: f.dataType for f in base.fields}
    return _struct(
        ("id", T.LongType()),
        *[(c, by_name[c]) for c in keys + attrs],
        ("effective_from", NTZ),
        ("effective_to", NTZ),
        ("deleted_flg", T.IntegerType()),
    )

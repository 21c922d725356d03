"""The fixture contract: bank feeds derived from the driver's test tables.

The test data carries no bank tables, so clients, accounts, cards,
transactions, three terminal snapshots and three blacklist snapshots are
derived from ``customer``, ``supplier``, ``nation`` and ``events`` by a fixed
mapping (documented in FIXTURES.md).  The same mapping is written once as
DuckDB SQL for the oracle side (``daybook.plans.oracle``); here it is built
with the DataFrame API so that every derived row grows with the tables.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# --- fixed values: batch calendar of the fixture (date, tx window [lo, hi)) ---
BATCHES = {
    1: (_dt.date(2024, 1, 10), _dt.datetime(2024, 1, 1), _dt.datetime(2024, 1, 11)),
    2: (_dt.date(2024, 1, 20), _dt.datetime(2024, 1, 10), _dt.datetime(2024, 1, 21)),
    3: (_dt.date(2024, 2, 1), _dt.datetime(2024, 1, 20), _dt.datetime(2024, 2, 1)),
}
# ------------------------------------------------------------------------------


_TABLES: dict[tuple, DataFrame] = {}


@dataclass
class Fixtures:
    spark: SparkSession
    sf_dir: str

    def _read(self, table: str, *cols: str) -> DataFrame:
        # One listing/footer read per table and session; DataFrames are immutable.
        key = (id(self.spark), self.sf_dir, table)
        base = _TABLES.get(key)
        if base is None:
            base = _TABLES[key] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return base.select(*cols)

    # The mapping is written as SQL expressions over the DataFrames: it reads
    # like FIXTURES.md and costs one JVM call per expression to build.

    # dimensions ------------------------------------------------------------
    def clients(self) -> DataFrame:
        return self._read("customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").selectExpr(
            "'U' || c_custkey AS client_id",
            "c_name AS last_name",
            "c_mktsegment AS first_name",
            "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'P' || (c_custkey % 5) END AS patronymic",
            "CAST(NULL AS DATE) AS date_of_birth",
            "'PS' || c_custkey AS passport_num",
            "CASE WHEN c_custkey % 3 = 0 THEN NULL "
            "ELSE date_add(DATE '2024-01-05', CAST(c_custkey % 61 AS INT)) END AS passport_valid_to",
            "'T' || c_nationkey || '-' || c_custkey AS phone",
            "CAST(NULL AS DATE) AS create_dt",
            "CAST(NULL AS DATE) AS update_dt",
        )

    def accounts(self) -> DataFrame:
        return (
            self._read("customer", "c_custkey")
            .where("c_custkey % 31 <> 30")
            .selectExpr(
                "'A' || c_custkey AS account",
                "date_add(DATE '2024-01-10', CAST((c_custkey * 7) % 90 AS INT)) AS valid_to",
                "'U' || c_custkey AS client",
                "CAST(NULL AS DATE) AS create_dt",
                "CAST(NULL AS DATE) AS update_dt",
            )
        )

    def cards(self) -> DataFrame:
        # Two cards per user (n = 0, 1): a generator, not a cross join.
        return (
            self._read("events", "user_id")
            .distinct()
            .selectExpr("user_id", "explode(array(0, 1)) AS n")
            .where("(user_id + n) % 41 <> 40")
            .selectExpr(
                "'K' || user_id || '-' || n AS card_num",
                "'A' || user_id AS account",
                "CAST(NULL AS DATE) AS create_dt",
                "CAST(NULL AS DATE) AS update_dt",
            )
        )

    # feeds -----------------------------------------------------------------
    def transactions(self, batch: int | None = None) -> DataFrame:
        ev = self._read("events", "event_id", "ts", "user_id", "event_type", "value")
        if batch is not None:
            _, lo, hi = BATCHES[batch]
            ev = ev.where(f"ts >= TIMESTAMP_NTZ '{lo:%Y-%m-%d %H:%M:%S}' AND ts < TIMESTAMP_NTZ '{hi:%Y-%m-%d %H:%M:%S}'")
        n_terminals = self._read("supplier", "s_suppkey").select(F.count(F.lit(1)))
        return ev.select(
            "*", (F.col("event_id") % n_terminals.scalar()).alias("terminal_no")
        ).selectExpr(
            "event_id AS transaction_id",
            "CAST(ts AS TIMESTAMP_NTZ) AS transaction_date",
            "CAST(value AS DECIMAL(10,2)) AS amount",
            "'K' || user_id || '-' || (event_id % 2) AS card_num",
            "event_type AS oper_type",
            "CASE WHEN event_id % 9 = 0 THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result",
            "'S' || terminal_no AS terminal",
        )

    def terminals(self, day: int) -> DataFrame:
        s = self._read("supplier", "s_suppkey", "s_name", "s_nationkey")
        n = self._read("nation", "n_nationkey", "n_name")
        if day == 1:
            nation_key, drop, address = "s_nationkey", 9, "s_name"
        else:
            shift, drop = (1, 7) if day == 2 else (2, 8)
            nation_key = f"CASE WHEN s_suppkey % 10 = 3 THEN (s_nationkey + {shift}) % 25 ELSE s_nationkey END"
            address = "CASE WHEN s_suppkey % 10 = 5 THEN NULL ELSE s_name END"
        # nation is a 25-row code table: the join is planned as a broadcast by size.
        return (
            s.where(f"s_suppkey % 10 <> {drop}")
            .selectExpr("*", f"{nation_key} AS nation_key")
            .join(n, F.col("nation_key") == F.col("n_nationkey"), "inner")
            .selectExpr(
                "'S' || s_suppkey AS terminal_id",
                "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type",
                "n_name AS terminal_city",
                f"{address} AS terminal_address",
            )
        )

    def blacklist(self, day: int) -> DataFrame:
        keep = {
            1: "c_custkey % 13 = 0",
            2: "(c_custkey % 13 = 0 AND c_custkey % 2 = 0) OR c_custkey % 17 = 0",
            3: "c_custkey % 13 = 0 OR (c_custkey % 17 = 0 AND c_custkey % 3 <> 0)",
        }[day]
        return (
            self._read("customer", "c_custkey")
            .where(keep)
            .selectExpr(
                "CAST(date_add(DATE '2024-01-01', CAST(c_custkey % 20 AS INT)) AS TIMESTAMP_NTZ) AS date",
                "'PS' || c_custkey AS passport",
            )
        )


def batch_date(batch: int) -> _dt.date:
    return BATCHES[batch][0]

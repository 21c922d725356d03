"""Seed dimensions (cards, accounts, clients) with declared schemas.

The dimensions are loaded once by the initial load.  Any Spark-readable
format works; Parquet is the default.  Names follow the warehouse tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.plans.daily import Dimensions
from daybook.schemas import ACCOUNTS, CARDS, CLIENTS
from daybook.sources.delimited import conform

SEED_TABLES = {"dwh_dim_cards": CARDS, "dwh_dim_accounts": ACCOUNTS, "dwh_dim_clients": CLIENTS}


def read_seed(spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    df = spark.read.format(fmt).options(**options).load(path)
    return conform(df, SEED_TABLES[name])


def read_dimensions(spark: SparkSession, root: str, fmt: str = "parquet", **options) -> Dimensions:
    return Dimensions(
        cards=read_seed(spark, f"{root}/dwh_dim_cards", "dwh_dim_cards", fmt, **options),
        accounts=read_seed(spark, f"{root}/dwh_dim_accounts", "dwh_dim_accounts", fmt, **options),
        clients=read_seed(spark, f"{root}/dwh_dim_clients", "dwh_dim_clients", fmt, **options),
    )


def register_dimensions(dims: Dimensions) -> None:
    """Expose the dimensions under their warehouse names as temp views."""
    dims.cards.createOrReplaceTempView("dwh_dim_cards")
    dims.accounts.createOrReplaceTempView("dwh_dim_accounts")
    dims.clients.createOrReplaceTempView("dwh_dim_clients")

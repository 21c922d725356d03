"""Transaction enrichment: the card -> account -> client -> blacklist star.

The dimension chain is joined once, on the dimension side, into a
``card_holders`` table keyed by card number; the fact table then needs a
single join per dimension.  Left joins keep unknown cards, cards without an
account and accounts without a client, exactly as the chained left joins do
(left joins whose predicates reject NULLs on the inner side re-associate).

Join strategy is left to the planner: a dimension whose measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (and, at run time, AQE's
threshold) is broadcast; anything larger becomes a shuffle join, with AQE's
skew-join handling for hot card numbers.  No unconditional broadcast hints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.people import fio

HOLDER_COLS = [
    "card_num",
    "passport_num",
    "fio",
    "phone",
    "passport_valid_to",
    "account_valid_to",
    "blacklisted",
]


def card_holders(
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    blacklist_current: DataFrame | None = None,
) -> DataFrame:
    """card_num -> holder attributes (passport, name, phone, validity dates, blacklist flag)."""
    ca = cards.select("card_num", "account")
    ac = accounts.select("account", F.col("valid_to").alias("account_valid_to"), "client")
    cl = clients.select(
        F.col("client_id").alias("client"),
        "last_name",
        "first_name",
        "patronymic",
        "passport_num",
        "passport_valid_to",
        "phone",
    )
    holders = ca.join(ac, "account", "left").join(cl, "client", "left")
    if blacklist_current is not None:
        # Only membership matters; distinct keys keep the join from multiplying rows.
        listed = blacklist_current.select(F.col("passport").alias("passport_num")).distinct()
        holders = holders.join(listed.withColumn("blacklisted", F.lit(True)), "passport_num", "left")
    else:
        holders = holders.withColumn("blacklisted", F.lit(None).cast("boolean"))
    return holders.select(
        "card_num",
        "passport_num",
        fio().alias("fio"),
        "phone",
        "passport_valid_to",
        "account_valid_to",
        F.coalesce(F.col("blacklisted"), F.lit(False)).alias("blacklisted"),
    )


def terminal_cities(terminals_current: DataFrame) -> DataFrame:
    return terminals_current.select(F.col("terminal_id").alias("terminal"), "terminal_city")


def enrich_transactions(
    tx: DataFrame,
    holders: DataFrame,
    terminals_current: DataFrame | None = None,
) -> DataFrame:
    """Transactions with holder attributes (and the terminal's current city)."""
    out = tx.join(holders, "card_num", "left")
    if terminals_current is not None:
        out = out.join(terminal_cities(terminals_current), "terminal", "left")
    else:
        out = out.withColumn("terminal_city", F.lit(None).cast("string"))
    # Unknown cards: concat_ws over three NULL name parts is '' and the
    # black-list test ``passport IS NOT NULL`` is false in the chained form.
    return out.withColumn("fio", F.coalesce(F.col("fio"), F.lit(""))).withColumn(
        "blacklisted", F.coalesce(F.col("blacklisted"), F.lit(False))
    )

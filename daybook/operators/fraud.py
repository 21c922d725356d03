"""Fraud rules and the fraud report.

Static rules (first match wins): expired passport, passport in the black
list, invalid contract.  Velocity rule: more than one distinct city for one
passport within one clock hour.  The report is both, at day grain, without
duplicates.

Plans, at scale
---------------
* ``fraud_static``: narrow filter, then a hash DISTINCT on the flagged rows.
* ``fraud_different_cities``: one aggregation keyed by (passport, day, hour).
  "More than one distinct non-NULL city" is ``min(city) < max(city)``: a
  constant-size, map-side-combinable aggregate (``count(DISTINCT)`` would
  plan an extra exchange).  The (fio, phone) pairs of the group travel as a
  set whose size is bounded by the clients that share one passport, never by
  the number of transactions.  NULL passports are filtered before the
  shuffle (they are never flagged), removing the one certain hot key.
* ``rep_fraud``: both rule families in the *same* aggregation, so the fact
  table is scanned and joined once and shuffled once (after map-side
  combine); people and hits travel in one set, groups without an event are
  dropped before anything is made of their sets, and a small DISTINCT over
  the flagged output gives day grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.constants import (
    EVENT_BLACKLISTED,
    EVENT_DIFFERENT_CITIES,
    EVENT_EXPIRED_PASSPORT,
    EVENT_INVALID_CONTRACT,
)
from daybook.functions.dates import contract_ended, passport_expired
from daybook.schemas import REP_FRAUD_COLS


def static_event_type(
    ts: str = "transaction_date",
    passport_valid_to: str = "passport_valid_to",
    blacklisted: str = "blacklisted",
    account_valid_to: str = "account_valid_to",
) -> Column:
    """The static rule label of one enriched row, NULL when no rule fires."""
    t = F.col(ts)
    return (
        F.when(passport_expired(F.col(passport_valid_to), t), F.lit(EVENT_EXPIRED_PASSPORT))
        .when(F.col(blacklisted), F.lit(EVENT_BLACKLISTED))
        .when(contract_ended(F.col(account_valid_to), t), F.lit(EVENT_INVALID_CONTRACT))
    )


def _report_row(day: Column, passport: Column, fio: Column, phone: Column, event: Column) -> list[Column]:
    return [
        day.alias("event_dt"),
        passport.alias("passport"),
        fio.alias("fio"),
        phone.alias("phone"),
        event.alias("event_type"),
        day.alias("report_dt"),
    ]


def fraud_static(enriched: DataFrame, only: str | None = None) -> DataFrame:
    """Rows of the report produced by the static rules (optionally one label)."""
    tagged = enriched.select(
        F.to_date("transaction_date").alias("day"),
        "passport_num",
        "fio",
        "phone",
        static_event_type().alias("event_type"),
    ).filter(F.col("event_type").isNotNull())
    if only is not None:
        tagged = tagged.filter(F.col("event_type") == F.lit(only))
    return tagged.select(
        *_report_row(F.col("day"), F.col("passport_num"), F.col("fio"), F.col("phone"), F.col("event_type"))
    ).distinct()


def _hour_groups(enriched: DataFrame, with_static: bool) -> DataFrame:
    """One row per (passport, day, clock hour) with the city range and people.

    ``with_static``: a person is there once for each static label of theirs, NULL included.
    """
    cols = [
        "passport_num",
        F.to_date("transaction_date").alias("tx_day"),
        F.hour("transaction_date").alias("tx_hour"),
        "terminal_city",
        F.struct("fio", "phone", *([static_event_type().alias("event_type")] if with_static else [])).alias("person"),
    ]
    aggs = [
        F.min("terminal_city").alias("city_lo"),
        F.max("terminal_city").alias("city_hi"),
        F.collect_set("person").alias("people"),
    ]
    return enriched.select(*cols).groupBy("passport_num", "tx_day", "tx_hour").agg(*aggs)


def _city_flag() -> Column:
    # NULL passport or NULL time never forms a group of its own in the rule.
    return (
        F.col("passport_num").isNotNull()
        & F.col("tx_day").isNotNull()
        & (F.col("city_lo") < F.col("city_hi"))
    )


def fraud_different_cities(enriched: DataFrame) -> DataFrame:
    """Report rows for passports seen in more than one city within a clock hour."""
    base = enriched.filter(F.col("passport_num").isNotNull() & F.col("transaction_date").isNotNull())
    flagged = _hour_groups(base, with_static=False).filter(_city_flag())
    person = F.explode("people").alias("p")
    return (
        flagged.select("tx_day", "passport_num", person)
        .select(
            *_report_row(
                F.col("tx_day"),
                F.col("passport_num"),
                F.col("p.fio"),
                F.col("p.phone"),
                F.lit(EVENT_DIFFERENT_CITIES),
            )
        )
        .distinct()
    )


def rep_fraud(enriched: DataFrame) -> DataFrame:
    """The fraud report (static rules and different cities) in one aggregation."""
    # Most groups are one person without a label in one city: the cheap test leaves them out first.
    eventful = _city_flag() | (F.size("people") > 1) | F.col("people")[0]["event_type"].isNotNull()
    people = (
        _hour_groups(enriched, with_static=True)
        .filter(eventful)
        .select("tx_day", "passport_num", F.when(_city_flag(), F.lit(EVENT_DIFFERENT_CITIES)).alias("cities"), F.explode("people").alias("p"))
    )
    events = F.filter(F.array("cities", "p.event_type"), lambda e: e.isNotNull())
    return (
        people.select("tx_day", "passport_num", "p.fio", "p.phone", F.explode(events).alias("event"))
        .select(*_report_row(F.col("tx_day"), F.col("passport_num"), F.col("fio"), F.col("phone"), F.col("event")))
        .distinct()
        .select(*REP_FRAUD_COLS)
    )


def rep_fraud_union(enriched: DataFrame) -> DataFrame:
    """The report as the union of the two rule families (reference shape)."""
    return fraud_static(enriched).unionByName(fraud_different_cities(enriched))

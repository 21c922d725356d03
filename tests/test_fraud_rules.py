"""Hand cases for the fraud rules (boundaries, priorities, NULLs)."""

from helpers import d, dims, rows, ts, tx_frame

from daybook.constants import (
    EVENT_BLACKLISTED,
    EVENT_DIFFERENT_CITIES,
    EVENT_EXPIRED_PASSPORT,
    EVENT_INVALID_CONTRACT,
)
from daybook.operators import fraud
from daybook.operators.enrich import card_holders, enrich_transactions
from daybook.schemas import BLACKLIST, TERMINALS

# client: (id, last, first, patronymic, passport, passport_valid_to, phone)
CLIENTS = [
    ("C1", "Ivanov", "Ivan", None, "P1", d("2024-01-10"), "+1"),
    ("C2", "Petrov", "Petr", "P.", "P2", None, "+2"),
    ("C3", "Sidorov", "Sid", "S.", "P3", d("2024-01-01"), "+3"),
    ("C4", None, None, None, "P4", None, "+4"),
]
ACCOUNTS = [
    ("A1", d("2030-01-01"), "C1"),
    ("A2", d("2024-01-10"), "C2"),
    ("A3", d("2024-01-01"), "C3"),
    ("A4", d("2030-01-01"), "C4"),
    ("A5", d("2024-01-01"), "NOBODY"),
]
CARDS = [("K1", "A1"), ("K2", "A2"), ("K3", "A3"), ("K4", "A4"), ("K5", "A5"), ("K6", None)]
TERMS = [("T1", "ATM", "Moscow", "a"), ("T2", "ATM", "Kazan", "b"), ("T3", "POS", None, "c"), ("T4", "POS", "Moscow", "d")]


def enriched(spark, tx, black=()):
    cl, ac, ca = dims(spark, CLIENTS, ACCOUNTS, CARDS)
    bl = spark.createDataFrame([(ts("2024-01-01T00:00:00"), p) for p in black], BLACKLIST).withColumnRenamed(
        "date", "effective_from"
    )
    holders = card_holders(ca, ac, cl, bl)
    terms = spark.createDataFrame(TERMS, TERMINALS)
    return enrich_transactions(tx_frame(spark, tx), holders, terms)


def static(spark, tx, black=()):
    return rows(fraud.fraud_static(enriched(spark, tx, black)), "passport", "event_type", "event_dt")


def test_passport_valid_through_end_of_day(spark):
    tx = [
        (1, ts("2024-01-10T23:59:59"), "K1", "T1"),
        (2, ts("2024-01-11T00:00:00"), "K1", "T1"),
    ]
    assert static(spark, tx) == [("P1", EVENT_EXPIRED_PASSPORT, d("2024-01-11"))]


def test_fraction_after_last_second_is_expired(spark):
    tx = [(1, ts("2024-01-10T23:59:59.500000"), "K1", "T1")]
    assert static(spark, tx) == [("P1", EVENT_EXPIRED_PASSPORT, d("2024-01-10"))]


def test_contract_ends_at_start_of_valid_to(spark):
    tx = [
        (1, ts("2024-01-10T00:00:00"), "K2", "T1"),
        (2, ts("2024-01-10T00:00:01"), "K2", "T1"),
    ]
    # NULL passport expiry never expires; the contract ends at midnight.
    got = rows(fraud.fraud_static(enriched(spark, tx)), "passport", "event_type", "event_dt")
    assert got == [("P2", EVENT_INVALID_CONTRACT, d("2024-01-10"))]


def test_rule_priority_first_match_wins(spark):
    # C3: passport expired, blacklisted and contract ended all at once.
    tx = [(1, ts("2024-01-05T12:00:00"), "K3", "T1")]
    assert static(spark, tx, black=["P3"]) == [("P3", EVENT_EXPIRED_PASSPORT, d("2024-01-05"))]
    tx = [(1, ts("2024-01-05T12:00:00"), "K2", "T1")]
    assert static(spark, tx, black=["P2"]) == [("P2", EVENT_BLACKLISTED, d("2024-01-05"))]


def test_null_transaction_time_can_still_be_blacklisted(spark):
    tx = [(1, None, "K2", "T1")]
    assert static(spark, tx, black=["P2"]) == [("P2", EVENT_BLACKLISTED, None)]


def test_unknown_card_and_missing_client(spark):
    # K5: account A5 has no client: contract ended, no passport; K6 has no account; K9 unknown.
    tx = [
        (1, ts("2024-01-05T12:00:00"), "K5", "T1"),
        (2, ts("2024-01-05T12:00:00"), "K6", "T1"),
        (3, ts("2024-01-05T12:00:00"), "K9", "T1"),
    ]
    got = rows(fraud.fraud_static(enriched(spark, tx)), "passport", "fio", "phone", "event_type")
    assert got == [(None, "", None, EVENT_INVALID_CONTRACT)]


def cities(spark, tx):
    return rows(fraud.fraud_different_cities(enriched(spark, tx)), "passport", "event_dt", "fio", "phone")


def test_two_cities_in_one_clock_hour(spark):
    tx = [(1, ts("2024-01-05T10:10:00"), "K4", "T1"), (2, ts("2024-01-05T10:50:00"), "K4", "T2")]
    assert cities(spark, tx) == [("P4", d("2024-01-05"), "", "+4")]


def test_clock_hour_boundary_is_not_a_sliding_window(spark):
    tx = [(1, ts("2024-01-05T10:59:00"), "K4", "T1"), (2, ts("2024-01-05T11:01:00"), "K4", "T2")]
    assert cities(spark, tx) == []


def test_same_city_and_null_city_do_not_count(spark):
    tx = [
        (1, ts("2024-01-05T10:10:00"), "K4", "T1"),
        (2, ts("2024-01-05T10:20:00"), "K4", "T4"),
        (3, ts("2024-01-05T10:30:00"), "K4", "T3"),
        (4, ts("2024-01-05T10:40:00"), "K4", "T99"),
    ]
    assert cities(spark, tx) == []


def test_null_passport_never_flagged(spark):
    tx = [(1, ts("2024-01-05T10:10:00"), "K9", "T1"), (2, ts("2024-01-05T10:50:00"), "K9", "T2")]
    assert cities(spark, tx) == []


def test_fused_report_equals_union_of_rules(spark):
    tx = [
        (1, ts("2024-01-05T10:10:00"), "K4", "T1"),
        (2, ts("2024-01-05T10:50:00"), "K4", "T2"),
        (3, ts("2024-01-05T10:50:00"), "K1", "T2"),
        (4, ts("2024-01-11T10:50:00"), "K1", "T1"),
        (5, ts("2024-01-11T10:55:00"), "K1", "T2"),
        (6, None, "K2", "T1"),
        (7, ts("2024-01-11T10:55:00"), "K5", "T2"),
        (8, ts("2024-01-11T10:56:00"), "K5", "T1"),
    ]
    e = enriched(spark, tx, black=["P2"])
    fused = rows(fraud.rep_fraud(e))
    union = rows(fraud.rep_fraud_union(e).select(*fraud.REP_FRAUD_COLS))
    assert fused == union
    kinds = {r[4] for r in fused}
    assert kinds == {EVENT_DIFFERENT_CITIES, EVENT_EXPIRED_PASSPORT, EVENT_BLACKLISTED, EVENT_INVALID_CONTRACT}


def test_report_of_shared_passports_and_missing_keys_carries_one_set(spark):
    """Three people of one passport in one hour, rows that no group may hold, and a plan with one set per group."""
    people = [(f"C{i}", name, "A", None, "P9", None, f"+{i}") for i, name in ((7, "One"), (8, "Two"), (9, "Three"))]
    cl, ac, ca = dims(
        spark,
        CLIENTS + people,
        ACCOUNTS + [(f"A{i}", d("2030-01-01"), f"C{i}") for i in (7, 8, 9)],
        CARDS + [(f"K{i}", f"A{i}") for i in (7, 8, 9)],
    )
    bl = spark.createDataFrame([(ts("2024-01-01T00:00:00"), "P2")], BLACKLIST).withColumnRenamed("date", "effective_from")
    tx = [
        (1, ts("2024-01-09T10:00:00"), "K7", "T1"),
        (2, ts("2024-01-09T10:30:00"), "K8", "T2"),
        (3, ts("2024-01-09T10:40:00"), "K9", "T3"),  # no city: in the group, and so flagged
        (4, ts("2024-01-09T11:00:00"), "K9", "T1"),  # the next hour: one city
        (5, ts("2024-01-09T10:00:00"), "K5", "T1"),  # no passport, contract ended
        (6, ts("2024-01-09T10:10:00"), "K5", "T2"),
        (7, ts("2024-01-09T10:10:00"), "K6", "T2"),
        (8, None, "K2", "T1"),  # no time: black list only
        (9, None, "K2", "T2"),
        (10, None, "K7", "T1"),
        (11, None, "K7", "T2"),
    ]
    e = enrich_transactions(tx_frame(spark, tx), card_holders(ca, ac, cl, bl), spark.createDataFrame(TERMS, TERMINALS))
    report = fraud.rep_fraud(e)
    assert rows(report, "event_dt", "passport", "phone", "event_type") == sorted(
        [(d("2024-01-09"), "P9", f"+{i}", EVENT_DIFFERENT_CITIES) for i in (7, 8, 9)]
        + [(d("2024-01-09"), None, None, EVENT_INVALID_CONTRACT), (None, "P2", "+2", EVENT_BLACKLISTED)],
        key=repr,
    )
    assert rows(report) == rows(fraud.rep_fraud_union(e).select(*fraud.REP_FRAUD_COLS))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("partial_collect_set(") == 1

"""SCD2 apply: reference quirks (all_versions) and invariants (open_only)."""

import datetime as dt

import pytest
from helpers import d, rows

from daybook.constants import CLOSE_ALL_VERSIONS, CLOSE_OPEN_ONLY, OPEN_UNTIL
from daybook.operators.scd2 import (
    empty_history,
    scd2_apply,
    scd2_current,
    snapshot_rejects,
    terminals_current,
)
from daybook.schemas import TERMINAL_ATTRS, TERMINAL_KEYS, TERMINALS

K, A = TERMINAL_KEYS, TERMINAL_ATTRS
D1, D2, D3 = d("2024-01-10"), d("2024-01-20"), d("2024-02-01")


def snap(spark, data):
    return spark.createDataFrame(data, TERMINALS)


def fold(spark, snaps, mode):
    h = empty_history(spark, K, A, TERMINALS)
    for day, s in snaps:
        h = scd2_apply(h, snap(spark, s), K, A, day, close=mode)
    return h


def close_of(day):
    return dt.datetime.combine(day, dt.time()) - dt.timedelta(seconds=1)


S1 = [("T1", "ATM", "Moscow", "a"), ("T2", "POS", "Kazan", "b"), ("T3", "ATM", "Omsk", "c")]
S2 = [("T1", "ATM", "Tver", "a"), ("T2", "POS", "Kazan", None)]  # T1 moved, T2 address -> NULL, T3 gone
S3 = [("T1", "ATM", "Perm", "a"), ("T2", "POS", "Kazan", None), ("T3", "ATM", "Omsk", "c")]  # T3 back


def test_reference_mode_restamps_every_version(spark):
    h = fold(spark, [(D1, S1), (D2, S2), (D3, S3)], CLOSE_ALL_VERSIONS)
    t1 = rows(h.filter("terminal_id = 'T1'"), "terminal_city", "effective_from", "effective_to")
    # Day 3 restamps the day-1 row too (closed on day 2 already): overlapping history.
    assert (("Moscow", dt.datetime(2024, 1, 10), close_of(D3))) in t1
    assert ("Tver", dt.datetime(2024, 1, 20), close_of(D3)) in t1


def test_reference_mode_keeps_returning_tombstone_open(spark):
    h = fold(spark, [(D1, S1), (D2, S2), (D3, S3)], CLOSE_ALL_VERSIONS)
    t3_open = rows(h.filter("terminal_id = 'T3' and effective_to = timestamp_ntz'2999-12-31 00:00:00'"), "deleted_flg")
    assert t3_open == [(0,), (1,)]


def test_reference_mode_misses_change_to_null(spark):
    h = fold(spark, [(D1, S1), (D2, S2)], CLOSE_ALL_VERSIONS)
    assert rows(terminals_current(h).filter("terminal_id = 'T2'"), "terminal_address") == [("b",)]


def test_open_only_sees_change_to_null_and_closes_tombstone(spark):
    h = fold(spark, [(D1, S1), (D2, S2), (D3, S3)], CLOSE_OPEN_ONLY)
    assert rows(terminals_current(h).filter("terminal_id = 'T2'"), "terminal_address") == [(None,)]
    t3 = rows(h.filter("terminal_id = 'T3'"), "deleted_flg", "effective_from", "effective_to")
    assert t3 == [
        (0, dt.datetime(2024, 1, 10), close_of(D2)),
        (0, dt.datetime(2024, 2, 1), OPEN_UNTIL),
        (1, dt.datetime(2024, 1, 20), close_of(D3)),
    ]


def _invariants(h):
    r = h.collect()
    by_key = {}
    for x in r:
        by_key.setdefault(x["terminal_id"], []).append(x)
    for key, versions in by_key.items():
        assert sum(v["effective_to"] == OPEN_UNTIL for v in versions) <= 1, key
        spans = sorted((v["effective_from"], v["effective_to"]) for v in versions)
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 < f2, (key, spans)


def test_open_only_invariants_and_current_equals_snapshot(spark):
    h = fold(spark, [(D1, S1), (D2, S2), (D3, S3)], CLOSE_OPEN_ONLY)
    _invariants(h)
    assert rows(terminals_current(h)) == rows(snap(spark, S3))


def test_open_only_apply_twice_is_apply_once(spark):
    h1 = fold(spark, [(D1, S1), (D2, S2)], CLOSE_OPEN_ONLY)
    h2 = scd2_apply(h1, snap(spark, S2), K, A, D2, close=CLOSE_OPEN_ONLY)
    assert rows(h1) == rows(h2)


def test_duplicate_and_null_keys(spark):
    s = [("T1", "ATM", "Moscow", "a"), ("T1", "ATM", "Moscow", "z"), (None, "POS", "Kazan", "b")]
    ref = fold(spark, [(D1, s)], CLOSE_ALL_VERSIONS)
    assert ref.count() == 3  # all inserted, as the reference does
    std = fold(spark, [(D1, s)], CLOSE_OPEN_ONLY)
    assert rows(std, "terminal_id", "terminal_address") == [("T1", "z")]
    assert snapshot_rejects(snap(spark, s), K).count() == 3


def test_blacklist_takes_effective_from_from_snapshot(spark):
    from daybook.schemas import BLACKLIST

    b = spark.createDataFrame([(dt.datetime(2024, 1, 3), "PS1")], BLACKLIST)
    h = scd2_apply(empty_history(spark, ["passport"], [], BLACKLIST), b, ["passport"], [], D1, from_col="date")
    assert rows(scd2_current(h), "passport", "effective_from") == [("PS1", dt.datetime(2024, 1, 3))]


@pytest.mark.parametrize("mode", [CLOSE_ALL_VERSIONS, CLOSE_OPEN_ONLY])
def test_ids_are_deterministic(spark, mode):
    a = fold(spark, [(D1, S1), (D2, S2)], mode)
    b = fold(spark, [(D1, S1), (D2, S2)], mode)
    assert rows(a) == rows(b)

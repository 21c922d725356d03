"""Property: SCD2 apply over random three-day snapshots (NULL and duplicate keys)
equals a plain replay of the original statement sequence (reference mode), and
keeps the open-only invariants."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.constants import CLOSE_ALL_VERSIONS, CLOSE_OPEN_ONLY, OPEN_UNTIL
from daybook.operators.scd2 import empty_history, scd2_apply

SCHEMA = "k string, a1 string, a2 string"
KEYS = st.sampled_from(["a", "b", "c", None])
VALS = st.sampled_from(["x", "y", None])
SNAP = st.lists(st.tuples(KEYS, VALS, VALS), max_size=5)
DAYS = [dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 2, 1)]


def _eq(a, b):
    return a is not None and b is not None and a == b


def replay_reference(snaps):
    """INSERT new / UPDATE close updated / INSERT updated / UPDATE close deleted / INSERT tombstones."""
    hist = []
    for day, snap in zip(DAYS, snaps):
        start = dt.datetime.combine(day, dt.time())
        close = start - dt.timedelta(seconds=1)
        cur = [h for h in hist if h[3] == OPEN_UNTIL and h[5] == 0]
        new = [s for s in snap if not any(_eq(s[0], c[0]) for c in cur)]
        dele = [c for c in cur if not any(_eq(s[0], c[0]) for s in snap)]
        upd = [
            s
            for s in snap
            for c in cur
            if _eq(s[0], c[0]) and any(x is not None and y is not None and x != y for x, y in zip(c[1:3], s[1:3]))
        ]
        hist += [(s[0], s[1], s[2], OPEN_UNTIL, start, 0) for s in new]
        upd_keys = {s[0] for s in upd}
        hist = [(h[0], h[1], h[2], close, h[4], h[5]) if h[0] is not None and h[0] in upd_keys else h for h in hist]
        hist += [(s[0], s[1], s[2], OPEN_UNTIL, start, 0) for s in upd]
        del_keys = {c[0] for c in dele}
        hist = [(h[0], h[1], h[2], close, h[4], h[5]) if h[0] is not None and h[0] in del_keys else h for h in hist]
        hist += [(c[0], c[1], c[2], OPEN_UNTIL, start, 1) for c in dele]
    return sorted(hist, key=repr)


def run(spark, snaps, mode):
    base = spark.createDataFrame([], SCHEMA)
    h = empty_history(spark, ["k"], ["a1", "a2"], base.schema)
    for day, snap in zip(DAYS, snaps):
        h = scd2_apply(h, spark.createDataFrame(snap, SCHEMA), ["k"], ["a1", "a2"], day, close=mode)
    out = h.select("k", "a1", "a2", "effective_to", "effective_from", "deleted_flg").collect()
    return sorted((tuple(r) for r in out), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snaps=st.lists(SNAP, min_size=3, max_size=3))
def test_reference_mode_equals_statement_replay(spark, snaps):
    assert run(spark, snaps, CLOSE_ALL_VERSIONS) == replay_reference(snaps)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snaps=st.lists(SNAP, min_size=3, max_size=3))
def test_open_only_invariants(spark, snaps):
    hist = run(spark, snaps, CLOSE_OPEN_ONLY)
    by_key = {}
    for k, a1, a2, eff_to, eff_from, flg in hist:
        assert k is not None
        by_key.setdefault(k, []).append((eff_from, eff_to, flg, a1, a2))
    for k, versions in by_key.items():
        assert sum(v[1] == OPEN_UNTIL for v in versions) <= 1
        spans = sorted(v[:2] for v in versions)
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 < f2
    # The current state is the last snapshot: one row per non-NULL key, the greatest attributes.
    last = {}
    for k, a1, a2 in snaps[-1]:
        if k is not None:
            last[k] = max(last.get(k, (a1, a2)), (a1, a2), key=lambda t: tuple((v is not None, v or "") for v in t))
    current = {k: (a1, a2) for k, a1, a2, eff_to, _, flg in hist if eff_to == OPEN_UNTIL and flg == 0}
    assert current == last


def _greatest(rows):
    """Spark's max(struct): field by field, NULL smallest."""
    return max(rows, key=lambda t: tuple((v is not None, v or "") for v in t[1:3]))


def replay_open_only(snaps):
    """Literal open-only form: NULL-safe compare, close open rows only, close returning tombstones."""
    hist = []
    for day, snap in zip(DAYS, snaps):
        start = dt.datetime.combine(day, dt.time())
        close = start - dt.timedelta(seconds=1)
        by_key = {}
        for r in snap:
            if r[0] is not None:
                by_key.setdefault(r[0], []).append(r)
        clean = [_greatest(v) for v in by_key.values()]
        cur = [h for h in hist if h[3] == OPEN_UNTIL and h[5] == 0]
        cur_keys = {c[0] for c in cur}
        new = [s for s in clean if s[0] not in cur_keys]
        dele = [c for c in cur if c[0] not in by_key]
        upd = [s for s in clean for c in cur if s[0] == c[0] and (s[1], s[2]) != (c[1], c[2])]
        upd_keys, del_keys, new_keys = {s[0] for s in upd}, {c[0] for c in dele}, {s[0] for s in new}
        hist = [
            (h[0], h[1], h[2], close, h[4], h[5])
            if h[3] == OPEN_UNTIL and (h[0] in upd_keys or h[0] in del_keys or (h[5] == 1 and h[0] in new_keys))
            else h
            for h in hist
        ]
        hist += [(s[0], s[1], s[2], OPEN_UNTIL, start, 0) for s in new + upd]
        hist += [(c[0], c[1], c[2], OPEN_UNTIL, start, 1) for c in dele]
    return sorted(hist, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snaps=st.lists(SNAP, min_size=3, max_size=3))
def test_open_only_equals_literal_replay(spark, snaps):
    assert run(spark, snaps, CLOSE_OPEN_ONLY) == replay_open_only(snaps)

"""Property: the one-join snapshot diff equals the three-join (reference) form,
also with NULL and duplicate keys, and so does the reference-mode apply."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators.diff import snapshot_diff

KEYS = st.sampled_from(["a", "b", "c", None])
VALS = st.sampled_from(["x", "y", None])
ROWS = st.lists(st.tuples(KEYS, VALS, VALS), max_size=6)


def brute(current, snapshot, null_safe):
    """Literal left-join / right-join / inner-join form, in plain Python."""

    def eq(a, b):
        return a is not None and b is not None and a == b

    def differ(c, s):
        pairs = list(zip(c[1:], s[1:]))
        if null_safe:
            return any(a != b for a, b in pairs)
        return any(a is not None and b is not None and a != b for a, b in pairs)

    new = [("NEW", *s) for s in snapshot if not any(eq(s[0], c[0]) for c in current)]
    deleted = [("DELETED", *c) for c in current if not any(eq(s[0], c[0]) for s in snapshot)]
    updated = [("UPDATED", *s) for s in snapshot for c in current if eq(s[0], c[0]) and differ(c, s)]
    return sorted(new + deleted + updated, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(current=ROWS, snapshot=ROWS, null_safe=st.booleans())
def test_one_join_diff_equals_three_joins(spark, current, snapshot, null_safe):
    schema = "k string, v1 string, v2 string"
    c = spark.createDataFrame(current, schema)
    s = spark.createDataFrame(snapshot, schema)
    got = snapshot_diff(c, s, ["k"], ["v1", "v2"], null_safe=null_safe).collect()
    got = sorted((tuple(r) for r in got), key=repr)
    assert got == brute(current, snapshot, null_safe)

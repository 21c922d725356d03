"""Plan shape and skew: the fused report shuffles once after map-side combine,
broadcasts dimensions only by size, and stays exact with a hot key."""

import contextlib
import io

from helpers import rows
from pyspark.sql import functions as F

from daybook.operators import fraud
from daybook.plans.catalog import fixture_enriched
from daybook.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_report_plan_combines_map_side_and_shuffles_once(spark):
    plan = plan_of(fraud.rep_fraud(fixture_enriched(Fixtures(spark, SF))))
    initial = plan.split("== Initial Plan ==")[-1] if "Initial Plan" in plan else plan
    agg_exchanges = [ln for ln in initial.splitlines() if "Exchange hashpartitioning(passport_num" in ln]
    assert len(agg_exchanges) == 1
    assert "partial_collect_set" in initial and "partial_min(terminal_city" in initial
    # Dimensions are written tables of measured size: broadcast, no exchange of the fact side.
    assert "BroadcastHashJoin" in initial
    assert "Exchange hashpartitioning(card_num" not in initial


def test_hot_passport_gives_the_same_report(spark):
    fx = Fixtures(spark, SF)
    tx = fx.transactions()
    # One card (hence one passport) carries a third of all transactions.
    hot = tx.withColumn(
        "card_num", F.when(F.col("transaction_id") % 3 == 0, F.lit("K1-0")).otherwise(F.col("card_num"))
    )
    e = fixture_enriched(fx, tx=hot)
    fused = rows(fraud.rep_fraud(e))
    union = rows(fraud.rep_fraud_union(e).select(*fraud.REP_FRAUD_COLS))
    assert fused == union
    assert any(r[1] == "PS1" and r[4] == "different cities" for r in fused)

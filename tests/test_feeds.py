"""Drop-folder routing and batch-date checks; zone independence."""

import datetime as dt
import os

import pytest
from helpers import rows

from daybook.schemas import BLACKLIST, TERMINALS, TRANSACTIONS
from daybook.sources.delimited import write_delimited
from daybook.sources.feeds import drop_batch_date, read_drop
from daybook.sources.workbook import write_minimal_xlsx


def _drop(spark, folder, stamp="10012024", tx_stamp=None):
    tx = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 10, 9), None, "K1", "pay", "OK", "T1")], TRANSACTIONS
    )
    write_delimited(tx, f"{folder}/transactions_{tx_stamp or stamp}.txt")
    bl = spark.createDataFrame([(dt.datetime(2024, 1, 3), "0001 000001")], BLACKLIST)
    write_delimited(bl, f"{folder}/passport_blacklist_{stamp}.txt")
    os.makedirs(folder, exist_ok=True)
    write_minimal_xlsx(
        f"{folder}/terminals_{stamp}.xlsx",
        [f.name for f in TERMINALS.fields],
        [["T1", "ATM", "Moscow", "a"], ["T2", "POS", "Kazan", "b"]],
    )
    with open(f"{folder}/readme.md", "w") as fh:
        fh.write("not a feed")


def test_read_drop_routes_feeds_by_name(spark, tmp_path):
    folder = str(tmp_path / "drop")
    _drop(spark, folder)
    feeds, d = read_drop(spark, folder)
    assert d == dt.date(2024, 1, 10)
    assert rows(feeds.terminals) == [("T1", "ATM", "Moscow", "a"), ("T2", "POS", "Kazan", "b")]
    assert rows(feeds.blacklist) == [(dt.datetime(2024, 1, 3), "0001 000001")]
    assert [r["transaction_id"] for r in feeds.transactions.collect()] == [1]


def test_mixed_batch_dates_are_refused(spark, tmp_path):
    folder = str(tmp_path / "mixed")
    _drop(spark, folder, stamp="10012024", tx_stamp="11012024")
    with pytest.raises(ValueError):
        drop_batch_date(spark, folder)


def test_results_do_not_depend_on_session_zone(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    base = rows(E.queries()["scd2_terminals_day3"](spark, sf))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        shifted = rows(E.queries()["scd2_terminals_day3"](spark, sf))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert shifted == base


def test_seed_dimensions_round_trip(spark, tmp_path):
    from daybook.sources.fixtures import Fixtures
    from daybook.sources.seeds import read_dimensions, register_dimensions

    fx = Fixtures(spark, "/root/testdata/sf0.001")
    root = str(tmp_path / "seeds")
    fx.cards().write.parquet(f"{root}/dwh_dim_cards")
    fx.accounts().write.parquet(f"{root}/dwh_dim_accounts")
    fx.clients().write.parquet(f"{root}/dwh_dim_clients")
    dims = read_dimensions(spark, root)
    register_dimensions(dims)
    assert rows(spark.table("dwh_dim_clients")) == rows(fx.clients())
    assert rows(dims.cards) == rows(fx.cards())
    assert [f.name for f in dims.accounts.schema.fields] == ["account", "valid_to", "client", "create_dt", "update_dt"]

"""The incoming folder as a stream: late, undated and incomplete files, crashes, several triggers."""

import datetime as dt

import pytest
from helpers import d, rows

from daybook.plans.daily import Dimensions
from daybook.plans.versioned import bank_warehouse
from daybook.schemas import BLACKLIST, TERMINALS, TRANSACTIONS
from daybook.sources.delimited import write_delimited
from daybook.sources.files import list_names
from daybook.sources.fixtures import Fixtures
from daybook.streaming import arrivals

DAY1, DAY2, DAY3 = d("2024-01-10"), d("2024-01-20"), d("2024-01-30")
WORDS = ("transactions", "terminals", "passport_blacklist")


@pytest.fixture
def bank(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001")

    class Bank:
        dims = Dimensions(fx.cards(), fx.accounts(), fx.clients())
        warehouse = bank_warehouse(spark, f"{tmp_path}/w")
        incoming, archive, quarantine = f"{tmp_path}/in", f"{tmp_path}/old", f"{tmp_path}/aside"

        def drop(self, date, ids, words=WORDS, suffix=""):
            tx = [(i, dt.datetime(2024, 1, 9, 10), None, "K1-0", "pay", "OK", "T1") for i in ids]
            feeds = (
                spark.createDataFrame(tx, TRANSACTIONS),
                spark.createDataFrame([("T1", "ATM", f"{date}", None)], TERMINALS),
                spark.createDataFrame([(dt.datetime(2024, 1, 3), "PS1")], BLACKLIST),
            )
            for word, feed in zip(WORDS, feeds, strict=True):
                if word in words:
                    write_delimited(feed, f"{self.incoming}/{word}_{date:%d%m%Y}{suffix}.txt")

        def drain(self):
            arrivals.arrival_stream(self.warehouse, self.dims, self.incoming, f"{tmp_path}/ck", self.archive, self.quarantine).awaitTermination()

        def take(self):
            return arrivals.take_arrivals(self.warehouse, self.dims, self.incoming, self.archive, self.quarantine)

        def ids(self):
            return sorted(r[0] for r in self.warehouse.read("transactions").collect())

        def aside(self):
            return rows(arrivals.quarantined(spark, self.quarantine), "reason", "batch_date", "name")

    return Bank()


def test_a_late_file_doesnt_stop_later_days(spark, bank):
    bank.drop(DAY1, [1])
    bank.drain()
    bank.drop(DAY1, [9], ["transactions"], "_late")
    bank.drop(DAY2, [1, 2])
    bank.drain()
    assert bank.ids() == [1, 2] and bank.warehouse.versions() == [1, 2]
    assert bank.aside() == [("late", DAY1, "transactions_10012024_late.txt")]
    bank.drop(DAY1, [8], ["transactions"], "_late")  # the same name again, and a stray one
    write_delimited(spark.createDataFrame([("T1", "ATM", "x", None)], TERMINALS), f"{bank.incoming}/terminals_99999999.txt")
    bank.drop(DAY3, [3])
    bank.drain()
    assert bank.ids() == [1, 2, 3]
    assert bank.aside() == [("late", DAY1, "transactions_10012024_late.txt")] * 2 + [("undated", None, "terminals_99999999.txt")]
    assert list_names(spark, bank.incoming) == [] and len(list_names(spark, bank.archive)) == 9


def test_an_incomplete_day_waits_and_holds_later_ones(spark, bank):
    bank.drop(DAY1, [1], ["transactions", "terminals"])
    bank.drop(DAY2, [2])
    bank.drain()
    assert bank.warehouse.versions() == [] and len(list_names(spark, bank.incoming)) == 5
    bank.drop(DAY1, [1], ["passport_blacklist"])
    bank.drain()
    assert bank.ids() == [1, 2] and list_names(spark, bank.incoming) == [] and bank.aside() == []


def test_files_read_but_not_moved_are_archived_by_the_next_pass(spark, bank, monkeypatch):
    bank.drop(DAY1, [1])

    def crash(*a):
        raise OSError("lost")

    moved = arrivals.move_into
    monkeypatch.setattr(arrivals, "move_into", crash)
    with pytest.raises(OSError, match="lost"):
        bank.take()
    monkeypatch.setattr(arrivals, "move_into", moved)
    assert bank.warehouse.versions() == [1] and len(list_names(spark, bank.incoming)) == 3
    bank.drop(DAY1, [9], ["transactions"], "_late")
    bank.drop(DAY2, [2])
    assert bank.take() == [DAY2]
    assert bank.ids() == [1, 2] and [a[2] for a in bank.aside()] == ["transactions_10012024_late.txt"]
    assert bank.take() == [] and len(list_names(spark, bank.archive)) == 6


def test_a_file_that_comes_while_a_day_runs_is_late_and_unread(spark, bank, monkeypatch):
    bank.drop(DAY1, [1])
    run = arrivals.run_day_versioned

    def meanwhile(*a, **kw):
        bank.drop(DAY1, [9], ["transactions"], "_b")
        return run(*a, **kw)

    monkeypatch.setattr(arrivals, "run_day_versioned", meanwhile)
    assert bank.take() == [DAY1]
    assert bank.ids() == [1] and bank.take() == [] and [a[2] for a in bank.aside()] == ["transactions_10012024_b.txt"]


def test_a_day_that_fails_stops_there_and_is_tried_again(spark, bank):
    bank.drop(DAY1, [1])
    bank.drop(DAY2, [2], ["transactions", "passport_blacklist"])
    write_delimited(spark.createDataFrame([("T1",)], "terminal_id string"), f"{bank.incoming}/terminals_20012024.txt")
    with pytest.raises(Exception, match="lacks"):
        bank.drain()
    assert bank.ids() == [1] and bank.warehouse.versions() == [1]
    write_delimited(spark.createDataFrame([("T1", "ATM", "Omsk", None)], TERMINALS), f"{bank.incoming}/terminals_20012024.txt")
    bank.drain()
    assert bank.ids() == [1, 2]

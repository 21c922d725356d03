"""Hours closed by the watermark, late rows in the ledger, repairs; against the batch counts."""

import datetime as dt

import pytest
from helpers import rows

from daybook.operators.enrich import enrich_transactions
from daybook.operators.windows import city_count_by_hour
from daybook.schemas import TRANSACTIONS
from daybook.sources.files import delete_path
from daybook.sources.delimited import write_delimited
from daybook.streaming import closed_hours
from daybook.streaming.drops import transaction_file_stream

HOLDERS = "card_num string, passport_num string, fio string, phone string, passport_valid_to date, account_valid_to date, blacklisted boolean"
PLACES = "terminal_id string, terminal_type string, terminal_city string, terminal_address string"


@pytest.fixture
def hours(spark, tmp_path):
    holders = spark.createDataFrame([(f"K{i}", f"P{i}", f"n{i}", "1", None, None, False) for i in range(3)], HOLDERS)
    places = spark.createDataFrame([(f"T{i}", "ATM", f"C{i}", None) for i in range(3)], PLACES)

    class Hours:
        root = f"{tmp_path}/h"
        sent, n = [], 0

        def drop(self, *rows_):
            """One file of (minutes after midnight, card, terminal)."""
            day = dt.datetime(2024, 1, 10)
            tx = [(len(self.sent) + i, None if m is None else day + dt.timedelta(minutes=m), None, f"K{c}", "pay", "OK", f"T{t}") for i, (m, c, t) in enumerate(rows_)]
            self.sent += tx
            self.n += 1
            write_delimited(spark.createDataFrame(tx, TRANSACTIONS).coalesce(1), f"{tmp_path}/in/transactions_{self.n:02d}012024.txt")

        def drain(self):
            stream = transaction_file_stream(spark, f"{tmp_path}/in", max_files=1).drop("batch_date")
            for q in closed_hours.start_closed_hours(stream, holders, places, self.root, f"{tmp_path}/ck"):
                q.awaitTermination()

        def counts(self):
            return rows(closed_hours.hours_now(spark, self.root).select("passport_num", "hour_group", "count_cities"))

        def batch(self):
            return rows(city_count_by_hour(enrich_transactions(spark.createDataFrame(self.sent, TRANSACTIONS), holders, places)))

        def late(self):
            return sorted(((r["run"], r["event_hour"].hour, r["passport_num"], r["n_counted"], r["n_there"], r["n_late"]) for r in closed_hours.ledger(spark, self.root).collect()), key=str)

    return Hours()


def test_late_rows_are_in_the_ledger_and_repair_their_hours(spark, hours):
    assert hours.counts() == [] and closed_hours.reconcile(spark, hours.root) == 0 and hours.late() == []
    hours.drop((5, 0, 0), (10, 0, 0), (20, 9, 1), (65, 1, 0), (None, 0, 1))  # card 9 is unknown: passport NULL
    hours.drop((300, 0, 0))  # closes the first hours
    hours.drop((305, 1, 0))
    hours.drain()
    assert closed_hours.reconcile(spark, hours.root) == 0 and hours.counts() == hours.batch()
    closed = rows(spark.read.parquet(f"{hours.root}/closed").select("event_hour", "passport_num", "n_rows"))
    assert [(h.hour, p, n) for h, p, n in closed] == [(0, "P0", 2), (0, None, 1), (1, "P1", 1)]
    hours.drop((30, 0, 2), (40, 9, 2), (50, 2, 0), (310, 1, 2))  # three late rows, one of them a new passport
    hours.drain()
    assert hours.counts() != hours.batch()
    assert closed_hours.reconcile(spark, hours.root) == 3
    assert hours.late() == [(1, 0, "P0", 2, 3, 1), (1, 0, "P2", 0, 1, 1), (1, 0, None, 1, 2, 1)]
    assert hours.counts() == hours.batch()
    hours.drop((31, 0, 1))
    hours.drop((700, 0, 0))
    hours.drain()
    hours.drop((720, 0, 0))
    hours.drain()
    assert closed_hours.reconcile(spark, hours.root) == 1 and hours.counts() == hours.batch()
    assert closed_hours.reconcile(spark, hours.root) == 0 and hours.counts() == hours.batch()
    # What was emitted stays as it was.
    again = rows(spark.read.parquet(f"{hours.root}/closed").where("event_hour < '2024-01-10 02:00:00'").select("event_hour", "passport_num", "n_rows"))
    assert again == closed


def test_a_replayed_reconciliation_gives_the_same(spark, hours):
    hours.drop((5, 0, 0))
    hours.drop((300, 0, 0))
    hours.drop((310, 0, 0))
    hours.drop((6, 0, 1))
    hours.drain()
    assert closed_hours.reconcile(spark, hours.root) == 1
    entered, counts = hours.late(), hours.counts()
    delete_path(spark, f"{hours.root}/reconciled")  # lost before its mark was written
    assert closed_hours.reconcile(spark, hours.root) == 1
    assert hours.late() == entered and hours.counts() == counts == hours.batch()

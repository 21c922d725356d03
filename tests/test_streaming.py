"""Stream = batch: the streamed results equal the batch operators once drained."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from helpers import rows  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stream_city_counts_equal_batch(spark):
    streamed = E.queries()["stream_city_count_by_hour"](spark, SF)
    batch = E.queries()["city_count_by_hour"](spark, SF)
    assert rows(streamed) == rows(batch)


def test_stream_unseen_equals_whole_table(spark):
    streamed = E.queries()["stream_transactions_unseen"](spark, SF)
    assert streamed.count() == spark.read.parquet(f"{SF}/events.parquet").count()
    assert streamed.select("transaction_id").distinct().count() == streamed.count()


def test_stream_drop_equals_batch_fold(spark):
    streamed = E.queries()["stream_daily_drop"](spark, SF)
    batch = E.queries()["daily_run_report"](spark, SF)
    assert rows(streamed) == rows(batch)


def test_dedupe_within_watermark_drops_near_repeats(spark, tmp_path):
    import datetime as dt

    from daybook.schemas import TRANSACTIONS
    from daybook.sources.delimited import write_delimited
    from daybook.streaming.drops import transaction_file_stream
    from daybook.streaming.unseen import dedupe_within_watermark

    rows_ = [(1, dt.datetime(2024, 1, 1, 10), None, "K", "pay", "OK", "T")] * 2 + [
        (2, dt.datetime(2024, 1, 1, 11), None, "K", "pay", "OK", "T")
    ]
    write_delimited(spark.createDataFrame(rows_, TRANSACTIONS), f"{tmp_path}/in/transactions_01012024.txt")
    stream = dedupe_within_watermark(transaction_file_stream(spark, f"{tmp_path}/in").drop("batch_date"), "1 hour")
    q = stream.writeStream.format("memory").queryName("dedupe_out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r[0] for r in spark.sql("select transaction_id from dedupe_out").collect()) == [1, 2]


def test_stream_different_cities_rule_equals_batch_rule(spark):
    streamed = E.queries()["stream_fraud_different_cities"](spark, SF)
    batch = E.queries()["fraud_different_cities"](spark, SF)
    assert rows(streamed) == rows(batch)


def test_drop_stream_is_incremental_and_archives_consumed_files(spark, tmp_path):
    import glob

    from daybook.plans.daily import Dimensions, StateRoots
    from daybook.sources.fixtures import Fixtures, batch_date
    from daybook.streaming.drops import daily_drop_stream, write_drop

    fx = Fixtures(spark, SF)
    base = str(tmp_path)
    inc = f"{base}/incoming"
    roots = StateRoots(f"{base}/t", f"{base}/b", f"{base}/x", f"{base}/r")
    dims = Dimensions(fx.cards(), fx.accounts(), fx.clients())

    def tx_files(p):
        return [f for f in glob.glob(p + "/**/*.csv", recursive=True) if "transaction" in f]

    for n in (1, 2):
        write_drop(inc, batch_date(n), fx.transactions(n), fx.terminals(n), fx.blacklist(n))
        q = daily_drop_stream(spark, inc, roots, dims, f"{base}/_ck", archive_dir=f"{base}/archive")
        q.awaitTermination()
    # Each run processed only its new drop; run 2 archived run 1's committed file.
    assert sorted(r[0] for r in spark.read.parquet(roots.report).select("batch_date").distinct().collect()) == [
        batch_date(1),
        batch_date(2),
    ]
    assert len(tx_files(f"{base}/archive")) == 1
    assert len(tx_files(inc)) == 1

import datetime as dt

from pyspark.sql import functions as F

from daybook.schemas import ACCOUNTS, CARDS, CLIENTS, TRANSACTIONS


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def frame(spark, schema, data):
    return spark.createDataFrame(data, schema)


def tx_frame(spark, data):
    """data: (id, ts, card, terminal)"""
    full = [(i, t, None, card, "pay", "SUCCESS", term) for i, t, card, term in data]
    return spark.createDataFrame(full, TRANSACTIONS)


def dims(spark, clients, accounts, cards):
    cl = spark.createDataFrame(
        [(c[0], c[1], c[2], c[3], None, c[4], c[5], c[6], None, None) for c in clients], CLIENTS
    )
    ac = spark.createDataFrame([(a[0], a[1], a[2], None, None) for a in accounts], ACCOUNTS)
    ca = spark.createDataFrame([(c[0], c[1], None, None) for c in cards], CARDS)
    return cl, ac, ca


def ntz(c):
    return F.col(c).cast("timestamp_ntz")

"""Registered queries: each Spark builder next to its DuckDB oracle.

Every builder takes ``(spark, sf_dir)``, reads the driver's tables through
the fixture mapping and returns a DataFrame over the *whole* tables.  The
fixture's current states: single-batch fraud queries stage the whole
``events`` table against the black list of day 1 and the terminals of day
3; SCD2 queries fold the three fixture days into an empty history.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.constants import (
    CLOSE_ALL_VERSIONS,
    CLOSE_OPEN_ONLY,
    EVENT_BLACKLISTED,
    EVENT_EXPIRED_PASSPORT,
    EVENT_INVALID_CONTRACT,
)
from daybook.operators import diff as D
from daybook.operators import fraud
from daybook.operators.enrich import card_holders, enrich_transactions
from daybook.operators.facts import unseen
from daybook.operators.scd2 import (
    blacklist_current,
    empty_history,
    scd2_apply,
    terminals_current,
)
from daybook.operators.windows import city_count_by_hour, first_tx_in_hour
from daybook.plans import oracle as O
from daybook.plans.daily import DailyFeeds, Dimensions, initial_state, run_days
from daybook.schemas import BLACKLIST, BLACKLIST_KEYS, TERMINAL_ATTRS, TERMINAL_KEYS, TERMINALS, history_schema
from daybook.sources.fixtures import Fixtures, batch_date
from daybook.sources.store import materialize
from daybook.sources.delimited import read_feed, write_delimited
from daybook.sources.feeds import read_drop
from daybook.sources.seeds import SEED_TABLES, read_dimensions, register_dimensions
from daybook.sources.staging import Staging
from daybook.sources.tables import HISTORY_DEFAULTS, create_table, insert_partial
from daybook.sources.workbook import read_workbooks, write_workbooks
from daybook.functions.coerce import coerce_by_name
from daybook.functions.filenames import batch_date_from_name
from daybook.operators.scd1 import scd1_upsert
from daybook.session import scratch_path, together
from daybook.schemas import REP_FRAUD_COLS, TRANSACTIONS
from daybook.plans.daily import StateRoots, run_day_stored
from daybook.plans.versioned import bank_warehouse, publish_current, run_day_versioned
from daybook.sources.store import ReportStore
from daybook.streaming.drops import daily_drop_stream, transaction_file_stream, write_drop
from daybook.streaming.city_hours import different_cities_from_counts, start_city_counts
from daybook.streaming.arrivals import arrival_stream
from daybook.streaming.closed_hours import hours_now, reconcile, start_closed_hours
from daybook.streaming.unseen import start_append_unseen


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn

    return deco


# --- shared Spark building blocks --------------------------------------------------
HIST_T = [*TERMINAL_KEYS, *TERMINAL_ATTRS, "effective_from", "effective_to", "deleted_flg"]
HIST_B = ["passport", "effective_from", "effective_to", "deleted_flg"]


def terminals_hist(fx: Fixtures, days: int, mode: str) -> DataFrame:
    """History after ``days`` fixture days; each earlier day is written (lineage cut)."""
    h = empty_history(fx.spark, TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS)
    for n in range(1, days + 1):
        if n > 1:
            h = materialize(h, f"terminals_hist_{mode}")
        h = scd2_apply(h, fx.terminals(n), TERMINAL_KEYS, TERMINAL_ATTRS, batch_date(n), close=mode)
    return h


def blacklist_hist(fx: Fixtures, days: int, mode: str) -> DataFrame:
    h = empty_history(fx.spark, BLACKLIST_KEYS, [], BLACKLIST)
    for n in range(1, days + 1):
        if n > 1:
            h = materialize(h, f"blacklist_hist_{mode}")
        h = scd2_apply(h, fx.blacklist(n), BLACKLIST_KEYS, [], batch_date(n), from_col="date", close=mode)
    return h


def _written_dimensions(fx: Fixtures) -> Dimensions:
    written = {"cards": fx.cards(), "accounts": fx.accounts(), "clients": fx.clients()}
    return Dimensions(*together(fx.spark, *(partial(materialize, rows, name) for name, rows in written.items())))


def fixture_enriched(fx: Fixtures, tx: DataFrame | None = None) -> DataFrame:
    """Whole events table, black list of day 1 (first load), terminals of day 3.

    The dimension side (card -> holder, terminal -> city) is written as
    tables first, as a production run does, so the fact join is planned on
    measured sizes.
    """
    # A first load into an empty history makes the current view the snapshot
    # itself (checked by the scd2_* queries), so the snapshot is used directly.
    black = fx.blacklist(1).withColumnRenamed("date", "effective_from")
    holders = materialize(card_holders(fx.cards(), fx.accounts(), fx.clients(), black), "card_holders")
    terms = materialize(fx.terminals(3), "terminals_current")
    return enrich_transactions(fx.transactions() if tx is None else tx, holders, terms)


SEEN = O.seen_ctes("transactions", "terminals_d3", "blacklist_d1")


# --- fraud report (flagship) -------------------------------------------------------
@register("rep_fraud", O.with_fixtures(*SEEN, body=O.report_sql()))
def q_rep_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.rep_fraud(fixture_enriched(Fixtures(spark, sf_dir)))


@register("fraud_static", O.with_fixtures(*SEEN, body=O.static_rules_sql()))
def q_fraud_static(spark, sf_dir):
    return fraud.fraud_static(fixture_enriched(Fixtures(spark, sf_dir)))


def _one_rule(label: str):
    def build(spark, sf_dir):
        return fraud.fraud_static(fixture_enriched(Fixtures(spark, sf_dir)), only=label)

    return build


for _name, _label in [
    ("fraud_expired_passport", EVENT_EXPIRED_PASSPORT),
    ("fraud_blacklisted", EVENT_BLACKLISTED),
    ("fraud_invalid_contract", EVENT_INVALID_CONTRACT),
]:
    register(_name, O.with_fixtures(*SEEN, body=O.static_rules_sql(only=_label)))(_one_rule(_label))


@register("fraud_different_cities", O.with_fixtures(*SEEN, body=O.cities_sql()))
def q_fraud_cities(spark, sf_dir):
    return fraud.fraud_different_cities(fixture_enriched(Fixtures(spark, sf_dir)))


@register(
    "transactions_enriched",
    O.with_fixtures(
        *SEEN,
        body="""select transaction_id, moment as transaction_date, card_num, terminal, passport as passport_num,
              coalesce(fio, '') as fio, phone, passport_until as passport_valid_to, contract_until as account_valid_to,
              coalesce(listed, false) as blacklisted, city as terminal_city
            from seen""",
    ),
)
def q_enriched(spark, sf_dir):
    return fixture_enriched(Fixtures(spark, sf_dir)).select(
        "transaction_id",
        "transaction_date",
        "card_num",
        "terminal",
        "passport_num",
        "fio",
        "phone",
        "passport_valid_to",
        "account_valid_to",
        "blacklisted",
        "terminal_city",
    )


@register(
    "first_tx_in_hour",
    O.with_fixtures(
        *SEEN,
        body=O.FIRST_IN_HOUR,
    ),
)
def q_first_tx(spark, sf_dir):
    return first_tx_in_hour(fixture_enriched(Fixtures(spark, sf_dir))).select(
        "transaction_id", "passport_num", "hour_group"
    )


@register(
    "city_count_by_hour",
    O.with_fixtures(*SEEN, body=O.CITY_COUNTS),
)
def q_city_count(spark, sf_dir):
    return city_count_by_hour(fixture_enriched(Fixtures(spark, sf_dir)))


# --- snapshot diffs (day 2 against the state after day 1) ----------------------------
def _day1_terminals_current(fx: Fixtures) -> DataFrame:
    return terminals_current(terminals_hist(fx, 1, CLOSE_ALL_VERSIONS))


_T1 = O.history_chain("t", 1, "all_versions")
_DIFF_T2 = O.day_diff("t", 2, "all_versions")


@register("new_terminals", O.with_fixtures(*_T1, *_DIFF_T2, body=f"select {O.T_COLS} from new_t2"))
def q_new_terminals(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return D.new_rows(_day1_terminals_current(fx), fx.terminals(2), TERMINAL_KEYS, TERMINAL_ATTRS)


@register("deleted_terminals", O.with_fixtures(*_T1, *_DIFF_T2, body=f"select {O.T_COLS} from del_t2"))
def q_deleted_terminals(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return D.deleted_rows(_day1_terminals_current(fx), fx.terminals(2), TERMINAL_KEYS, TERMINAL_ATTRS)


@register("updated_terminals", O.with_fixtures(*_T1, *_DIFF_T2, body=f"select {O.T_COLS} from upd_t2"))
def q_updated_terminals(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return D.updated_rows(_day1_terminals_current(fx), fx.terminals(2), TERMINAL_KEYS, TERMINAL_ATTRS)


_T2_OPEN = O.history_chain("t", 2, "open_only")
_DIFF_T3_OPEN = O.day_diff("t", 3, "open_only")


@register(
    "snapshot_diff_terminals",
    O.with_fixtures(
        *_T2_OPEN,
        *_DIFF_T3_OPEN,
        body=f"""select 'NEW' as change, {O.T_COLS} from new_t3
            union all select 'DELETED', {O.T_COLS} from del_t3
            union all select 'UPDATED', {O.T_COLS} from upd_t3""",
    ),
)
def q_snapshot_diff(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cur = terminals_current(terminals_hist(fx, 2, CLOSE_OPEN_ONLY))
    return D.snapshot_diff(cur, fx.terminals(3), TERMINAL_KEYS, TERMINAL_ATTRS, null_safe=True)


_B1 = O.history_chain("b", 1, "all_versions")
_DIFF_B2 = O.day_diff("b", 2, "all_versions")


@register("new_passports", O.with_fixtures(*_B1, *_DIFF_B2, body="select date, passport from new_b2"))
def q_new_passports(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cur = blacklist_current(blacklist_hist(fx, 1, CLOSE_ALL_VERSIONS))
    return D.new_rows(cur, fx.blacklist(2), BLACKLIST_KEYS, [], snapshot_extra=["date"]).select("date", "passport")


@register("deleted_passports", O.with_fixtures(*_B1, *_DIFF_B2, body="select effective_from, passport from del_b2"))
def q_deleted_passports(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cur = blacklist_current(blacklist_hist(fx, 1, CLOSE_ALL_VERSIONS))
    return D.deleted_rows(cur, fx.blacklist(2), BLACKLIST_KEYS, [], current_extra=["effective_from"]).select(
        "effective_from", "passport"
    )


# --- SCD2 histories ----------------------------------------------------------------
def _reg_terminals(day: int, mode: str, name: str):
    sql = O.with_fixtures(*O.history_chain("t", day, mode), body=f"select {O.HIST_T_COLS} from h_t{day}")

    def build(spark, sf_dir):
        return terminals_hist(Fixtures(spark, sf_dir), day, mode).select(*HIST_T)

    register(name, sql)(build)


def _reg_blacklist(day: int, mode: str, name: str):
    sql = O.with_fixtures(
        *O.history_chain("b", day, mode),
        body=f"select passport, effective_from, effective_to, deleted_flg from h_b{day}",
    )

    def build(spark, sf_dir):
        return blacklist_hist(Fixtures(spark, sf_dir), day, mode).select(*HIST_B)

    register(name, sql)(build)


for _d in (1, 2, 3):
    _reg_terminals(_d, CLOSE_OPEN_ONLY, f"scd2_terminals_day{_d}")
for _d in (2, 3):
    _reg_terminals(_d, CLOSE_ALL_VERSIONS, f"scd2_terminals_day{_d}_all_versions")
    _reg_blacklist(_d, CLOSE_OPEN_ONLY, f"scd2_blacklist_day{_d}")
_reg_blacklist(3, CLOSE_ALL_VERSIONS, "scd2_blacklist_day3_all_versions")


@register(
    "terminals_current",
    O.with_fixtures(
        *O.history_chain("t", 3, "open_only"),
        body=O.current_sql("t", 3, O.T_COLS),
    ),
)
def q_terminals_current(spark, sf_dir):
    return terminals_current(terminals_hist(Fixtures(spark, sf_dir), 3, CLOSE_OPEN_ONLY))


@register(
    "terminals_current_all_versions",
    O.with_fixtures(
        *O.history_chain("t", 3, "all_versions"),
        body=O.current_sql("t", 3, O.T_COLS),
    ),
)
def q_terminals_current_av(spark, sf_dir):
    return terminals_current(terminals_hist(Fixtures(spark, sf_dir), 3, CLOSE_ALL_VERSIONS))


@register(
    "blacklist_current",
    O.with_fixtures(
        *O.history_chain("b", 3, "open_only"),
        body=O.current_sql("b", 3, "effective_from, passport"),
    ),
)
def q_blacklist_current(spark, sf_dir):
    return blacklist_current(blacklist_hist(Fixtures(spark, sf_dir), 3, CLOSE_OPEN_ONLY))


# --- fact append --------------------------------------------------------------------
@register(
    "transactions_append_unseen",
    O.with_fixtures(
        O.batch_tx(1),
        O.batch_tx(2),
        body=O.unseen_sql("tx_b1", "tx_b2"),
    ),
)
def q_append_unseen(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return unseen(fx.transactions(1), fx.transactions(2), ["transaction_id"])


# --- three-day run ------------------------------------------------------------------
def _three_days(spark, sf_dir, mode=CLOSE_OPEN_ONLY, n_days=3, facts=True):
    fx = Fixtures(spark, sf_dir)
    dims = Dimensions(fx.cards(), fx.accounts(), fx.clients())
    days = [
        (DailyFeeds(fx.transactions(n), fx.terminals(n), fx.blacklist(n)), batch_date(n))
        for n in range(1, n_days + 1)
    ]
    return run_days(initial_state(spark), days, dims, close=mode, checkpoint_every=1, facts=facts)


@register("daily_run_report", O.daily_report_sql())
def q_daily_report(spark, sf_dir):
    return _three_days(spark, sf_dir, facts=False).report


@register("rep_fraud_two_batches", O.daily_report_sql(2))
def q_report_two(spark, sf_dir):
    """Report table after two daily runs (appended day by day)."""
    return _three_days(spark, sf_dir, n_days=2, facts=False).report


@register("daily_run_report_all_versions", O.daily_report_sql(3, "all_versions"))
def q_daily_report_av(spark, sf_dir):
    """Three daily runs with the reference close mode."""
    return _three_days(spark, sf_dir, mode=CLOSE_ALL_VERSIONS, facts=False).report


@register(
    "daily_run_blacklist_hist",
    O.with_fixtures(
        *O.history_chain("b", 3, "open_only"),
        body="select passport, effective_from, effective_to, deleted_flg from h_b3",
    ),
)
def q_daily_blacklist(spark, sf_dir):
    return _three_days(spark, sf_dir, facts=False).blacklist.select(*HIST_B)


@register(
    "daily_run_transactions_hist",
    O.with_fixtures(
        O.batch_tx(1),
        O.batch_tx(2),
        O.batch_tx(3),
        f"facts_2 as (from tx_b1 union all {O.unseen_sql('tx_b1', 'tx_b2')})",
        body=f"from facts_2 union all {O.unseen_sql('facts_2', 'tx_b3')}",
    ),
)
def q_daily_tx(spark, sf_dir):
    return _three_days(spark, sf_dir).transactions


@register(
    "daily_run_terminals_hist",
    O.with_fixtures(*O.history_chain("t", 3, "open_only"), body=f"select {O.HIST_T_COLS} from h_t3"),
)
def q_daily_terminals(spark, sf_dir):
    return _three_days(spark, sf_dir, facts=False).terminals.select(*HIST_T)


# --- sources --------------------------------------------------------------------------
@register(
    "src_transactions_delimited",
    O.with_fixtures(
        body="""select transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal
            from transactions""",
    ),
)
def q_src_delimited(spark, sf_dir):
    """Transactions written as ';'-separated text with decimal comma, read back."""
    fx = Fixtures(spark, sf_dir)
    folder = scratch_path(spark, f"daybook/drops/{uuid.uuid4().hex}")
    write_delimited(fx.transactions(), folder)
    return read_feed(spark, folder, TRANSACTIONS)


_RAW_TEXT = """
    cast(event_id as varchar) as transaction_id_txt,
    case when event_id % 11 = 0 then 'not a date' else cast(ts as varchar) end as transaction_date_txt,
    case when event_type = 'error' then 'abc' when event_id % 7 = 0 then ''
         else replace(cast(cast(value as decimal(12,2)) as varchar), '.', ',') end as amount_txt"""


@register(
    "coerce_lenient",
    f"""with raw as (select event_id, {_RAW_TEXT} from events)
        select event_id,
               try_cast(transaction_date_txt as timestamp) as transaction_date,
               try_cast(replace(trim(amount_txt), ',', '.') as decimal(10,2)) as amount
        from raw""",
)
def q_coerce(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value")
    e = F.col("event_id")
    raw = ev.select(
        e,
        F.when(e % 11 == 0, F.lit("not a date")).otherwise(F.col("ts").cast("string")).alias("transaction_date"),
        F.when(F.col("event_type") == "error", F.lit("abc"))
        .when(e % 7 == 0, F.lit(""))
        .otherwise(F.regexp_replace(F.col("value").cast("decimal(12,2)").cast("string"), r"\.", ","))
        .alias("amount"),
    )
    return coerce_by_name(raw).select("event_id", "transaction_date", "amount")


@register(
    "batch_date_from_filename",
    r"""with names as (
          select event_id as transaction_id,
                 case when event_id % 17 = 0 then 'transactions.txt'
                      when event_id % 13 = 0 then 'transactions_3102' || strftime(ts, '%Y') || '.txt'
                      else 'transactions_' || strftime(ts, '%d%m%Y') || '.txt' end as file_name
          from events)
        select transaction_id, file_name,
               cast(try_strptime(regexp_extract(file_name, '_(\d{8})\.', 1), '%d%m%Y') as date) as batch_date
        from names""",
)
def q_batch_date(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    e = F.col("event_id")
    name = (
        F.when(e % 17 == 0, F.lit("transactions.txt"))
        .when(e % 13 == 0, F.concat(F.lit("transactions_3102"), F.date_format("ts", "yyyy"), F.lit(".txt")))
        .otherwise(F.concat(F.lit("transactions_"), F.date_format("ts", "ddMMyyyy"), F.lit(".txt")))
    )
    return ev.select(e.alias("transaction_id"), name.alias("file_name")).withColumn(
        "batch_date", batch_date_from_name(F.col("file_name"))
    )


@register("src_workbook_terminals", O.with_fixtures(body=f"select {O.T_COLS} from terminals_d2"))
def q_src_workbook(spark, sf_dir):
    """Terminal snapshot written as workbooks (one per partition), read back."""
    fx = Fixtures(spark, sf_dir)
    folder = scratch_path(spark, f"daybook/workbooks/{uuid.uuid4().hex}")
    write_workbooks(fx.terminals(2), folder, prefix="terminals_20012024")
    return read_workbooks(spark, folder, TERMINALS, glob="*terminals*.xlsx")


@register(
    "feed_routing_drop",
    O.with_fixtures(
        body="""select 'transactions' as feed, cast(transaction_id as varchar) as key, terminal as detail from transactions
            union all select 'terminals', terminal_id, terminal_city from terminals_d2
            union all select 'blacklist', passport, cast(cast(date as date) as varchar) from blacklist_d2""",
    ),
)
def q_feed_routing(spark, sf_dir):
    """Several files of one feed, of both extensions, and files of no feed in one drop: each goes where its name says."""
    fx = Fixtures(spark, sf_dir)
    folder = scratch_path(spark, f"daybook/routing/{uuid.uuid4().hex}")
    day, tx = batch_date(2), fx.transactions()
    write_drop(folder, day, tx.where("transaction_id % 3 > 0"), fx.terminals(2).where("terminal_type = 'ATM'"), fx.blacklist(2), terminals_as_workbook=False)
    write_delimited(fx.terminals(2).where("terminal_type <> 'ATM'"), f"{folder}/pos_terminals_{day:%d%m%Y}.txt")
    write_delimited(tx.where("transaction_id % 3 = 0"), f"{folder}/more_transactions_{day:%d%m%Y}.csv")
    write_delimited(fx.blacklist(1), f"{folder}/passports_{batch_date(1):%d%m%Y}.txt")
    write_delimited(fx.terminals(1), f"{folder}/notes.txt")
    feeds, found = read_drop(spark, folder)
    if found != day:
        raise ValueError(f"batch date {found}, expected {day}")
    rows = feeds.transactions.selectExpr("'transactions' AS feed", "CAST(transaction_id AS STRING) AS key", "terminal AS detail")
    rows = rows.union(feeds.terminals.selectExpr("'terminals'", "terminal_id", "terminal_city"))
    return rows.union(feeds.blacklist.selectExpr("'blacklist'", "passport", "CAST(CAST(date AS DATE) AS STRING)"))


@register(
    "staging_replace",
    O.with_fixtures(
        body=f"""select {O.T_COLS}, passport from terminals_d2 full join blacklist_d3 on passport = 'PS' || substr(terminal_id, 2)""",
    ),
)
def q_staging(spark, sf_dir):
    """Terminals staged twice and the black list three times; statements over the staged names see the last ones."""
    fx = Fixtures(spark, sf_dir)
    with Staging(spark) as stage:
        for n in (1, 2, 3):
            stage.replace("blacklist", fx.blacklist(n))
            if n < 3:
                stage.replace("terminals", fx.terminals(n))
        joined = spark.sql("SELECT t.*, passport FROM stg_terminals t FULL JOIN stg_blacklist ON passport = 'PS' || substr(terminal_id, 2)")
        return materialize(joined, "staging_replace")


@register(
    "seed_dimensions",
    O.with_fixtures(
        body="""select card_num, cards.account, valid_to, client_id, last_name, first_name, patronymic, passport_num, passport_valid_to, phone
            from cards full join accounts on accounts.account = cards.account full join clients on client_id = client""",
    ),
)
def q_seeds(spark, sf_dir):
    """The three seed dimensions from delimited files with declared schemas, joined under their warehouse names."""
    fx = Fixtures(spark, sf_dir)
    root = scratch_path(spark, f"daybook/seeds/{uuid.uuid4().hex}")
    for name, rows in zip(SEED_TABLES, (fx.cards(), fx.accounts(), fx.clients()), strict=True):
        rows.write.option("header", True).option("sep", ";").csv(f"{root}/{name}")
    register_dimensions(read_dimensions(spark, root, "csv", header=True, sep=";"))
    return spark.sql(
        "SELECT card_num, c.account, valid_to, client_id, last_name, first_name, patronymic, passport_num, passport_valid_to, phone "
        "FROM dwh_dim_cards c FULL JOIN dwh_dim_accounts a ON a.account = c.account FULL JOIN dwh_dim_clients ON client_id = client"
    )


@register(
    "insert_with_defaults",
    O.with_fixtures(
        body=f"""select {O.T_COLS}, timestamp '2024-01-10 00:00:00' as effective_from, {O.OPEN} as effective_to, 0 as deleted_flg from terminals_d1
            union all select terminal_id, null, null, null, timestamp '2024-01-20 00:00:00', {O.OPEN}, 1
            from terminals_d1 anti join terminals_d2 using (terminal_id)""",
    ),
)
def q_defaults(spark, sf_dir):
    """New terminals, then tombstones, inserted into a catalog table by parts of its columns; the rest comes from its defaults."""
    fx = Fixtures(spark, sf_dir)
    name = f"daybook_{uuid.uuid4().hex}"
    place = scratch_path(spark, f"daybook/tables/{name}")
    create_table(spark, name, history_schema(TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS), place, HISTORY_DEFAULTS)
    insert_partial(fx.terminals(1).withColumn("effective_from", F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")), name)
    gone = fx.terminals(1).join(fx.terminals(2), TERMINAL_KEYS, "left_anti").select(*TERMINAL_KEYS)
    insert_partial(gone.selectExpr(*TERMINAL_KEYS, "TIMESTAMP_NTZ '2024-01-20 00:00:00' AS effective_from", "1 AS deleted_flg"), name)
    rows = spark.table(name).select(*HIST_T)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.schema(rows.schema).parquet(place)


@register(
    "surrogate_ids_stable",
    O.with_fixtures(
        *O.history_chain("t", 3, "open_only"),
        body=f"select {O.HIST_T_COLS}, true as same_id, cast(1 as bigint) as rows_of_id from h_t3",
    ),
)
def q_surrogate(spark, sf_dir):
    """Ids of the history, and of one built again from rows dealt otherwise: one row an id, and the same id a row."""
    fx = Fixtures(spark, sf_dir)

    def history(deal) -> DataFrame:
        h = empty_history(spark, TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS)
        for n in (1, 2, 3):
            h = materialize(scd2_apply(h, deal(fx.terminals(n)), TERMINAL_KEYS, TERMINAL_ATTRS, batch_date(n)), "surrogate_ids")
        return h

    once, again = history(lambda rows: rows), history(lambda rows: rows.repartition(7, "terminal_city").orderBy(F.desc("terminal_id")))
    key = [*TERMINAL_KEYS, "effective_from", "deleted_flg"]
    uses = once.groupBy("id").agg(F.count("*").alias("rows_of_id"))
    both = once.join(again.select(*key, F.col("id").alias("id_again")), key, "left").join(uses, "id")
    return both.select(*HIST_T, F.expr("id <=> id_again").alias("same_id"), "rows_of_id")


# --- type-1 dimension ---------------------------------------------------------------
_CLIENT_BATCH_SQL = """client_batch as (
      select client_id, last_name, first_name, patronymic, passport_num, passport_valid_to,
             case when cast(substr(client_id, 2) as bigint) % 4 = 0 then phone || '-2' else phone end as phone
      from clients where cast(substr(client_id, 2) as bigint) % 2 = 0
      union all
      select 'N' || substr(client_id, 2), last_name, first_name, patronymic, passport_num, passport_valid_to, phone
      from clients where cast(substr(client_id, 2) as bigint) % 25 = 0)"""


@register(
    "scd1_upsert_clients",
    O.with_fixtures(
        _CLIENT_BATCH_SQL,
        body="""select coalesce(b.client_id, d.client_id) as client_id,
                   coalesce(b.client_id, null) is not null as from_batch,
                   case when b.client_id is null then d.phone else b.phone end as phone,
                   case when d.client_id is null then date '2024-01-20' else null end as create_dt,
                   case when d.client_id is not null and b.client_id is not null
                             and (b.phone is distinct from d.phone
                                  or b.last_name is distinct from d.last_name
                                  or b.first_name is distinct from d.first_name
                                  or b.patronymic is distinct from d.patronymic
                                  or b.passport_num is distinct from d.passport_num
                                  or b.passport_valid_to is distinct from d.passport_valid_to)
                        then date '2024-01-20' else null end as update_dt
            from clients d full outer join client_batch b on d.client_id = b.client_id""",
    ),
)
def q_scd1(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    dim = fx.clients().drop("date_of_birth")
    num = F.substring("client_id", 2, 100).cast("bigint")
    changed = (
        dim.filter(num % 2 == 0)
        .withColumn("phone", F.when(num % 4 == 0, F.concat("phone", F.lit("-2"))).otherwise(F.col("phone")))
        .drop("create_dt", "update_dt")
    )
    new = (
        dim.filter(num % 25 == 0)
        .withColumn("client_id", F.concat(F.lit("N"), F.substring("client_id", 2, 100)))
        .drop("create_dt", "update_dt")
    )
    out = scd1_upsert(dim, changed.unionByName(new), ["client_id"], "2024-01-20")
    batch_keys = changed.unionByName(new).select("client_id", F.lit(True).alias("from_batch"))
    return (
        out.join(batch_keys, "client_id", "left")
        .select(
            "client_id",
            F.coalesce("from_batch", F.lit(False)).alias("from_batch"),
            "phone",
            "create_dt",
            "update_dt",
        )
    )


# --- streams (result read back from the sink once the stream has drained) -------------
def _scratch(spark, name):
    return scratch_path(spark, f"daybook/{name}/{uuid.uuid4().hex}")


def _write_three_drops(fx: Fixtures, incoming: str) -> None:
    for n in (1, 2, 3):
        write_drop(incoming, batch_date(n), fx.transactions(n), fx.terminals(n), fx.blacklist(n))


@register("stream_daily_drop", O.daily_report_sql())
def q_stream_drop(spark, sf_dir):
    """Three daily drops consumed by the file stream; the stored report equals the batch fold."""
    fx = Fixtures(spark, sf_dir)
    base = _scratch(spark, "stream_drop")
    incoming = f"{base}/incoming"
    _write_three_drops(fx, incoming)
    roots = StateRoots(
        f"{base}/terminals", f"{base}/blacklist", f"{base}/transactions", f"{base}/report", fact_buckets=8
    )
    dims = _written_dimensions(fx)
    q = daily_drop_stream(spark, incoming, roots, dims, f"{base}/_checkpoint", archive_dir=f"{base}/archive")
    q.awaitTermination()
    return ReportStore(spark, roots.report).read().select(*REP_FRAUD_COLS)


@register(
    "stream_city_count_by_hour",
    O.with_fixtures(*SEEN, body=O.CITY_COUNTS),
)
def q_stream_city(spark, sf_dir):
    """All transactions as one text drop, streamed through the watermarked hourly count."""
    fx = Fixtures(spark, sf_dir)
    base = _scratch(spark, "stream_city")
    write_delimited(fx.transactions(), f"{base}/incoming/transactions_01022024.txt")
    black = fx.blacklist(1).withColumnRenamed("date", "effective_from")
    holders = materialize(card_holders(fx.cards(), fx.accounts(), fx.clients(), black), "card_holders")
    terms = materialize(fx.terminals(3), "terminals_current")
    tx = transaction_file_stream(spark, f"{base}/incoming").drop("batch_date")
    q = start_city_counts(spark, tx, holders, terms, f"{base}/city_counts", f"{base}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/city_counts").select("passport_num", "hour_group", "count_cities")


@register("stored_daily_run_report_all_versions", O.daily_report_sql(3, "all_versions"))
def q_stored_run_av(spark, sf_dir):
    """Three stored production days in the reference close mode (versioned histories)."""
    fx = Fixtures(spark, sf_dir)
    base = _scratch(spark, "stored_run")
    roots = StateRoots(
        f"{base}/terminals", f"{base}/blacklist", f"{base}/transactions", f"{base}/report", fact_buckets=8
    )
    dims = _written_dimensions(fx)
    for n in (1, 2, 3):
        feeds = DailyFeeds(fx.transactions(n), fx.terminals(n), fx.blacklist(n))
        run_day_stored(spark, roots, feeds, dims, batch_date(n), close=CLOSE_ALL_VERSIONS)
    return ReportStore(spark, roots.report).read().select(*REP_FRAUD_COLS)


# --- versioned tables (a day is seen in all tables at once) ----------------------------
def _versioned(spark, sf_dir, name, close=CLOSE_OPEN_ONLY):
    """A warehouse below a scratch folder, the fixture's dimensions, and feeds by day."""
    fx = Fixtures(spark, sf_dir)
    dims = _written_dimensions(fx)
    feeds = {n: DailyFeeds(fx.transactions(n), fx.terminals(n), fx.blacklist(n)) for n in (1, 2, 3)}
    return bank_warehouse(spark, _scratch(spark, name), close, buckets=16), dims, feeds


@register("versioned_run_failed_then_read", O.daily_report_sql(2))
def q_versioned_failed(spark, sf_dir):
    """Two days, then a third that fails at its last write: readers still see the second day's report."""
    warehouse, dims, feeds = _versioned(spark, sf_dir, "versioned_failed")
    for n in (1, 2):
        run_day_versioned(warehouse, feeds[n], dims, batch_date(n))
    lost = replace(dims, cards=dims.cards.withColumn("account", F.expr("IF(length(card_num) > 0, CAST(raise_error('lost') AS STRING), account)")))
    try:
        run_day_versioned(warehouse, feeds[3], lost, batch_date(3))
    except Exception as error:
        if "lost" not in str(error):
            raise
    return warehouse.read("report").select(*REP_FRAUD_COLS)


@register("versioned_run_corrected_transactions", REGISTRY["daily_run_transactions_hist"].sql)
def q_versioned_corrected(spark, sf_dir):
    """Day 3 first with another feed, then run again with its own: nothing of the first attempt stays."""
    warehouse, dims, feeds = _versioned(spark, sf_dir, "versioned_corrected")
    for n in (1, 2):
        run_day_versioned(warehouse, feeds[n], dims, batch_date(n))
    other = feeds[3].transactions.withColumn("transaction_id", F.col("transaction_id") + 10**9)
    run_day_versioned(warehouse, replace(feeds[3], transactions=other), dims, batch_date(3))
    run_day_versioned(warehouse, feeds[3], dims, batch_date(3))
    return warehouse.read("transactions")


@register("versioned_run_report_all_versions", O.daily_report_sql(3, "all_versions"))
def q_versioned_report_av(spark, sf_dir):
    """Three days in the reference close mode, histories copied on write by bucket."""
    warehouse, dims, feeds = _versioned(spark, sf_dir, "versioned_report", CLOSE_ALL_VERSIONS)
    for n in (1, 2, 3):
        run_day_versioned(warehouse, feeds[n], dims, batch_date(n))
    return warehouse.read("report").select(*REP_FRAUD_COLS)


@register(
    "versioned_run_terminals_all_versions",
    O.with_fixtures(*O.history_chain("t", 3, "all_versions"), body=f"select {O.HIST_T_COLS} from h_t3"),
)
def q_versioned_terminals_av(spark, sf_dir):
    """The history of the copy-on-write buckets after three days."""
    warehouse, dims, feeds = _versioned(spark, sf_dir, "versioned_terminals", CLOSE_ALL_VERSIONS)
    for n in (1, 2, 3):
        run_day_versioned(warehouse, feeds[n], dims, batch_date(n))
    return warehouse.read("terminals").select(*HIST_T)


@register(
    "versioned_run_earlier_terminals",
    O.with_fixtures(*O.history_chain("t", 2, "open_only"), body=f"select {O.HIST_T_COLS} from h_t2"),
)
def q_versioned_earlier(spark, sf_dir):
    """After three days, the terminals' history as of the second day's version."""
    warehouse, dims, feeds = _versioned(spark, sf_dir, "versioned_earlier")
    for n in (1, 2, 3):
        run_day_versioned(warehouse, feeds[n], dims, batch_date(n))
    return warehouse.read("terminals", version=2).select(*HIST_T)


@register(
    "versioned_current_views",
    O.with_fixtures(
        *O.history_chain("t", 3, "open_only"),
        *O.history_chain("b", 3, "open_only"),
        body=f"""select 'terminal' as kind, terminal_id as name, terminal_city as city from ({O.current_sql('t', 3, O.T_COLS)})
            union all select 'passport', passport, null from ({O.current_sql('b', 3, 'passport')})""",
    ),
)
def q_versioned_views(spark, sf_dir):
    """The catalog views of the current states, read by another session after three days and a rerun."""
    warehouse, dims, feeds = _versioned(spark, sf_dir, "versioned_views")
    prefix = f"daybook_{uuid.uuid4().hex}_"
    for n in (1, 2, 3, 3):
        run_day_versioned(warehouse, feeds[n], dims, batch_date(n))
        publish_current(warehouse, prefix)
    other = spark.newSession()
    return other.sql(
        f"SELECT 'terminal' AS kind, terminal_id AS name, terminal_city AS city FROM {prefix}v_terminals "
        f"UNION ALL SELECT 'passport', passport, NULL FROM {prefix}v_passport_blacklist"
    )


@register("stream_fraud_different_cities", O.with_fixtures(*SEEN, body=O.cities_sql()))
def q_stream_cities_rule(spark, sf_dir):
    """The different-cities rule read from the streamed hourly table (= the batch rule)."""
    fx = Fixtures(spark, sf_dir)
    base = _scratch(spark, "stream_cities_rule")
    write_delimited(fx.transactions(), f"{base}/incoming/transactions_01022024.txt")
    black = fx.blacklist(1).withColumnRenamed("date", "effective_from")
    holders = materialize(card_holders(fx.cards(), fx.accounts(), fx.clients(), black), "card_holders")
    terms = materialize(fx.terminals(3), "terminals_current")
    tx = transaction_file_stream(spark, f"{base}/incoming").drop("batch_date")
    q = start_city_counts(spark, tx, holders, terms, f"{base}/city_counts", f"{base}/_checkpoint")
    q.awaitTermination()
    return different_cities_from_counts(spark.read.parquet(f"{base}/city_counts"))


@register(
    "stream_transactions_unseen",
    O.with_fixtures(body="select * from transactions"),
)
def q_stream_unseen(spark, sf_dir):
    """Three overlapping daily transaction drops; the stored history keeps each id once."""
    fx = Fixtures(spark, sf_dir)
    base = _scratch(spark, "stream_unseen")
    for n in (1, 2, 3):
        write_delimited(fx.transactions(n), f"{base}/incoming/transactions_{batch_date(n):%d%m%Y}.txt")
    tx = transaction_file_stream(spark, f"{base}/incoming", max_files=1).drop("batch_date")
    q = start_append_unseen(spark, tx, f"{base}/facts", f"{base}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/facts").drop("tx_day")


@register("stream_daily_drop_late_file", O.daily_report_sql())
def q_stream_late(spark, sf_dir):
    """Three drops over three triggers on versioned tables; a late file of day 1 is set aside, the later days go on."""
    fx = Fixtures(spark, sf_dir)
    warehouse, dims, feeds = _versioned(spark, sf_dir, "stream_late")
    base = _scratch(spark, "stream_late_files")
    for n in (1, 2, 3):
        write_drop(f"{base}/in", batch_date(n), feeds[n].transactions, feeds[n].terminals, feeds[n].blacklist, terminals_as_workbook=False)
        if n == 2:
            write_delimited(fx.transactions(3), f"{base}/in/transactions_{batch_date(1):%d%m%Y}_late.txt")
        arrival_stream(warehouse, dims, f"{base}/in", f"{base}/_checkpoint", f"{base}/archive", f"{base}/quarantine").awaitTermination()
    return warehouse.read("report").select(*REP_FRAUD_COLS)


@register("stream_city_count_three_triggers", O.with_fixtures(*SEEN, body=O.CITY_COUNTS))
def q_stream_three_triggers(spark, sf_dir):
    """Hours closed by the watermark over three triggers, the last one of late rows, which reconciliation repairs."""
    fx = Fixtures(spark, sf_dir)
    base = _scratch(spark, "stream_closed_hours")
    tx = fx.transactions()
    first, last = tx.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    middle = F.lit(first + (last - first) / 2)
    late = F.coalesce((F.col("transaction_id") % 50 == 0) & (F.col("transaction_date") <= middle), F.lit(False))
    early = F.coalesce(F.col("transaction_date") <= middle, F.lit(True))
    for n, some in enumerate((early & ~late, ~early, late), start=1):
        write_delimited(tx.where(some).coalesce(1), f"{base}/in/transactions_{n:02d}022024.txt")
    black = fx.blacklist(1).withColumnRenamed("date", "effective_from")
    holders = materialize(card_holders(fx.cards(), fx.accounts(), fx.clients(), black), "card_holders")
    stream = transaction_file_stream(spark, f"{base}/in", max_files=1).drop("batch_date")
    for query in start_closed_hours(stream, holders, materialize(fx.terminals(3), "terminals_current"), f"{base}/hours", f"{base}/_checkpoint"):
        query.awaitTermination()
    reconcile(spark, f"{base}/hours")
    return hours_now(spark, f"{base}/hours").select("passport_num", "hour_group", "count_cities")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}

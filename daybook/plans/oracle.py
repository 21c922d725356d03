"""DuckDB SQL for every registered query, written independently of the engine.

Labels, dates and batch windows stand here as literals, and the statements
take other forms than the Spark plans: snapshot diffs are semi and anti joins,
closing is a join with a table of ended keys, static rules are a ranked rule
table, and the city rule is a grouped table with HAVING.

The fixture mapping (FIXTURES.md) is the leading CTE list of every query;
``customer supplier nation events`` are the driver's pre-registered views.
"""

from __future__ import annotations

# --- fixed values: validity sentinel, batch calendar (date, transactions from, to), rules in priority order ---
OPEN = "TIMESTAMP '2999-12-31 00:00:00'"
CALENDAR = {
    1: ("2024-01-10", "2024-01-01", "2024-01-11"),
    2: ("2024-01-20", "2024-01-10", "2024-01-21"),
    3: ("2024-02-01", "2024-01-20", "2024-02-01"),
}
RULES = "(values (1, 'expired passport'), (2, 'passport in black list'), (3, 'invalid contract'))"
# ---------------------------------------------------------------------------------------------------------------

FIXTURE_CTES = """
clients as (
  select 'U' || c_custkey as client_id, c_name as last_name, c_mktsegment as first_name,
         case when c_custkey % 7 = 0 then null else 'P' || (c_custkey % 5) end as patronymic,
         'PS' || c_custkey as passport_num,
         case when c_custkey % 3 = 0 then null
              else date '2024-01-05' + cast(c_custkey % 61 as int) end as passport_valid_to,
         'T' || c_nationkey || '-' || c_custkey as phone
  from customer),
accounts as (
  select 'A' || c_custkey as account, date '2024-01-10' + cast((c_custkey * 7) % 90 as int) as valid_to,
         'U' || c_custkey as client
  from customer where c_custkey % 31 <> 30),
cards as (
  select 'K' || user_id || '-' || n as card_num, 'A' || user_id as account
  from (select distinct user_id from events) u, (values (0), (1)) v(n)
  where (user_id + n) % 41 <> 40),
transactions as (
  select event_id as transaction_id, ts as transaction_date, cast(value as decimal(10,2)) as amount,
         'K' || user_id || '-' || (event_id % 2) as card_num, event_type as oper_type,
         case when event_id % 9 = 0 then 'REJECT' else 'SUCCESS' end as oper_result,
         'S' || (event_id % (select count(*) from supplier)) as terminal
  from events),
terminals_d1 as (
  select 'S' || s_suppkey as terminal_id, case when s_suppkey % 2 = 0 then 'ATM' else 'POS' end as terminal_type,
         n_name as terminal_city, s_name as terminal_address
  from supplier join nation on n_nationkey = s_nationkey
  where s_suppkey % 10 <> 9),
terminals_d2 as (
  select 'S' || s_suppkey as terminal_id, case when s_suppkey % 2 = 0 then 'ATM' else 'POS' end as terminal_type,
         n_name as terminal_city, case when s_suppkey % 10 = 5 then null else s_name end as terminal_address
  from supplier join nation
    on n_nationkey = case when s_suppkey % 10 = 3 then (s_nationkey + 1) % 25 else s_nationkey end
  where s_suppkey % 10 <> 7),
terminals_d3 as (
  select 'S' || s_suppkey as terminal_id, case when s_suppkey % 2 = 0 then 'ATM' else 'POS' end as terminal_type,
         n_name as terminal_city, case when s_suppkey % 10 = 5 then null else s_name end as terminal_address
  from supplier join nation
    on n_nationkey = case when s_suppkey % 10 = 3 then (s_nationkey + 2) % 25 else s_nationkey end
  where s_suppkey % 10 <> 8),
blacklist_d1 as (
  select cast(date '2024-01-01' + cast(c_custkey % 20 as int) as timestamp) as date, 'PS' || c_custkey as passport
  from customer where c_custkey % 13 = 0),
blacklist_d2 as (
  select cast(date '2024-01-01' + cast(c_custkey % 20 as int) as timestamp) as date, 'PS' || c_custkey as passport
  from customer where (c_custkey % 13 = 0 and c_custkey % 2 = 0) or c_custkey % 17 = 0),
blacklist_d3 as (
  select cast(date '2024-01-01' + cast(c_custkey % 20 as int) as timestamp) as date, 'PS' || c_custkey as passport
  from customer where c_custkey % 13 = 0 or (c_custkey % 17 = 0 and c_custkey % 3 <> 0))"""


def with_fixtures(*ctes: str, body: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"with {FIXTURE_CTES}{extra}\n{body}"


def batch_tx(n: int) -> str:
    _, since, until = CALENDAR[n]
    return (
        f"tx_b{n} as (select * from transactions "
        f"where transaction_date >= timestamp '{since}' and transaction_date < timestamp '{until}')"
    )


def unseen_sql(history: str, batch: str) -> str:
    """Rows of a batch whose id the history lacks (a NULL id is never known)."""
    return f"select * from {batch} where not exists (from {history} known where known.transaction_id = {batch}.transaction_id)"


# --- type-2 histories --------------------------------------------------------------
T_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]
T_COLS = "terminal_id, terminal_type, terminal_city, terminal_address"
PERIOD = "effective_from, effective_to, deleted_flg"
HIST_T_COLS = f"{T_COLS}, {PERIOD}"
HIST_B_COLS = f"passport, {PERIOD}"
# tag of the CTE names: (snapshot tables, key, attributes, column that new rows start from)
ENTITIES = {
    "t": ("terminals_d", "terminal_id", T_ATTRS, None),
    "b": ("blacklist_d", "passport", [], "date"),
}


def no_history(tag: str) -> str:
    _, key, attrs, _ = ENTITIES[tag]
    texts = ", ".join(f"''::varchar as {c}" for c in [key, *attrs])
    return f"h_{tag}0 as (select {texts}, {OPEN} as effective_from, {OPEN} as effective_to, 0::integer as deleted_flg limit 0)"


def day_diff(tag: str, n: int, mode: str) -> list[str]:
    """CTEs snap, live, new, del and (with attributes) upd of day n against the history after day n - 1."""
    table, key, attrs, starts = ENTITIES[tag]
    payload = [*attrs, *([starts] if starts else [])]
    if mode == "open_only":
        ranked = ", ".join(f"{c} desc nulls last" for c in payload)
        snap = f"select distinct on ({key}) * from {table}{n} where {key} is not null order by {key}, {ranked}"
        unlike = "is distinct from"
    else:
        snap, unlike = f"from {table}{n}", "<>"
    ctes = [
        f"snap_{tag}{n} as ({snap})",
        f"live_{tag}{n} as (from h_{tag}{n - 1} where deleted_flg = 0 and effective_to = {OPEN})",
        f"new_{tag}{n} as (select s.* from snap_{tag}{n} s anti join live_{tag}{n} using ({key}))",
        f"del_{tag}{n} as (select l.* from live_{tag}{n} l anti join snap_{tag}{n} using ({key}))",
    ]
    if attrs:
        differs = " or ".join(f"s.{c} {unlike} l.{c}" for c in attrs)
        ctes.append(f"upd_{tag}{n} as (select s.* from snap_{tag}{n} s semi join live_{tag}{n} l on s.{key} = l.{key} and ({differs}))")
    return ctes


def history_chain(tag: str, days: int, mode: str) -> list[str]:
    _, key, attrs, starts = ENTITIES[tag]
    cols = ", ".join([key, *attrs])
    ctes = [no_history(tag)]
    for n in range(1, days + 1):
        day = f"timestamp '{CALENDAR[n][0]}'"
        changed = [f"del_{tag}{n}", *([f"upd_{tag}{n}"] if attrs else [])]
        ended = " union ".join(f"select {key}, 0 as flag from {c}" for c in changed)
        if mode == "open_only":
            # a key that comes back ends its tombstone; rows that have ended stay as they are
            ended += f" union select {key}, 1 from new_{tag}{n}"
            matches = f"e.{key} = h.{key} and e.flag = h.deleted_flg and h.effective_to = {OPEN}"
        else:
            matches = f"e.{key} = h.{key}"
        kept = ", ".join(f"h.{c}" for c in [key, *attrs])
        ctes += [
            *day_diff(tag, n, mode),
            f"ended_{tag}{n} as ({ended})",
            f"""h_{tag}{n} as (
    select {kept}, h.effective_from, if(e.{key} is null, h.effective_to, {day} - interval 1 second) as effective_to, h.deleted_flg
    from h_{tag}{n - 1} h left join ended_{tag}{n} e on {matches}
    union all
    select {cols}, {starts or day}, {OPEN}, 0 from new_{tag}{n}
    union all
    select {cols}, {day}, {OPEN}, flag from (
        select {cols}, 1 as flag from del_{tag}{n}"""
            + (f" union all select {cols}, 0 from upd_{tag}{n}" if attrs else "")
            + "))",
        ]
    return ctes


def current_sql(tag: str, n: int, columns: str) -> str:
    return f"select {columns} from h_{tag}{n} where deleted_flg = 0 and effective_to = {OPEN}"


# --- enrichment and fraud ------------------------------------------------------------
def seen_ctes(tx: str, terminals: str, blacklist: str, tag: str = "") -> list[str]:
    """The transactions ``tx`` with what is known of their card and terminal, as ``seen<tag>``."""
    return [
        f"""holder{tag} as (
    select card_num, passport_num as passport, concat_ws(' ', last_name, first_name, patronymic) as fio, phone,
           passport_valid_to as passport_until, contract.valid_to as contract_until,
           passport_num in (select passport from {blacklist} where passport is not null) as listed
    from cards left join accounts contract using (account) left join clients person on person.client_id = contract.client)""",
        f"""seen{tag} as (
    select transaction_id, transaction_date as moment, date_trunc('hour', transaction_date) as hour, card_num, terminal,
           holder{tag}.* exclude (card_num), place.terminal_city as city
    from {tx} left join holder{tag} using (card_num) left join {terminals} place on place.terminal_id = terminal)""",
    ]


def static_rules_sql(tag: str = "", only: str | None = None) -> str:
    chosen = "" if only is None else f" where label = '{only}'"
    return f"""select distinct moment::date as event_dt, passport, fio, phone, label as event_type, moment::date as report_dt
    from (
        select seen{tag}.*, (
            select min_by(label, rank) from {RULES} rule(rank, label)
            where (rank = 1 and passport_until + interval 1 day - interval 1 second < moment)
               or (rank = 2 and listed)
               or (rank = 3 and contract_until < moment)) as label
        from seen{tag})
    where label is not null{chosen.replace(' where', ' and')}"""


def cities_sql(tag: str = "") -> str:
    return f"""select distinct moment::date as event_dt, passport, fio, phone, 'different cities' as event_type, moment::date as report_dt
    from seen{tag}
    where (passport, hour) in (
        select (passport, hour) from seen{tag} where passport is not null and moment is not null
        group by passport, hour having count(distinct city) > 1)"""


CITY_COUNTS = """select passport as passport_num, min(moment) as hour_group, count(distinct city) as count_cities
    from seen where moment is not null group by passport, hour"""

FIRST_IN_HOUR = """select transaction_id, seen.passport as passport_num, earliest as hour_group
    from seen join (select passport, hour, min(moment) as earliest from seen group by passport, hour) g
      on g.passport is not distinct from seen.passport and g.hour is not distinct from seen.hour"""


def report_sql(tag: str = "") -> str:
    return f"{static_rules_sql(tag)}\nunion all\n{cities_sql(tag)}"


def daily_report_sql(days: int = 3, mode: str = "open_only") -> str:
    """The report of each day's staged batch against the states after that day."""
    ctes = [*history_chain("t", days, mode), *history_chain("b", days, mode)]
    for n in range(1, days + 1):
        ctes.append(batch_tx(n))
        ctes.append(f"terminals_{n} as ({current_sql('t', n, T_COLS)})")
        ctes.append(f"blacklist_{n} as ({current_sql('b', n, 'passport')})")
        ctes += seen_ctes(f"tx_b{n}", f"terminals_{n}", f"blacklist_{n}", f"_{n}")
    return with_fixtures(*ctes, body="\nunion all\n".join(report_sql(f"_{n}") for n in range(1, days + 1)))

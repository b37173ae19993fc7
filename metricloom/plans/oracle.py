"""SQL with the same results as the registered queries, for a second engine.

Written the plain way: trailing counts as range joins, aggregates after joins.
It shares parameters and fixed values with the queries. Only the synthetic rows
share more: their digests and the order by digest are part of their definition, so
the SQL repeats them (with one global sort in place of buckets).
"""

from __future__ import annotations

from metricloom import fixed_values as fixed
from metricloom.plans import registry as reg
from metricloom.sources import sample_tables as sample


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _words(values) -> str:
    return ", ".join(_text(v) for v in values)


def _case(key: str, pairs: dict) -> str:
    return f"case {key} " + " ".join(
        f"when {_text(k) if isinstance(k, str) else k} then {_text(v)}" for k, v in pairs.items()
    ) + " end"


AS_OF = f"timestamp '{reg.AS_OF}'"

# Named parts, each with the parts it reads.
PARTS: dict[str, tuple[list[str], str]] = {
    "raw_customers": ([], f"""
        select cast(c_custkey as varchar) as customer_id,
               ' ' || split_part(c_name, '#', 1) as first_name,
               split_part(c_name, '#', 2) || '  ' as last_name,
               c_name || '@Example.COM ' as email,
               (select min(o_orderdate) from orders where o_custkey = c_custkey) as signup_date,
               ' n' || cast(c_nationkey as varchar) as country,
               {_case('c_nationkey % 5', sample.CHANNEL_TEXT)} as acquisition_channel,
               {_case('c_mktsegment', sample.SEGMENT_TEXT)} as segment,
               case when c_acctbal > 5000 then 'True' when c_acctbal > 2500 then '1'
                    when c_acctbal > 0 then 't' else 'no' end as is_active
        from customer"""),
    "raw_events": ([], """
        select cast(event_id as varchar) as event_id, cast(user_id as varchar) as customer_id,
               ts as event_timestamp,
               case when event_type = 'view' then ' Page_View'
                    when event_type = 'click' and value > 100 then 'SIGN_UP_STARTED'
                    when event_type = 'signup' and value > 110 then 'sign_up_completed '
                    when event_type = 'purchase' and value > 150 then 'Upgraded'
                    when event_type = 'purchase' and value > 80 then 'activated'
                    when event_type = 'error' then 'churned'
                    else 'feature_used' end as event_type,
               case when value < 30 then 'Web ' when value < 60 then ' iOS'
                    else 'ANDROID' end as platform,
               printf('S%08d', user_id) as session_id
        from events"""),
    "raw_payments": ([], f"""
        select cast(o_orderkey as varchar) as payment_id, cast(o_custkey as varchar) as customer_id,
               o_orderdate as payment_timestamp, o_totalprice as amount,
               case when o_totalprice >= {sample.UNRATED_FROM} then '{sample.UNRATED_CURRENCY}'
                    else {_case('o_orderpriority', sample.CURRENCY_TEXT)} end as currency,
               {_case('o_orderstatus', sample.STATUS_TEXT)} as status,
               substr(o_orderpriority, 3) as plan
        from orders"""),
    "stg_customers": (["raw_customers"], f"""
        select customer_id, trim(first_name) as first_name, trim(last_name) as last_name,
               lower(trim(email)) as email, signup_date as signup_at,
               upper(trim(country)) as country_code,
               lower(trim(acquisition_channel)) as acquisition_channel,
               upper(substr(trim(segment), 1, 1)) || lower(substr(trim(segment), 2)) as segment,
               coalesce(lower(is_active) in ({_words(fixed.TRUE_WORDS)}), false) as is_active
        from raw_customers"""),
    "stg_events": (["raw_events"], f"""
        select event_id, customer_id, event_timestamp as event_at,
               lower(trim(event_type)) as event_type, lower(trim(platform)) as platform, session_id,
               case lower(trim(event_type)) {' '.join(
                   f"when '{t}' then {n}" for t, n in fixed.FUNNEL_STEPS.items()
               )} end as funnel_step
        from raw_events"""),
    "fx": ([], "select * from (values " + ", ".join(
        f"('{c}', cast('{r}' as decimal(5,4)))" for c, r in fixed.USD_RATES.items()
    ) + ") as rates(currency, usd_rate)"),
    "stg_payments": (["raw_payments", "fx"], """
        select p.payment_id, p.customer_id, p.payment_timestamp as paid_at,
               cast(p.amount as decimal(12,2)) as amount_local, upper(trim(p.currency)) as currency,
               cast(p.amount as decimal(12,2)) * fx.usd_rate as amount_usd,
               lower(trim(p.status)) as status,
               upper(substr(p.plan, 1, 1)) || lower(substr(p.plan, 2)) as plan
        from raw_payments p left join fx on fx.currency = upper(trim(p.currency))"""),
    "dim": (["stg_customers"], f"""
        select md5(customer_id) as customer_sk, customer_id, first_name, last_name, email,
               signup_at, cast(signup_at as date) as signup_date,
               cast(date_trunc('month', signup_at) as date) as signup_month, country_code,
               acquisition_channel, segment,
               coalesce(segment in ({_words(fixed.PAYING_SEGMENTS)}), false) as is_paying,
               is_active,
               cast(datediff('day', signup_at, {AS_OF}) as integer) as days_since_signup
        from stg_customers"""),
    "ev": (["stg_events", "dim"], """
        select e.event_id, d.customer_sk, e.customer_id, cast(e.event_at as date) as event_date,
               e.event_at, e.event_type, e.platform, e.session_id, e.funnel_step,
               if(e.event_type = 'page_view', 1, 0) as is_page_view,
               if(e.event_type = 'sign_up_completed', 1, 0) as is_signup,
               if(e.event_type = 'activated', 1, 0) as is_activation,
               if(e.event_type = 'upgraded', 1, 0) as is_upgrade
        from stg_events e left join dim d on d.customer_id = e.customer_id"""),
    "pay": (["stg_payments", "dim"], """
        select p.payment_id, d.customer_sk, p.customer_id, cast(p.paid_at as date) as payment_date,
               p.paid_at, p.amount_local, p.currency, p.amount_usd, p.status, p.plan,
               d.segment as customer_segment, d.country_code,
               coalesce(p.status = 'succeeded', false) as is_recognized_revenue,
               if(p.status = 'succeeded', p.amount_usd, 0) as recognized_amount_usd
        from stg_payments p left join dim d on d.customer_id = p.customer_id"""),
    "days": ([], f"""
        select cast(t.d as date) as date_day
        from generate_series(timestamp '{reg.REPORT_FIRST}', timestamp '{reg.REPORT_LAST}',
                             interval 1 day) as t(d)"""),
    "event_days": (["ev"], "select distinct event_date from ev"),
    "data_days": (["ev"], """
        select cast(t.d as date) as date_day
        from (select min(event_date) as f, max(event_date) as l from ev) b,
             generate_series(b.f, b.l, interval 1 day) as t(d)"""),
    "daily": (["ev"], """
        select event_date, count(distinct customer_id) as dau from ev group by event_date"""),
    "weekly": (["ev", "event_days"], f"""
        select a.event_date, count(distinct e.customer_id) as wau
        from event_days a join ev e
          on e.event_date > a.event_date - {fixed.WEEK_DAYS} and e.event_date <= a.event_date
        group by a.event_date"""),
    "thirty": (["ev", "event_days"], f"""
        select a.event_date, count(distinct e.customer_id) as mau
        from event_days a join ev e
          on e.event_date > a.event_date - {fixed.MONTH_DAYS} and e.event_date <= a.event_date
        group by a.event_date"""),
    "kpi_users": (["days", "daily", "weekly", "thirty"], """
        select date_day, coalesce(dau, 0) as dau, coalesce(wau, 0) as wau, coalesce(mau, 0) as mau,
               if(coalesce(mau, 0) = 0, 0, round(cast(dau as double) / mau, 4)) as dau_mau_ratio
        from days
        left join daily on daily.event_date = date_day
        left join weekly on weekly.event_date = date_day
        left join thirty on thirty.event_date = date_day"""),
    "kpi_users_calendar": (["days", "ev"], f"""
        select date_day, dau, wau, mau,
               if(mau = 0, 0, round(cast(dau as double) / mau, 4)) as dau_mau_ratio
        from (
            select date_day,
                   count(distinct customer_id) filter (event_date = date_day) as dau,
                   count(distinct customer_id) filter (event_date > date_day - {fixed.WEEK_DAYS})
                       as wau,
                   count(distinct customer_id) as mau
            from days left join ev
              on event_date > date_day - {fixed.MONTH_DAYS} and event_date <= date_day
            group by date_day)"""),
    "kpi_users_data": (["data_days", "ev"], f"""
        select date_day, dau, wau, mau,
               if(mau = 0, 0, round(cast(dau as double) / mau, 4)) as dau_mau_ratio
        from (
            select date_day,
                   count(distinct customer_id) filter (event_date = date_day) as dau,
                   count(distinct customer_id) filter (event_date > date_day - {fixed.WEEK_DAYS})
                       as wau,
                   count(distinct customer_id) as mau
            from data_days left join ev
              on event_date > date_day - {fixed.MONTH_DAYS} and event_date <= date_day
            group by date_day)"""),
    "paid": (["stg_payments"], "select *, cast(paid_at as date) as payment_date from stg_payments"),
    "monthly": (["pay"], """
        select cast(date_trunc('month', payment_date) as date) as month_start,
               customer_segment as segment, sum(recognized_amount_usd) as revenue,
               count(distinct customer_id) as paying_customers, count(*) as txn_count
        from pay where is_recognized_revenue
        group by all"""),
    "lagged": (["monthly"], """
        select *, lag(revenue) over (partition by segment order by month_start) as previous
        from monthly"""),
    "kpi_revenue": (["lagged"], """
        select month_start, segment, cast(revenue as double) as revenue_usd, paying_customers,
               txn_count, cast(previous as double) as prev_month_revenue,
               round(cast(revenue - previous as double) / nullif(cast(previous as double), 0), 4)
                   as mom_growth_pct,
               if(paying_customers = 0, 0,
                  round(cast(revenue as double) / paying_customers, 2)) as arpu_usd
        from lagged"""),
    "reached": (["dim", "stg_events"], """
        select d.customer_id, d.signup_month,
               coalesce(max(if(event_type = 'sign_up_started', 1, 0)), 0) as did_start,
               coalesce(max(if(event_type = 'sign_up_completed', 1, 0)), 0) as did_complete,
               coalesce(max(if(event_type = 'activated', 1, 0)), 0) as did_activate,
               coalesce(max(if(event_type = 'upgraded', 1, 0)), 0) as did_upgrade
        from dim d left join stg_events e on e.customer_id = d.customer_id
        group by d.customer_id, d.signup_month"""),
    "cohorts": (["reached"], """
        select signup_month as cohort_month, count(*) as cohort_size,
               cast(sum(did_start) as bigint) as started,
               cast(sum(did_complete) as bigint) as completed,
               cast(sum(did_activate) as bigint) as activated,
               cast(sum(did_upgrade) as bigint) as upgraded
        from reached group by signup_month"""),
    "kpi_funnel": (["cohorts"], """
        select *, round(cast(started as double) / cohort_size, 4) as pct_started,
               round(cast(completed as double) / cohort_size, 4) as pct_completed,
               round(cast(activated as double) / cohort_size, 4) as pct_activated,
               round(cast(upgraded as double) / cohort_size, 4) as pct_upgraded,
               round(cast(activated as double) / nullif(completed, 0), 4)
                   as completion_to_activation,
               round(cast(upgraded as double) / nullif(activated, 0), 4) as activation_to_upgrade
        from cohorts"""),
}


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(PARTS[name][0], seen)
            seen.append(name)
    return seen


def sql(parts: list[str], select: str) -> str:
    """A select over named parts."""
    ctes = [f"{name} as ({PARTS[name][1]})" for name in _needed(parts, [])]
    return (f"with {', '.join(ctes)} " if ctes else "") + select


# --- synthetic data ------------------------------------------------------------


def _u(seed: int, row: str, draw: int) -> str:
    digits = f"substr(md5('{seed}.{draw // 2}:' || {row}), {1 + 13 * (draw % 2)}, 13)"
    return f"(cast('0x' || {digits} as bigint) / cast({1 << 52} as double))"


def _whole(u: str, n) -> str:
    return f"cast(floor({u} * {n}) as bigint)"


def _pick(u: str, values: list) -> str:
    items = ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[{_whole(u, len(values))} + 1]"


def _weighted(u: str, values: list[str], weights: list[float]) -> str:
    whens, reached = [], 0.0
    for value, weight in zip(values[:-1], weights[:-1], strict=True):
        reached = round(reached + weight, 10)
        whens.append(f"when {u} < cast({reached} as double) then {_text(value)}")
    return f"case {' '.join(whens)} else {_text(values[-1])} end"


def _spread(u: str) -> str:
    first, last = f"timestamp '{fixed.ACTIVITY_START}'", f"timestamp '{fixed.ACTIVITY_END}'"
    return f"{first} + to_seconds({_whole(u, f'''datediff('second', {first}, {last})''')})"


_C = [_u(fixed.CUSTOMER_SEED, "c_custkey", i) for i in range(8)]
_E = [_u(fixed.EVENT_SEED, "n", i) for i in range(5)]
_P = [_u(fixed.PAYMENT_SEED, "n", i) for i in range(5)]
_PLAN_PRICE = "case plan " + " ".join(
    f"when '{plan}' then {usd}" for plan, usd in fixed.PLAN_PRICES.items()
) + " end"

SYNTH_CUSTOMERS = f"""
    select customer_id, first_name, last_name, email, signup_date, country, acquisition_channel,
           segment,
           draw > if(segment = 'Free', cast({fixed.INACTIVE_SHARE_FREE} as double),
                     cast({fixed.INACTIVE_SHARE_OTHER} as double)) as is_active
    from (select printf('{fixed.CUSTOMER_KEY}', c_custkey) as customer_id,
                 {_pick(_C[3], fixed.FIRST_NAMES)} as first_name,
                 {_pick(_C[4], fixed.LAST_NAMES)} as last_name,
                 'user' || c_custkey || '@example.com' as email,
                 timestamp '{fixed.SIGNUP_START}'
                     + to_hours({_whole(_C[0], fixed.SIGNUP_MAX_DAYS + 1)} * 24
                                + {_whole(_C[1], 24)}) as signup_date,
                 {_pick(_C[5], fixed.COUNTRIES)} as country,
                 {_pick(_C[6], fixed.CHANNELS)} as acquisition_channel,
                 {_weighted(_C[2], fixed.SEGMENTS, fixed.SEGMENT_WEIGHTS)} as segment,
                 {_C[7]} as draw
          from customer)"""


def _numbered(source: str, columns: str) -> str:
    place = "cast('0x' || substr(md5(customer_id), 1, 13) as bigint)"
    return (
        f"select {columns}, row_number() over (order by {place}, customer_id) - 1 as row_index, "
        f"count(*) over () as total from ({source})"
    )


SYNTH_EVENTS = f"""
    with who as ({_numbered(SYNTH_CUSTOMERS, 'customer_id')}),
    drawn as (
        select n, {_whole(_E[0], '(select max(total) from who)')} as row_index
        from range(1, (select max(total) * {reg.EVENTS_PER_CUSTOMER} + 1 from who)) as r(n))
    select printf('{fixed.EVENT_KEY}', n) as event_id, customer_id,
           {_spread(_E[1])} as event_timestamp,
           {_weighted(_E[2], fixed.EVENT_TYPES, fixed.EVENT_WEIGHTS)} as event_type,
           {_weighted(_E[3], fixed.PLATFORMS, fixed.PLATFORM_WEIGHTS)} as platform,
           printf('{fixed.SESSION_KEY}', {_whole(_E[4], fixed.SESSION_COUNT)} + 1) as session_id
    from drawn join who using (row_index)"""

SYNTH_PAYMENTS = f"""
    with paying as (select * from ({SYNTH_CUSTOMERS})
                    where segment in ({_words(fixed.PAYING_SEGMENTS)})),
    who as ({_numbered('select * from paying', 'customer_id, segment as plan')}),
    drawn as (
        select n, {_whole(_P[0], '(select max(total) from who)')} as row_index
        from range(1, (select max(total) * {reg.PAYMENTS_PER_PAYING_CUSTOMER} + 1 from who))
            as r(n))
    select printf('{fixed.PAYMENT_KEY}', n) as payment_id, customer_id,
           {_spread(_P[1])} as payment_timestamp,
           cast({_PLAN_PRICE} * {_pick(_P[2], fixed.PRICE_MULTIPLES)} as double) as amount,
           {_weighted(_P[3], fixed.CURRENCIES, fixed.CURRENCY_WEIGHTS)} as currency,
           {_weighted(_P[4], fixed.STATUSES, fixed.STATUS_WEIGHTS)} as status, plan
    from drawn join who using (row_index)"""


# --- queries -----------------------------------------------------------------------


def _buyers(anchors: str) -> str:
    return sql(["paid"], f"""
        select a.day as {{day}}, count(distinct customer_id) filter (payment_date = a.day)
                   as buyers_1d,
               count(distinct customer_id) filter (payment_date > a.day - {fixed.WEEK_DAYS})
                   as buyers_7d,
               count(distinct customer_id) as buyers_30d
        from ({anchors}) a left join paid
          on payment_date > a.day - {fixed.MONTH_DAYS} and payment_date <= a.day
        group by a.day""")


def _with_engaged(name: str, width: int) -> str:
    return sql(["ev", "event_days"], f"""
        select a.event_date, count(distinct e.customer_id) as {name},
               count(distinct e.customer_id) filter (e.funnel_step >= {reg.ENGAGED_STEP})
                   as engaged_{name}
        from event_days a join ev e
          on e.event_date > a.event_date - {width} and e.event_date <= a.event_date
        group by a.event_date""")


def _payment_texts() -> str:
    price = "cast(cast(o_totalprice as decimal(12,2)) as varchar)"
    return f"""
        select cast(o_orderkey as varchar) as payment_id,
               case when o_orderkey % {sample.NO_SUCH_DAY} = 0 then '2024-13-45'
                    when o_orderkey % {sample.EMPTY_TIME} = 0 then ''
                    else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as payment_timestamp,
               case when o_orderkey % {sample.NO_AMOUNT} = 0 then 'n/a'
                    when o_orderkey % {sample.AMOUNT_WITH_UNIT} = 0 then {price} || ' EUR'
                    else {price} end as amount
        from orders"""


_BAD_TIME = "(payment_timestamp is not null and try_cast(payment_timestamp as timestamp) is null)"
_BAD_AMOUNT = "(amount is not null and try_cast(amount as decimal(12,2)) is null)"


def _all_order_days() -> str:
    return """select cast(t.d as date) as date_day
        from (select min(cast(o_orderdate as date)) as f, max(cast(o_orderdate as date)) as l
              from orders) b, generate_series(b.f, b.l, interval 1 day) as t(d)"""


def _freshness(
    name: str, table: str, column: str, as_of: str = reg.AS_OF, shown: str = ""
) -> str:
    warn, error = fixed.FRESHNESS_HOURS[name]
    moment = f"timestamp '{as_of}'"
    hours = f"cast(datediff('microsecond', max({column}), {moment}) as double) / 3600000000"
    return f"""
        select '{shown or name}' as source_name, max({column}) as max_loaded_at,
               round({hours}, 4) as age_hours,
               case when max({column}) is null or {hours} > {error} then 'error'
                    when {hours} > {warn} then 'warn' else 'pass' end as status
        from {table}"""


_RATES = """pct_started, pct_completed, pct_activated, pct_upgraded, completion_to_activation,
    activation_to_upgrade"""
_COHORT_TILES = "cohort_month, cohort_size, pct_completed, pct_activated, pct_upgraded"

ORACLE: dict[str, str] = {
    "row_counts": sql(["raw_customers", "raw_events", "raw_payments"], """
        select 'raw_crm_customers' as table_name, count(*) as row_count from raw_customers
        union all select 'raw_app_events', count(*) from raw_events
        union all select 'raw_payments', count(*) from raw_payments"""),
    "filter_paying_customers": sql(["stg_customers"], f"""
        select customer_id, segment from stg_customers
        where segment in ({_words(fixed.PAYING_SEGMENTS)})"""),
    "fx_literal_relation": sql(["fx", "stg_payments"], """
        select fx.currency, cast(any_value(usd_rate) as double) as usd_rate,
               nullif(count(payment_id), 0) as txn_count,
               cast(sum(amount_local) as double) as amount_local
        from fx left join stg_payments p on p.currency = fx.currency group by fx.currency"""),
    "synth_keys": f"""
        select o_orderkey, printf('{fixed.CUSTOMER_KEY}', o_custkey) as customer_key,
               printf('{fixed.EVENT_KEY}', o_orderkey) as event_key,
               printf('{fixed.SESSION_KEY}', o_custkey) as session_key,
               printf('{fixed.PAYMENT_KEY}', o_orderkey) as payment_key,
               'user' || o_custkey || '@example.com' as email
        from orders""",
    "synth_customers": SYNTH_CUSTOMERS,
    "synth_events": SYNTH_EVENTS,
    "synth_payments": SYNTH_PAYMENTS,
    "scalar_strings": sql(["raw_customers"], """
        select customer_id, trim(first_name) as trimmed, lower(trim(email)) as lowered,
               upper(trim(country)) as uppered,
               upper(substr(trim(segment), 1, 1)) || lower(substr(trim(segment), 2)) as title_case,
               upper(substr(acquisition_channel, 1, 1)) || lower(substr(acquisition_channel, 2))
                   as capitalised
        from raw_customers"""),
    "scalar_casts": sql(["raw_payments"], """
        select cast(payment_id as bigint) as payment_number,
               cast(payment_timestamp as date) as payment_date,
               cast(cast(payment_timestamp as date) as varchar) as date_text,
               cast(cast(payment_timestamp as date) as timestamp) as day_start,
               cast(cast(amount as decimal(12,2)) as double) as amount_local,
               cast(cast(amount as decimal(12,2)) >= 100000 as integer) as is_large
        from raw_payments"""),
    "bool_parse": sql(["raw_customers"], f"""
        select customer_id, is_active as raw_text,
               coalesce(lower(is_active) in ({_words(fixed.TRUE_WORDS)}), false) as is_active
        from raw_customers"""),
    "segment_ilike_case": sql(["raw_customers"], f"""
        select customer_id, case {' '.join(
            f"when segment ilike '{s}' then '{s}'" for s in fixed.SEGMENTS
        )} end as segment from raw_customers"""),
    "event_funnel_step": sql(["stg_events"],
                             "select event_id, event_type, funnel_step from stg_events"),
    "event_flags": sql(["stg_events"], """
        select event_id, if(event_type = 'page_view', 1, 0) as is_page_view,
               if(event_type = 'sign_up_completed', 1, 0) as is_signup,
               if(event_type = 'activated', 1, 0) as is_activation,
               if(event_type = 'upgraded', 1, 0) as is_upgrade
        from stg_events"""),
    "stg_customers": sql(["stg_customers"], "select * from stg_customers"),
    "stg_customers_strict": sql(["raw_customers", "stg_customers"], f"""
        select s.* replace (case {' '.join(
            f"when r.segment ilike '{s}' then '{s}'" for s in fixed.SEGMENTS
        )} end as segment)
        from (select distinct * from stg_customers) s
        join raw_customers r using (customer_id)"""),
    "stg_events": sql(["stg_events"], "select * from stg_events"),
    "stg_payments": sql(["stg_payments"], """
        select * replace (cast(amount_local as double) as amount_local,
                          cast(amount_usd as double) as amount_usd) from stg_payments"""),
    "payments_fx_usd": sql(["stg_payments"], """
        select payment_id, currency, cast(amount_local as double) as amount_local,
               cast(amount_usd as double) as amount_usd from stg_payments"""),
    "dim_date": f"""
        with spine as ({_all_order_days()}),
        per_day as (select cast(o_orderdate as date) as d, count(*) as n from orders group by all)
        select date_day, cast(year(date_day) as integer) as year,
               cast(quarter(date_day) as integer) as quarter,
               cast(month(date_day) as integer) as month,
               cast(day(date_day) as integer) as day_of_month,
               cast(dayofweek(date_day) as integer) as day_of_week,
               dayname(date_day) as day_name, monthname(date_day) as month_name,
               cast(date_trunc('month', date_day) as date) as month_start,
               cast(date_trunc('quarter', date_day) as date) as quarter_start,
               cast(date_trunc('year', date_day) as date) as year_start,
               dayofweek(date_day) in (0, 6) as is_weekend, coalesce(n, 0) as orders
        from spine left join per_day on d = date_day""",
    "dim_customers": sql(["dim"], "select * from dim"),
    "surrogate_key": "select cast(o_orderkey as varchar) as payment_id, "
                     "md5(cast(o_custkey as varchar)) as customer_sk from orders",
    "tenure_days": sql(["dim"], "select customer_id, days_since_signup from dim"),
    "fct_events": sql(["ev"], "select * from ev"),
    "fct_payments": sql(["pay"], """
        select * replace (cast(amount_local as double) as amount_local,
                          cast(amount_usd as double) as amount_usd,
                          cast(recognized_amount_usd as double) as recognized_amount_usd)
        from pay"""),
    "filter_recognized_payments": sql(["pay"], """
        select payment_id, customer_segment, payment_date,
               cast(recognized_amount_usd as double) as recognized_amount_usd
        from pay where is_recognized_revenue"""),
    "filter_date_between": sql(["paid"], f"""
        select payment_id, payment_date, cast(amount_local as double) as amount_local
        from paid
        where payment_date between date '{reg.RANGE_FIRST}' and date '{reg.RANGE_LAST}'"""),
    "distinct_anchor_days": sql(["event_days"], "select * from event_days"),
    "dau": sql(["daily"], "select * from daily"),
    "wau_rolling": _with_engaged("wau", fixed.WEEK_DAYS),
    "mau_rolling": _with_engaged("mau", fixed.MONTH_DAYS),
    "active_users_folded": f"""
        select event_date, dau, w.wau, m.mau, engaged_wau, engaged_mau
        from ({sql(["daily"], "select * from daily")}) d
        join ({_with_engaged("wau", fixed.WEEK_DAYS)}) w using (event_date)
        join ({_with_engaged("mau", fixed.MONTH_DAYS)}) m using (event_date)""",
    "dau_mau_joined": sql(["daily", "thirty"], """
        select event_date, dau, mau, round(cast(dau as double) / mau, 4) as dau_mau_ratio
        from daily join thirty using (event_date)"""),
    "dau_mau_stickiness": sql(["daily", "thirty"], """
        select event_date, round(cast(dau as double) / mau, 4) as dau_mau_ratio
        from daily join thirty using (event_date)"""),
    "quarantine_accepted": f"""
        select payment_id, cast(payment_timestamp as timestamp) as payment_timestamp,
               cast(cast(amount as decimal(12,2)) as double) as amount
        from ({_payment_texts()}) where not {_BAD_TIME} and not {_BAD_AMOUNT}""",
    "quarantine_rejected": f"""
        select payment_id, if({_BAD_TIME}, payment_timestamp, null) as payment_timestamp_text,
               if({_BAD_AMOUNT}, amount, null) as amount_text,
               concat_ws(',', if({_BAD_AMOUNT}, 'amount', null),
                         if({_BAD_TIME}, 'payment_timestamp', null)) as reasons
        from ({_payment_texts()}) where {_BAD_TIME} or {_BAD_AMOUNT}""",
    "calendar_gap_fill": sql(["paid"], f"""
        select date_day, count(payment_id) filter (status = 'refunded') as refunds,
               count(distinct customer_id) filter (status = 'refunded') as customers,
               count(payment_id) filter (amount_usd is null) as unrated
        from ({_all_order_days()}) left join paid on payment_date = date_day
        group by date_day"""),
    "kpi_daily_active_users": sql(["kpi_users"], "select * from kpi_users"),
    "kpi_daily_active_users_calendar": sql(["kpi_users_calendar"],
                                           "select * from kpi_users_calendar"),
    "active_buyers": _buyers(
        "select distinct payment_date as day from paid where payment_date is not null").replace(
        "{day}", "payment_date"),
    "active_buyers_calendar": _buyers(
        f"select date_day as day from ({_all_order_days()})").replace("{day}", "date_day"),
    "monthly_revenue": sql(["monthly"], """
        select month_start, segment, cast(revenue as double) as revenue_usd, paying_customers,
               txn_count from monthly"""),
    "revenue_prev_month": sql(["kpi_revenue"], """
        select month_start, segment, revenue_usd, prev_month_revenue from kpi_revenue"""),
    "revenue_mom_growth": sql(["kpi_revenue"],
                              "select month_start, segment, mom_growth_pct from kpi_revenue"),
    "arpu": sql(["kpi_revenue"],
                "select month_start, segment, paying_customers, arpu_usd from kpi_revenue"),
    "kpi_revenue_by_segment": sql(["kpi_revenue"], "select * from kpi_revenue"),
    "revenue_series": sql(["kpi_revenue"],
                          "select * from kpi_revenue order by month_start, segment"),
    "revenue_by_month": sql(["monthly"], """
        select month_start, cast(sum(revenue) as double) as revenue from monthly
        group by month_start"""),
    "kpi_revenue_recent": sql(["kpi_revenue"], f"""
        select * from kpi_revenue where month_start >= date '{reg.RECENT_MONTH}'
        order by month_start, segment"""),
    "customer_milestones": sql(["reached"], "select * from reached"),
    "cohort_rollup": sql(["cohorts"], "select * from cohorts"),
    "funnel_rates": sql(["kpi_funnel"], f"select cohort_month, {_RATES} from kpi_funnel"),
    "kpi_funnel_conversion": sql(["kpi_funnel"], "select * from kpi_funnel"),
    "kpi_funnel_recent": sql(["kpi_funnel"], f"""
        select {_COHORT_TILES} from kpi_funnel
        where cohort_month >= date '{reg.RECENT_COHORT}' order by cohort_month"""),
    "funnel_latest_cohort": sql(["kpi_funnel"], f"""
        select {_COHORT_TILES} from kpi_funnel
        where cohort_month = (select max(cohort_month) from kpi_funnel)"""),
    "dq_unique": sql(["stg_payments"], """
        select customer_id, count(*) as n_records from stg_payments
        where customer_id is not null group by customer_id having count(*) > 1"""),
    "dq_unique_summary": sql(["stg_payments"], """
        select 'unique payment_id' as check_name,
               count(*) - count(distinct payment_id) as failures from stg_payments
        union all
        select 'unique customer_id', count(*) - count(distinct customer_id) from stg_payments"""),
    "dq_not_null": sql(["stg_payments", "stg_events"], """
        select 'not_null_stg_payments_payment_id' as check_name,
               count(*) - count(payment_id) as failures from stg_payments
        union all
        select 'not_null_stg_payments_amount_usd', count(*) - count(amount_usd) from stg_payments
        union all
        select 'not_null_stg_events_event_id', count(*) - count(event_id) from stg_events
        union all
        select 'not_null_stg_events_funnel_step', count(*) - count(funnel_step)
        from stg_events"""),
    "dq_accepted_values": sql(["dim"], f"""
        select 'accepted_values_dim_customers_segment' as check_name, count(*) as failures
        from dim where segment not in ({_words(fixed.SEGMENTS)})"""),
    "dq_relationships_payments": sql(["stg_payments", "dim", "stg_events"], " union all ".join(
        f"""
        select 'relationships_stg_payments_customer_id__{name}_customer_id' as check_name,
               count(*) as failures
        from stg_payments p where p.customer_id is not null
          and not exists (select 1 from {parent} x where x.customer_id = p.customer_id)"""
        for name, parent in {
            "dim_customers": "dim",
            "paying_customers": "(select * from dim where is_paying)",
            "stg_events": "stg_events",
        }.items())),
    "dq_orphan_event_sk": sql(["stg_events", "dim"], """
        select 'no orphan event customer_sk (all)' as check_name, count(*) as failures
        from stg_events e where not exists (
            select 1 from dim d where d.customer_id = e.customer_id)
        union all
        select 'no orphan event customer_sk (paying)', count(*)
        from stg_events e where not exists (
            select 1 from dim d where d.customer_id = e.customer_id and d.is_paying)"""),
    "source_freshness": sql(
        ["raw_events", "raw_payments"],
        _freshness("events", "raw_events", "event_timestamp")
        + " union all "
        + _freshness(
            "events", "raw_events", "event_timestamp", reg.AS_OF_EARLIER, "events, earlier"
        )
        + " union all " + _freshness("payments", "raw_payments", "payment_timestamp")),
    "dq_report": sql(["dim", "stg_payments", "stg_events"], f"""
        select '{fixed.REPORT_LINES["customers"]}' as check_name,
               count(*) - count(distinct customer_id) as failures from dim
        union all
        select '{fixed.REPORT_LINES["payments"]}',
               count(*) - count(distinct payment_id) from stg_payments
        union all
        select '{fixed.REPORT_LINES["events"]}', count(*) from stg_events e
        where not exists (
            select 1 from dim d where d.customer_id = e.customer_id and d.is_paying)"""),
    "latest_days_topk": sql(["kpi_users_data"], """
        select * from kpi_users_data order by date_day desc limit 30"""),
    "headline_tiles": sql(["kpi_users_data", "paid"], """
        , newest as (
            select * from kpi_users_data
            where date_day = (select max(date_day) from kpi_users_data)),
        by_month as (
            select date_trunc('month', payment_date) as month, sum(amount_usd) as revenue
            from paid where status = 'succeeded' group by all)
        select 'dau' as tile, cast(dau as double) as value from newest
        union all select 'mau', cast(mau as double) from newest
        union all select 'dau_mau_ratio', dau_mau_ratio from newest
        union all
        select 'revenue_latest_month', cast(revenue as double) from by_month
        where month = (select max(month) from by_month)"""),
}

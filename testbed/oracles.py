"""The expected result of every query as DuckDB SQL over the driver's tables.

table expressions, and not from the Spark code: the Spark side aggregates before it joins, this side
joins first.
"""

from __future__ import annotations

RAW = r"""
cust as (select c_custkey as k, c_custkey // 75 as acc, c_custkey % 75 as j from customer),
placed as (select k, acc, case when j < 50 then 0 when j < 65 then 1 when j < 72 then 2 end as n from cust),
acct as (select distinct acc from cust),
raw_accounts as (
  select acc::varchar as id, 'Account ' || acc as name,
         '2020-01-' || lpad((1 + acc % 28)::varchar, 2, '0') || ' 08:00:00' as created_at,
         (['Europe/Madrid', 'Europe/Paris', 'UTC'])[1 + acc % 3] as time_zone, n_name as country
  from acct join nation on n_nationkey = acc % 25),
raw_locations as (
  select (acc * 10 + s.n)::varchar as id, 'Site ' || (acc * 10 + s.n) as name, acc::varchar as account_id,
         case s.n when 3 then (['Yes', 'true', '1'])[1 + acc % 3]
                  when 4 then case when acc % 2 = 0 then 'unknown' end
                  else (['No', 'FALSE', ' 0 '])[1 + (acc + s.n) % 3] end as archived,
         'City ' || acc as city, lpad(acc::varchar, 5, '0') as zipcode, n_name as country
  from acct, unnest([0, 1, 2, 3, 4]) as s(n) join nation on n_nationkey = s.n),
raw_memberships as (
  select k::varchar as id, (k + 100000)::varchar as user_id, acc::varchar as account_id,
         (['true', 'NO', ' 1 ', 'n/a'])[1 + k % 4] as active,
         ([' Employee ', 'MANAGER', 'admin'])[1 + k % 3] as role,
         'First' || k as firstname, 'Last' || k as lastname
  from cust),
made as (
  select k, 1 as suffix, k as mem, acc * 10 + n as loc, acc as own from placed
  union all select k, 2, k, acc * 10 + n, acc from placed where k % 10 = 0
  union all select k, 3, k, acc * 10 + (case k % 10 when 1 then 3 when 2 then 4 else 1 end), acc from placed where k % 10 between 1 and 3
  union all select k, 4, null, acc * 10 + n, acc from placed where k % 25 = 4
  union all select k, 5, k, acc * 10 + n, acc + 1 from placed where k % 25 = 5
  union all select k, 6, k, (acc + 1) * 10, acc from placed where k % 25 = 6
  union all select k, 7, k + 1000000000, acc * 10 + n, acc from placed where k % 25 = 7),
raw_user_contracts as (
  select (k * 10 + suffix)::varchar as id, mem::varchar as membership_id, loc::varchar as location_id,
         own::varchar as account_id,
         (['2023-01-15', '15/01/2023', ' 2023-02-01 ', 'n/a'])[1 + k % 4] as contract_start,
         ([null, '31/12/2024', null, '2024-12-31'])[1 + k % 4] as contract_end,
         ([' Full_Time ', 'PART_TIME'])[1 + k % 2] as contract_type,
         (['35h', ' 39H ', '37,5', null, '35h30'])[1 + k % 5] as contract_time
  from made),
activity as (
  select event_id, event_type, event_id::varchar as id,
         case when event_id % 37 <> 0 then (user_id * 10 + case
             when event_id % 10 >= 4 then event_id % 10 - 2
             when user_id % 5 < 3 or event_id % 20 = 0 then 1
             else 8 end)::varchar end as user_contract_id,
         (user_id // 75)::varchar as account_id,
         case when event_id % 53 <> 0 then case when event_id % 29 = 0
             then (ts + interval 2 hours)::varchar || '+02:00' else ts::varchar end end as starts_at,
         (ts + interval 8 hours)::varchar as ends_at
  from events),
raw_shifts as (
  select id, user_contract_id, account_id, starts_at, ends_at,
         ([' Planned ', 'ADHOC'])[1 + event_id % 2] as planification_type
  from activity where event_type is null or event_type not in ('signup', 'error')),
raw_rests as (
  select id, user_contract_id, account_id, starts_at, ends_at,
         (['Vacation', ' SICK ', 'rest'])[1 + event_id % 3] as rest_type
  from activity where event_type in ('signup', 'error'))
"""

STAGING = r"""
spelling(word, meaning) as (
  values ('true', true), ('yes', true), ('1', true), ('false', false), ('no', false), ('0', false)),
stg_accounts as (
  select id as account_id, name as account_name, created_at::timestamp as created_at, time_zone, country
  from raw_accounts),
stg_locations as (
  select id as location_id, name as location_name, account_id, meaning as is_archived, city, zipcode, country
  from raw_locations left join spelling on word = lower(trim(archived))),
stg_memberships as (
  select id as membership_id, user_id, account_id, meaning as is_active, lower(trim(role)) as role,
         firstname as first_name, lastname as last_name
  from raw_memberships left join spelling on word = lower(trim(active))),
stg_rests as (
  select id as rest_id, user_contract_id, account_id, (left(starts_at, 19) || coalesce(regexp_extract(starts_at, '\.[0-9]+'), ''))::timestamp
         - coalesce(try_cast(nullif(regexp_extract(starts_at, '\+([0-9]{2}):00$', 1), '') as integer), 0) * interval 1 hour as starts_at_utc,
         ends_at::timestamp as ends_at_utc, lower(trim(rest_type)) as rest_type
  from raw_rests),
stg_shifts as (
  select id as shift_id, user_contract_id, account_id, (left(starts_at, 19) || coalesce(regexp_extract(starts_at, '\.[0-9]+'), ''))::timestamp
         - coalesce(try_cast(nullif(regexp_extract(starts_at, '\+([0-9]{2}):00$', 1), '') as integer), 0) * interval 1 hour as starts_at_utc,
         ends_at::timestamp as ends_at_utc, lower(trim(planification_type)) as planification_type
  from raw_shifts),
stg_user_contracts as (
  select id as user_contract_id, membership_id, location_id, account_id,
         coalesce(try_strptime(trim(contract_start), '%Y-%m-%d'), try_strptime(trim(contract_start), '%d/%m/%Y'))::date as contract_start,
         coalesce(try_strptime(trim(contract_end), '%Y-%m-%d'), try_strptime(trim(contract_end), '%d/%m/%Y'))::date as contract_end,
         lower(trim(contract_type)) as contract_type,
         translate(lower(trim(contract_time)), ',h', '.')::double as contract_time
  from raw_user_contracts)
"""

MODEL = r"""
tagged as (
  select shift_id as event_id, 'shift' as event_type, user_contract_id, account_id, starts_at_utc, ends_at_utc from stg_shifts
  union all
  select rest_id, 'rest', user_contract_id, account_id, starts_at_utc, ends_at_utc from stg_rests),
int_all_schedules as (
  select t.*, starts_at_utc::date as activity_date,
         (starts_at_utc::date - (isodow(starts_at_utc) - 1)::integer)::date as week_start
  from tagged t join stg_user_contracts using (user_contract_id)),
int_employee_activity_daily as (
  select user_contract_id, account_id, activity_date, week_start, count(*)::bigint as schedule_count, 1::integer as had_activity
  from int_all_schedules group by all),
int_employee_activity_weekly as (
  select user_contract_id, account_id, week_start, count(*)::bigint as active_days_in_week, 1::integer as had_activity_in_week
  from int_employee_activity_daily group by all),
attributed as (
  select w.account_id, w.week_start, k.membership_id, w.user_contract_id, k.location_id, w.active_days_in_week
  from int_employee_activity_weekly w
  join stg_user_contracts k using (user_contract_id, account_id)
  join stg_memberships m using (membership_id, account_id)),
int_billable_employees_weekly as (
  select account_id, week_start, membership_id, location_id, min(user_contract_id) as user_contract_id,
         max(active_days_in_week)::bigint as active_days_in_week, 1::integer as is_billable_employee
  from attributed group by all),
headcount as (
  select account_id, location_id, week_start, count(distinct membership_id)::bigint as heads
  from int_billable_employees_weekly group by all),
int_location_metrics_weekly as (
  select h.account_id, h.location_id, h.week_start, heads as billable_employee_count, is_archived,
         (is_archived is not distinct from false) as is_billable_location,
         case when heads >= 40 then 'large' when heads >= 6 then 'small' else 'micro' end as location_size
  from headcount h join stg_locations using (location_id, account_id)),
fct_location_revenue_weekly as (
  select account_id, location_id, week_start, billable_employee_count, location_size, is_billable_location,
         base::integer as base_price, mid::bigint as employees_in_7_39_band, top::bigint as employees_in_40_plus_band,
         (4 * mid + 2.4 * top)::decimal(18,2) as extra_employee_cost,
         (base + 4 * mid + 2.4 * top)::decimal(18,2) as total_location_revenue
  from (select *, list_price * is_billable_location::integer as base,
               greatest(least(billable_employee_count, 39) - 6, 0) * is_billable_location::integer as mid,
               greatest(billable_employee_count - 39, 0) * is_billable_location::integer as top
        from int_location_metrics_weekly
        join (values ('micro', 60), ('small', 80), ('large', 216)) price(location_size, list_price) using (location_size))),
fct_account_billing_weekly as (
  select account_id, week_start, (count(*) filter (is_billable_location))::bigint as billable_locations,
         coalesce(sum(billable_employee_count) filter (is_billable_location), 0)::bigint as billable_employees,
         sum(total_location_revenue)::decimal(18,2) as expected_weekly_revenue
  from fct_location_revenue_weekly group by all),
dim_accounts as (from stg_accounts),
dim_locations as (from stg_locations),
dim_memberships as (from stg_memberships),
dim_calendar_weekly as (
  select d::date as week_start, (d + interval 6 days)::date as week_end, weekofyear(d)::integer as iso_week
  from (select unnest(generate_series(min(week_start)::timestamp, max(week_start)::timestamp, interval 7 days)) as d
        from int_employee_activity_weekly))
"""

PREFIX = f"with {RAW.strip()},\n{STAGING.strip()},\n{MODEL.strip()}\n"

TABLE_NAMES = (
    "stg_accounts", "stg_locations", "stg_memberships", "stg_rests", "stg_shifts", "stg_user_contracts",
    "int_all_schedules", "int_employee_activity_daily", "int_employee_activity_weekly",
    "int_billable_employees_weekly", "int_location_metrics_weekly",
    "dim_accounts", "dim_locations", "dim_memberships", "dim_calendar_weekly",
    "fct_location_revenue_weekly", "fct_account_billing_weekly",
)

GRAINS = {
    "stg_accounts": "account_id",
    "stg_locations": "location_id",
    "stg_memberships": "membership_id",
    "stg_rests": "rest_id",
    "stg_shifts": "shift_id",
    "stg_user_contracts": "user_contract_id",
    "int_all_schedules": "event_type, event_id",
    "int_employee_activity_daily": "user_contract_id, account_id, activity_date",
    "int_employee_activity_weekly": "user_contract_id, account_id, week_start",
    "int_billable_employees_weekly": "account_id, week_start, membership_id, location_id",
    "int_location_metrics_weekly": "account_id, location_id, week_start",
    "dim_accounts": "account_id",
    "dim_locations": "location_id",
    "dim_memberships": "membership_id",
    "dim_calendar_weekly": "week_start",
    "fct_location_revenue_weekly": "account_id, location_id, week_start",
    "fct_account_billing_weekly": "account_id, week_start",
}

RAW_NAMES = ("raw_accounts", "raw_locations", "raw_memberships", "raw_rests", "raw_shifts", "raw_user_contracts")

READS = {
    "int_employee_activity_daily": "int_all_schedules",
    "int_employee_activity_weekly": "int_employee_activity_daily",
}


def _each(names, select: str) -> str:
    return PREFIX + "\nunion all ".join(select.format(name=name) for name in names)


def _audit() -> str:
    def row(name: str) -> str:
        before = f"(select count(*) from {READS[name]})" if name in READS else "null"
        return f"select '{name}' as table_name, {before}::bigint as rows_before, (select count(*) from {name})::bigint as rows_after"

    return PREFIX + "\nunion all ".join(row(name) for name in TABLE_NAMES)


def _grains() -> str:
    def row(name: str, grain: str) -> str:
        return (
            f"select '{name}' as table_name, count(*)::bigint as duplicate_keys, "
            f"coalesce(sum(n - 1), 0)::bigint as extra_rows "
            f"from (select count(*) as n from {name} group by {grain} having count(*) > 1)"
        )

    return PREFIX + "\nunion all ".join(row(*item) for item in GRAINS.items())


CHECKS = {
    "raw_csv_roundtrip": _each(
        RAW_NAMES,
        "select '{name}' as table_name, count(*)::bigint as rows_written, count(*)::bigint as rows_read, "
        "0::bigint as rows_differing from {name}",
    ),
    "row_count_audit": _audit(),
    "price_boundary_grid": r"""
with grid as (select distinct p_partkey::bigint as heads, billable from part, (values (true), (false)) b(billable)),
priced as (
  select heads, billable,
         case when heads < 6 then 'micro' when heads < 40 then 'small' else 'large' end as size,
         (select count(*) from generate_series(7, 39) g(e) where e <= heads) as mid,
         greatest(heads - 39, 0) as top
  from grid)
select heads as billable_employee_count, size as location_size, billable as is_billable_location,
       case when not billable then 0 when size = 'micro' then 60 when size = 'small' then 80 else 216 end::integer as base_price,
       (case when billable then mid else 0 end)::bigint as employees_in_7_39_band,
       (case when billable then top else 0 end)::bigint as employees_in_40_plus_band,
       (case when billable then mid * 4 + top * 2.4 else 0 end)::decimal(18,2) as extra_employee_cost,
       (case when not billable then 0 when size = 'micro' then 60 when size = 'small' then 80 + mid * 4
             else 216 + mid * 4 + top * 2.4 end)::decimal(18,2) as total_location_revenue
from priced""",
    "dq_orphan_events": PREFIX + r"""
select event_type, case when user_contract_id is null then 'null_id' else 'unknown_id' end as reason,
       count(*)::bigint as event_count
from tagged t
where not exists (select 1 from stg_user_contracts k where k.user_contract_id = t.user_contract_id)
group by all""",
    "dq_orphan_contracts": PREFIX + r"""
select user_contract_id, account_id, membership_id from stg_user_contracts k
where not exists (select 1 from stg_memberships m where m.membership_id = k.membership_id)""",
    "dq_boolean_spellings": PREFIX + r"""
select source_column, raw_value, meaning as normalised, row_count
from (select 'locations.archived' as source_column, archived as raw_value, count(*)::bigint as row_count from raw_locations group by all
      union all
      select 'memberships.active', active, count(*)::bigint from raw_memberships group by all) t
left join spelling on word = lower(trim(raw_value))""",
    "dq_contract_parse": PREFIX + r"""
select 'contract_start' as field, r.contract_start as raw_value, count(*)::bigint as row_count
from raw_user_contracts r join stg_user_contracts s on s.user_contract_id = r.id
where r.contract_start is not null and s.contract_start is null group by all
union all
select 'contract_end', r.contract_end, count(*)::bigint
from raw_user_contracts r join stg_user_contracts s on s.user_contract_id = r.id
where r.contract_end is not null and s.contract_end is null group by all
union all
select 'contract_time', contract_time, count(*)::bigint
from raw_user_contracts
where regexp_matches(lower(contract_time), '[0-9]h\s*[0-9]')
   or (contract_time is not null and try_cast(translate(lower(trim(contract_time)), ',h', '.') as double) is null)
group by all""",
    "dq_multi_contract_members": PREFIX + r"""
select account_id, week_start, membership_id, count(distinct user_contract_id)::bigint as contract_count,
       count(distinct location_id)::bigint as location_count
from attributed group by all having count(distinct user_contract_id) > 1""",
    "dq_inactive_members": PREFIX + r"""
select membership_id, account_id from stg_memberships m
where not exists (select 1 from int_billable_employees_weekly b
                  where b.membership_id = m.membership_id and b.account_id = m.account_id)""",
    "dq_grain_duplicates": _grains(),
    "dq_layer_reconciliation": PREFIX + r""",
pairs as (
  select 'events_vs_daily_counts' as check_name, (select count(*) from int_all_schedules) as l, (select sum(schedule_count) from int_employee_activity_daily) as r
  union all
  select 'daily_rows_vs_active_days', (select count(*) from int_employee_activity_daily), (select sum(active_days_in_week) from int_employee_activity_weekly)
  union all
  select 'location_vs_account_revenue', (select sum(total_location_revenue) from fct_location_revenue_weekly), (select sum(expected_weekly_revenue) from fct_account_billing_weekly))
select check_name, coalesce(l, 0)::decimal(18,2) as left_total, coalesce(r, 0)::decimal(18,2) as right_total,
       coalesce(l, 0) = coalesce(r, 0) as agrees
from pairs""",
    "dq_attribution_losses": PREFIX + r"""
select reason, count(*)::bigint as row_count
from (select case
        when k.user_contract_id is null then 'contract_not_in_account'
        when k.membership_id is null then 'membership_missing'
        when not exists (select 1 from stg_memberships m where m.membership_id = k.membership_id and m.account_id = k.account_id) then 'membership_not_in_account'
        when k.location_id is null then 'location_missing'
        when not exists (select 1 from stg_locations s where s.location_id = k.location_id and s.account_id = k.account_id) then 'location_not_in_account'
      end as reason
      from int_employee_activity_weekly w
      left join stg_user_contracts k on k.user_contract_id = w.user_contract_id and k.account_id = w.account_id)
where reason is not null group by all""",
    "dq_rejected_rows": PREFIX + r""",
texts as (
  select 'stg_locations' as table_name, id as row_id, account_id, 'archived' as field, 'unknown_flag' as reason, archived as raw_value
  from raw_locations where archived is not null and lower(trim(archived)) not in (select word from spelling)
  union all
  select 'stg_memberships', id, account_id, 'active', 'unknown_flag', active
  from raw_memberships where active is not null and lower(trim(active)) not in (select word from spelling)
  union all
  select 'stg_user_contracts', id, account_id, field, 'unreadable_date', text
  from (select id, account_id, unnest(['contract_start', 'contract_end']) as field, unnest([contract_start, contract_end]) as text from raw_user_contracts)
  where text is not null and coalesce(try_strptime(trim(text), '%Y-%m-%d'), try_strptime(trim(text), '%d/%m/%Y')) is null
  union all
  select 'stg_user_contracts', id, account_id, 'contract_time',
         case when regexp_matches(lower(contract_time), '[0-9]h\s*[0-9]') then 'hours_with_minutes' else 'unreadable_hours' end, contract_time
  from raw_user_contracts
  where regexp_matches(lower(contract_time), '[0-9]h\s*[0-9]')
     or (contract_time is not null and try_cast(translate(lower(trim(contract_time)), ',h', '.') as double) is null)
  union all
  select case event_type when 'shift' then 'stg_shifts' else 'stg_rests' end, event_id, account_id, 'user_contract_id',
         case when user_contract_id is null then 'null_id' else 'unknown_id' end, user_contract_id
  from tagged t where not exists (select 1 from stg_user_contracts k where k.user_contract_id = t.user_contract_id)
  union all
  select 'stg_user_contracts', user_contract_id, account_id, 'membership_id',
         case when membership_id is null then 'null_id' else 'unknown_id' end, membership_id
  from stg_user_contracts k where not exists (select 1 from stg_memberships m where m.membership_id = k.membership_id)),
weeks as (
  select w.user_contract_id, w.account_id, w.week_start, k.membership_id, k.location_id, case
        when k.user_contract_id is null then 'contract_not_in_account'
        when k.membership_id is null then 'membership_missing'
        when not exists (select 1 from stg_memberships m where m.membership_id = k.membership_id and m.account_id = k.account_id) then 'membership_not_in_account'
        when k.location_id is null then 'location_missing'
        when not exists (select 1 from stg_locations s where s.location_id = k.location_id and s.account_id = k.account_id) then 'location_not_in_account'
      end as reason
  from int_employee_activity_weekly w
  left join stg_user_contracts k on k.user_contract_id = w.user_contract_id and k.account_id = w.account_id)
select table_name, row_id, account_id, null::date as week_start, field, reason, raw_value, 1::bigint as row_count from texts
union all
select 'int_employee_activity_weekly', user_contract_id, account_id, week_start,
       case when reason like 'contract%' then 'user_contract_id' when reason like 'member%' then 'membership_id' else 'location_id' end as field, reason,
       case when reason like 'contract%' then user_contract_id when reason like 'member%' then membership_id else location_id end as raw_value, count(*)::bigint
from weeks where reason is not null group by all""",
}


def oracle_sql() -> dict[str, str]:
    tables = {name: f"{PREFIX}select * from {name}" for name in TABLE_NAMES}
    return {**tables, **CHECKS}

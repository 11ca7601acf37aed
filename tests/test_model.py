"""Row-level rules of the model, on literal rows; roll-ups are checked in both their forms."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import contract, dicts, event, location, member, raw_tables, tables, values
from weekmeter.operators import activity, attribution, pricing
from weekmeter.operators.pricing import Band, RateCard, Tier
from weekmeter.schemas import TABLES

W1, W2 = date(2024, 1, 1), date(2024, 1, 8)


def stepwise(t):
    """The same tables built one from the other, as a rebuild does."""
    daily = activity.daily_activity(t.int_all_schedules)
    weekly = activity.weekly_activity(daily)
    employees = attribution.billable_employees(
        attribution.contract_activity(weekly, t.stg_user_contracts, t.stg_memberships)
    )
    metrics = attribution.location_metrics(employees, t.stg_locations)
    revenue = pricing.location_revenue(metrics)
    return {
        "int_employee_activity_daily": daily,
        "int_employee_activity_weekly": weekly,
        "int_billable_employees_weekly": employees,
        "int_location_metrics_weekly": metrics,
        "fct_location_revenue_weekly": revenue,
        "fct_account_billing_weekly": pricing.account_billing(revenue),
    }


def both(t, name, *columns):
    """Rows of a table, after checking that its lazy and its stepwise form agree."""
    columns = columns or TABLES[name].columns
    lazy = values(t.table(name), *columns)
    assert lazy == values(stepwise(t)[name], *columns)
    return lazy


def test_schemas_are_as_declared(spark):
    t = tables(spark)
    for name, table in TABLES.items():
        assert ", ".join(f"{c} {k}" for c, k in t.table(name).dtypes) == table.ddl, name
    for name, df in stepwise(t).items():
        assert ", ".join(f"{c} {k}" for c, k in df.dtypes) == TABLES[name].ddl, name


def test_staging_keeps_every_row(spark):
    t = tables(
        spark,
        accounts=[{"id": "1", "name": "A", "created_at": "2020-01-01 08:00:00"}, {"id": "1"}],
        locations=[location("1", archived="n/a"), location("1", archived=" Yes ")],
        memberships=[member("1", role=" Manager "), member(None)],
    )
    assert values(t.stg_accounts, "account_id", "created_at") == [("1", None), ("1", datetime(2020, 1, 1, 8))]
    assert values(t.stg_locations, "location_id", "is_archived") == [("1", None), ("1", True)]
    assert values(t.stg_memberships, "membership_id", "role") == [(None, None), ("1", "manager")]


def test_schedules_keep_known_contracts_and_tag_events(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        shifts=[event("7", "c1"), event("8", "nope"), event("9", None)],
        rests=[event("7", "c1")],
    )
    assert values(t.int_all_schedules, "event_id", "event_type") == [("7", "rest"), ("7", "shift")]


def test_repeated_contract_repeats_its_events(spark):
    t = tables(spark, user_contracts=[contract("c1"), contract("c1", account="a2")], shifts=[event("1", "c1"), event("2", "c1")])
    assert t.int_all_schedules.count() == 4
    assert both(t, "int_employee_activity_daily", "schedule_count") == [(4,)]
    assert both(t, "int_employee_activity_weekly", "active_days_in_week") == [(1,)]


def test_event_counts_at_its_start(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        shifts=[event("1", "c1", "2024-01-07 22:00:00", "2024-01-08 06:00:00")],
    )
    assert both(t, "int_employee_activity_weekly", "week_start") == [(W1,)]


def test_missing_start_groups_under_a_null_week(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        memberships=[member("m1")],
        locations=[location("l1")],
        shifts=[event("1", "c1", None), event("2", "c1", None), event("3", "c1")],
    )
    assert both(t, "int_employee_activity_daily", "activity_date", "week_start", "schedule_count") == [
        (None, None, 2), (W1, W1, 1),
    ]
    assert both(t, "int_employee_activity_weekly", "week_start", "active_days_in_week") == [(None, 1), (W1, 1)]
    assert both(t, "fct_account_billing_weekly", "week_start", "billable_employees") == [(None, 1), (W1, 1)]


def test_active_days_are_distinct_days(spark):
    days = [1, 1, 2, 7, 8]
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        shifts=[event(str(i), "c1", f"2024-01-0{d} 10:00:00") for i, d in enumerate(days)],
    )
    assert both(t, "int_employee_activity_weekly", "week_start", "active_days_in_week") == [(W1, 3), (W2, 1)]


def test_account_comes_from_the_event_until_attribution(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        memberships=[member("m1")],
        shifts=[event("1", "c1", account="other")],
    )
    assert both(t, "int_employee_activity_weekly", "account_id") == [("other",)]
    assert both(t, "int_billable_employees_weekly") == []


@pytest.mark.parametrize(
    "given, members",
    [
        (contract("c1", member=None), [member("m1")]),
        (contract("c1", member="gone"), [member("m1")]),
        (contract("c1"), [member("m1", account="a2")]),
    ],
)
def test_contract_without_its_member_is_dropped(spark, given, members):
    t = tables(spark, user_contracts=[given], memberships=members, shifts=[event("1", "c1")])
    assert both(t, "int_billable_employees_weekly") == []


def test_repeated_membership_counts_once(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        memberships=[member("m1"), member("m1")],
        locations=[location("l1")],
        shifts=[event("1", "c1")],
    )
    assert both(t, "fct_account_billing_weekly", "billable_employees") == [(1,)]


def test_dedupe_takes_first_id_in_text_order_and_most_days(spark):
    t = tables(
        spark,
        user_contracts=[contract("9"), contract("10")],
        memberships=[member("m1")],
        shifts=[
            event("1", "9", "2024-01-01 10:00:00"),
            event("2", "9", "2024-01-02 10:00:00"),
            event("3", "10", "2024-01-03 10:00:00"),
        ],
    )
    assert both(t, "int_billable_employees_weekly", "user_contract_id", "active_days_in_week") == [("10", 2)]


def test_member_at_two_locations_counts_at_both(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c2", location="l2")],
        memberships=[member("m1")],
        locations=[location("l1"), location("l2")],
        shifts=[event("1", "c1"), event("2", "c2")],
    )
    assert both(t, "int_location_metrics_weekly", "location_id", "billable_employee_count") == [("l1", 1), ("l2", 1)]
    assert both(t, "fct_account_billing_weekly", "billable_locations", "billable_employees", "expected_weekly_revenue") == [
        (2, 2, Decimal("120.00"))
    ]


def test_location_of_another_account_and_missing_location_are_dropped(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c2", location=None)],
        memberships=[member("m1")],
        locations=[location("l1", account="a2")],
        shifts=[event("1", "c1"), event("2", "c2")],
    )
    assert both(t, "int_billable_employees_weekly", "location_id") == [(None,), ("l1",)]
    assert both(t, "int_location_metrics_weekly") == []


@pytest.mark.parametrize("archived", ["yes", "unknown", None])
def test_account_with_only_unbillable_locations_stays_at_zero(spark, archived):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        memberships=[member("m1")],
        locations=[location("l1", archived=archived)],
        shifts=[event("1", "c1")],
    )
    assert both(t, "fct_location_revenue_weekly", "billable_employee_count", "is_billable_location", "base_price", "total_location_revenue") == [
        (1, False, 0, Decimal("0.00"))
    ]
    assert both(t, "fct_account_billing_weekly", "billable_locations", "billable_employees", "expected_weekly_revenue") == [
        (0, 0, Decimal("0.00"))
    ]


def test_inactive_flag_and_ended_contract_do_not_matter(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1", contract_end="2020-01-01")],
        memberships=[member("m1", active="no")],
        locations=[location("l1")],
        shifts=[event("1", "c1")],
    )
    assert both(t, "fct_account_billing_weekly", "billable_employees") == [(1,)]


PRICES = [
    (1, "micro", 60, 0, 0, "60.0"), (5, "micro", 60, 0, 0, "60.0"), (6, "small", 80, 0, 0, "80.0"),
    (7, "small", 80, 1, 0, "84.0"), (39, "small", 80, 33, 0, "212.0"), (40, "large", 216, 33, 1, "350.4"),
    (41, "large", 216, 33, 2, "352.8"), (100, "large", 216, 33, 61, "494.4"),
]


def test_price_list(spark):
    counts = spark.createDataFrame([(row[0],) for row in PRICES], "n int")
    grid = pricing.price_grid(counts)
    columns = (
        "billable_employee_count", "location_size", "base_price",
        "employees_in_7_39_band", "employees_in_40_plus_band", "total_location_revenue",
    )
    got = sorted(tuple(r) for r in grid.filter("is_billable_location").select(*columns).collect())
    assert got == [(*row[:5], Decimal(row[5])) for row in PRICES]
    free = grid.filter("not is_billable_location")
    assert {tuple(r) for r in free.select(*columns[2:]).collect()} == {(0, 0, 0, Decimal(0))}
    assert free.count() == len(PRICES)


def test_head_counts_price_through_the_model(spark):
    heads = {"l5": 5, "l6": 6, "l39": 39, "l40": 40}
    people = [(f"{site}-{i}", site) for site, n in heads.items() for i in range(n)]
    t = tables(
        spark,
        user_contracts=[contract(f"c{p}", member=p, location=site) for p, site in people],
        memberships=[member(p) for p, _ in people],
        locations=[location(site) for site in heads],
        rests=[event(p, f"c{p}") for p, _ in people],
    )
    assert both(t, "fct_location_revenue_weekly", "location_id", "billable_employee_count", "total_location_revenue") == [
        ("l39", 39, Decimal("212.00")), ("l40", 40, Decimal("350.40")),
        ("l5", 5, Decimal("60.00")), ("l6", 6, Decimal("80.00")),
    ]
    assert both(t, "fct_account_billing_weekly", "expected_weekly_revenue") == [(Decimal("702.40"),)]


def test_other_rate_card(spark):
    rates = RateCard(
        tiers=(Tier("solo", 1, 10), Tier("team", None, 20)),
        bands=(Band("employees_in_7_39_band", 2, 3, Decimal("1.5")), Band("employees_in_40_plus_band", 4, None, Decimal("0.25"))),
    )
    grid = pricing.price_grid(spark.range(1, 6), rates).filter("is_billable_location")
    got = {r.billable_employee_count: (r.location_size, r.total_location_revenue) for r in grid.collect()}
    assert got == {
        1: ("solo", Decimal("10.00")), 2: ("team", Decimal("21.50")), 3: ("team", Decimal("23.00")),
        4: ("team", Decimal("23.25")), 5: ("team", Decimal("23.50")),
    }


def test_calendar_fills_weeks_without_activity(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")],
        shifts=[
            event("1", "c1", "2023-12-31 10:00:00"), event("2", "c1", "2024-01-10 10:00:00"),
            event("3", "unknown", "2030-01-01 10:00:00"), event("4", "c1", None),
        ],
    )
    want = [
        (date(2023, 12, 25), date(2023, 12, 31), 52), (W1, date(2024, 1, 7), 1), (W2, date(2024, 1, 14), 2),
    ]
    assert values(t.dim_calendar_weekly, "week_start", "week_end", "iso_week") == want
    from weekmeter.operators.dimensions import weekly_calendar

    assert values(weekly_calendar(t.int_employee_activity_weekly), "week_start", "week_end", "iso_week") == want


def test_no_rows_at_all(spark):
    t = tables(spark)
    for name in TABLES:
        assert t.table(name).count() == 0, name


def test_permissive_run_keeps_bad_rows_as_null(spark):
    rows = dict(
        user_contracts=[contract("c1", contract_start="31/02/2024", contract_time="abc")],
        memberships=[member("m1")],
        locations=[location("l1")],
        shifts=[event("1", "c1", "01/02/2024")],
    )
    t = tables(spark, permissive=True, **rows)
    assert values(t.stg_user_contracts, "contract_start", "contract_time") == [(None, None)]
    assert both(t, "fct_account_billing_weekly", "week_start", "billable_employees") == [(None, 1)]
    with pytest.raises(Exception):
        tables(spark, **rows).fct_account_billing_weekly.collect()


def test_hot_contract_account_and_null_ids(spark):
    """A third of all events on one contract, a third without one: both forms agree with a count by hand."""
    shifts = spark.range(30000).selectExpr(
        "string(id) as id",
        "case id % 3 when 0 then 'c0' when 1 then null else concat('c', id % 200) end as user_contract_id",
        "'a1' as account_id",
        "string(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 500, 0, 0)) as starts_at",
        "cast(null as string) as ends_at",
        "'x' as planification_type",
    )
    raw = raw_tables(
        spark,
        user_contracts=[contract(f"c{i}", member=f"m{i}") for i in range(100)],
        memberships=[member(f"m{i}") for i in range(100)],
        locations=[location("l1")],
    )
    from weekmeter.plans.lazy import LazyTables

    t = LazyTables({**raw, "raw_shifts": shifts})
    rows = both(t, "int_employee_activity_daily", "user_contract_id", "schedule_count")
    by_hand = [i for i in range(30000) if i % 3 == 0 or (i % 3 == 2 and i % 200 < 100)]
    assert sum(n for _, n in rows) == len(by_hand)
    assert sum(n for c, n in rows if c == "c0") == sum(1 for i in by_hand if i % 3 == 0 or i % 200 == 0)
    both(t, "fct_account_billing_weekly")


def test_weeks_across_spans_and_before_1970(spark):
    days = ["1969-12-28", "1969-12-29", "1970-01-04", "1970-01-05", "2023-10-08", "2023-10-09", "2024-02-29", "2031-03-31"]
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c2", member="m2")],
        memberships=[member("m1"), member("m2")],
        locations=[location("l1")],
        shifts=[event(f"{c}{i}", c, f"{d} 23:59:59") for c in ("c1", "c2") for i, d in enumerate(days)],
    )
    rows = both(t, "int_employee_activity_weekly", "week_start", "active_days_in_week")
    assert len(rows) == 14 and sum(n for _, n in rows) == 2 * len(days)
    assert len(both(t, "fct_account_billing_weekly")) == 7


def test_copies_of_contracts_and_members_do_not_multiply_activity(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1")] * 50 + [contract("c1", location="l2")] * 2,
        memberships=[member("m1")] * 50,
        locations=[location("l1"), location("l2")],
        shifts=[event("1", "c1"), event("2", "c1", "2024-01-02 10:00:00")],
    )
    assert t.contract_activity.count() == 2
    both(t, "fct_location_revenue_weekly")
    assert both(t, "int_employee_activity_daily", "schedule_count") == [(52,), (52,)]

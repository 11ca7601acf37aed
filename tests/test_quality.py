from datetime import date
from decimal import Decimal

from tests.helpers import contract, event, location, member, raw_tables, tables, values
from weekmeter.operators import quality
from weekmeter.schemas import TABLES

W1 = date(2024, 1, 1)


def test_orphan_events(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c1"), contract(None)],
        shifts=[event("1", "c1"), event("2", None), event("3", None), event("4", "x"), event("5", "y")],
        rests=[event("1", "x")],
    )
    report = quality.orphan_events(t.events, t.stg_user_contracts)
    assert values(report, "event_type", "reason", "event_count") == [
        ("rest", "unknown_id", 1), ("shift", "null_id", 2), ("shift", "unknown_id", 2),
    ]


def test_orphan_contracts(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c2", member=None), contract("c3", member="gone")],
        memberships=[member("m1"), member("m1", account="a2"), member(None)],
    )
    report = quality.orphan_contracts(t.stg_user_contracts, t.stg_memberships)
    assert values(report, "user_contract_id", "account_id", "membership_id") == [("c2", "a1", None), ("c3", "a1", "gone")]


def test_boolean_spellings(spark):
    raw = raw_tables(
        spark,
        locations=[location("1", archived=v) for v in ("No", "No", "maybe", None)],
        memberships=[member("1", active=v) for v in (" 1 ", "t")],
    )
    report = quality.boolean_spellings(raw["raw_locations"], raw["raw_memberships"])
    assert values(report, "source_column", "raw_value", "normalised", "row_count") == [
        ("locations.archived", None, None, 1), ("locations.archived", "No", False, 2),
        ("locations.archived", "maybe", None, 1),
        ("memberships.active", " 1 ", True, 1), ("memberships.active", "t", None, 1),
    ]


def test_contract_parse_reports_and_never_fails(spark):
    raw = raw_tables(
        spark,
        user_contracts=[
            contract("1", contract_start="n/a", contract_end="31/02/2024", contract_time="35h30"),
            contract("2", contract_start="n/a", contract_end="2024-01-01", contract_time="abc"),
            contract("3", contract_start="2024-1-1", contract_time=" 35 H "),
            contract("4", contract_time=""),
            contract("5", contract_time="35 H 30"),
        ],
    )
    report = quality.contract_parse(raw["raw_user_contracts"])
    assert values(report, "field", "raw_value", "row_count") == [
        ("contract_end", "31/02/2024", 1),
        ("contract_start", "2024-1-1", 1), ("contract_start", "n/a", 2),
        ("contract_time", "", 1), ("contract_time", "35 H 30", 1), ("contract_time", "35h30", 1), ("contract_time", "abc", 1),
    ]


def test_multi_contract_members(spark):
    t = tables(
        spark,
        user_contracts=[
            contract("c1"), contract("c2"), contract("c3", location="l2"), contract("c4", location=None),
            contract("d1", member="m2"), contract("d2", member="m2"),
            contract("e1", member="m3"), contract("e1", member="m3"),
        ],
        memberships=[member("m1"), member("m2"), member("m3")],
        shifts=[
            event("1", "c1"), event("2", "c2"), event("3", "c3"), event("4", "c4"),
            event("5", "d1"), event("6", "d2", "2024-01-09 10:00:00"), event("7", "e1"),
        ],
    )
    args = (t.stg_user_contracts, t.stg_memberships)
    want = [("a1", W1, "m1", 4, 2)]
    columns = ("account_id", "week_start", "membership_id", "contract_count", "location_count")
    assert values(quality.multi_contract_members(t.active_days, *args), *columns) == want
    assert values(quality.multi_contract_members(t.int_employee_activity_weekly, *args), *columns) == want


def test_inactive_members(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c2", member="m2"), contract("c3", member="m3", account="a2")],
        memberships=[member("m1"), member("m2"), member("m3"), member(None)],
        shifts=[event("1", "c1"), event("2", "c3")],
    )
    want = [(None, "a1"), ("m2", "a1"), ("m3", "a1")]
    for activity in (t.events, t.int_employee_activity_weekly):
        report = quality.inactive_members(t.stg_memberships, t.stg_user_contracts, activity)
        assert values(report, "membership_id", "account_id") == want


def test_grain_duplicates(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c1"), contract("c1"), contract("c2"), contract("c2"), contract("c3")],
        shifts=[event("1", "c3"), event("1", "c1")],
        rests=[event("1", "c3")],
    )
    report = quality.grain_duplicates({name: t.table(name) for name in TABLES})
    got = {r.table_name: (r.duplicate_keys, r.extra_rows) for r in report.collect()}
    assert got.pop("stg_user_contracts") == (2, 3)
    assert got.pop("stg_shifts") == (1, 1)
    assert got.pop("int_all_schedules") == (1, 3)
    assert set(got) | {"stg_user_contracts", "stg_shifts", "int_all_schedules"} == set(TABLES)
    assert set(got.values()) == {(0, 0)}


def test_layer_reconciliation(spark):
    t = tables(
        spark,
        user_contracts=[contract("c1"), contract("c1")],
        memberships=[member("m1")],
        locations=[location("l1")],
        shifts=[event("1", "c1"), event("2", "c1"), event("3", "c1", None)],
    )
    built = {name: t.table(name) for name in TABLES}
    columns = ("check_name", "left_total", "right_total", "agrees")
    assert values(quality.layer_reconciliation(built), *columns) == [
        ("daily_rows_vs_active_days", Decimal(2), Decimal(2), True),
        ("events_vs_daily_counts", Decimal(6), Decimal(6), True),
        ("location_vs_account_revenue", Decimal(120), Decimal(120), True),
    ]
    built["int_employee_activity_daily"] = built["int_employee_activity_daily"].filter("week_start is not null")
    assert values(quality.layer_reconciliation(built), *columns)[:2] == [
        ("daily_rows_vs_active_days", Decimal(1), Decimal(2), False),
        ("events_vs_daily_counts", Decimal(6), Decimal(4), False),
    ]


def test_layer_reconciliation_without_rows(spark):
    t = tables(spark)
    report = quality.layer_reconciliation({name: t.table(name) for name in TABLES})
    assert {tuple(r) for r in report.select("left_total", "right_total", "agrees").collect()} == {(Decimal(0), Decimal(0), True)}


def test_attribution_losses(spark):
    t = tables(
        spark,
        user_contracts=[
            contract("ok"), contract("acc"), contract("nomem", member=None), contract("badmem", member="gone"),
            contract("noloc", location=None), contract("badloc", location="l2"), contract("both", member=None, location=None),
            contract("badloc", location="l3"),
        ],
        memberships=[member("m1"), member("m1"), member("gone", account="a2")],
        locations=[location("l1"), location("l2", account="a2"), location("l1")],
        shifts=[
            event("1", "ok"), event("2", "acc", account="a9"), event("3", "acc", "2024-02-01 10:00:00", account="a9"),
            event("4", "nomem"), event("5", "badmem"), event("6", "noloc"), event("7", "badloc"), event("8", "both"),
            event("9", "unknown"),
        ],
    )
    report = quality.attribution_losses(
        t.int_employee_activity_weekly, t.stg_user_contracts, t.stg_memberships, t.stg_locations
    )
    assert values(report, "reason", "row_count") == [
        ("contract_not_in_account", 2), ("location_missing", 1), ("location_not_in_account", 2),
        ("membership_missing", 2), ("membership_not_in_account", 1),
    ]

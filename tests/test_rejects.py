"""Rows that are set aside or lost: stored by a permissive rebuild, and as many as the reports count."""

from collections import Counter

import pytest

from tests.helpers import contract, event, location, member, raw_tables, values
from tests.test_random import dirty_extracts
from weekmeter.operators import activity, quality, rejects
from weekmeter.plans.lazy import LazyTables
from weekmeter.plans.rebuild import rebuild
from weekmeter.schemas import TABLES
from weekmeter.sources.tables import children, current_versions, read_audit, read_table, table_path

ROWS = {
    "accounts": [{"id": "a1", "name": "A", "created_at": "soon"}, {"id": "a2", "created_at": "2020-01-01 08:00:00"}],
    "locations": [location("l1"), location("l2", archived="maybe"), location("l3", archived=None)],
    "memberships": [member("m1"), member("m2", active=" n/a ")],
    "user_contracts": [
        contract("c1", contract_start="31/02/2024", contract_end="x", contract_time="35h30"),
        contract("c2", "m2", contract_time="many"),
        contract("c3", None),
        contract("c4", "m9"),
        contract("c5", location="l9"),
        contract("c5", location="l9"),
    ],
    "shifts": [
        event("1", "c1", end="later"), event("2", "c2", "nine o'clock", "ten"), event("3", None), event("4", "c9"),
        event("5", "c5"), event("6", "c3"), event("7", "c1", account="a2"),
    ],
    "rests": [event("1", "c4")],
}

WANT = [
    ("stg_accounts", "a1", "a1", None, "created_at", "unreadable_time", "soon", 1),
    ("stg_locations", "l2", "a1", None, "archived", "unknown_flag", "maybe", 1),
    ("stg_memberships", "m2", "a1", None, "active", "unknown_flag", " n/a ", 1),
    ("stg_user_contracts", "c1", "a1", None, "contract_start", "unreadable_date", "31/02/2024", 1),
    ("stg_user_contracts", "c1", "a1", None, "contract_end", "unreadable_date", "x", 1),
    ("stg_user_contracts", "c1", "a1", None, "contract_time", "hours_with_minutes", "35h30", 1),
    ("stg_user_contracts", "c2", "a1", None, "contract_time", "unreadable_hours", "many", 1),
    ("stg_user_contracts", "c3", "a1", None, "membership_id", "null_id", None, 1),
    ("stg_user_contracts", "c4", "a1", None, "membership_id", "unknown_id", "m9", 1),
    ("stg_shifts", "1", "a1", None, "ends_at", "unreadable_time", "later", 1),
    ("stg_shifts", "2", "a1", None, "starts_at", "unreadable_time", "nine o'clock", 1),
    ("stg_shifts", "2", "a1", None, "ends_at", "unreadable_time", "ten", 1),
    ("stg_shifts", "3", "a1", None, "user_contract_id", "null_id", None, 1),
    ("stg_shifts", "4", "a1", None, "user_contract_id", "unknown_id", "c9", 1),
]
WEEK = "2024-01-01"
WANT_WEEKS = [
    ("c3", "a1", WEEK, "membership_id", "membership_missing", None, 1),
    ("c4", "a1", WEEK, "membership_id", "membership_not_in_account", "m9", 1),
    ("c5", "a1", WEEK, "location_id", "location_not_in_account", "l9", 2),
    ("c1", "a2", WEEK, "user_contract_id", "contract_not_in_account", "c1", 1),
]


def test_a_permissive_rebuild_stores_what_it_sets_aside(spark, tmp_path):
    folder = str(tmp_path)
    audit = {r.table_name: r.rows_after for r in rebuild(spark, raw_tables(spark, **ROWS), folder, permissive=True).collect()}
    stored = read_table(spark, folder, "rejected")
    assert stored.columns == rejects.REJECTED.columns
    rows = [tuple(r) for r in stored.collect()]
    weeks = [(r[1], r[2], str(r[3]), *r[4:]) for r in rows if r[0] == "int_employee_activity_weekly"]
    # A week without a start (the second shift's) is lost for no reason of its contract c2: it is none of these.
    assert Counter(weeks) == Counter(WANT_WEEKS)
    assert Counter(r for r in rows if r[0] != "int_employee_activity_weekly") == Counter(WANT)
    assert audit["rejected"] == len(rows) and audit["stg_shifts"] == 7
    assert read_audit(spark, folder).where("table_name = 'rejected'").count() == 1


def test_staged_tables_are_split_but_whole(spark, tmp_path):
    folder, raw = str(tmp_path), raw_tables(spark, **ROWS)
    rebuild(spark, raw, folder, permissive=True)
    lazy = LazyTables(raw, permissive=True)
    for name in rejects.STAGED:
        stored = read_table(spark, folder, name)
        assert stored.columns == TABLES[name].columns
        assert values(stored, *stored.columns) == values(lazy.table(name), *stored.columns)
        path = table_path(folder, name, current_versions(spark, folder)[name].run)
        parts = {x for x in children(spark, path) if x.startswith("set_aside")}
        assert parts <= {"set_aside=false", "set_aside=true"} and ("set_aside=true" in parts) == (name != "stg_rests")
    split = spark.read.parquet(table_path(folder, "stg_shifts", current_versions(spark, folder)["stg_shifts"].run))
    assert sorted(r.shift_id for r in split.where("set_aside = 'true'").collect()) == ["1", "2"]


def test_a_strict_run_keeps_the_last_list(spark, tmp_path):
    folder = str(tmp_path)
    rebuild(spark, raw_tables(spark, **ROWS), folder, permissive=True)
    before = values(read_table(spark, folder, "rejected"), *rejects.REJECTED.columns)
    clean = {"accounts": [{"id": "a1"}], "user_contracts": [contract("c1")], "shifts": [event("1", "c1"), event("2", "c0")]}
    names = [r.table_name for r in rebuild(spark, raw_tables(spark, **clean), folder).collect()]
    assert names == list(TABLES)
    assert values(read_table(spark, folder, "rejected"), *rejects.REJECTED.columns) == before
    # Over staged tables of a strict run only references are listed: it has no unreadable texts.
    rebuild(spark, raw_tables(spark), folder, groups=["intermediate"], permissive=True)
    reasons = {(r.table_name, r.reason) for r in read_table(spark, folder, "rejected").collect()}
    assert reasons == {("stg_shifts", "unknown_id"), ("stg_user_contracts", "unknown_id"), ("int_employee_activity_weekly", "membership_not_in_account")}


def test_without_rows(spark, tmp_path):
    rebuild(spark, raw_tables(spark), str(tmp_path), permissive=True)
    assert read_table(spark, str(tmp_path), "rejected").count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_listed_rows_are_as_many_as_the_reports_count(spark, seed):
    lazy = LazyTables(raw_tables(spark, **dirty_extracts(seed)), permissive=True)
    staged = {name: rejects.staged(name, lazy.raw) for name in rejects.STAGED}
    weekly = lazy.int_employee_activity_weekly
    contracts, members = staged["stg_user_contracts"], staged["stg_memberships"]
    rows = [r.asDict() for r in rejects.rejected(staged, weekly).collect()]

    def counts(keep, key):
        out = Counter()
        for r in filter(keep, rows):
            out[key(r)] += r["row_count"]
        return out

    def report(df):
        return Counter({tuple(r)[:-1]: r[-1] for r in df.collect()})

    kinds = {"stg_shifts": "shift", "stg_rests": "rest"}
    of_events = counts(lambda r: r["field"] == "user_contract_id" and r["table_name"] in kinds, lambda r: (kinds[r["table_name"]], r["reason"]))
    events = activity.events(staged["stg_shifts"], staged["stg_rests"])
    assert of_events == report(quality.orphan_events(events, contracts))

    orphans = counts(lambda r: r["table_name"] == "stg_user_contracts" and r["field"] == "membership_id", lambda r: (r["row_id"], r["account_id"], r["raw_value"]))
    assert orphans == Counter(tuple(r) for r in quality.orphan_contracts(contracts, members).collect())

    parsed = counts(lambda r: r["field"].startswith("contract_"), lambda r: (r["field"], r["raw_value"]))
    assert parsed == report(quality.contract_parse(lazy.raw["raw_user_contracts"]).select("field", "raw_value", "row_count"))

    lost = counts(lambda r: r["table_name"] == "int_employee_activity_weekly", lambda r: (r["reason"],))
    assert lost == report(quality.attribution_losses(weekly, contracts, members, staged["stg_locations"]))
    assert of_events and orphans and parsed and lost


def test_staging_finds_problems_in_the_pass_that_types(spark):
    plan = rejects.staged("stg_shifts", raw_tables(spark, **ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

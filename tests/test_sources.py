import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import contract, dicts, event, location, member, raw_frame, raw_tables, values
from weekmeter.plans.lazy import LazyTables
from weekmeter.plans.rebuild import rebuild
from weekmeter.schemas import GROUPS, RAW_COLUMNS, RAW_FILES, TABLES
from weekmeter.operators.pricing import Band, RateCard, Tier
from weekmeter.sources.csv_extracts import Dialect, detect_dialect, read_extract, read_raw, write_raw
from weekmeter.sources.csv_records import csv_records
from weekmeter.sources.tables import children, read_audit, read_table, remove, shared_folder


def write(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode())
    return str(path)


def test_columns_are_read_by_header_name(spark, tmp_path):
    path = write(tmp_path, "x.csv", "name,extra,id\nAnna,9,007\nBert,8,08\n")
    assert values(read_extract(spark, path, ["id", "name"]), "id", "name") == [("007", "Anna"), ("08", "Bert")]


def test_quotes_spaces_and_empty_values(spark, tmp_path):
    path = write(tmp_path, "x.csv", 'id,a,b\n1,"x, ""y""", z \n2,,""\n3, true ,"\\"\n')
    df = read_extract(spark, path, ["id", "a", "b"])
    assert values(df, "id", "a", "b") == [
        ("1", 'x, "y"', " z "), ("2", None, None), ("3", " true ", "\\"),
    ]


def test_quoted_line_break_is_kept(spark, tmp_path):
    path = write(tmp_path, "x.csv", 'id,name\n1,"two\nlines"\n2,one\n3,"a\r\n\n\nb"\r\n')
    assert values(read_extract(spark, path, ["id", "name"]), "id", "name") == [("1", "two\nlines"), ("2", "one"), ("3", "a\r\n\n\nb")]


@pytest.mark.parametrize("columns", [["id", "a", "b"], ["id"]])
@pytest.mark.parametrize("body", ["1,x\n", "1,x,y,z\n", '1,"x,y\n', '1,5" x,y\n2,6" x,z\n', '1,x, "y\n2" ,x,z\n'])
def test_broken_record_fails(spark, tmp_path, body, columns):
    path = write(tmp_path, "x.csv", "id,a,b\n" + body)
    with pytest.raises(Exception):
        read_extract(spark, path, columns).collect()


@pytest.mark.parametrize("body", ['1,x,"two\n2,y,lines"\n', '1,x,"two\n2,y,"\n', '"1\n",x,y\n', '1,x,"a ""b\n2,y,c"" d"\n'])
def test_torn_record_reads_as_one(spark, tmp_path, body):
    path = write(tmp_path, "x.csv", "id,a,b\n" + body + "3,z,ok\n")
    found = values(read_extract(spark, path, ["id", "b"]), "id", "b")
    assert len(found) == 2 and ("3", "ok") in found


def odd_shifts(rnd, count):
    bits = ["plain", "two\nlines", 'a "quoted" word', "\n", '"\n"', "a,b", "\r\n", "x" * 300 + "\n\n", '""', "trailing \n"]
    return [event(str(k), "c" + rnd.choice(bits), planification_type=rnd.choice(bits) * rnd.randint(1, 4)) for k in range(count)]


@pytest.mark.parametrize("size", ["97b", "512b", "2k", "1m"])
def test_line_breaks_read_right_over_any_splits(spark, tmp_path, size):
    rnd = random.Random(size)
    rows = odd_shifts(rnd, 120)
    long = "a very long value\n" * 300  # goes on over many ranges
    raw = raw_tables(spark, shifts=rows + [event("long", "c", planification_type=long)], user_contracts=[contract("1", contract_start="2023\n01")])
    raw = {**raw, "raw_shifts": raw["raw_shifts"].coalesce(2)}
    write_raw(spark, raw, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        back = read_raw(spark, str(tmp_path))
        for name in ("raw_shifts", "raw_user_contracts"):
            assert values(back[name], *RAW_COLUMNS[name]) == values(raw[name], *RAW_COLUMNS[name])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["1k", "64k", "1g"])
def test_values_go_on_over_pieces_files_and_ranges(spark, tmp_path, size):
    rnd, expected = random.Random(size), []
    for file in range(6):
        rows = [(f"{file}-{k}", "x\n" * rnd.choice([0, 0, 0, 1, 3]) + str(k)) for k in range(rnd.choice([5, 40, 1100]))]
        rows += [(f"{file}-long", "a line\n\n" * rnd.choice([30, 600, 1800]) + "z"), (f"{file}-last", "q")]
        write(tmp_path, f"{file}.csv", "id,a\n" + "".join(f'{i},"{a}"\n' if "\n" in a else f"{i},{a}\n" for i, a in rows))
        expected += rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        assert values(read_extract(spark, str(tmp_path), ["id", "a"]), "id", "a") == sorted(expected)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_of_a_torn_range_are_dealt_out(spark, tmp_path):
    rows = "".join(f'{k},"two\nlines"\n' if k % 50 == 0 else f"{k},one\n" for k in range(40000))
    path = write(tmp_path, "x.csv", "id,a\n" + rows)
    settings = {"spark.sql.files.maxPartitionBytes": "1g", "spark.sql.files.openCostInBytes": "1g", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert spark.read.text(path).rdd.getNumPartitions() == 1
        records = csv_records(spark, path, '"')
        counts = [r["count"] for r in records.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == 40001 and max(counts) < 40001 / 3
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_a_value_that_is_never_closed_is_named(spark, tmp_path):
    path = write(tmp_path, "x.csv", 'id,a\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="never closed in .*x.csv"):
        read_extract(spark, path, ["id"])


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
@pytest.mark.parametrize("quote", ['"', "'"])
def test_dialects_are_found(spark, tmp_path, delimiter, quote):
    rows = [event(str(k), f"it, is; {k}|5 o'clock \"sharp\"\tand\nso on") for k in range(30)]
    raw = raw_tables(spark, shifts=rows, accounts=[{"id": "1", "name": "a;b,c"}])
    write_raw(spark, raw, str(tmp_path), Dialect(delimiter, quote))
    back = read_raw(spark, str(tmp_path))
    for name, columns in RAW_COLUMNS.items():
        assert values(back[name], *columns) == values(raw[name], *columns), name


def test_dialect_of_odd_samples():
    assert detect_dialect([]) == Dialect() == detect_dialect(["", ""]) == detect_dialect(["one", "two"])
    assert detect_dialect(["a;b", "1;2,5", "2;3,5"]) == Dialect(";")
    assert detect_dialect(["a\tb,c", "1\t2", "2\t3"], ["a", "b,c"]) == Dialect("\t")
    assert detect_dialect(["a,b;c", "1,2", "3,4"], ["a"]) == Dialect(",")
    assert detect_dialect(["'a';'b'", "'1';'it''s'"]) == Dialect(";", "'")
    assert detect_dialect(["a,b", '1,"x']) == Dialect()


def test_given_dialect_is_not_looked_for(spark, tmp_path):
    path = write(tmp_path, "x.csv", "id;a,b\n1;x,y\n")
    assert read_extract(spark, path, ["id;a"], Dialect(",")).collect()[0][0] == "1;x"
    assert read_extract(spark, path, ["id"]).collect()[0][0] == "1"


def test_other_delimiter_and_quote(spark, tmp_path):
    path = write(tmp_path, "x.csv", "id;a;b\n1;37,5;'x; ''y'' z'\n2;\"q;\n")
    df = read_extract(spark, path, ["id", "a", "b"], Dialect(";", "'"))
    assert values(df, "id", "a", "b") == [("1", "37,5", "x; 'y' z"), ("2", '"q', None)]


def test_dialect_reaches_all_extracts(spark, tmp_path):
    raw = raw_tables(spark, accounts=[{"id": "1", "name": "a;b"}], shifts=[event("1", "c")])
    write_raw(spark, raw, str(tmp_path), Dialect(";"))
    back = read_raw(spark, str(tmp_path), dialect=Dialect(";"))
    assert values(back["raw_accounts"], "id", "name") == [("1", "a;b")]
    assert values(back["raw_shifts"], *RAW_COLUMNS["raw_shifts"]) == values(raw["raw_shifts"], *RAW_COLUMNS["raw_shifts"])


def test_memberships_are_split(spark, tmp_path):
    for name, file in RAW_FILES.items():
        rows = "".join(f"{i},u,a,true,r,f,l\n" for i in range(20000)) if name == "raw_memberships" else ""
        write(tmp_path, file, ",".join(RAW_COLUMNS[name]) + "\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        members = read_raw(spark, str(tmp_path))["raw_memberships"]
        assert members.rdd.getNumPartitions() > 2 and members.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wrong_number_of_values_fails(spark, tmp_path):
    path = write(tmp_path, "x.csv", "id,a,b\n1,x\n")
    with pytest.raises(Exception):
        read_extract(spark, path, ["id", "a"]).collect()


def test_missing_column_fails(spark, tmp_path):
    path = write(tmp_path, "x.csv", "id,a\n1,x\n")
    with pytest.raises(Exception):
        read_extract(spark, path, ["id", "b"])


def test_folder_of_files(spark, tmp_path):
    write(tmp_path, "1.csv", "id,a\n1,x\n")
    write(tmp_path, "2.csv", "id,a\n2,y\n")
    assert values(read_extract(spark, str(tmp_path), ["id", "a"]), "id", "a") == [("1", "x"), ("2", "y")]


def test_files_with_different_headers_fail(spark, tmp_path):
    write(tmp_path, "1.csv", "id,a\n1,x\n")
    write(tmp_path, "2.csv", "a,id\ny,2\n")
    with pytest.raises(Exception):
        read_extract(spark, str(tmp_path), ["id", "a"]).collect()


def test_all_extracts_are_split(spark, tmp_path):
    lines = "".join(f"{i},c,a,2024-01-01 00:00:00,,x\n" for i in range(20000))
    for name, file in RAW_FILES.items():
        write(tmp_path, file, ",".join(RAW_COLUMNS[name]) + "\n" + (lines if name == "raw_shifts" else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        shifts = read_raw(spark, str(tmp_path))["raw_shifts"]
        assert shifts.rdd.getNumPartitions() > 5
        assert shifts.count() == 20000
        # Ranges of whole records are not shuffled.
        assert "Exchange" not in shifts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_round_trip(spark, tmp_path):
    raw = raw_tables(
        spark,
        accounts=[{"id": "1", "name": 'He said "hi", then\nleft'}, {"id": "2", "name": " padded "}],
        user_contracts=[contract("1", contract_start=" 2023-02-01 ")],
        shifts=[event("1", "c")],
    )
    write_raw(spark, raw, str(tmp_path))
    back = read_raw(spark, str(tmp_path))
    for name, columns in RAW_COLUMNS.items():
        assert values(back[name], *columns) == values(raw[name], *columns)


ROWS = dict(
    accounts=[{"id": "a1", "created_at": "2020-01-01 08:00:00"}],
    user_contracts=[contract("c1"), contract("c2", member="m2")],
    memberships=[member("m1"), member("m2")],
    locations=[location("l1")],
    shifts=[event("1", "c1"), event("2", "c1"), event("3", "c2", "2024-01-09 08:00:00"), event("4", "c1", None)],
    rests=[event("1", "c2"), event("2", "gone")],
)


def test_rebuild_writes_what_the_lazy_plan_gives(spark, tmp_path):
    raw = raw_tables(spark, **ROWS)
    audit = {r.table_name: r for r in rebuild(spark, raw, str(tmp_path)).collect()}
    lazy = LazyTables(raw)
    assert list(audit) == list(TABLES)
    for name, table in TABLES.items():
        stored = read_table(spark, str(tmp_path), name)
        assert ", ".join(f"{c} {k}" for c, k in stored.dtypes) == table.ddl
        rows = values(stored, *table.columns)
        assert rows == values(lazy.table(name), *table.columns), name
        assert audit[name].rows_after == len(rows), name
    assert audit["int_employee_activity_daily"].rows_before == audit["int_all_schedules"].rows_after == 5
    assert audit["int_employee_activity_weekly"].rows_before == audit["int_employee_activity_daily"].rows_after
    assert audit["stg_shifts"].rows_before is None


def test_rebuild_replaces_tables(spark, tmp_path):
    rebuild(spark, raw_tables(spark, **ROWS), str(tmp_path))
    rebuild(spark, raw_tables(spark, **{**ROWS, "shifts": []}), str(tmp_path))
    assert read_table(spark, str(tmp_path), "stg_shifts").count() == 0
    assert values(read_table(spark, str(tmp_path), "fct_account_billing_weekly"), "billable_employees") == [(1,)]


def test_rebuild_of_some_groups_reads_the_stored_rest(spark, tmp_path):
    raw = raw_tables(spark, **ROWS)
    rebuild(spark, raw, str(tmp_path), groups=["staging", "intermediate"])
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path), "fct_account_billing_weekly").collect()
    audit = rebuild(spark, raw, str(tmp_path), groups=["facts"])
    assert [r.table_name for r in audit.collect()] == ["fct_location_revenue_weekly", "fct_account_billing_weekly"]
    with pytest.raises(ValueError):
        rebuild(spark, raw, str(tmp_path), groups=["mart"])
    assert set(GROUPS) == {t.group for t in TABLES.values()}


def test_rebuild_without_rows(spark, tmp_path):
    audit = rebuild(spark, raw_tables(spark), str(tmp_path)).collect()
    assert {r.rows_after for r in audit} == {0}
    for name, table in TABLES.items():
        assert values(read_table(spark, str(tmp_path), name), *table.columns) == []


def test_only_a_null_week(spark, tmp_path):
    rows = {**ROWS, "shifts": [event("1", "c1", None)], "rests": []}
    rebuild(spark, raw_tables(spark, **rows), str(tmp_path))
    fact = read_table(spark, str(tmp_path), "fct_account_billing_weekly")
    assert values(fact, "account_id", "week_start", "billable_employees") == [("a1", None, 1)]


def test_strict_rebuild_fails_on_a_bad_end_time(spark, tmp_path):
    rows = {**ROWS, "shifts": [event("1", "c1", end="soon")]}
    with pytest.raises(Exception):
        rebuild(spark, raw_tables(spark, **rows), str(tmp_path / "strict"))
    audit = rebuild(spark, raw_tables(spark, **rows), str(tmp_path / "permissive"), permissive=True)
    assert {r.table_name: r.rows_after for r in audit.collect()}["stg_shifts"] == 1


def test_facts_and_weekly_tables_are_stored_by_week(spark, tmp_path):
    rebuild(spark, raw_tables(spark, **ROWS), str(tmp_path))
    weeks = sorted(p.name for p in (tmp_path / "fct_account_billing_weekly").glob("*/week_start=*"))
    assert weeks == ["week_start=2024-01-01", "week_start=2024-01-08", "week_start=__HIVE_DEFAULT_PARTITION__"]
    for name in ("fct_account_billing_weekly", "int_employee_activity_weekly", "int_billable_employees_weekly"):
        one = read_table(spark, str(tmp_path), name).filter("week_start = date'2024-01-08'")
        assert "PartitionFilters: [isnotnull(week_start" in one._jdf.queryExecution().toString()
        assert one.count() == 1


def extracts(spark, folder, **rows):
    write_raw(spark, raw_tables(spark, **rows), str(folder))
    return read_raw(spark, str(folder))


def contents(spark, folder):
    return {name: values(read_table(spark, folder, name), *table.columns) for name, table in TABLES.items()}


def test_a_failed_rebuild_changes_no_table(spark, tmp_path):
    # Over files, so that the run fails while it writes and not while it is planned.
    tables = str(tmp_path / "tables")
    rebuild(spark, extracts(spark, tmp_path / "good", **ROWS), tables)
    before = contents(spark, tables)
    bad = extracts(spark, tmp_path / "bad", **{**ROWS, "accounts": [], "shifts": [event("1", "c1"), event("2", "c1", end="soon")]})
    with pytest.raises(Exception):
        rebuild(spark, bad, tables)
    assert contents(spark, tables) == before
    assert all(len(children(spark, f"{tables}/{name}")) == 1 for name in TABLES)
    rebuild(spark, bad, tables, groups=["intermediate", "facts"])
    assert contents(spark, tables) == before


def test_later_groups_fail_without_a_finished_write(spark, tmp_path):
    tables = str(tmp_path / "tables")
    bad = extracts(spark, tmp_path / "bad", **{**ROWS, "shifts": [event("1", "c1", end="soon")]})
    with pytest.raises(Exception):
        rebuild(spark, bad, tables)
    with pytest.raises(ValueError, match="no finished write"):
        rebuild(spark, bad, tables, groups=["intermediate"])
    with pytest.raises(ValueError, match="no finished write"):
        read_table(spark, tables, "stg_accounts")


def test_old_versions_go_and_the_audit_stays(spark, tmp_path):
    raw = raw_tables(spark, **ROWS)
    for _ in range(4):
        rebuild(spark, raw, str(tmp_path), groups=["staging"])
    assert len(children(spark, str(tmp_path / "stg_shifts"))) == 2
    assert children(spark, str(tmp_path / "_leases")) == []
    audit = read_audit(spark, str(tmp_path))
    assert audit.select("run").distinct().count() == 4 and audit.filter("table_name = 'stg_shifts' and rows_after = 4").count() == 4


def test_a_reader_keeps_its_version_over_the_next_rebuild(spark, tmp_path):
    rebuild(spark, raw_tables(spark, **ROWS), str(tmp_path))
    shifts = read_table(spark, str(tmp_path), "stg_shifts")
    rebuild(spark, raw_tables(spark, **{**ROWS, "shifts": []}), str(tmp_path))
    assert shifts.count() == 4 and read_table(spark, str(tmp_path), "stg_shifts").count() == 0


def test_other_rate_cards_are_stored_whole_and_exact(spark, tmp_path):
    card = RateCard(
        (Tier("all", None, 10),),
        (Band("first_seat", 1, 1, Decimal("1.125")), Band("second_seat", 2, 2, Decimal("0.1")), Band("others", 3, None, Decimal("7"))),
    )
    rows = {**ROWS, "shifts": ROWS["shifts"] + [event("5", "c2")]}
    rebuild(spark, raw_tables(spark, **rows), str(tmp_path), rates=card)
    fact = read_table(spark, str(tmp_path), "fct_location_revenue_weekly")
    assert fact.schema["total_location_revenue"].dataType.simpleString() == "decimal(19,3)"
    found = values(
        fact.filter("week_start is not null"),
        "billable_employee_count", "first_seat", "second_seat", "others", "extra_employee_cost", "total_location_revenue",
    )
    assert found == [(1, 1, 0, 0, Decimal("1.125"), Decimal("11.125")), (2, 1, 1, 0, Decimal("1.225"), Decimal("11.225"))]
    bill = read_table(spark, str(tmp_path), "fct_account_billing_weekly")
    assert Decimal("11.225") in [r.expected_weekly_revenue for r in bill.collect()]


def test_remove(spark, tmp_path):
    write(tmp_path, "x", "1")
    remove(spark, str(tmp_path / "x"))
    assert children(spark, str(tmp_path)) == [] == children(spark, str(tmp_path / "gone"))


def test_shared_folder_is_under_the_configured_one(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


class Cluster:
    """Stands in for a session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_cluster_must_name_a_shared_folder(monkeypatch):
    with pytest.raises(ValueError):
        shared_folder(Cluster, "x")
    monkeypatch.setattr(Cluster.conf, "get", staticmethod(lambda key, default=None: "file:/tmp/x"))
    with pytest.raises(ValueError):
        shared_folder(Cluster, "x")
    monkeypatch.setattr(Cluster.conf, "get", staticmethod(lambda key, default=None: "hdfs://name/x"))
    assert shared_folder(Cluster, "y").startswith("hdfs://name/x/y-")

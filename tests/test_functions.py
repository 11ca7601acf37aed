from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from weekmeter.functions import dates, text

ERRORS = pytest.importorskip("pyspark.errors").PySparkException


def apply(spark, function, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("true", True), (" YES ", True), ("1", True), (" Yes　", True),
        ("False", False), ("no", False), ("0", False),
        ("t", None), ("y", None), ("", None), ("true\n", None), (None, None),
    ],
)
def test_flag(spark, value, expected):
    assert apply(spark, text.flag, [value]) == [expected]


def test_trim_strips_space_separators_only(spark):
    spaces = "       　"
    assert apply(spark, text.trim_spaces, [f"{spaces}a b{spaces}", "\ta\t", "\na\r\n", " ", "", None]) == [
        "a b", "\ta\t", "\na\r\n", "", "", None,
    ]


def test_category(spark):
    assert apply(spark, text.category, [" Full_Time ", "ADHOC", None]) == ["full_time", "adhoc", None]


def test_hours(spark):
    given = ["35h", " 39H ", "37,5", "37.5 h", None, "35h30", "1e1", "-2", ".5", "7."]
    want = [35.0, 39.0, 37.5, 37.5, None, 3530.0, 10.0, -2.0, 0.5, 7.0]
    assert apply(spark, text.hours, given) == want
    assert apply(spark, lambda c: text.hours(c, permissive=True), given) == want


@pytest.mark.parametrize("bad", ["", "abc", "35d", "35f", "1_000", "n/a", "1,000.5", "--5", "nanx"])
def test_bad_hours_fail_or_are_null(spark, bad):
    with pytest.raises(ERRORS):
        apply(spark, text.hours, [bad])
    assert apply(spark, lambda c: text.hours(c, permissive=True), [bad]) == [None]


def test_hours_that_are_not_finite(spark):
    low, high, nan = apply(spark, text.hours, ["-inf", " Infinity ", "NaN"])
    assert low == float("-inf") and high == float("inf") and nan != nan


def test_contract_date(spark):
    given = ["2024-01-05", " 2024-01-05 ", "05/06/2024", "2024-1-5", "2024/01/05", "2024-01-01\n", "n/a", "", None]
    want = [date(2024, 1, 5), date(2024, 1, 5), date(2024, 6, 5), None, None, None, None, None, None]
    assert apply(spark, dates.contract_date, given) == want
    assert apply(spark, lambda c: dates.contract_date(c, permissive=True), given) == want


@pytest.mark.parametrize("bad", ["2024-02-30", "31/02/2024", "01/13/2024"])
def test_impossible_date_fails_or_is_null(spark, bad):
    with pytest.raises(ERRORS):
        apply(spark, dates.contract_date, [bad])
    assert apply(spark, lambda c: dates.contract_date(c, permissive=True), [bad]) == [None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc_timestamp_converts_offsets_and_zones(spark, zone):
    given = [
        "2024-01-07 23:59:59", "2024-01-07T23:59:59", "2024-01-08 01:30:00+02:00", "2024-01-08T01:30:00.25+02:00", "2024-01-07 23:30:00Z",
        "2024-03-10 02:30:00", "2024-01-07 24:00:00-01:00", "2024/1/8 01:30:00 Europe/Paris", None,
    ]
    want = [
        datetime(2024, 1, 7, 23, 59, 59), datetime(2024, 1, 7, 23, 59, 59), datetime(2024, 1, 7, 23, 30), datetime(2024, 1, 7, 23, 30, 0, 250000),
        datetime(2024, 1, 7, 23, 30), datetime(2024, 3, 10, 2, 30), datetime(2024, 1, 8, 1), datetime(2024, 1, 8, 0, 30), None,
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert apply(spark, dates.utc_timestamp, given) == want
        assert apply(spark, lambda c: dates.utc_timestamp(c, permissive=True), given) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_an_offset_moves_an_event_over_the_week_edge(spark):
    def week(c):
        return dates.week_start(dates.utc_timestamp(c).cast("date"))

    assert apply(spark, week, ["2024-01-08 01:30:00+02:00", "2024-01-07 23:30:00-02:00"]) == [date(2024, 1, 1), date(2024, 1, 8)]


def test_utc_timestamp_spellings(spark):
    given = [
        "2024/01/05 10:00:00", "2024/1/5", "2024-1-5", "2024-01-05 24:00:00", "2024-02-29T24:00:00",
        "2024/12/31 24:00:00", "2024-01-05 10:00:00 Europe/Paris", "2024-01-05 10:24:00", "2024-01-05 10:00:00.123456",
    ]
    want = [
        datetime(2024, 1, 5, 10), datetime(2024, 1, 5), datetime(2024, 1, 5), datetime(2024, 1, 6), datetime(2024, 3, 1),
        datetime(2025, 1, 1), datetime(2024, 1, 5, 9), datetime(2024, 1, 5, 10, 24), datetime(2024, 1, 5, 10, 0, 0, 123456),
    ]
    assert apply(spark, dates.utc_timestamp, given) == want
    assert apply(spark, lambda c: dates.utc_timestamp(c, permissive=True), given) == want


@pytest.mark.parametrize("bad", ["01/02/2024", "2024", "2024-01", "", "10:00:00", "soon", "2024-01-05 25:00:00", "2024-01-05 24:00:01", "     2024", " 2024-01 ", "2024-01-01 24:00:00.5", "2024-01-01 10:24:00:00", "2024-01-05 10:00:00+99:00"])
def test_bad_timestamp_fails_or_is_null(spark, bad):
    with pytest.raises(ERRORS):
        apply(spark, dates.utc_timestamp, [bad])
    assert apply(spark, lambda c: dates.utc_timestamp(c, permissive=True), [bad]) == [None]


def test_week_starts_on_monday(spark):
    def week(c):
        return dates.week_start(dates.utc_timestamp(c).cast("date"))

    given = ["2024-01-07 23:59:59", "2024-01-08 00:00:00", "2023-01-01 12:00:00", None]
    assert apply(spark, week, given) == [date(2024, 1, 1), date(2024, 1, 8), date(2022, 12, 26), None]


def test_week_does_not_depend_on_the_session_zone(spark):
    def week(c):
        return dates.week_start(dates.utc_timestamp(c).cast("date"))

    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert apply(spark, week, ["2024-01-07 23:59:59"]) == [date(2024, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_spans_hold_each_day_once(spark):
    days = spark.sql("select explode(sequence(date'1969-11-01', date'1970-06-30')) as d")
    day, number = F.col("d"), F.explode(F.sequence(F.lit(0), F.lit(dates.SPAN_WEEKS - 1))).alias("n")
    weeks = (
        days.select("d", dates.span_start(day).alias("s"), dates.span_bit(day).alias("b"), number)
        .select("d", dates.week_of_span(F.col("s"), F.col("n")).alias("w"), dates.active_days(F.col("b"), F.col("n")).alias("k"))
        .filter("k > 0")
    )
    assert weeks.filter("k <> 1").count() == 0
    assert weeks.filter(F.col("w") != dates.week_start(day)).count() == 0
    assert weeks.count() == days.count()


def test_a_full_span_fits_a_bigint(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2025-12-28')) as d")
    day = F.col("d")
    spans = days.groupBy(dates.span_start(day).alias("s")).agg(F.bit_or(dates.span_bit(day)).alias("b"))
    full = spans.filter(F.bit_count("b") == 63)
    assert full.count() >= 10 and full.filter("b = 9223372036854775807").count() == full.count()


# Texts that DuckDB reads, or refuses, as a time; what it reads as no time of this calendar is refused here by name.
ODD_TIMES = [
    "epoch", " EPOCH ", "epoch 10:00", "12024-01-01 00:00:00", "12024-01-01", "120240-01-01 01:02:03", "294246-12-31 23:59:59",
    "294248-01-10 04:00:00", "+2024-01-01", "2024-01-01 10", "2024-01-01T10", "2024-01-01 10:00", "2024-01-01 10:00:00 ",
    "2024-01-01 10:00:00\n", "2024-01-01 ", "2024-01-01\n", " 2024-01-01 10:00:00", "12024/01/01 10:00:00", "99999-12-31 24:00:00",
    "02024-01-01 10:00:00", "0012024-01-01", "12024-01-01 10:00:00.5", "2024-1-5 1", "infinite", "eepoch", "12024-13-01",
]
NO_TIME_HERE = {
    "infinity": "not a finite time", "-infinity": "not a finite time", " Inf ": "not a finite time", "-44-03-15": "before year 1",
    "-0044-03-15 10:00:00": "before year 1", "0044-03-15 (BC) 10:00:00": "before year 1",
}


def test_odd_times_are_read_as_duckdb_reads_them(spark):
    duckdb = pytest.importorskip("duckdb")
    want = [duckdb.execute("select try_cast(? as timestamp)::varchar", [value]).fetchone()[0] for value in ODD_TIMES]
    def read(value):
        return dates.utc_timestamp(value, permissive=True).cast("string")

    got = apply(spark, read, ODD_TIMES)
    assert [g and g.removeprefix("+") for g in got] == want
    assert sum(w is None for w in want) == 12 and apply(spark, read, list(NO_TIME_HERE)) == [None] * len(NO_TIME_HERE)


@pytest.mark.parametrize("value", [*NO_TIME_HERE, "2024-01-01 10", "2024-01-01\n", "2024-01-01 10:00:00\n"])
def test_times_with_no_place_are_refused_by_name(spark, value):
    names = list(dates.NAMED_FORMS) if value not in NO_TIME_HERE else [NO_TIME_HERE[value]]
    with pytest.raises(ERRORS) as failure:
        apply(spark, dates.utc_timestamp, [value])
    assert any(name in str(failure.value) for name in names)

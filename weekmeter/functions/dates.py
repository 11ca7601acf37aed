"""Parsing and truncation of dates and zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekmeter.functions.text import trim_spaces

# The two accepted shapes of a contract date. ``\z`` is the end of the text;
# ``$`` would also match before a final newline.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
DAY_FIRST_DATE = r"^\d{2}/\d{2}/\d{4}\z"
DAY_FIRST_FORMAT = "dd/MM/yyyy"

# A whole date, year first, that a time may follow (a slash later on belongs to a zone
# name); an end of day written as an hour of that day, exactly; an offset or zone after a time.
SLASHED_DATE = r"^(\s*\d+)/(\d+)/(\d+)"
WHOLE_DATE = r"^\s*\d+([-/])\d{1,2}\1\d{1,2}([ T]|\s*\z)"
DAY_END = "24:00:00"
DAY_END_EXACT = r"[ T]24:00:00(\.0*)?\s*([A-Za-z+-].*)?\z"
ZONED_TIME = r"\d:\d.*[A-Za-z+-]"

# Forms of a time that are no date with a time of day. The zeros before a longer year do not count.
EPOCH = r"(?i)^\s*epoch\s*\z"
NAMED_FORMS = {
    "not a finite time": r"(?i)^\s*[+-]?inf(inity)?\s*\z",
    "before year 1": r"(?i)^\s*-\d|\(bc\)",
    "an hour without minutes": r"^\s*\d+[-/]\d+[-/]\d+[ T]\s*\d+\s*\z",
    "a space or line break behind the date": r"^\s*\d+[-/]\d+[-/]\d+\s+\z",
    "a line break behind the time": r"\d[\t-\r]+\z",
}
LEADING_ZEROS = r"^\s*0+(?=\d{4,}-)"


def utc_timestamp(text: Column, permissive: bool = False) -> Column:
    """Text to a zone-less timestamp in UTC; an offset or zone in the text is converted.

    Four things a plain cast does otherwise are found by cheap checks, as this runs on every event:
    slashes between year, month and day are read as dashes, 24:00:00 (and no later) is the next
    midnight, a text without a whole date fails (the cast would fill in January or the first), and a
    time with an offset is converted (the cast would keep its wall clock).

    Texts that are no plain date and time are sorted into forms first. ``epoch`` is 1970, years may be of six digits
    (up to 294246), and what has no place in a timestamp or is cut off is refused by name (``NAMED_FORMS``).
    """

    def cast(value: Column) -> Column:
        return value.try_cast("timestamp_ntz") if permissive else value.cast("timestamp_ntz")

    def converted(value: Column) -> Column:
        moment = value.try_cast("timestamp") if permissive else value.cast("timestamp")
        # As wall clock in UTC, whatever the session's zone.
        return F.to_utc_timestamp(moment, F.current_timezone()).cast("timestamp_ntz")

    def read(value: Column) -> Column:
        return F.when(value.rlike(ZONED_TIME), converted(value)).otherwise(cast(value))

    def refused(reason: str) -> Column:
        return cast(F.concat(F.lit(f"{reason}: "), text))

    dashed = F.regexp_replace(F.regexp_replace(text, SLASHED_DATE, "$1-$2-$3"), LEADING_ZEROS, "")
    midnight = F.replace(dashed, F.lit(DAY_END), F.lit("00:00:00"))
    usual = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    # A date and a time to the second, with no more than digits of a fraction behind it: nothing to look for
    # but the day's end.
    fraction = (
        (F.substring(text, 20, 1) == ".")
        & F.substring(text, 21, 1).between("0", "9")
        & F.substring(text, 21, 9).try_cast("int").isNotNull()
        & (F.octet_length(text) < 30)
    )
    plain = usual & (F.substring(text, 17, 1) == ":") & ((F.octet_length(text) == 19) | fraction)
    read_plain = F.when(plain & ~text.contains(DAY_END), cast(text)).when(
        text.rlike(EPOCH), F.lit("1970-01-01").cast("timestamp_ntz")
    )
    for name, form in NAMED_FORMS.items():
        read_plain = read_plain.when(text.rlike(form), refused(name))
    return (
        read_plain.when(~usual & ~text.rlike(WHOLE_DATE), refused("not a whole date"))
        .when(
            text.contains(DAY_END),
            F.when(text.rlike(DAY_END_EXACT), read(midnight) + F.expr("interval 1 day")).otherwise(
                refused("later than the end of the day")
            ),
        )
        .otherwise(F.when(usual, read(text)).otherwise(read(dashed)))
    )


def contract_date(text: Column, permissive: bool = False) -> Column:
    """ISO or day-first date. Another shape is NULL; an impossible day fails, or is NULL if permissive."""
    day = trim_spaces(text)
    if permissive:
        iso, day_first = day.try_cast("date"), F.try_to_date(day, DAY_FIRST_FORMAT)
    else:
        iso, day_first = day.cast("date"), F.to_date(day, DAY_FIRST_FORMAT)
    return F.when(day.rlike(ISO_DATE), iso).when(day.rlike(DAY_FIRST_DATE), day_first)


def week_start(day: Column) -> Column:
    """Monday of the week, as a date. Takes a date: truncating a timestamp would give a zoned one."""
    return F.trunc(day, "week")


# A span is nine weeks: the most whole weeks whose days fit the bits of a bigint.
SPAN_WEEKS = 9


def _day_of_span(day: Column) -> Column:
    # Day 4 of the epoch, 1970-01-05, was a Monday.
    return F.pmod(F.unix_date(day) - 4, F.lit(7 * SPAN_WEEKS))


def span_start(day: Column) -> Column:
    """Monday on which the day's nine-week span begins."""
    return F.date_sub(day, _day_of_span(day))


def span_bit(day: Column) -> Column:
    """One bit per day of a span, its first Monday lowest; OR-ing rows marks the active days."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), _day_of_span(day))


def week_of_span(start: Column, number: Column) -> Column:
    return F.date_add(start, number * 7)


def active_days(bits: Column, number: Column) -> Column:
    """How many of the seven days of a span's week are marked."""
    week = F.call_function("shiftright", bits, number * 7).bitwiseAND(0b1111111)
    return F.bit_count(week).cast("bigint")

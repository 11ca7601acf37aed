"""CSV extracts as all-text tables, and back."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmeter.schemas import RAW_COLUMNS, RAW_FILES
from weekmeter.sources.csv_records import csv_records
from weekmeter.sources.together import run_together

# What a dialect is looked for among, the likelier first.
DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
SAMPLE_LINES = 200
SAMPLE_CHARS = 1 << 16  # of each of these lines


@dataclass(frozen=True)
class Dialect:
    """How extracts are written: what is between values, and what quotes them (doubled inside)."""

    delimiter: str = ","
    quote: str = '"'

    def options(self) -> dict[str, object]:
        return {
            "header": True,
            "sep": self.delimiter,
            "quote": self.quote,
            "escape": self.quote,
            # Spaces belong to the value.
            "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False,
        }


def sample_lines(spark: SparkSession, path: str) -> list[str]:
    """The first ``SAMPLE_LINES`` lines of a file (of one of them, if it is a folder), cut at ``SAMPLE_CHARS``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return [row.value.removesuffix("\r") for row in lines.select(F.left("value", F.lit(SAMPLE_CHARS)).alias("value")).head(SAMPLE_LINES)]


def sample_records(lines: list[str], dialect: Dialect) -> list[list[str]]:
    """The records of a sample of lines; the last one may have been cut off."""
    return list(csv.reader((f"{x}\n" for x in lines), delimiter=dialect.delimiter, quotechar=dialect.quote, doublequote=True))


def detect_dialect(lines: list[str], columns: Iterable[str] = ()) -> Dialect:
    """The dialect that reads a sample of lines, a header first, best.

    Of all pairs of delimiter and quote, the one with which the header has most of the given columns is taken; then the
    one with which most records are as wide as a header of several values; then the one whose quotes open most
    values. Other quotes than the usual one count only if a value of the sample begins and ends with them. Among
    equals, and for a sample that tells nothing, the usual dialect stays.
    """
    columns, text = set(columns), "\n".join(lines)

    def quoted(dialect: Dialect) -> bool:
        d, q = re.escape(dialect.delimiter), dialect.quote
        return q == QUOTES[0] or re.search(f"(?:^|{d}){q}(?:[^{q}]|{q}{q})*{q}(?:{d}|$)", text, re.MULTILINE) is not None

    def score(dialect: Dialect) -> tuple[int, float, int]:
        try:
            rows = sample_records(lines, dialect)
        except csv.Error:
            return 0, 0.0, 0
        if len(rows) > 1 and len(lines) >= SAMPLE_LINES:
            rows.pop()  # the sample may end inside a record
        rows = [row for row in rows if row]
        if not rows:
            return 0, 0.0, 0
        width = len(rows[0])
        alike = sum(len(row) == width for row in rows) / len(rows) if width > 1 else 0.0
        mark = re.compile(f"(?:^|{re.escape(dialect.delimiter)}){dialect.quote}")
        return len(columns.intersection(rows[0])), alike, sum(len(mark.findall(x)) for x in lines)

    # ``max`` takes the first of equals.
    return max(filter(quoted, (Dialect(d, q) for d in DELIMITERS for q in QUOTES)), key=score)


def read_extract(spark: SparkSession, path: str, columns: Iterable[str], dialect: Dialect | None = None) -> DataFrame:
    """Read one file, or a folder of files, by header name and as text.

    Of the values, only the first lines are read up front, for the header. Files are split, and quoted
    values may hold line breaks (``csv_records``). A record with a wrong number of values, or with a line break
    that is not quoted, fails the read, and so do files whose headers differ.

    Where no dialect is given, it is found from the first lines (``detect_dialect``); all files of a folder share it.
    """
    columns = list(columns)
    lines = sample_lines(spark, path)
    dialect = dialect or detect_dialect(lines, columns)
    names = next(filter(None, sample_records(lines, dialect)), None)
    if not names or len(set(names)) < len(names) or not set(columns) <= set(names):
        raise ValueError(f"no header with {', '.join(columns)} in {path}")
    return _parsed(csv_records(spark, path, dialect.quote), names, dialect).select(*columns)


def _parsed(records: DataFrame, names: list[str], dialect: Dialect) -> DataFrame:
    """Records as columns; header records go, and other headers fail."""
    text = F.col("record")
    ddl = ", ".join(f"`{name}` string" for name in names)
    options = {key: str(value) for key, value in dialect.options().items() if key != "header"}
    header = F.array(*map(F.lit, names))
    breaks = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))

    def checked(x: Column) -> Column:
        """Whether a parsed record is one of values. Fails on what is neither that nor the header."""
        values = F.array(*(x.record[name] for name in names))
        # A record made of column names is a header; one in another order, or of other files, fails.
        named = F.size(F.array_intersect(values, header))
        own = F.array_compact(values) == header
        # Parsing ends at a line break outside quotes: then values have fewer breaks than the text.
        lost = (x.breaks > 0) & (breaks(F.array_join(values, "")) != x.breaks)
        return (
            F.when(~own & (2 * named > len(names)), F.raise_error(F.lit("a header differs from the first one")).cast("boolean"))
            .when(lost, F.raise_error(F.lit("a quote inside an unquoted value")).cast("boolean"))
            .otherwise(~own)
        )

    # As an argument of a function, a record is parsed once and not for each use of its values.
    record = F.from_csv(text, ddl, options | {"mode": "FAILFAST", "multiLine": "true"})
    one = F.array(F.struct(record.alias("record"), breaks(text).alias("breaks")))
    return records.select(F.explode(F.filter(one, checked)).alias("x")).select("x.record.*")


def read_raw(spark: SparkSession, folder: str, dialect: Dialect | None = None) -> dict[str, DataFrame]:
    """The six raw tables of a folder of extracts, lazily; each extract may have a dialect of its own."""

    def read(name: str) -> DataFrame:
        return read_extract(spark, f"{folder.rstrip('/')}/{RAW_FILES[name]}", RAW_COLUMNS[name], dialect)

    return dict(zip(RAW_FILES, run_together(spark, read, RAW_FILES), strict=True))


def write_raw(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    dialect: Dialect | Mapping[str, Dialect] = Dialect(),
) -> None:
    """Write raw tables as extracts that ``read_raw`` reads (each "file" is a folder of parts).

    All in one dialect, or some tables in dialects of their own.
    """
    dialects = {} if isinstance(dialect, Dialect) else dialect
    usual = dialect if isinstance(dialect, Dialect) else Dialect()

    def write(name: str) -> None:
        path = f"{folder.rstrip('/')}/{RAW_FILES[name]}"
        raw[name].write.mode("overwrite").options(**dialects.get(name, usual).options()).csv(path)

    run_together(spark, write, RAW_FILES)

"""Records of split CSV files: quoted values may hold line breaks, wherever files are split.

A line break ends a record unless an odd number of quotes stands before it in the file. Files are read as lines, in
ranges that any number of tasks take. Three steps find the records:

1. Lines are counted off into pieces: up to ``2 ** PIECE_BITS`` lines of one range. Per piece, the parity of its quotes
   and its last line with an odd number of them. Running sums of these, over the ranges of a file and the pieces of a
   range, a row each, tell which pieces begin inside a value, and the line where that value's record begins. A piece
   that does not, and has no line with an odd number of quotes, is made of whole records: that is every piece of most
   files, and their lines go on as they are.
2. In the other pieces a running sum over the lines tells which of them begin a record. Lines are dealt out by piece,
   without the name of their file, and to a number of tasks that follows the size of the files: no task has to hold a
   range, however large ranges are, and ``TASK_BYTES`` of lines bound its memory.
3. Lines of records that go on are put together by the number of their first line.

Lines end in a line feed; a carriage return before it belongs to the end of a record, and inside a value stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmeter.session import MIB, estimated_bytes, shuffle_partitions

RANGE = ["file", "range"]
# Lines of a piece, as a power of two.
PIECE_BITS = 10
# Bytes of lines that a task sorts; more beyond 4096 tasks (``shuffle_partitions``).
TASK_BYTES = 16 * MIB


def quotes_in(text: Column, quote: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(quote), F.lit("")))


def _ended(record: Column) -> Column:
    """A record without the carriage return that ends it."""
    return F.when(record.endswith("\r"), F.left(record, F.length(record) - 1)).otherwise(record)


def csv_records(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """One row per record that is not empty, as text: record. A value that is never closed fails at once."""
    # Line feeds only: a carriage return alone does not end a line.
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes_in(F.col("value"), quote) % 2).alias("odd"),
    ).withColumn("block", F.shiftright("at", PIECE_BITS))
    # A task reads its ranges one after the other, so a block is one piece, or several at the ends of ranges.
    pieces = lines.groupBy(*RANGE, "block").agg(
        F.min("at").alias("start"), F.sum("odd").alias("odd"), F.max(F.when(F.col("odd") == 1, F.col("at"))).alias("last_odd")
    )
    ranges = pieces.groupBy(*RANGE).agg(F.sum("odd").alias("odd"), F.max("last_odd").alias("last_odd"))
    files = ranges.groupBy("file").agg(F.sum("odd").alias("odd"))
    unclosed = F.max(F.when(F.col("odd") % 2 == 1, F.col("file")))
    found = files.agg(F.coalesce(F.max("odd"), F.lit(0)).alias("odd"), unclosed.alias("unclosed")).first()
    if found.unclosed:
        raise ValueError(f"a quoted value is never closed in {found.unclosed}")
    if not found.odd:
        return text.select(_ended(F.col("value")).alias("record")).where("record <> ''")
    tasks = shuffle_partitions(estimated_bytes([text]), usual=TASK_BYTES)
    lines, torn = lines.repartition(tasks, "block"), _torn_blocks(pieces, ranges, tasks)
    # The condition is part of the value, so that nothing that is done to records is done to other lines.
    whole = lines.join(torn, "block", "left").select(F.when(F.col("pieces").isNull(), F.col("value")).alias("value"))
    single, long = _torn_records(lines.join(torn, "block"))
    return whole.union(single).union(long).select(_ended(F.col("value")).alias("record")).where("record <> ''")


def _torn_blocks(pieces: DataFrame, ranges: DataFrame, tasks: int) -> DataFrame:
    """Blocks in which values go on over lines, with their pieces: start, range, inside, and head.

    A piece is inside if it begins within a value. The last line before it with an odd number of quotes is then its
    head, the line where that value's record begins; for other pieces it means nothing.
    """
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *RANGE, F.sum("odd").over(earlier).alias("odd_earlier"), F.last("last_odd", ignorenulls=True).over(earlier).alias("head_earlier")
    )
    before = Window.partitionBy(*RANGE).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumns({"odd_before": F.sum("odd").over(before), "head_before": F.max("last_odd").over(before)})
    inside = (F.coalesce("odd_earlier", F.lit(0)) + F.coalesce("odd_before", F.lit(0))) % 2
    placed = placed.join(ranges, RANGE).withColumns({"inside": inside, "head": F.coalesce("head_before", "head_earlier")})
    # Dealt out as the lines are, so that their join moves neither again.
    blocks = placed.repartition(tasks, "block").groupBy("block").agg(
        F.collect_list(F.struct("start", "range", "inside", "head")).alias("pieces"),
        F.max((F.col("odd") > 0) | (F.col("inside") == 1)).alias("torn"),
    )
    return blocks.where("torn").select("block", "pieces")


def _torn_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of one line, and of several, of blocks in which values go on over lines."""
    # A line's piece is the last one of its block that starts no later.
    piece = F.array_max(F.filter("pieces", lambda x: x.start <= F.col("at")))
    lines = lines.select("block", "at", "value", "odd", piece.alias("piece")).select("block", "at", "value", "odd", "piece.*")
    order = Window.partitionBy("block", "start").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    begins = (F.col("inside") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 0
    placed = lines.withColumn("begins", begins)
    single = placed.select(F.when(F.col("begins") & (F.col("odd") == 0), F.col("value")).alias("value"))
    first = F.max(F.when(F.col("begins"), F.col("at"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = placed.withColumn("first", first).where("not begins or odd = 1")
    long = (
        parts.groupBy(F.coalesce("first", "head").alias("first"))
        .agg(F.array_sort(F.collect_list(F.struct("range", "at", "value"))).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda x: x.value), "\n").alias("value"))
    )
    return single, long

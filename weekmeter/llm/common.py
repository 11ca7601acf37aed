"""Helpers the operators share: written cut points, ranks over a whole table, Arrow output."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.session import setting_number

LOWEST_ID = -(2**63)
SHARE = 4096
LEAST_SHARE = 256
BATCH = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_path(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A folder of our own is set only where the session runs on one machine. One that machines mount (``file:``) is
    taken there, and on a cluster where ``find_shared`` has seen that executors share it.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weekmeter-llm-"))
    folder = context.getCheckpointDir().rstrip("/")
    if folder.startswith("file:") and not context.master.startswith("local") and folder not in _seen:
        raise ValueError(f"executors do not share {folder}: set spark.checkpoint.dir to a folder that they do")
    return folder


_seen: set[str] = set()


def find_shared(spark: SparkSession) -> None:
    """On a cluster, try whether the folder for cut points is shared where its name (``file:``) does not tell.

    Such a folder may be a mount of all machines or a disk of each. Where the session names none, or one that is
    not shared, a folder in the warehouse is set, as the session's own tables lie there, if that one is.
    """
    context = spark.sparkContext
    named = (context.getCheckpointDir() or "").rstrip("/")
    if context.master == "local" or context.master.startswith("local["):
        return
    if named and (context.master.startswith("local") or not named.startswith("file:")):
        return
    _seen.discard(named)
    if named and seen_by_all(spark, named):
        _seen.add(named)
        return
    instead = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/weekmeter-shared"
    if seen_by_all(spark, instead):
        context.setCheckpointDir(instead)
        _seen.add(context.getCheckpointDir().rstrip("/"))


def seen_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether all that executors write under a folder is there when it is read.

    Tasks are dealt out in turns, so each executor there is writes a file. Those that come later are not tried
    before the next query.
    """
    tasks = 2 * spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size()
    path = f"{folder}/seen-{uuid.uuid4().hex}"
    try:
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(path)
            return spark.read.schema("id long").parquet(path).count() == tasks
        finally:
            _delete(spark, path)
    except (PySparkException, Py4JError):
        return False


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    A lost executor then costs a read, not a rerun. Spark removes the files once the frame is gone, as
    ``prepare`` has it do.
    """
    shared_path(df.sparkSession)
    return df.checkpoint()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Cuts:
    """Cut points of work in many small steps: tables under the shared folder, removed when they are let go.

    Spark deletes the shuffle files of a step as soon as its table is written, and plans the next one by the
    table's real size: small ones are then broadcast or read by few tasks. Used as a context; at its end all
    its tables go, so what is to outlive it must be ``cut`` first.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_path(spark)}/cuts-{uuid.uuid4().hex}"
        self.kept: dict[int, tuple[DataFrame, str]] = {}
        self.number = 0

    def __enter__(self) -> Cuts:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows as a written table."""
        path = f"{self.folder}/{self.number}"
        self.number += 1
        before = self.spark.conf.get(SHUFFLE_CLEANUP)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.kept[id(kept)] = kept, path
        return kept

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove tables that nothing reads any more."""
        for table in tables:
            if table is not None and id(table) in self.kept:
                remove(self.spark, self.kept.pop(id(table))[1])


def join_spread(rows: DataFrame, table: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table of one row per key, where a key may hold any share of the rows.

    Keys that hold more than 1 / ``SHARE`` of the rows (and more than ``LEAST_SHARE`` rows) are dealt to as many
    salts as they hold such shares. There are at most ``SHARE`` keys of that kind, whatever the input, so their
    list is broadcast, and the table gets at most ``SHARE`` rows more. ``rows`` is read three times: write it first.
    """
    keys = [keys] if isinstance(keys, str) else keys
    unit = max(-(-rows.count() // SHARE), LEAST_SHARE)
    hot = (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") > unit)
        .select(*keys, F.ceil(F.col("_held") / unit).cast("int").alias("_salts"))
    )
    salt = F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_salts")).cast("int"), F.lit(0))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_salts")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = table.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(salts)).drop("_salts")
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")


def let_go(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that are no longer used.

    It does so when the driver collects its garbage, which by itself may be long after a cut point.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled texts of each quality: doc, text, quality.

    Of the ids with a label, those with the smallest hash are taken. An id with both labels counts as the lower
    one, and of the rows of an id one text is taken, that with the smallest hash; NULL ids have no label. So
    every run takes the same texts, and never more than twice ``sample`` of them.
    """
    known = (
        labels.select(F.col("doc_id").alias("doc"), F.col("quality").cast("int").alias("quality"))
        .where("doc is not null and quality in (0, 1)")
        .groupBy("doc").agg(F.min("quality").alias("quality"))
    )
    parts = [
        known.where(F.col("quality") == quality).orderBy(F.xxhash64("doc"), "doc").limit(sample) for quality in (0, 1)
    ]
    picked = F.broadcast(parts[0].union(parts[1]))  # at most twice ``sample`` rows
    texts = docs.select(F.col("doc_id").alias("doc"), F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return texts.groupBy("doc", "quality").agg(one).select("doc", "one.text", "quality")


def id_key(column: str | Column) -> Column:
    """An id for comparing and grouping: NULL counts as the smallest id there is."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(LOWEST_ID))


def from_key(column: str) -> Column:
    return F.when(F.col(column) != LOWEST_ID, F.col(column))


def in_arrow(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: T.StructType,
    after: Callable[[], None] | None = None,
) -> DataFrame:
    """Apply ``work`` to every Arrow batch; batches for which it returns None add no rows.

    ``after`` is called when a task has had its last batch.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out
        if after:
            after()

    return df.mapInArrow(run, schema)


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Add a gapless rank from 0 over the whole table, in the given order, without one big task.

    Rows are range-partitioned and sorted, each partition numbers its own, and the partitions' row
    counts (one row each) are summed up before them. The sorted rows are written first, so that the
    numbering is read off one fixed layout, also when tasks run again.
    """
    placed = cut(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("_at")
    )
    before = running_total(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_part", "_n", "_before")
    return (
        placed.join(before.select("_part", "_before"), "_part")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_part", "_row", "_before")
    )


def running_total(parts: DataFrame, order: str, amount: str, name: str) -> DataFrame:
    """The sum of ``amount`` over earlier rows of a table with one row per partition of a larger one."""
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, F.coalesce(F.sum(amount).over(earlier), F.lit(0)))


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and bound the batches they exchange.

    Checkpoints whose frames are gone are removed from now on: Spark reads that setting at each checkpoint. On a
    cluster the folder for them is tried each time (``find_shared``).

    ``BATCH`` bytes of rows go to Python at a time: with long texts, Spark's default number of rows
    makes batches that do not fit several times into an executor. Set for good, and only downwards.
    """
    if setting_number(spark.conf.get(BATCH_SETTING)) > BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH))
    context = spark.sparkContext
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    find_shared(spark)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="weekmeter-ship-")) / "weekmeter.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written under the shared folder."""
    if not path.startswith(shared_path(spark) + "/"):
        raise ValueError(f"{path} is not under the shared folder")
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    gateway = spark.sparkContext._jvm
    target = gateway.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def prepared(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or pipeline stage that prepares the session first."""

    @functools.wraps(query)
    def run(spark: SparkSession, *given) -> DataFrame:
        prepare(spark)
        return query(spark, *given)

    return run


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Give all columns but the used ones names no operator uses; also how to name and order them as before."""
    names = docs.columns
    inner = {c: c if c in used else f"_c{k}" for k, c in enumerate(names)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in names])
    return hidden, lambda df: df.select(*[F.col(inner[c]).alias(c) for c in names])

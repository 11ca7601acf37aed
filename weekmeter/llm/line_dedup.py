"""Line dedup: lines that stand in many documents go, except in the last document that holds them.

All of it is DataFrame functions.

1. The lines of every text are exploded with their positions, stripped and lower-cased (A-Z only). Keys of
   at least ``min_chars`` code points are hashed to 128 bits.
2. The distinct documents of each hash are counted, with the largest document id. Spark does so in two
   steps, first by hash and document, then by hash with partial counts, so a line that a third of all
   documents hold is nobody's single group. Hashes in ``min_docs`` documents or more are written.
3. Lines meet these hashes again in a join on the hash and a salt. A hash that holds more than
   1 / ``SHARE`` of the repeated lines is dealt to as many salts as it holds such shares: there are at most
   ``SHARE`` hashes of that kind, whatever the input, so their list is broadcast, and all copies that the
   salts add to the written hashes are at most ``SHARE`` rows.
4. The positions to drop are gathered per text, which no document's lines exceed, joined to the texts, and
   the lines at the other positions are put together again in order.

A row is known by its id and a 128-bit hash of its text, so rows of one id (NULL included) are kept apart
unless they are equal, and equal rows get equal results.

Defined results: a NULL or empty text is one empty line, and its kept text is empty; rows of one id are one
document when documents are counted, NULL being an id of its own and the smallest; a line that occurs
several times in the last document stays there each time; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmeter.llm.common import cut, read, set_aside

MIN_CHARS = 40
MIN_DOCS = 5
SHARE = 4096
SPACES = " \t\n\x0b\f\r"
HASH = ["h1", "h2"]
ROW = ["id", "t1", "t2"]


def line_key(line: Column) -> Column:
    """The line without outer spaces and with A-Z lower-cased; other letters stay as they are."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.char_length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def hashed(value: Column, one: str, two: str) -> dict[str, Column]:
    """128 bits of a text: two hashes that start from different seeds."""
    return {one: F.xxhash64(value), two: F.xxhash64(F.lit(one), value)}


def lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: id, t1, t2, place, h1, h2."""
    placed = rows.select(*ROW, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    # A code point has one byte at least, so most short lines go before they are normalised.
    keys = placed.where(F.octet_length("line") >= min_chars).select(*ROW, "place", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select(*ROW, "place", *_named(hashed(F.col("key"), *HASH)))


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def repeated(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """The hashes found in enough documents: h1, h2, last (the largest id), held (lines with the hash)."""
    null_id = F.max(F.col("id").isNull().cast("int"))
    return (
        lines(rows, min_chars)
        .groupBy(*HASH)
        .agg((F.count_distinct("id") + null_id).alias("docs"), F.max("id").alias("last"), F.count(F.lit(1)).alias("held"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )


def dropped(rows: DataFrame, hashes: DataFrame, min_chars: int) -> DataFrame:
    """The positions to drop of each text that has any: id, t1, t2, gone."""
    total = hashes.agg(F.sum("held")).first()[0] or 1
    spread = hashes.withColumn("salts", F.ceil(F.col("held") * SHARE / total).cast("int"))
    hot = spread.where("salts > 1").select(*HASH, "salts")  # at most SHARE rows
    salt = F.coalesce(F.pmod(F.xxhash64(*ROW, "place"), F.col("salts")).cast("int"), F.lit(0))
    dealt = lines(rows, min_chars).join(F.broadcast(hot), HASH, "left").withColumn("salt", salt).drop("salts")
    marks = spread.select(*HASH, "last", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return (
        dealt.join(marks, [*HASH, "salt"])
        .where("id is null or id <> last")
        .groupBy(*ROW)
        .agg(F.collect_set("place").alias("gone"))
    )


def _cleaned(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """The rows with their texts cleaned, and two counts; ``docs`` has no column of a name used here."""
    rows = docs.withColumns({"id": F.col("doc_id"), "text": F.coalesce("text", F.lit(""))})
    rows = rows.withColumns(hashed(F.col("text"), "t1", "t2"))
    gone = dropped(rows, cut(repeated(rows, min_chars, min_docs)), min_chars).select(
        *[F.col(c).alias(f"to_{c}") for c in ROW], "gone"
    )
    same = F.col("id").eqNullSafe(F.col("to_id")) & (F.col("t1") == F.col("to_t1")) & (F.col("t2") == F.col("to_t2"))
    joined = rows.join(gone, same, "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    # Both arrays are arguments of a function, so that they are made once per text and not once per line.
    kept = F.transform(
        F.array(F.struct(F.split("text", "\n").alias("lines"), F.col("gone"))),
        lambda x: F.struct(
            F.size(x.lines).cast("long").alias("n_lines"),
            F.array_join(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(x.lines) - 1), x.gone), lambda k: F.get(x.lines, k)
                ),
                "\n",
            ).alias("text"),
        ),
    )[0]
    return joined.withColumn("kept", kept).select(
        *docs.columns, F.col("kept.text").alias("kept_text"), "kept.n_lines", F.size("gone").cast("long").alias("n_dropped")
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, text (cleaned), n_lines (before dropping), n_dropped."""
    return _cleaned(docs.select("doc_id", "text"), min_chars, min_docs).select(
        "doc_id", F.col("kept_text").alias("text"), "n_lines", "n_dropped"
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with all their columns, texts cleaned."""
    hidden, named = set_aside(docs, "doc_id", "text")
    cleaned = _cleaned(hidden, min_chars, min_docs)
    return named(cleaned.withColumn("text", F.col("kept_text")))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = drop_repeated_lines(read(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# A-Z only, and spaces as the contract names them.
ORACLE = r"""
with line as (
  select doc_id, unnest(l) as line, generate_subscripts(l, 1) as place
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keyed as (
  select *, regexp_replace(regexp_replace(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') as k
  from line),
common as (select k, max(doc_id) as last from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
judged as (
  select doc_id, place, line, last is not null and doc_id <> last as gone from keyed left join common using (k))
select doc_id, count(*)::bigint as n_lines, (count(*) filter (gone))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

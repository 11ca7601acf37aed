"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, then seeded blocks.

Sources, by code point with NULL last, weigh 5, 2, 1, 5, 2, 1 ... and share all words there are; a
target stops at three times its source's size and what is over goes to the others by weight. The mix
is dealt in blocks of ``BLOCK`` words: for each output shard the next blocks go to the sources with
the highest quotients target / (2k - 1), which gives whole quotas per source and shard.

A source's documents are laid end to end in an order seeded by their ids; blocks are cut off that
line. A quota of whole rounds takes every block once per round; what is left takes consecutive
blocks from a seeded start, going round at the end, so few documents are cut.

All DataFrame functions. The one grouping by source is spread over ``PLACES`` parts of its line, so a
source may hold most of the rows; an id that holds more than 1 / ``SHARE`` of the rows is spread over as
many parts by a hash of its texts. Rows of one id and size are ordered by that hash, so reruns agree.

Defined results: NULL text has size 0; documents without words are never taken; NULL source is a
source, the last; repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmeter.llm.common import LEAST_SHARE, SHARE, cut, ranked, read, set_aside

BLOCK = 16
SHARDS = 8
SEED = "mix"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
PLACES = 4096  # parts of a source's line: the first three hexadecimal digits of the seeded place

WORD = r"[^\x20\x09-\x0D]+"


def _seeded(text: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(text.cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: its size, weight and target. Input: _none, _source, size."""
    sums = sizes.groupBy("_none", "_source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_order") % len(WEIGHTS) + 1).cast("int"))
    sources = cut(ranked(sums, ["_none", "_source"], "_order").withColumn("_weight", weight))
    most = MOST_REPEATS * F.col("source_size")
    share = None  # words per unit of weight; rises until no open source is over its limit
    while True:
        closed = F.lit(False) if share is None else most / F.col("_weight") < F.lit(share)
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(closed, most).otherwise(0)).alias("limited"),
            F.sum(F.when(closed, 0).otherwise(F.col("_weight"))).alias("open"),
        ).first()
        if not row["total"]:
            return sources.withColumn("target", F.lit(0.0))
        found = (row["total"] - row["limited"]) / row["open"]
        if found == share:
            break
        share = found
    return sources.withColumn("target", F.least(most.cast("double"), F.lit(share) * F.col("_weight")))


def shard_quotas(sources: DataFrame, block: int, shards: int) -> DataFrame:
    """Add ``_blocks``, the blocks of a source, and ``_quotas``: its quota of shards 0 to s, for each s.

    Sainte-Laguë seats only ever grow with the house, so the quota of shard s is the difference of two
    of these. Seats well above the final divisor are certain; only those near it (some four per
    source) are ranked by quotient.
    """
    totals = sources.agg(F.sum("source_size").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total, count = totals["t"] or 0, totals["n"]
    house_all = (2 * total + block) // (2 * block)
    sources = sources.withColumn("_blocks", F.ceil(F.col("source_size") / block).cast("long"))
    houses = F.array(*[F.lit(house_all * (s + 1) // shards).cast("long") for s in range(shards)])
    ideal = F.col("target") / F.lit(float(max(total, 1))) * F.col("_house")
    margin = F.ceil(F.col("_ideal") * count / (2 * F.greatest(F.col("_house"), F.lit(1)))) + 2
    dealt = (
        sources.select("_none", "_source", "_order", "target", F.posexplode(houses).alias("_shard", "_house"))
        .withColumn("_ideal", ideal)
        .withColumn("_sure", F.greatest(F.lit(0), F.floor("_ideal") - margin).cast("long"))
        .withColumn("_seats", F.sequence(F.col("_sure") + 1, F.floor("_ideal") + margin))
    )
    seats = ranked(
        dealt.where("target > 0")
        .select("_shard", "_none", "_source", "_order", "target", F.explode("_seats").alias("_seat"))
        .withColumn("_behind", -F.col("target") / (2 * F.col("_seat") - 1)),
        ["_shard", "_behind", "_order", "_seat"],
        "_rank",
    )
    left = dealt.groupBy("_shard").agg((F.first("_house") - F.sum("_sure")).alias("_left"))
    start = seats.groupBy("_shard").agg(F.min("_rank").alias("_start"))
    won = (
        seats.join(left.join(start, "_shard"), "_shard")
        .where(F.col("_rank") - F.col("_start") < F.col("_left"))
        .groupBy("_none", "_source", "_shard")
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    quotas = (
        dealt.join(won, ["_none", "_source", "_shard"], "left")
        .groupBy("_none", "_source")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("_shard", (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("q")))
            ).alias("_q")
        )
    )
    limit = MOST_REPEATS * F.col("_blocks")
    return sources.join(quotas, ["_none", "_source"]).withColumn(
        "_quotas", F.transform(F.col("_q")["q"], lambda q: F.least(q, limit))
    ).drop("_q")


def mix(
    docs: DataFrame, keep: list[str] | None = None, block: int = BLOCK, shards: int = SHARDS, seed: str = SEED
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with size, source_size, target, taken and slices.

    A slice is one run of words that the mix takes: its first word, the word after its last, and the
    output shard that gets it. ``taken`` counts the words of all slices.
    """
    made = ("size", "source_size", "target", "taken", "slices")
    own = [c for c in keep or docs.columns if c not in made]
    docs, _ = set_aside(docs.select(*dict.fromkeys([*own, "doc_id", "text", "source"])), "doc_id", "text", "source")
    named = dict(zip(docs.columns, own, strict=False))
    inner = list(named)
    sized = docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "_none": F.col("source").isNull(),
            "_source": F.coalesce("source", F.lit("")),
            "_place": _seeded(F.col("doc_id"), seed),
            "_id": F.col("doc_id"),
            "_text": F.xxhash64("text"),
        }
    )
    # Written once: sizes are counted once, and the line is laid out over one fixed set of rows.
    sized = cut(sized.select(*inner, "size", "_id", "_none", "_source", "_place", "_text"))
    sized = sized.withColumn("_part", F.substring("_place", 1, 3))
    # An id that many rows share (NULL, say) has parts of its own, by its texts, behind those it would be in.
    share = max(-(-sized.count() // SHARE), LEAST_SHARE)
    often = sized.groupBy("_place").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > share).select("_place")
    own = F.concat("_place", F.substring(F.hex("_text"), -3, 3))
    sized = sized.join(F.broadcast(often.withColumn("_often", F.lit(True))), "_place", "left").withColumn(
        "_part", F.when(F.col("_often"), own).otherwise(F.col("_part"))
    ).drop("_often")  # at most SHARE ids are broadcast
    sources = cut(shard_quotas(source_targets(sized), block, shards))

    parts = sized.groupBy("_none", "_source", "_part").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("_none", "_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    parts = parts.join(
        sources.withColumn(
            "_first", F.conv(F.substring(_seeded(F.col("_source"), seed), 1, 8), 16, 10).cast("long") % F.greatest("_blocks", F.lit(1))
        ),
        ["_none", "_source"],
    )
    line = Window.partitionBy("_none", "_source", "_part").orderBy("_place", "_id", "size", "_text")
    placed = sized.withColumn(
        "_inner", F.coalesce(F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).join(parts, ["_none", "_source", "_part"])

    quota = F.element_at("_quotas", -1)
    begin, end = F.col("_before") + F.col("_inner"), F.col("_before") + F.col("_inner") + F.col("size")
    blocks, first = F.col("_blocks"), F.col("_first")
    rounds, rest = F.floor(quota / F.greatest(blocks, F.lit(1))).cast("long"), F.col("_rest")
    shard_of = lambda at: F.least(
        F.size(F.filter("_quotas", lambda q: q <= at)), F.lit(shards - 1)
    )

    def taken_from(low: Column, high: Column, turn: Column) -> Column:
        """The words of this document between two places on the line; ``turn`` is the first one's block's turn."""
        a, b = F.greatest(begin, low), F.least(end, high)
        at = turn + F.floor((a - low) / block)
        return F.struct(
            (a - begin).alias("from_word"),
            (F.greatest(a, b) - begin).alias("to_word"),
            shard_of(at).cast("int").alias("shard"),
        )

    whole = F.transform(
        F.when(F.col("_rounds") > 0, F.sequence(F.lit(0).cast("long"), F.col("_rounds") - 1)).otherwise(F.array().cast("array<long>")),
        lambda k: taken_from(F.lit(0).cast("long"), F.col("source_size"), k * blocks),
    )
    tail = taken_from(first * block, F.least((first + rest) * block, F.col("source_size")), F.col("_rounds") * blocks)
    wrapped = taken_from(
        F.lit(0).cast("long"), (first + rest - blocks) * block, F.col("_rounds") * blocks + blocks - first
    )
    slices = F.filter(F.concat(whole, F.array(tail, wrapped)), lambda s: s.to_word > s.from_word)
    # A slice may start in one shard's last block and end in the next one's: it goes with its start.
    return (
        placed.withColumn("_rounds", rounds)
        .withColumn("_rest", quota - F.col("_rounds") * blocks)
        .withColumn("slices", slices)
        .withColumn("taken", F.aggregate("slices", F.lit(0).cast("long"), lambda n, s: n + s.to_word - s.from_word))
        .select(*[F.col(c).alias(name) for c, name in named.items()], *made)
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")  # the text is only counted, and stays behind
    return mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def take_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: a row for each slice the mix takes; a whole text as it is, a part as its words."""
    hidden, named = set_aside(docs, "doc_id", "text", "source", "n_chars")
    rows = mix(hidden).withColumn("_slice", F.explode("slices"))
    first, count = F.col("_slice.from_word"), F.col("_slice.to_word") - F.col("_slice.from_word")
    whole = count == F.col("size")
    words = F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), (first + 1).cast("int"), count.cast("int"))
    rows = rows.withColumn("_part", F.when(~whole, F.concat_ws(" ", words)))
    return named(
        rows.withColumns(
            {
                "n_chars": F.when(whole, F.col("n_chars")).otherwise(F.length("_part").cast("long")),
                "text": F.coalesce("_part", "text"),
            }
        )
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM d GROUP BY source),
f AS (
  SELECT *, 3 * source_size / w AS r,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM s),
g AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY r, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
            / (sum(w) OVER (ORDER BY r, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lam
  FROM f),
h AS (SELECT first(lam ORDER BY r, rk) FILTER (lam <= r) AS share FROM g),
t AS (
  SELECT source, source_size, rk, total, least((3 * source_size)::DOUBLE, share * w) AS target,
         ceil(source_size / 16)::BIGINT AS blocks
  FROM g, h),
seats AS (
  SELECT source, rk, k, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, rk, k) AS n, total
  FROM (SELECT *, unnest(range(1, 3 * blocks + 2)) AS k FROM t WHERE target > 0)),
q AS (
  SELECT rk, count(*) AS won FROM seats WHERE n <= (2 * total + 16) // 32 GROUP BY rk),
p AS (
  SELECT t.*, least(coalesce(won, 0), 3 * blocks) AS quota,
         ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8))::BIGINT % greatest(blocks, 1) AS first
  FROM t LEFT JOIN q USING (rk)),
l AS (
  SELECT d.doc_id, d.size, p.*, quota // greatest(blocks, 1) AS rounds, quota % greatest(blocks, 1) AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY p.rk ORDER BY place, doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (rounds * size
        + greatest(0, least(a + size, least((first + rest) * 16, source_size)) - greatest(a, first * 16))
        + greatest(0, least(a + size, (first + rest - blocks) * 16) - a))::BIGINT AS taken
FROM l
"""

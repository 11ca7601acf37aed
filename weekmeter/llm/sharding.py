"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard sits on the ring in ``VIRTUAL`` places. A key goes to the first shard clockwise from its own
place; if that shard is full, on to the next one, until one has room. Keys are placed in the order of a
second hash, so the result is that of placing them one by one. Capacities differ by one row at most and
add up to all rows, so the law is ``rows``: counts at most one apart.

One by one is not how it is computed. A key's shard depends on its place and on which shards are full
when its turn comes, and shards fill up only as often as there are shards. So each round counts, per
shard and range of turns, the keys that open shards would get, finds the turn at which the next one is
full, and narrows it down in ever smaller ranges: some jobs of counts, and no rows on the driver.

Defined results: NULL ids sit at one place of the ring and overflow like others; a NULL text has no
bytes (size 1, CRC 0); repeated rows are keys of their own; an empty table gives no rows; with fewer
rows than shards some shards stay empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmeter.llm.common import cut, from_key, id_key, ranked, read

SHARDS = 8
VIRTUAL = 64
RING_BITS = 12  # the ring has 4096 places
RANGES = 4096  # ranges of turns counted in one job
SLOT_ROWS = 1 << 16  # rows numbered in one window


def ring(shards: int, virtual: int = VIRTUAL) -> list[list[int]]:
    """For each place, the shards in the order in which they are met clockwise. 4096 short lists."""
    places = 1 << RING_BITS
    seated: list[list[int]] = [[] for _ in range(places)]
    for shard in range(shards):
        for k in range(virtual):
            seated[int.from_bytes(hashlib.sha256(f"{shard}/{k}".encode()).digest()[:4], "big") % places].append(shard)
    out: list[list[int]] = [[] for _ in range(places)]
    ahead: list[int] = []
    for place in [*reversed(range(places)), *reversed(range(places))]:  # twice round, against the clock
        for shard in reversed(seated[place]):
            ahead = [shard, *(s for s in ahead if s != shard)]
        out[place] = ahead
    return out


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _choice(full_at: list[int]):
    """The shard of a key: the first of its list that is not full before its turn."""
    full = F.array(*[F.lit(x).cast("long") for x in full_at])
    return F.filter("_clockwise", lambda s: F.element_at(full, s + 1) >= F.col("_turn"))[0]


def closing_turns(keys: DataFrame, rows: int, limits: list[int]) -> list[int]:
    """For each shard, the turn of the last key it takes (-1: none), by counting keys per shard and range."""
    never = rows  # no key has this turn
    full_at = [never if limit else -1 for limit in limits]
    load = [0] * len(limits)
    done = 0  # turns before this are settled and counted in load
    while done < rows:
        open_ = [s for s, at in enumerate(full_at) if at == never]
        if len(open_) == 1:
            full_at[open_[0]] = rows - 1
            break
        low, high = done, rows
        base = list(load)
        while True:  # in [low, high) the next open shard becomes full
            width = -(-(high - low) // RANGES)
            counted = (
                keys.where((F.col("_turn") >= low) & (F.col("_turn") < high))
                .groupBy(_choice(full_at).alias("s"), F.floor((F.col("_turn") - low) / width).alias("r"))
                .count().collect()  # shards times RANGES rows at most
            )
            by_range: dict[int, list[tuple[int, int]]] = {}
            for s, r, n in counted:
                by_range.setdefault(r, []).append((s, n))
            for r in sorted(by_range):
                after = list(base)
                for s, n in by_range[r]:
                    after[s] += n
                if any(after[s] >= limits[s] for s in open_):
                    low, high = low + r * width, min(high, low + (r + 1) * width)
                    break
                base = after
            else:
                return full_at
            if width == 1:
                shard = next(s for s in open_ if after[s] >= limits[s])
                full_at[shard] = low
                load, done = after, low + 1
                break
    return full_at


def assign(keyed: DataFrame, order: list[str], shards: int = SHARDS) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows with a ``_ring`` hash, taking turns in the given order."""
    spark = keyed.sparkSession
    places = spark.createDataFrame(
        [(place, shards_) for place, shards_ in enumerate(ring(shards))], "_place int, _clockwise array<int>"
    )
    turns = ranked(keyed, order, "_turn").withColumn(
        "_place", F.shiftrightunsigned("_ring", 64 - RING_BITS).cast("int")
    )
    # The ring is a table of 4096 rows, whatever the input.
    turns = cut(turns.join(F.broadcast(places), "_place").drop("_place"))
    rows = turns.count()
    full_at = closing_turns(turns.select("_turn", "_clockwise"), rows, capacities(rows, shards))
    placed = turns.withColumns(
        {"shard": _choice(full_at).cast("int"), "_range": F.floor(F.col("_turn") / SLOT_ROWS)}
    ).drop("_clockwise")
    counts = placed.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("shard", "_range").orderBy("_turn")
    return (
        placed.withColumn("_number", F.row_number().over(own) - 1)
        .join(counts, ["shard", "_range"])
        .withColumn("slot", F.col("_before") + F.col("_number"))
        .drop("_range", "_before", "_number", "_turn", "_ring")
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    keyed = read(spark, folder, "documents").select(
        id_key("doc_id").alias("id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    ).withColumns({"_ring": F.xxhash64("id"), "_order": F.xxhash64("id", F.lit("turn"))})
    placed = assign(keyed, ["_order", "id", "size", "text_crc32"])
    return placed.select(
        from_key("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

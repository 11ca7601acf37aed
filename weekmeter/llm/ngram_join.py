"""N-gram Jaccard join: links between documents whose sets of 5-word shingles are alike, exactly.

The method is the pigeonhole over a partition of the universe. The shingles of a size band are hashed
into segments. Two linked sets of n and s shingles differ in at most H = (n + s) / 9 of them, so at
most H segments differ, and of any H + 1 non-empty segments taken in an order both sets share, one is
the same in both. Each document therefore indexes the subsets that its H + 1 cheapest segments hold:

- The cost of a segment is its expected number of partners, bounded by the rarest of its shingles in a
  count sketch over all documents (fixed size). Passages that many documents share are thus the last to
  be indexed. Any order gives the same links; the sketch only decides how many candidates there are.
- Sets below ``TINY`` shingles differ in one at most: for them the whole set is one segment, indexed with
  its one-deletion neighbourhood. In larger bands a neighbourhood of c shingles costs c + 1 index rows for
  two units of the pigeonhole where two further segments cost two, so the allocation takes segments.
- A set with too few non-empty segments is indexed in finer partitions as well, until it has enough.
- A set near the lower end of its band is indexed in the band below, too, where smaller partners are.

Documents of one signature are a bucket. Every member is compared first with the centre of one of its
buckets, then with the centres of the others unless they are in one component already; last, in blocks,
the members that still lie in different components. Sizes, and parities of hashed cells, tell at once
that most pairs are not linked; the rest are compared exactly. No pair that could join two components
is left out, and the pairs within a group of copies are never listed. Buckets, centres and nodes that hold
a large share of the rows are dealt out (``join_spread``), and shuffle files are given back at each cut point.

Defined results: NULL and empty texts, and texts without words, have empty sets and link with nothing;
texts of equal sets are one node from the start; a NULL id counts as the smallest; the pipeline stage
tells rows of one id apart by their sets, and those with empty sets by all their columns. Sets are told
apart by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm import words as W
from weekmeter.llm.common import Cuts, cut, from_key, id_key, in_arrow, join_spread, read, set_aside
from weekmeter.llm.components import components

SHINGLE = 5
TINY = 8  # sets below this differ in one shingle at most when linked
BAND_RATIO = 4  # largest to smallest size of a band
SEGMENTS = 1.5  # segments of a band per shingle of its smallest size
SKETCH_BITS = 20
SKETCH_ROW = 1 << 14  # counters in one row of the sketch while it is added up
HOT_LEVEL = 14  # buckets expected to hold more than 2**14 documents are salted
SALTS = 64
MEMBERS = 1000  # nodes of a group that one block holds
BLOCK_SHINGLES = 1 << 21  # shingles of a group that one block holds
COPIES_SEEN = 200_000  # fingerprints remembered in a task, so that copies are indexed once

U64 = np.uint64


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every text."""
    for part in W.texts(column):
        found = W.words(part)
        hashes = W.word_hashes(part.data, found, lower=True)
        grams = W.ngram_hashes(hashes, SHINGLE)
        firsts = found.firsts.tolist()
        for k, row in enumerate(part.rows):
            a, b = firsts[k], firsts[k + 1]
            if b - a >= SHINGLE:
                yield row, np.unique(grams[a : b - SHINGLE + 1])
            elif b > a:
                yield row, W.ngram_hashes(hashes[a:b], b - a) ^ W.mixed(np.array([b - a], U64))
            else:
                yield row, np.zeros(0, U64)


def fingerprint(shingles: np.ndarray) -> int:
    total = W.mixed(shingles).sum(dtype=U64) + U64(len(shingles))
    return int(W.mixed(np.array([total]))[0].view(np.int64))


def bands(size: int) -> list[tuple[int, int, int]]:
    """The bands a set of this size is indexed in: number, smallest size, and signatures needed."""

    def low(band: int) -> int:
        return TINY * BAND_RATIO ** (band - 1) if band else 1

    band = 0
    while size >= low(band + 1):
        band += 1
    found = [(band, low(band), (size + 5 * size // 4) // 9 + 1)]
    if band and 4 * size <= 5 * (low(band) - 1):
        found.append((band - 1, low(band - 1), (size + low(band) - 1) // 9 + 1))
    return found


def signatures(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures to index of one set, and the expected size of their buckets as a power of two."""
    spread = W.mixed(shingles)
    levels = counts[shingles & U64(len(counts) - 1)]
    out, out_levels = [], []
    for band, low, needed in bands(len(shingles)):
        if band == 0:
            whole = spread.sum(dtype=U64)
            # The whole set, and the set without each one of its shingles.
            sums = np.concatenate(([whole], whole - spread)) if len(shingles) > 1 else np.array([whole])
            out.append(W.mixed(sums ^ U64(0xA5A5)))
            # Each has the level of what it holds: other sets with the same signature must give it the same.
            held = np.full(len(sums), levels.min())
            if len(levels) > 1:
                held[1 + levels.argmin()] = np.partition(levels, 1)[1]
            out_levels.append(held)
            continue
        for depth, segments in enumerate((int(SEGMENTS * low), 8 * int(SEGMENTS * low), 0)):
            segment = shingles % U64(segments) if segments else shingles
            order = np.argsort(segment, kind="stable")
            segment = segment[order]
            begin = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            sums = np.add.reduceat(spread[order], begin)
            level = np.minimum.reduceat(levels[order], begin)
            mark = W.mixed(segment[begin] + U64((band * 4 + depth + 1) << 50))
            sign = W.mixed(sums ^ mark)
            enough = len(sign) >= needed
            if len(sign) > needed:
                key = (level.astype(U64) << U64(57)) | (sign >> U64(7))
                chosen = np.argpartition(key, needed - 1)[:needed]
                sign, level = sign[chosen], level[chosen]
            out.append(sign)
            out_levels.append(level)
            if enough:
                break
    return np.concatenate(out), np.concatenate(out_levels)


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """The count sketch over all documents: for each cell, the power of two that its documents reach.

    Every task adds up its own sketch; the cells are summed in rows. 2**SKETCH_BITS bytes in the end.
    """
    cells = 1 << SKETCH_BITS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, shingles in shingle_sets(batch.column(0)):
                held.append(shingles & U64(cells - 1))
                size += len(shingles)
                if size >= cells:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells)
        for k in range(0, cells, SKETCH_ROW):
            row = total[k : k + SKETCH_ROW]
            if row.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([row.astype(np.uint32).tobytes()])], ["first", "cells"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = np.frombuffer(row, np.uint32).astype(np.int64)
                sums[first] = sums[first] + row if first in sums else row
        for first, row in sums.items():
            level = np.ceil(np.log2(np.maximum(row, 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([level.tobytes()])], ["first", "cells"])

    rows = (
        docs.select("text").mapInArrow(run, "first long, cells binary").repartition("first")
        .mapInArrow(add, "first long, cells binary").toArrow()
    )
    counts = np.zeros(cells, np.uint8)
    for first, row in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        counts[first : first + SKETCH_ROW] = np.frombuffer(row, np.uint8)
    return counts


def parity(shingles: np.ndarray) -> bytes:
    """For each cell of a table of at least two bits per shingle: whether an odd number falls there.

    Two tables differ in at most as many bits as the sets differ in shingles.
    """
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    odd = np.bincount((shingles & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def shingled(docs: DataFrame) -> DataFrame:
    """One row per document: id (NULL as the smallest), number of shingles, fingerprint and parity of the set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = np.zeros(batch.num_rows, np.int64)
        prints = np.zeros(batch.num_rows, np.int64)
        parities = [b""] * batch.num_rows
        for row, shingles in shingle_sets(batch.column(1)):
            sizes[row], prints[row], parities[row] = len(shingles), fingerprint(shingles), parity(shingles)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(prints), pa.array(parities, pa.binary())],
            ["id", "n", "node", "parity"],
        )

    schema = T.StructType.fromDDL("id long, n long, node long, parity binary")
    return in_arrow(docs.select(id_key("doc_id").alias("id"), "text"), work, schema)


def indexed(docs: DataFrame, counts) -> DataFrame:
    """The index rows: signature, salt (-1 unless the bucket is expected to be hot), node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = counts.value
        seen: set[int] = set()
        for batch in batches:
            signs, salts, nodes = [], [], []
            for _, shingles in shingle_sets(batch.column(0)):
                if not len(shingles):
                    continue
                node = fingerprint(shingles)
                if node in seen:
                    continue
                if len(seen) < COPIES_SEEN:
                    seen.add(node)
                sign, level = signatures(shingles, levels)
                signs.append(sign)
                salts.append(np.where(level >= HOT_LEVEL, node % SALTS, -1).astype(np.int32))
                nodes.append(np.full(len(sign), node, np.int64))
            if signs:
                yield _index_batch(signs, salts, nodes)

    return docs.select("text").mapInArrow(run, "sign long, salt int, node long")


def _index_batch(signs, salts, nodes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [W.signed(np.concatenate(signs)), pa.array(np.concatenate(salts)), pa.array(np.concatenate(nodes))],
        ["sign", "salt", "node"],
    )


def buckets(index: DataFrame, cuts: Cuts) -> DataFrame:
    """Members of buckets of two nodes or more: sign, node, and the number of members."""
    bucket = Window.partitionBy("sign", "salt")
    rows = index.withColumns({"x": F.min("node").over(bucket), "y": F.max("node").over(bucket)})
    # Hot buckets were dealt out by salt; whether they hold two nodes shows when their parts are counted.
    rows = cuts.keep(rows.where("salt >= 0 or x <> y").select("sign", "node").distinct())
    sizes = rows.groupBy("sign").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = cuts.keep(join_spread(rows, sizes, "sign"))
    cuts.drop(rows)
    return members


def bucket_stars(members: DataFrame) -> DataFrame:
    """All members of each bucket but its centre, with the centre: sign, node, centre.

    The centre is the member that has most company in all its buckets together: of a group of near
    copies, that is the one nearest to what they have in common.
    """
    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    centres = (
        members.join(company, "node").groupBy("sign").agg(F.max(F.struct("company", "node")).alias("m"))
        .select("sign", F.col("m.node").alias("centre"))
    )
    return join_spread(members.select("sign", "node"), centres, "sign").where("node <> centre")


def likely(pairs: DataFrame, holders: DataFrame) -> DataFrame:
    """Drop the pairs (a, b) that sizes or parities show not to be linked; no linked pair goes."""
    kept = [c for c in pairs.columns if c not in ("a", "b")]
    one, two = (
        holders.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"p{side}"))
        for side in ("a", "b")
    )
    sides = join_spread(pairs, two, "b").join(one, "a")  # a centre may have any number of partners
    sides = sides.where("5 * na >= 4 * nb and 5 * nb >= 4 * na").select("a", "b", *kept, "na", "nb", "pa", "pb")
    last = len(kept) + 2

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        most = (batch.column(last).to_numpy() + batch.column(last + 1).to_numpy()) // 9
        keep = np.zeros(batch.num_rows, bool)
        for k, (one, two) in enumerate(zip(batch.column(last + 2), batch.column(last + 3), strict=True)):
            one, two = np.frombuffer(one.as_py(), np.uint8), np.frombuffer(two.as_py(), np.uint8)
            if len(one) < len(two):
                one, two = two, one
            one = np.bitwise_xor.reduce(one.reshape(-1, len(two)), axis=0)
            keep[k] = int(np.bitwise_count(one ^ two).sum()) <= most[k]
        return pa.RecordBatch.from_arrays(batch.columns[:last], ["a", "b", *kept]).filter(pa.array(keep))

    return in_arrow(sides, work, pairs.select("a", "b", *kept).schema)


def grouped(met: DataFrame, holders: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes that have met one centre, and the centre: centre, node, component, n, parity."""
    rows = met.select("b", "a").union(met.select("b", "b").distinct()).toDF("centre", "node")
    of = found.select("node", "component")
    rows = rows.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return rows.join(holders.select("node", "n", "parity"), "node")


def in_blocks(rows: DataFrame, cuts: Cuts) -> DataFrame:
    """Deal the rows of each centre to pairs of blocks: the rows, with one and two (a pair), and own (its block).

    A block holds about ``MEMBERS`` nodes and ``BLOCK_SHINGLES`` shingles. A component that fills a block has
    blocks of its own, and is never compared with itself; the others share blocks. Centres of one component
    have nothing left to compare. ``rows`` must be written.
    """
    parts = cuts.keep(
        rows.groupBy("centre", "component").agg(F.greatest(F.count(F.lit(1)) / MEMBERS, F.sum("n") / BLOCK_SHINGLES).alias("fill"))
    )
    several = parts.groupBy("centre").agg(
        F.count(F.lit(1)).alias("components"), F.sum(F.when(F.col("fill") < 1, F.col("fill"))).alias("rest")
    ).where("components > 1")
    dealt = cuts.keep(
        join_spread(parts, several, "centre")
        .withColumn("lead", F.when(F.col("fill") >= 1, F.col("component")))
        .withColumn("count", F.greatest(F.ceil(F.coalesce(F.when(F.col("fill") >= 1, F.col("fill")), "rest")), F.lit(1)).cast("int"))
        .select("centre", "component", "lead", "count")
    )
    blocks = cuts.keep(
        dealt.select("centre", "lead", "count").distinct()
        .select("centre", "lead", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("part"))
        .select("centre", "lead", F.xxhash64("lead", "part").alias("own"))
    )
    other = blocks.select("centre", F.col("lead").alias("other_lead"), F.col("own").alias("two"))
    work = (
        blocks.withColumnRenamed("own", "one").join(other, "centre").where("one <= two and coalesce(lead <> other_lead, true)")
        .select("centre", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("own"))
    )
    own = F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("count")).cast("int"))
    placed = join_spread(rows, dealt, ["centre", "component"]).withColumn("own", own).drop("lead", "count")
    return placed.join(work, ["centre", "own"])


def likely_pairs(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """A row of a pair of blocks, and the rows of other components that sizes and parities do not rule out.

    No pair comes twice. Of two different blocks, only pairs across them come.
    """
    node, component, n, own = (table.column(c).to_numpy() for c in ("node", "component", "n", "own"))
    apart_only = table.column("one")[0].as_py() != table.column("two")[0].as_py()
    parities = table.column("parity").to_pylist()
    width = np.array([len(x) for x in parities])
    for wide in np.unique(width):
        left = np.flatnonzero(width == wide)
        words = np.array([np.frombuffer(parities[k], np.uint64) for k in left])
        for narrow in (wide, wide // 2):
            right = np.flatnonzero(width == narrow)
            if not len(right):
                continue
            bits = np.bitwise_xor.reduce(words.reshape(len(left), -1, narrow // 8), axis=1)
            for at in right.tolist():
                mates = left[(component[left] != component[at]) & (5 * n[left] >= 4 * n[at]) & (5 * n[at] >= 4 * n[left])]
                if apart_only:
                    mates = mates[own[mates] != own[at]]
                if wide == narrow:
                    mates = mates[node[mates] < node[at]]
                if not len(mates):
                    continue
                apart = np.bitwise_count(bits[np.searchsorted(left, mates)] ^ np.frombuffer(parities[at], np.uint64)).sum(axis=1)
                mates = mates[apart <= (n[mates] + n[at]) // 9]
                if len(mates):
                    yield at, mates


def with_company(table: pa.Table) -> pa.Table:
    """The nodes of a pair of blocks that have a likely pair."""
    seen = np.zeros(table.num_rows, bool)
    for at, mates in likely_pairs(table):
        seen[at] = True
        seen[mates] = True
    return table.select(["centre", "node"]).filter(pa.array(seen))


def joining(table: pa.Table) -> pa.Table:
    """Links of a pair of blocks, compared exactly: enough of them to join what the links join."""
    node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
    shingles = table.column("shingles").combine_chunks()
    places, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
    sets = [values[places[k] : places[k + 1]] for k in range(len(node))]
    _, parent = np.unique(component, return_inverse=True)
    parent = parent.tolist()  # of each row, its component; of each component, one it has joined
    roots = list(range(max(parent, default=-1) + 1))

    def root(k: int) -> int:
        while roots[k] != k:
            roots[k] = roots[roots[k]]
            k = roots[k]
        return k

    a, b = [], []
    for at, mates in likely_pairs(table):
        for mate in mates.tolist():
            one, two = root(parent[at]), root(parent[mate])
            if one != two and _linked(sets[at], sets[mate]):
                roots[max(one, two)] = min(one, two)
                a.append(node[at])
                b.append(node[mate])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _linked(one: np.ndarray, two: np.ndarray) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= 80 * (len(one) + len(two) - both)


def shingle_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of some nodes: node, shingles. ``wanted`` has the node and the id of a row that holds it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows of one id come together: their set is wanted once
        for batch in batches:
            nodes, sets = [], []
            expected = batch.column(1).to_pylist()
            for row, shingles in shingle_sets(batch.column(0)):
                node = expected[row]
                if node not in seen and len(shingles) and fingerprint(shingles) == node:
                    if len(seen) < COPIES_SEEN:
                        seen.add(node)
                    nodes.append(node)
                    sets.append(shingles)
            if nodes:
                lengths = np.array([len(x) for x in sets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), W.lists(np.concatenate(sets), lengths)], ["node", "shingles"]
                )

    texts = docs.select(id_key("doc_id").alias("id"), "text").join(wanted.select("id", "node"), "id")
    return texts.select("text", "node").mapInArrow(run, "node long, shingles array<long>")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sets are linked: 100 * intersection >= 80 * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= 80 * union).select("a", "b")


class _Links:
    """The components found so far, and the sets read so far."""

    def __init__(self, docs: DataFrame, holders: DataFrame, cuts: Cuts):
        self.docs, self.holders, self.cuts = docs, holders, cuts
        self.sets: DataFrame | None = None
        self.found: DataFrame | None = None

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """Sets of some nodes (and others), of which those not read yet are read."""
        wanted = self.holders.join(nodes.distinct(), "node")
        if self.sets is None:
            self.sets = self.cuts.keep(shingle_table(self.docs, wanted))
            return self.sets
        missing = self.cuts.keep(wanted.join(self.sets.select("node").distinct(), "node", "left_anti"))
        if not missing.isEmpty():
            self.sets = self.sets.unionByName(self.cuts.keep(shingle_table(self.docs, missing)))
        return self.sets

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Those pairs that lie in different components."""
        own = self.found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        other = self.found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        joined = pairs.join(own, "a", "left").join(other, "b", "left")
        return joined.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    def compare(self, pairs: DataFrame) -> None:
        """Compare likely pairs exactly; add their links."""
        if self.found is not None and pairs.isEmpty():
            return
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        self.add(similar(pairs, self.sets_of(nodes)))

    def compare_in_blocks(self, met: DataFrame) -> None:
        """Two members of a bucket have its centre in common: compare what still lies apart there.

        Parities first tell which nodes have a likely partner at all; only their sets are moved.
        """
        rows = self.cuts.keep(grouped(met, self.holders, self.found))
        keys = ["centre", "one", "two"]
        company = in_blocks(rows, self.cuts).groupBy(*keys).applyInArrow(with_company, "centre long, node long")
        company = self.cuts.keep(company.distinct())
        if company.isEmpty():
            return
        sets = self.sets_of(company.select("node"))
        near = self.cuts.keep(rows.join(company, ["centre", "node"]).join(sets, "node"))
        self.cuts.drop(rows)
        self.add(in_blocks(near, self.cuts).groupBy(*keys).applyInArrow(joining, "a long, b long"))

    def add(self, links: DataFrame) -> None:
        """Links beside the components there are; a component is joined as the links of its members to its node."""
        before, links = self.found, self.cuts.keep(links)
        if before is None:
            self.found = components(links, "a", "b", self.cuts)
        elif not links.isEmpty():
            stars = before.select(F.col("node").alias("a"), F.col("component").alias("b"))
            self.found = components(links.unionByName(stars), "a", "b", self.cuts)
            self.cuts.drop(before)
        self.cuts.drop(links)


def placed_nodes(docs: DataFrame) -> DataFrame:
    """One row per document: id (NULL as the smallest), n, node, component (smallest node reachable)."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(shingle_counts(docs))
    with Cuts(spark) as cuts:
        nodes = cuts.keep(shingled(docs))
        members = buckets(indexed(docs, counts), cuts)
        met = cuts.keep(
            bucket_stars(members)
            .groupBy(F.col("node").alias("a"), F.col("centre").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
        )
        holders = cuts.keep(
            nodes.where("n > 0").groupBy("node")
            .agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("parity").alias("parity"))
            .join(members.select("node").distinct(), "node")
        )
        cuts.drop(members)

        # Every member with the centre it shares most signatures with, then with its other centres.
        pairs = cuts.keep(likely(met, holders))
        links = _Links(docs, holders, cuts)
        best = cuts.keep(
            pairs.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        )
        links.compare(best)
        links.compare(cuts.keep(links.apart(pairs.join(best, ["a", "b"], "left_anti"))))
        cuts.drop(pairs, best)
        links.compare_in_blocks(met)

        placed = nodes.select("id", "n", "node").join(links.found, "node", "left")
        return cut(placed.withColumn("component", F.coalesce("component", "node")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: id (NULL as the smallest), n, node, component (smallest id reachable)."""
    placed = placed_nodes(docs)
    least = placed.where("n > 0").groupBy("component").agg(F.min("id").alias("least"))
    # A component may hold any share of the documents, and all empty sets are one here.
    return join_spread(placed, least, "component", "left").select(
        "id", "n", "node", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component")
    )


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_components(read(spark, folder, "documents"))
    return found.select(
        from_key("id").alias("doc_id"), F.col("n").alias("n_shingles"), from_key("component").alias("component_id")
    )


def with_nodes(rows: DataFrame) -> DataFrame:
    """Add the number of shingles and the fingerprint of the set to rows with a text."""
    at = rows.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, nodes = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for row, shingles in shingle_sets(batch.column(at)):
            sizes[row], nodes[row] = len(shingles), fingerprint(shingles)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sizes), pa.array(nodes)], [*batch.schema.names, "n", "node"]
        )

    return in_arrow(rows, work, T.StructType([*rows.schema, *T.StructType.fromDDL("n long, node long")]))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: of each component, the document with the smallest (id, node) stays.

    Documents with empty sets all stay, exact repeats of a row aside. An id of one row tells which row it
    is; only rows of ids that repeat are read again for their sets.
    """
    found = placed_nodes(docs)
    linked = found.where("n > 0")
    stays = cut(linked.groupBy("component").agg(F.min(F.struct("id", "node")).alias("m")).select("m.id", "m.node"))
    kept = stays.select("id").union(found.where("n = 0").select("id"))
    gone = linked.select("id").distinct().join(kept, "id", "left_anti")
    again = cut(found.groupBy("id").count().where("count > 1").select("id"))
    hidden, named = set_aside(docs, "doc_id", "text")
    left = hidden.withColumn("id", id_key("doc_id")).join(gone, "id", "left_anti")
    if again.isEmpty():
        return named(left)
    once = left.join(again, "id", "left_anti")
    # Copies of a row merge before the join, the least row of a set stays for all.
    row = F.struct(*hidden.columns)
    several = (
        with_nodes(left.join(again, "id", "left_semi"))
        .withColumns({"row": row, "empty": F.when(F.col("n") == 0, row)})
        .groupBy("id", "node", "empty").agg(F.min("row").alias("row"))
    )
    # Rows with empty sets need no partner; a key of their own deals them out.
    several = several.withColumn("node", F.when(F.col("empty").isNull(), F.col("node")).otherwise(F.xxhash64("empty")))
    judged = several.join(stays.withColumn("stays", F.lit(True)), ["id", "node"], "left")
    return named(once.drop("id").unionByName(judged.where("empty is not null or stays").select("row.*")))

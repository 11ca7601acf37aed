"""Substring dedup by relative Lempel-Ziv parsing.

A window is ``WINDOW`` consecutive words. The corpus is its own reference, cut into blocks that are indexed:

1. Anchors. Each window picks the least hash among its ``ANCHOR``-word grams, so equal windows pick
   equal anchors, about two words in thirteen start one, and an anchor that occurs once in the corpus rules
   out all windows that pick it. Only windows with a repeated anchor go on.
2. Blocks of documents. A task indexes the documents it holds, about ``BLOCK`` windows at a time. The reference
   of a block has every window once, at its earliest place, so a place of a document can begin at most one match of
   ``WINDOW`` words, and following that match as far as the words agree gives the longest. Each document is
   factored greedily: the longest match from a place is a factor, and the next begins behind it; a place
   without one is a word by itself. Windows over the end of a factor are looked up one by one.
3. Blocks of anchors. Only reference windows of a block go further, in pieces of consecutive windows with
   one anchor, so a passage in a third of all documents sends its pieces once per block, not once per
   document. Pieces of one anchor meet in one block, whatever documents they come from, and are factored there in
   the same way. The pieces of an anchor with a large share of them are split into windows, dealt by window.
4. Cover. The words of all factors, and of the windows found over their ends, go.

Documents with one word sequence are copies: the one with the smallest id is looked up, of the others
every word is covered. Windows are told apart by 64-bit hashes, word sequences by SHA-256.

Defined results: NULL and empty texts have no words; a NULL id counts as the smallest; rows of one id
and one word sequence are one document; of rows of one id with other words the order of their
fingerprints decides; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm import words as W
from weekmeter.llm.common import cut, from_key, id_key, in_arrow, join_spread, let_go, read, set_aside

WINDOW = 20
ANCHOR = 9
BLOCK = 1_500_000  # anchors, or windows, that one block holds at least before it is indexed
PIECE_SHARE = 1 << 16
LEAST_PIECES = 1 << 8  # an anchor with more pieces than this, and than one in PIECE_SHARE, is dealt by window

EMPTY = hashlib.sha256(b"").digest()


def _anchored(column: pa.Array):
    """For every part of a column: part, words, window hashes, anchor hash and place of each window, bounds by row.

    Windows of row k are those from ``bounds[k]`` to ``bounds[k] + counts[k]``; they start at a word each.
    """
    spread = WINDOW - ANCHOR + 1
    for part in W.texts(column):
        found = W.words(part)
        hashes = W.word_hashes(part.data, found)
        grams = W.ngram_hashes(hashes, ANCHOR)
        windows = W.ngram_hashes(hashes, WINDOW)
        if len(windows):
            # The leftmost of equal hashes; the last gram a window may pick starts WINDOW - ANCHOR words in.
            view = np.lib.stride_tricks.sliding_window_view(grams, spread)
            place = np.arange(len(windows)) + view.argmin(axis=1)
        else:
            place = np.zeros(0, np.int64)
        yield part, found, windows, grams, place, found.firsts[:-1], W.runs_in_rows(found, WINDOW)


class _Block:
    """Rows held back until the task has enough of them to index together."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, size: int, *row) -> bool:
        self.rows.append(row)
        self.size += size
        return self.size >= BLOCK

    def take(self) -> list[tuple]:
        rows, self.rows, self.size = self.rows, [], 0
        return rows


def _offsets(lengths: Iterable[int]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.fromiter(lengths, np.int64)))).astype(np.int32)


def word_rows(docs: DataFrame) -> DataFrame:
    """Per document: id, node, sha, n, and anchors: ``known`` to repeat within its block, ``sent`` to be checked.

    Of the documents of a block that share an anchor, one sends it.
    """

    def indexed(rows: list[tuple]) -> pa.RecordBatch:
        ids, nodes, shas, counts, anchors = zip(*rows, strict=True)
        seen: set[int] = set()
        anchors = list(anchors)
        for k, node in enumerate(nodes):
            if node in seen:
                anchors[k] = anchors[k][:0]  # a copy
            seen.add(node)
        lengths = np.array([len(x) for x in anchors])
        flat = np.concatenate(anchors)
        owner = np.repeat(np.arange(len(rows)), lengths)
        order = np.lexsort((owner, flat))
        value, own = flat[order], owner[order]
        new = np.concatenate(([True], value[1:] != value[:-1])) if len(value) else np.zeros(0, bool)
        repeated = ~new
        repeated[:-1] |= ~new[1:]
        first_of_own = new | np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]
        known, sent = repeated & first_of_own, new

        def split(mask: np.ndarray) -> pa.Array:
            picked, by = value[mask], own[mask]
            back = np.argsort(by, kind="stable")
            lengths = np.bincount(by, minlength=len(rows))
            return pa.ListArray.from_arrays(
                pa.array(_offsets(lengths.tolist())), pa.array(picked[back].view(np.int64))
            )

        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(shas, pa.binary()), pa.array(counts, pa.int64()),
             split(known), split(sent)],
            ["id", "node", "sha", "n", "known", "sent"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part, found, _, grams, place, bounds, counts in _anchored(batch.column(1)):
                for k, row in enumerate(part.rows):
                    text = part.data[part.offsets[k] : part.offsets[k + 1]].tobytes()
                    digest = hashlib.sha256(b" ".join(text.split())).digest()
                    node = _node(digest)
                    own = place[bounds[k] : bounds[k] + counts[k]]
                    own = own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) else own
                    if block.add(len(own) + 1, ids[row], node, digest, int(found.counts[k]), grams[own]):
                        yield indexed(block.take())
        if block.rows:
            yield indexed(block.take())

    return docs.select(id_key("doc_id").alias("id"), "text").mapInArrow(
        run, "id long, node long, sha binary, n long, known array<long>, sent array<long>"
    )


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """id, anchors: of each document that is the first of its word sequence, the anchors that repeat."""
    sent = rows.select("node", F.explode("sent").alias("anchor"))
    bucket = Window.partitionBy("anchor")
    shared = (
        sent.withColumns({"x": F.min("node").over(bucket), "y": F.max("node").over(bucket)})
        .where("x <> y").select("node", "anchor")
    )
    every = shared.unionByName(rows.select("node", F.explode("known").alias("anchor")))
    by_node = every.groupBy("node").agg(F.collect_set("anchor").alias("anchors"))
    first = rows.groupBy("node", "sha").agg(F.min("id").alias("id"))
    return first.join(by_node, "node").select("id", "node", "anchors")


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def packed_words(docs: DataFrame) -> DataFrame:
    """id, node and the words of each document, one space between them, compressed: less to move than the text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [b" ".join((x.as_py() or b"").split()) for x in batch.column(1).cast(pa.large_binary())]
        nodes = [_node(hashlib.sha256(x).digest()) for x in texts]
        packed = [zlib.compress(x, 1) for x in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())], ["id", "node", "packed"]
        )

    schema = T.StructType.fromDDL("id long, node long, packed binary")
    return in_arrow(docs.select(id_key("doc_id").alias("id"), "text"), work, schema)


class Index:
    """The windows of a block, in the order of their places, and its reference: each window's earliest place."""

    def __init__(self, value: np.ndarray):
        by = np.argsort(value, kind="stable")
        ordered = value[by]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(by) else np.zeros(0, bool)
        self.earliest = np.zeros(len(by), np.int64)
        self.earliest[by] = by[np.flatnonzero(new)][np.cumsum(new) - 1]

    @property
    def reference(self) -> np.ndarray:
        return self.earliest == np.arange(len(self.earliest))


class Found(NamedTuple):
    """What a parse finds, in runs of consecutive windows: place in the block of the first window of each run and of
    its source, number of windows, and whether the run is a factor or windows over the end of one."""

    begin: np.ndarray
    source: np.ndarray
    count: np.ndarray
    factor: np.ndarray


def parse(index: Index, owner: np.ndarray, doc: np.ndarray, at: np.ndarray) -> Found:
    """Factor the documents of a block greedily against its reference.

    ``owner`` is the row that a window is of, ``doc`` the document: rows of one document are no source of each other.
    """
    source = index.earliest
    # A match is followed as long as the next word of the text is the next of the reference.
    placed = np.flatnonzero(~index.reference & ((doc[source] != doc) | (at[source] != at)))
    heads = source[placed]
    goes_on = np.zeros(len(placed), bool)
    goes_on[1:] = (
        (np.diff(owner[placed]) == 0) & (np.diff(at[placed]) == 1)
        & (np.diff(owner[heads]) == 0) & (np.diff(at[heads]) == 1)
    )
    begin = np.flatnonzero(~goes_on)
    matches = np.diff(np.append(begin, len(placed)))
    starts = at[placed[begin]]
    runs: list[tuple[int, int, bool]] = []
    before, reach = -1, 0
    for row, first, start, count in zip(
        owner[placed[begin]].tolist(), begin.tolist(), starts.tolist(), matches.tolist(), strict=True
    ):
        if row != before:
            before, reach = row, 0
        over = min(max(reach - start, 0), count)  # windows that begin within the last factor
        if over:
            runs.append((first, over, False))
        if over < count:
            runs.append((first + over, count - over, True))
            reach = start + count - 1 + WINDOW
    first, count, factor = (np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else [np.zeros(0, np.int64)] * 3
    return Found(placed[first], heads[first], count, factor.astype(bool))


RUN = "at int, count int, source long, source_at int, factor boolean"


def block_parse(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Per candidate: its words packed, the pieces it sends on, and what is found in its own block of documents."""
    schema = (
        "id long, node long, packed binary, pieces array<struct<anchor long, at int, windows array<long>>>, "
        f"found array<struct<{', '.join(x.strip().replace(' ', ':') for x in RUN.split(','))}>>"
    )

    def indexed(rows: list[tuple]) -> pa.RecordBatch:
        # Rows by id and fingerprint, so that the first of equal windows is the earliest.
        rows = sorted(rows, key=lambda row: row[:2])
        ids, nodes, packed, windows, anchors, places = zip(*rows, strict=True)
        id_of, node_of = np.array(ids, np.int64), np.array(nodes, np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in windows])
        value, anchor, at = np.concatenate(windows), np.concatenate(anchors), np.concatenate(places)
        doc = _numbered(id_of, node_of)[owner]
        index = Index(value)
        found = parse(index, owner, doc, at)
        runs = pa.StructArray.from_arrays(
            [pa.array(at[found.begin], pa.int32()), pa.array(found.count, pa.int32()),
             pa.array(id_of[owner[found.source]], pa.int64()), pa.array(at[found.source], pa.int32()), pa.array(found.factor)],
            ["at", "count", "source", "source_at", "factor"],
        )
        sent = np.flatnonzero(index.reference)
        apart = np.ones(len(sent), bool)
        apart[1:] = (np.diff(owner[sent]) != 0) | (np.diff(at[sent]) != 1) | (anchor[sent][1:] != anchor[sent][:-1])
        begin = np.flatnonzero(apart)
        pieces = pa.StructArray.from_arrays(
            [pa.array(anchor[sent[begin]].view(np.int64)), pa.array(at[sent[begin]], pa.int32()),
             W.lists(value[sent], np.diff(np.append(begin, len(sent))))],
            ["anchor", "at", "windows"],
        )

        def by_row(column: pa.Array, of: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(_offsets(np.bincount(owner[of], minlength=len(rows)).tolist())), column)

        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(packed, pa.binary()),
             by_row(pieces, sent[begin]), by_row(runs, found.begin)],
            ["id", "node", "packed", "pieces", "found"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            ids, nodes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            packed, wanted = batch.column(2).to_pylist(), batch.column(3)
            texts = pa.array([zlib.decompress(x) for x in packed], pa.large_binary())
            for part, _, windows, grams, place, bounds, counts in _anchored(texts):
                for k, row in enumerate(part.rows):
                    span = slice(bounds[k], bounds[k] + counts[k])
                    anchors = grams[place[span]]
                    at = np.flatnonzero(np.isin(anchors, wanted[row].values.to_numpy().view(np.uint64)))
                    if block.add(len(at) + 1, ids[row], nodes[row], packed[row], windows[span][at], anchors[at], at):
                        yield indexed(block.take())
        if block.rows:
            yield indexed(block.take())

    texts = packed_words(docs).join(anchors, ["id", "node"])
    return texts.select("id", "node", "packed", "anchors").mapInArrow(run, schema)


def _numbered(*sorted_columns: np.ndarray) -> np.ndarray:
    """Number rows that are sorted by some columns; rows that agree in all of them get one number."""
    new = np.zeros(len(sorted_columns[0]), bool)
    for column in sorted_columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def dealt_pieces(parsed: DataFrame) -> DataFrame:
    """key, id, node, at, windows: equal windows of all blocks have one key, and no key holds many pieces.

    The anchor is the key, but for anchors with more than 1 / ``PIECE_SHARE`` of the pieces (and more than
    ``LEAST_PIECES``), whose windows are their own keys. There are fewer than ``PIECE_SHARE`` such anchors,
    whatever the input, so their list is broadcast.
    """
    total = parsed.agg(F.sum(F.size("pieces"))).first()[0] or 0
    unit = max(-(-total // PIECE_SHARE), LEAST_PIECES)
    pieces = parsed.select("id", "node", F.inline("pieces"))
    hot = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > unit)
    keyed = pieces.join(F.broadcast(hot.select("anchor", F.lit(True).alias("hot"))), "anchor", "left")
    whole = F.array(F.struct(F.col("anchor").alias("key"), "at", "windows"))
    single = F.transform(
        "windows", lambda w, k: F.struct(w.alias("key"), (F.col("at") + k).alias("at"), F.array(w).alias("windows"))
    )
    return keyed.select("id", "node", F.inline(F.when(F.col("hot"), single).otherwise(whole)))


def anchor_parse(pieces: DataFrame) -> DataFrame:
    """What is found in blocks of anchors, a row per run: id, node, and the columns of ``RUN``."""

    def indexed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, nodes, starts = (table.column(c).to_numpy() for c in ("id", "node", "at"))
        windows = table.column("windows").combine_chunks()
        windows = windows.chunk(0) if isinstance(windows, pa.ChunkedArray) else windows
        flat, counts = windows.flatten().to_numpy(), windows.value_lengths().to_numpy().astype(np.int64)
        order = np.lexsort((starts, nodes, ids))
        value = flat[W.segments(counts[order], (np.cumsum(counts) - counts)[order])]
        ids, nodes, counts = ids[order], nodes[order], counts[order]
        row = np.repeat(np.arange(len(ids)), counts)
        doc = _numbered(ids, nodes)[row]
        at = W.segments(counts, starts[order].astype(np.int64))
        found = parse(Index(value), doc, doc, at)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[row[found.begin]]), pa.array(nodes[row[found.begin]]), pa.array(at[found.begin], pa.int32()),
             pa.array(found.count, pa.int32()), pa.array(ids[row[found.source]]), pa.array(at[found.source], pa.int32()),
             pa.array(found.factor)],
            ["id", "node", "at", "count", "source", "source_at", "factor"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            if size >= BLOCK:
                other = key != last
                end = int(other.argmax()) if other.any() else len(key)  # the last key is taken whole
                held.append(batch.slice(0, end))
                if end == len(key):
                    continue
                yield indexed(held)
                held, size, batch = [], 0, batch.slice(end)
            held.append(batch)
            size += len(batch.column("windows").flatten())
            last = key[-1]
        if held:
            yield indexed(held)

    by_key = pieces.repartition("key").sortWithinPartitions("key")
    return by_key.select("key", "id", "node", "at", "windows").mapInArrow(run, f"id long, node long, {RUN}")


def factors(parsed: DataFrame, texts: bool = False) -> DataFrame:
    """The covered words of each candidate: id, node, sha, n, factors, words removed, the text kept and its digest.

    A factor is (start, length, source id, source start), in words. The text kept is given if ``texts``
    asks for it, and NULL if it is the whole.
    """
    one = F.struct("at", "count", "source", "source_at", "factor")
    across = anchor_parse(dealt_pieces(parsed)).groupBy("id", "node").agg(F.collect_list(one).alias("more"))
    both = F.concat("found", F.coalesce("more", F.array().cast(parsed.schema["found"].dataType)))
    joined = parsed.select("id", "node", "packed", "found").join(across, ["id", "node"], "left").select(
        "id", "node", "packed", both.alias("found")
    )
    schema = (
        "id long, node long, sha binary, n long, "
        "factors array<struct<start int, length int, source long, source_start int>>, "
        "n_removed long, kept string, kept_sha256 binary"
    )
    factor = pa.list_(
        pa.struct([("start", pa.int32()), ("length", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())])
    )
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), factor, pa.int64(), pa.string(), pa.binary()]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in range(batch.num_rows):
            joined = zlib.decompress(batch.column("packed")[row].as_py())
            words = joined.split(b" ")
            runs = batch.column("found")[row].values.flatten()
            at, count, source, source_at, is_factor = (x.to_numpy(zero_copy_only=False) for x in runs)
            found = [
                {"start": int(at[k]), "length": int(count[k]) + WINDOW - 1, "source": int(source[k]), "source_start": int(source_at[k])}
                for k in sorted(np.flatnonzero(is_factor).tolist(), key=lambda k: (at[k], count[k]))
            ]
            over_ends = [(int(a), int(n)) for a, n in zip(at[~is_factor], count[~is_factor], strict=True)]
            covered = cover(len(words), found, over_ends)
            removed = int(covered.sum())
            kept = b" ".join(itertools.compress(words, ~covered))
            out.append((
                batch.column("id")[row].as_py(), batch.column("node")[row].as_py(),
                hashlib.sha256(joined).digest(), len(words), found, removed,
                kept.decode() if removed and texts else None, hashlib.sha256(kept).digest(),
            ))
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(
            columns, ["id", "node", "sha", "n", "factors", "n_removed", "kept", "kept_sha256"]
        )

    return in_arrow(joined, lambda batch: work(batch) if batch.num_rows else None, T.StructType.fromDDL(schema))


def cover(size: int, found: list[dict], over_ends: list[tuple[int, int]]) -> np.ndarray:
    """The words of a document that its factors hold, or windows over their ends: first place and number of these."""
    edges = np.zeros(size + 1, np.int64)
    for start, length in [(f["start"], f["length"]) for f in found] + [(a, n + WINDOW - 1) for a, n in over_ends]:
        edges[start] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def _parsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents as ``word_rows`` gives them, with ``copy``, and the parsed candidates."""
    rows = cut(word_rows(docs))
    parsed = cut(block_parse(docs, repeated_anchors(rows)))
    let_go(docs.sparkSession)
    alike = cut(rows.groupBy("id", "node", "sha", "n").agg(F.count(F.lit(1)).alias("rows")))
    first = alike.groupBy("node", "sha").agg(F.min("id").alias("first"))
    copy = (F.col("id") != F.col("first")) & (F.col("n") >= WINDOW)
    return join_spread(alike, first, ["node", "sha"]).withColumn("copy", copy).drop("first"), parsed


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document: id, n_words, n_removed, and the digest of the words kept."""
    rows, parsed = _parsed(docs)
    found = factors(parsed).select("id", "node", "n_removed", "kept_sha256")
    # Repeated rows of a document are one row here, and as many in ``found``; those not parsed are counted out.
    one = F.lit(1).cast("long")
    again = F.sequence(one, F.when(F.col("n_removed").isNull(), F.col("rows")).otherwise(one))
    placed = rows.join(found, ["id", "node"], "left").withColumn("_row", F.explode(again))
    return placed.select(
        "id",
        F.col("n").alias("n_words"),
        F.when(F.col("copy"), F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = deduplicated(read(spark, folder, "documents"))
    return found.select(
        from_key("id").alias("doc_id"), "n_words", "n_removed", F.lower(F.hex("kept_sha256")).alias("kept_sha256")
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: covered words go, and documents of which no word is left; other texts stay as they are."""
    rows, parsed = _parsed(docs)
    shorter = factors(parsed, texts=True).where("n_removed > 0").select("id", "sha", "kept")
    copies = rows.where("copy").select("id", "sha", F.lit("").alias("kept"))
    # Written before the documents move again, so that what led to it can go.
    changed = cut(shorter.unionByName(copies).dropDuplicates(["id", "sha"]))
    del rows, parsed, shorter, copies
    let_go(spark)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    hidden, named = set_aside(docs, "doc_id", "text", "n_chars")
    keyed = hidden.withColumns({"id": id_key("doc_id"), "sha": F.unhex(F.sha2(F.concat_ws(" ", words), 256))})
    left = keyed.join(changed, ["id", "sha"], "left").where("kept is null or kept <> ''")
    return named(
        left.withColumns(
            {
                "n_chars": F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length("kept").cast("long")),
                "text": F.coalesce("kept", "text"),
            }
        )
    )

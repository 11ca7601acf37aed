"""Fill-in-middle transformation: texts cut into prefix, middle and suffix, and reordered for training.

A text is a sequence of units, lines by default (a line with its line feed, and what is left after the last
one). Two cut points, and the form, are read off a hash of the document's id and a seed, so every run and
every executor gives the same result.

Finding the cuts. The text's UTF-8 bytes are cut into fixed blocks. A Fenwick tree over the blocks stores two
counts in each node: ends of units, and code points. A binary-lifting descent walks down from the largest power
of two and finds the block that holds the k-th end of a unit, with the code points before that block; the end
itself is located inside its one block. Cutting a text of m blocks twice thus reads two blocks and 2 log m nodes,
after one pass that counts.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle), with
a mark before each piece. A text that contains a mark stays plain, so a mark never stands for itself and
``restored`` rebuilds every text from its output and form alone.

Defined results: NULL texts are empty, empty texts plain with 0 units; a NULL id hashes as an empty one;
repeated rows give repeated results; an empty table gives no rows; other columns are not looked at. One task
holds one Arrow batch (``common.BATCH`` bytes, or one text) and its pieces.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm import words as W
from weekmeter.llm.common import in_arrow, read

BLOCK = 4096
LINE_FEED = 10
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


class BlockCounts:
    """A Fenwick tree over the blocks of a text: ends of units, and code points."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        self.blocks = max(1, -(-len(data) // block))
        begins = np.arange(0, len(data), block)
        ends, points = data == LINE_FEED, (data & 0xC0) != 0x80
        # Sums up to each block; a node holds those of the blocks below it.
        self.ends = self._nodes(np.add.reduceat(ends, begins, dtype=np.int64) if len(data) else np.zeros(1, np.int64))
        self.points = self._nodes(np.add.reduceat(points, begins, dtype=np.int64) if len(data) else np.zeros(1, np.int64))

    @staticmethod
    def _nodes(counts: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(len(sums))
        return sums - sums[at - (at & -at)]

    def total(self) -> tuple[int, int]:
        """Ends of units and code points of the whole text."""
        at, ends, points = self.blocks, 0, 0
        while at:
            ends, points, at = ends + int(self.ends[at]), points + int(self.points[at]), at - (at & -at)
        return ends, points

    def after(self, unit: int) -> tuple[int, int]:
        """Bytes and code points up to and including the end of a unit, counted from 1."""
        if unit == 0:
            return 0, 0
        block, points, step = 0, 0, 1 << (self.blocks.bit_length() - 1)
        while step:
            if block + step <= self.blocks and self.ends[block + step] < unit:
                block += step
                unit -= int(self.ends[block])
                points += int(self.points[block])
            step >>= 1
        begin = block * self.block
        own = self.data[begin : begin + self.block]
        stop = int(np.flatnonzero(own == LINE_FEED)[unit - 1]) + 1
        return begin + stop, points + int(np.count_nonzero((own[:stop] & 0xC0) != 0x80))


@dataclass(frozen=True)
class Rates:
    """The seed of the cuts, and how many texts of a hundred are cut, and of those are put suffix first."""

    seed: int = 7
    cut: int = 100
    suffix_first: int = 50


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32, read off a hash of the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def cut_text(doc_id: int | None, data: np.ndarray, rates: Rates) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (None if plain), and output of one text."""
    text = data.tobytes()
    counts = BlockCounts(data)
    ends, points = counts.total()
    units = ends + (len(text) > 0 and text[-1] != LINE_FEED)
    h1, h2, h3, h4 = draws(doc_id, rates.seed)
    if not text or h3 % 100 >= rates.cut or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return units, "plain", None, None, text
    # The piece after the last end, if there is one, ends with the text.
    (one, one_points), (two, two_points) = (
        counts.after(unit) if unit <= ends else (len(text), points) for unit in sorted((h1 % (units + 1), h2 % (units + 1)))
    )
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    if h4 % 100 < rates.suffix_first:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return units, form, one_points, two_points - one_points, output


CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        out = []
        for part in W.texts(batch.column(1)):
            places = part.offsets.tolist()
            for k, row in enumerate(part.rows):
                out.append(cut_text(ids[row], part.data[places[k] : places[k + 1]], rates))
        columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 5
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array(c, t) for c, t in zip(columns[:4], types, strict=True)],
                pa.array(columns[4], pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return in_arrow(rows, work, T.StructType.fromDDL(CUT))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of. Each mark stands once in an output that is not plain."""
    prefix, suffix, middle = (mark.decode() for mark in (PREFIX, SUFFIX, MIDDLE))
    head = F.substring_index(output, middle, 1)
    first = lambda mark: F.substring_index(head, mark, 1)
    last = lambda mark: F.substring_index(head, mark, -1)
    end = F.substring_index(output, middle, -1)
    psm = F.concat(F.replace(first(suffix), F.lit(prefix), F.lit("")), end, last(suffix))
    spm = F.concat(last(prefix), end, F.replace(first(prefix), F.lit(suffix), F.lit("")))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(read(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = r"""
with drawn as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
         sha256('7:' || doc_id) as h
  from documents),
numbered as (
  select *, len(units) as n,
         [('0x' || h[1 : 8])::bigint, ('0x' || h[9 : 16])::bigint, ('0x' || h[17 : 24])::bigint, ('0x' || h[25 : 32])::bigint] as d
  from drawn),
placed as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
              when d[4] % 100 < 50 then 'spm' else 'psm' end as form
  from numbered),
cut as (
  select *, array_to_string(units[1 : a], '') as prefix, array_to_string(units[a + 1 : b], '') as middle,
         array_to_string(units[b + 1 :], '') as suffix
  from placed)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
       case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""

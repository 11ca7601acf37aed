"""Quality classifier by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are hashed byte n-grams of the text, n-grams of its character classes, and repeated words and
lines; a text is the log-weighted counts of its terms. A singular value decomposition of the sample
gives the latent space. Every whole text is projected, its cosines with all labelled vectors are taken
in blocks (exactly, as one matrix product), and the labels of the nearest vote by similarity.

The sample is bounded: at most ``SAMPLE`` labelled documents of each label, those with the smallest
hash of their id, never held-out ones; one text for each id, and the lower of two labels. What is broadcast is the projection and the sample's vectors:
some 1.5 MB, whatever the input.

Defined results: NULL and empty texts have no terms and get the sample's share of good texts, as does
everything where no labels are given (0.5); a NULL id is not held out; rows with equal ids are scored
each for itself; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm import words as W
from weekmeter.llm.common import in_arrow, labelled_sample, read
from weekmeter.llm.quality_rules import earlier_in_row

SAMPLE = 1200
NEIGHBOURS = 15
SHARPNESS = 6  # votes weigh similarity to this power
LATENT = 64
BITS = 11  # 2048 cells for byte n-grams, as many for class n-grams
CELLS = 1 << BITS
TERMS = 2 * CELLS + 2
REPEATS = 30  # a text of one word over and over counts as so many repeats
EMPHASIS = 8  # of that one term beside some hundred n-grams
BLOCK = 512  # texts whose terms and cosines are held at a time
GOOD = 0.7

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[128:] = 200


def _grams(data: np.ndarray) -> np.ndarray:
    """The cell of the four bytes from each place on."""
    wide = data.astype(np.uint32)
    four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    return ((four * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def term_counts(column: pa.Array):
    """Blocks of rows with the logarithms of their term counts (float32, a row per text)."""
    for part in W.texts(column):
        found = W.words(part)
        hashes = W.word_hashes(part.data, found)
        again = np.concatenate(([False], hashes[1:] == hashes[:-1])) if len(hashes) else np.zeros(0, bool)
        breaks = np.flatnonzero(part.data == 10)
        starts = np.unique(np.concatenate((part.offsets[:-1], breaks + 1)))
        starts = starts[starts < len(part.data)]
        stops = np.concatenate((starts[1:], [len(part.data)])) if len(starts) else starts
        line_rows = np.searchsorted(part.offsets, starts, "right") - 1
        line_again = earlier_in_row(line_rows, W.word_hashes(part.data, W.Words(starts, stops, np.array([0, len(starts)]))))
        lines = np.bincount(line_rows[line_again], minlength=len(part.rows))
        raw, shape = (_grams(x) if len(x) > 3 else np.zeros(0, np.int64) for x in (part.data, _CLASS[part.data]))
        for first in range(0, len(part.rows), BLOCK):
            some = range(first, min(first + BLOCK, len(part.rows)))
            terms = np.zeros((len(some), TERMS), np.float32)
            for k, row in enumerate(some):
                a, b = int(part.offsets[row]), int(part.offsets[row + 1]) - 3
                if b > a:
                    terms[k, :CELLS] = np.bincount(raw[a:b], minlength=CELLS)
                    terms[k, CELLS : 2 * CELLS] = np.bincount(shape[a:b], minlength=CELLS)
                c, d = found.firsts[row], found.firsts[row + 1]
                terms[k, -2] = REPEATS * again[c + 1 : d].sum() / max(d - c, 1)
            terms[:, -1] = lines[some.start : some.stop]
            terms = np.log1p(terms)
            terms[:, -2] *= EMPHASIS
            yield range(part.rows.start + some.start, part.rows.start + some.stop), terms


@dataclass(frozen=True)
class Voters:
    """The latent space, the labelled vectors in it, and their labels."""

    weights: np.ndarray  # of the terms
    axes: np.ndarray  # terms by latent dimensions
    vectors: np.ndarray
    good: np.ndarray

    def latent(self, terms: np.ndarray) -> np.ndarray:
        vectors = (terms * self.weights) @ self.axes
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

    def score(self, terms: np.ndarray) -> np.ndarray:
        prior = float(self.good.mean()) if len(self.good) else 0.5
        scores = np.full(len(terms), prior)
        some = terms.any(axis=1)
        if not len(self.good) or not some.any():
            return scores
        cosines = self.latent(terms[some]) @ self.vectors.T
        near = min(NEIGHBOURS, cosines.shape[1])
        chosen = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
        votes = np.maximum(np.take_along_axis(cosines, chosen, axis=1).astype(float), 0) ** SHARPNESS
        total = votes.sum(axis=1)
        share = (votes * self.good[chosen]).sum(axis=1) / np.maximum(total, 1e-300)
        scores[some] = np.where(total > 0, np.clip(share, 0, 1), prior)
        return scores


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def fit_voters(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Voters:
    """Fit on at most ``sample`` labelled texts of each label that are not held out."""
    picked = labelled_sample(docs, labels.where(~held_out(F.col("doc_id"))), sample)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [x.astype(np.float16).tobytes() for _, terms in term_counts(batch.column(1)) for x in terms]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], ["doc", "quality", "terms"])

    schema = T.StructType.fromDDL("doc long, quality int, terms binary")
    table = in_arrow(picked, work, schema).toArrow().sort_by("doc")
    empty = np.zeros(0, np.float32)
    if not table.num_rows:
        return Voters(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), empty.reshape(0, 1), empty)
    terms = np.frombuffer(b"".join(table.column("terms").to_pylist()), np.float16).reshape(-1, TERMS).astype(np.float32)
    good = table.column("quality").to_numpy().astype(np.float32)
    weights = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))).astype(np.float32) + 0.1
    weighted = terms * weights
    lengths = np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    weighted /= lengths
    values, vectors = np.linalg.eigh((weighted @ weighted.T).astype(np.float64))
    top = np.argsort(-values)[: min(LATENT, len(values))]
    top = top[values[top] > 1e-9 * max(values.max(), 1e-300)]
    axes = (weighted.T @ vectors[:, top].astype(np.float32)) / np.sqrt(values[top]).astype(np.float32)
    voters = Voters(weights, axes, empty, good)
    return Voters(weights, axes, voters.latent(terms).astype(np.float32), good)


def quality_scores(docs: DataFrame, voters: Voters) -> DataFrame:
    """All columns of ``docs`` but the text, with ``score``: how likely the label is 1."""
    kept = [c for c in docs.columns if c not in ("text", "score")]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(voters)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = np.zeros(batch.num_rows)
        for rows, terms in term_counts(batch.column(len(kept))):
            scores[rows.start : rows.stop] = sent.value.score(terms)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], [*kept, "score"])

    return in_arrow(docs.select(*kept, "text"), work, schema)


def op2_quality_knn(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    scored = quality_scores(docs, fit_voters(docs, read(spark, folder, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"),
    )

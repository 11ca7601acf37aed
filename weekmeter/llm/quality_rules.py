"""Quality rules: a linear-chain conditional random field marks each line content or boilerplate.

Every line that holds a word is described by shares of symbols, capitals, bars and the like. Viterbi
decoding finds the likeliest sequence of marks of a text's lines, and the share of words in content
lines decides whether the text stays. Base rules (too short, too repetitive) come first.

The field is trained here, on a bounded sample of labelled documents (``SAMPLE`` of each label, those
with the smallest hash of their id; one text for each id, and the lower of two labels) and of their lines
(``CHAINS`` chains of up to ``LONGEST_CHAIN`` lines, those with the smallest hash). A line of the sample
counts as boilerplate if it occurs in no good document of the sample. Without labelled rows of both kinds every line is content.

Defined results: NULL and empty texts have no words and fail the base rules; NULL ids, repeated rows
and extra columns are kept as they come; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm import words as W
from weekmeter.llm.common import in_arrow, labelled_sample, read, set_aside

SAMPLE = 1000
CHAINS = 1 << 14  # chains of lines to train on
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words
LEAST_CONTENT = 0.5
LONGEST_CHAIN = 32  # lines of one training sequence; longer texts give several

# The byte classes that line shares are taken of.
CLASSES = {
    "symbol": b"#*$%&|<>",
    "bar": b"|",
    "mark": b"!?",
    "capital": bytes(range(65, 91)),
    "digit": b"0123456789",
    "stop": b".,;:",
    "other": b"{}[]()=_/\\@~^+\"'`-",
}
FEATURES = [*CLASSES, "repeated_words", "earlier_line", "few_words", "long_words", "bias"]


@dataclass(frozen=True)
class LineField:
    """Weights of the field: one per feature for content over boilerplate, and the four transitions."""

    weights: np.ndarray
    steps: np.ndarray  # [from, to], 0 boilerplate, 1 content


def _counts(marks: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """How many bytes are marked in each of several ranges, none of them empty, in order."""
    if not len(starts):
        return np.zeros(0, np.int64)
    bounds = np.column_stack((starts, stops)).ravel()
    return np.add.reduceat(np.append(marks, np.uint8(0)), bounds, dtype=np.int64)[::2]


def _marked(part: W.Texts, members: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(members)] = 1
    return table[part.data]


@dataclass
class Lines:
    """Lines that hold a word, of all rows of a part, with their features."""

    rows: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    repeats: np.ndarray
    features: np.ndarray


def earlier_in_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one of the same row."""
    order = np.lexsort((np.arange(len(rows)), hashes, rows))
    same = np.zeros(len(rows), bool)
    if len(rows):
        r, h = rows[order], hashes[order]
        same[order[1:]] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    return same


def lines_of(part: W.Texts, found: W.Words, hashes: np.ndarray) -> Lines:
    breaks = np.flatnonzero(part.data == 10)
    starts = np.unique(np.concatenate((part.offsets[:-1], breaks + 1)))
    starts = starts[starts < len(part.data)]
    rows = np.searchsorted(part.offsets, starts, "right") - 1
    stops = np.concatenate((starts[1:], [len(part.data)])) if len(starts) else starts
    # A break belongs to no line; a row that ends without one ends where the next row starts.
    stops = stops - (part.data[np.maximum(stops - 1, 0)] == 10) * (stops > starts)
    first = np.searchsorted(found.starts, starts)
    last = np.searchsorted(found.starts, stops)
    full = last > first
    starts, stops, rows, first, last = (x[full] for x in (starts, stops, rows, first, last))
    count = last - first
    ranges = W.Words(starts, stops, np.array([0, len(starts)]))
    line_hashes = W.word_hashes(part.data, ranges)
    repeats = earlier_in_row(rows, line_hashes)
    of_line = np.repeat(np.arange(len(starts)), count)
    again = earlier_in_row(of_line, hashes[W.segments(count, first)])
    size = np.maximum(stops - starts, 1)
    features = np.empty((len(starts), len(FEATURES)), np.float32)
    for k, members in enumerate(CLASSES.values()):
        features[:, k] = np.minimum(_counts(_marked(part, members), starts, stops) / size * 10, 5)
    k = len(CLASSES)
    features[:, k] = np.bincount(of_line[again], minlength=len(starts)) / np.maximum(count, 1) * 5
    features[:, k + 1] = repeats
    features[:, k + 2] = count < 4
    features[:, k + 3] = size / np.maximum(count, 1) > 15
    features[:, k + 4] = 1
    return Lines(rows, count, line_hashes, repeats, features)


def _viterbi(scores: np.ndarray, steps: np.ndarray) -> list[bool]:
    """The likeliest marks of one sequence; ties go to content."""
    back: list[tuple[int, int]] = []
    off, on = 0.0, float(scores[0])
    for score in scores[1:].tolist():
        to_off = 0 if off + steps[0][0] > on + steps[1][0] else 1
        to_on = 0 if off + steps[0][1] > on + steps[1][1] else 1
        off, on = (
            (on, off)[to_off == 0] + steps[to_off][0],
            (on, off)[to_on == 0] + steps[to_on][1] + score,
        )
        back.append((to_off, to_on))
    mark = 0 if off > on else 1
    marks = [mark]
    for pair in reversed(back):
        mark = pair[mark]
        marks.append(mark)
    return [m == 1 for m in reversed(marks)]


def train(chains: DataFrame) -> LineField:
    """Fit the field to sampled chains of lines (bounded): columns doc, chain, quality, hashes, features.

    All chains of a text but its last are full, so those that were not sampled leave the others' places as they are.
    """
    table = chains.toArrow().sort_by([("doc", "ascending"), ("chain", "ascending")])
    size = len(FEATURES)
    nothing = LineField(np.zeros(size), np.zeros((2, 2)))
    quality = table.column("quality").to_numpy()
    if not (quality == 0).any() or not (quality == 1).any():
        return nothing
    hashes = table.column("hashes").combine_chunks()
    count = np.diff(hashes.offsets.to_numpy())
    hashes = hashes.flatten().to_numpy()
    doc, quality = np.repeat(table.column("doc").to_numpy(), count), np.repeat(quality, count)
    flat = table.column("features").combine_chunks().flatten().to_numpy().reshape(-1, size)
    good = np.isin(hashes, np.unique(hashes[quality == 1]))
    begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    place = np.arange(len(doc)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(doc)]))))
    chain = np.cumsum((place % LONGEST_CHAIN) == 0) - 1
    at = place % LONGEST_CHAIN
    n, width = int(chain[-1]) + 1, int(at.max()) + 1
    x = np.zeros((n, width, size))
    y = np.zeros((n, width), int)
    there = np.zeros((n, width), bool)
    x[chain, at], y[chain, at], there[chain, at] = flat, good, True

    weights, steps = np.zeros(size), np.zeros((2, 2))
    moment = [np.zeros(size + 4), np.zeros(size + 4)]
    total = there.sum()
    pairs = there[:, 1:] & there[:, :-1]
    seen_steps = np.array([[(pairs & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    seen = np.einsum("ntk,nt->k", x, (y * there).astype(float))
    for round_ in range(1, 121):
        emit = np.stack((np.zeros((n, width)), x @ weights), axis=2) * there[:, :, None]
        forward = np.zeros((n, width, 2))
        backward = np.zeros((n, width, 2))
        forward[:, 0] = emit[:, 0]
        for t in range(1, width):
            last = forward[:, t - 1]
            moved = np.logaddexp(last[:, :1] + steps[0], last[:, 1:] + steps[1]) + emit[:, t]
            forward[:, t] = np.where(there[:, t, None], moved, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            later = emit[:, t + 1] + backward[:, t + 1]
            moved = np.logaddexp(later[:, :1] + steps[:, 0], later[:, 1:] + steps[:, 1])
            backward[:, t] = np.where(there[:, t + 1, None], moved, 0)
        whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        on = np.exp(forward[:, :, 1] + backward[:, :, 1] - whole[:, None]) * there
        joint = forward[:, :-1, :, None] + steps[None, None] + (emit[:, 1:] + backward[:, 1:])[:, :, None, :]
        joint = np.exp(joint - whole[:, None, None, None]) * pairs[:, :, None, None]
        slope = np.concatenate(
            (seen - np.einsum("ntk,nt->k", x, on), (seen_steps - joint.sum(axis=(0, 1))).ravel())
        ) / total - 0.0005 * np.concatenate((weights, steps.ravel()))
        moment[0] = 0.9 * moment[0] + 0.1 * slope
        moment[1] = 0.99 * moment[1] + 0.01 * slope**2
        move = 0.1 * (moment[0] / (1 - 0.9**round_)) / (np.sqrt(moment[1] / (1 - 0.99**round_)) + 1e-8)
        weights += move[:size]
        steps += move[size:].reshape(2, 2)
    return LineField(weights, steps)


def fit_field(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = CHAINS) -> LineField:
    """Train on at most ``sample`` labelled texts of each quality, and at most ``most`` chains of their lines."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        doc = batch.column(0).to_numpy()
        quality = batch.column(2).to_numpy()
        out = []
        for part in W.texts(batch.column(1)):
            found = W.words(part)
            lines = lines_of(part, found, W.word_hashes(part.data, found))
            if not len(lines.rows):
                continue
            first = np.searchsorted(lines.rows, lines.rows)
            place = np.arange(len(lines.rows)) - first
            begin = np.flatnonzero(place % LONGEST_CHAIN == 0)
            rows = lines.rows[begin] + part.rows.start
            count = np.diff(np.concatenate((begin, [len(place)])))
            out.append((doc[rows], place[begin] // LONGEST_CHAIN, quality[rows], count, lines.hashes.view(np.int64), lines.features))
        if not out:
            return None
        doc, chain, quality, count, hashes, features = (np.concatenate(x) for x in zip(*out, strict=True))
        offsets = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc), pa.array(chain, pa.int64()), pa.array(quality, pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes)),
                pa.ListArray.from_arrays(pa.array(offsets * len(FEATURES)), pa.array(features.ravel())),
            ],
            ["doc", "chain", "quality", "hashes", "features"],
        )

    schema = "doc long, chain long, quality int, hashes array<long>, features array<float>"
    chains = in_arrow(labelled_sample(docs, labels, sample), work, T.StructType.fromDDL(schema))
    return train(chains.orderBy(F.xxhash64("doc", "chain"), "doc", "chain").limit(most))


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long"


def measure(column: pa.Array, field: LineField) -> list[np.ndarray]:
    """The base measures of each text, and its words in content lines."""
    out = []
    for part in W.texts(column):
        found = W.words(part)
        hashes = W.word_hashes(part.data, found)
        rows = len(part.rows)
        full = np.flatnonzero(np.diff(part.offsets))
        ranges = part.offsets[full], part.offsets[full + 1]
        chars, symbols = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        # Code points by their first bytes.
        chars[full] = _counts((((part.data & 0xC0) != 0x80) & ~W.SPACE[part.data]).view(np.uint8), *ranges)
        symbols[full] = _counts(_marked(part, CLASSES["symbol"]), *ranges)

        row_of = found.rows()
        grams = W.ngram_hashes(hashes, 3)
        inside = row_of[: len(grams)] == row_of[2:] if len(grams) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        keys = W.mixed(grams[at] ^ W.mixed(row_of[at].astype(np.uint64)))
        order = np.argsort(keys)
        equal = np.zeros(len(keys) + 1, bool)
        equal[1:-1] = keys[order[1:]] == keys[order[:-1]]
        twice = at[order[equal[1:] | equal[:-1]]]
        covered = np.zeros(len(hashes), bool)
        for k in range(3):
            covered[twice + k] = True
        repeated = np.bincount(row_of[covered], minlength=rows)

        lines = lines_of(part, found, hashes)
        duplicates = np.bincount(lines.rows[lines.repeats], minlength=rows)
        scores = lines.features @ field.weights
        content = np.zeros(rows, np.int64)
        bounds = np.searchsorted(lines.rows, np.arange(rows + 1))
        steps = field.steps.tolist()
        for row in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = bounds[row], bounds[row + 1]
            content[row] = lines.words[a:b][_viterbi(scores[a:b], steps)].sum()
        out.append((found.counts, chars, symbols, duplicates, repeated, content))
    return [np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)]


def quality_rules(docs: DataFrame, field: LineField) -> DataFrame:
    """All columns of ``docs`` with ``quality``, a struct of the measures, base_failed and kept."""
    kept = [c for c in docs.columns if c != "quality"]
    made = "measures"
    while made in kept:
        made += "_"
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(made, T.StructType.fromDDL(MEASURES))])
    names = T.StructType.fromDDL(MEASURES).names
    place = kept.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not batch.num_rows:
            return None
        found = measure(batch.column(place), field)
        struct = pa.StructArray.from_arrays([pa.array(x) for x in found], names)
        return pa.RecordBatch.from_arrays([*batch.columns, struct], [*kept, made])

    m = F.col(made)
    failed = (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > MOST_REPEATED * m.n_words)
    return in_arrow(docs.select(*kept), work, schema).select(
        *kept,
        F.struct(
            *[m[n].alias(n) for n in names],
            failed.alias("base_failed"),
            (~failed & (m.content_words >= LEAST_CONTENT * m.n_words)).alias("kept"),
        ).alias("quality"),
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    field = fit_field(docs, read(spark, folder, "labels"))
    return quality_rules(docs.select("doc_id", "text"), field).select("doc_id", "quality.*")


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    field = fit_field(docs, read(spark, folder, "labels"))
    hidden, named = set_aside(docs, "text")
    return named(quality_rules(hidden, field).where("quality.kept"))

"""Chat formatting at token level: segments are encoded apart, and reserved ids are put between them.

A turn is written as::

    ### {role}: {text}</turn>

followed by a line break. In tokens, ``### ``, ``: `` and the end of the turn are one reserved id each,
above the vocabulary, so no text can forge them. They could still be forged in the written form, so
runs of three or more ``#``, ``</turn>`` and backslashes inside a text (and ``:`` inside a role) are
escaped with backslashes before encoding; taking the backslashes away gives the text back.

Role and text of every row are encoded where the row lies, before anything moves. Then the rows of a
conversation are brought together in order and streamed: places of tokens and the loss mask come from
prefix sums of segment lengths. A conversation of any length needs the memory of one batch of turns.
(Its digest runs over all turns in order, so one task reads them; the costly part is done before.)

Defined results: NULL text and role are empty; a NULL conversation id is a conversation, a NULL turn
comes first; turns with equal numbers go by role, then by a hash of the text; repeated rows are turns
of their own; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm.bpe import byte_of_character
from weekmeter.llm.common import from_key, id_key, in_arrow, read

TURN, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"

_IN_TEXT = re.compile(r"\\|#{3,}|</turn>")
_IN_ROLE = re.compile(r"\\|#{3,}|</turn>|:")


def _with_backslashes(found: re.Match) -> str:
    string = found.group()
    return "".join("\\" + c for c in string) if string[0] == "#" else "\\" + string


def escape(text: str) -> str:
    return _IN_TEXT.sub(_with_backslashes, text)


def escape_role(role: str) -> str:
    return _IN_ROLE.sub(_with_backslashes, role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class Coder:
    """A byte-level tokenizer file with three reserved ids above its vocabulary."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text here
        byte_of = byte_of_character()
        file = json.loads(text)
        special = {x["id"] for x in file["added_tokens"]}
        size = max([*file["model"]["vocab"].values(), *special]) + 1
        self.bytes = [b""] * size
        for token, number in file["model"]["vocab"].items():
            if number not in special:
                self.bytes[number] = bytes(byte_of[c] for c in token)
        self.turn, self.role_end, self.turn_end = size, size + 1, size + 2

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()


@functools.lru_cache(maxsize=2)
def _built(text: str) -> Coder:
    return Coder(text)


class Template:
    """A tokenizer file sent to the executors once; built there on first use."""

    def __init__(self, spark: SparkSession, path: str):
        self._text = spark.sparkContext.broadcast(Path(path).read_text())

    def __call__(self) -> Coder:
        return _built(self._text.value)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _list_column(parts: list[np.ndarray], kind) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), kind))


def encoded_segments(rows: DataFrame, template: Template) -> DataFrame:
    """conv, turn, role, tie, and the ids of the escaped role and text of every row."""
    schema = "conv long, turn long, role string, tie long, role_ids array<int>, text_ids array<int>"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not batch.num_rows:
            return None
        coder = template()
        once = functools.lru_cache(maxsize=1000)(lambda role: coder.encode(escape_role(role)))
        roles = [once(x or "") for x in batch.column(2).to_pylist()]
        texts = [coder.encode(escape(x.as_py() or "")) for x in batch.column(4)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:4], _list_column(roles, pa.int32()), _list_column(texts, pa.int32())],
            ["conv", "turn", "role", "tie", "role_ids", "text_ids"],
        )

    keyed = rows.select(
        id_key(F.col("conv_id").cast("long")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.xxhash64("text").alias("tie"), "text",
    )
    return in_arrow(keyed, work, T.StructType.fromDDL(schema))


def format_conversations(rows: DataFrame, template: Template) -> DataFrame:
    """One row per turn, in order within each partition: conv, place, token_start, ids, loss_mask.

    ``loss_mask`` is 1 on the text of assistant turns. Turns of a conversation are adjacent.
    """
    schema = "conv long, place long, token_start long, ids array<int>, loss_mask array<tinyint>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, start = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            coder = template()
            reserved = [np.array([x], np.int32) for x in (coder.turn, coder.role_end, coder.turn_end)]
            roles, texts = batch.column("role_ids"), batch.column("text_ids")
            trained = np.array([x == TRAINED_ROLE for x in batch.column("role").to_pylist()])
            parts, lengths = [], np.empty((batch.num_rows, 5), np.int64)
            for k in range(batch.num_rows):
                own = (reserved[0], roles[k].values.to_numpy(), reserved[1], texts[k].values.to_numpy(), reserved[2])
                parts += own
                lengths[k] = [len(x) for x in own]
            # Segment ends are prefix sums; so is the mask, of steps up and down where trained texts begin and end.
            ends = np.cumsum(lengths.ravel()).reshape(-1, 5)
            steps = np.zeros(int(ends[-1, -1]) + 1, np.int8)
            np.add.at(steps, ends[trained, 2], 1)
            np.add.at(steps, ends[trained, 3], -1)
            mask = np.cumsum(steps[:-1], dtype=np.int8)
            offsets = np.concatenate(([0], ends[:, -1])).astype(np.int32)
            convs = batch.column("conv").to_pylist()
            places, starts = [], []
            for k, now in enumerate(convs):
                if now != conv:
                    conv, place, start = now, 0, 0
                places.append(place)
                starts.append(start)
                place += 1
                start += int(offsets[k + 1] - offsets[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(places, pa.int64()), pa.array(starts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), pa.int32())),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(mask, pa.int8()))],
                ["conv", "place", "token_start", "ids", "loss_mask"],
            )

    segments = encoded_segments(rows, template)
    together = segments.repartition("conv").sortWithinPartitions("conv", "turn", "role", "tie")
    return together.mapInArrow(run, schema)


def read_back(formatted: DataFrame, template: Template) -> DataFrame:
    """Digests of each conversation, decoded from the formatted rows alone (in their order)."""
    schema = (
        "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []

        def done():
            turns, loss = state["turns"].hexdigest(), state["loss"].hexdigest()
            out.append((conv, state["n"], turns, state["loss_chars"], loss, state["chars"], state["tokens"]))

        for batch in batches:
            coder = template()
            for now, ids, mask in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4), strict=True):
                if state is None or now != conv:
                    if state is not None:
                        done()
                    conv = now
                    state = {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "loss_chars": 0, "chars": 0, "tokens": 0}
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                middle = int(np.flatnonzero(ids == coder.role_end)[0])
                if ids[0] != coder.turn or ids[-1] != coder.turn_end:
                    raise ValueError("a turn lacks its reserved ids")
                role, text = coder.decode(ids[1:middle]), coder.decode(ids[middle + 1 : -1])
                state["chars"] += len(TURN) + len(role) + len(ROLE_END) + len(text) + len(TURN_END)
                state["turns"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                trained = unescape(coder.decode(ids[mask == 1]))
                state["loss"].update(trained.encode())
                state["loss_chars"] += len(trained)
                state["n"] += 1
                state["tokens"] += len(ids)
            if out:
                yield _rows(out, schema)
                out = []
        if state is not None:
            done()
            yield _rows(out, schema)

    return formatted.mapInArrow(run, schema)


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names
    )


def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    both = "\\### Assistant: </turn> ok"
    given = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(both).alias("text"),
    )
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(given)
    template = Template(spark, default_path())
    found = read_back(format_conversations(rows, template), template)
    return found.select(
        from_key("conv").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )

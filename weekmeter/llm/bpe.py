"""Byte-pair encoding by backtracking over Aho-Corasick matches, and decoding by an offset table.

The vocabulary is a tokenizers file of the kind "BPE with word ends": NFC, white space dropped, lower
case, words split by pattern, bytes as symbols, the last symbol of a word marked. The encoder takes
the longest token that starts at a position; two neighbours may stand side by side only if merging in
rank order would never have joined across them (the pair table, filled on demand). Where a pair may
not, it tries the next shorter token, or steps back. This gives exactly the merges, in linear time.

Texts are split at ASCII white space first; a bounded store remembers the ids of a chunk, so that a
frequent word costs one look-up. Tokens are never trained here; the file's path is a parameter.

Defined results: NULL and empty texts give no ids and an empty decoded text; special tokens written
out in a text are encoded as such, as the library does; ids and other columns are kept as they come.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmeter.llm.common import in_arrow, read, set_aside

CHUNKS = 60_000  # chunks of text that a Python worker remembers, twice at most, while a task runs
WORDS = 200_000  # words, and pairs of tokens, likewise
DECODE_PIECE = 1 << 16  # ids decoded at a time

# Fixed values of the file format: how bytes are written as printable characters, and the word pattern.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
PLAIN = re.compile(r"[\x00-ɏ]*\Z")  # no combining marks: NFC leaves such text alone


def byte_of_character() -> dict[str, int]:
    others = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}


class _Store(dict):
    """Remembers results of ``make`` for a bounded number of keys.

    When full, all are put aside, and what is asked for again comes back: frequent keys stay.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make = make
        self.most = most
        self.aside: dict = {}

    def forget(self) -> None:
        self.clear()
        self.aside = {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.aside = dict(self)
            self.clear()
        value = self.aside.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class WordBpe:
    """Encoder and decoder of one tokenizer file.

    A symbol is one character: the byte itself, plus 256 if it ends the word. A token is a string of
    symbols, so that every position of a word is a place where a token may start.
    """

    def __init__(self, text: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        file = json.loads(text)
        model = file["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("not a BPE file with word ends")
        vocabulary = model["vocab"]
        byte_of = byte_of_character()
        self.symbols: dict[int, str] = {}
        for token, number in vocabulary.items():
            if len(token) == 1:
                self.symbols[number] = chr(byte_of[token])
            elif token.endswith(WORD_END) and len(token) == 1 + len(WORD_END):
                self.symbols[number] = chr(256 + byte_of[token[0]])
        self.parts = {number: (number, number) for number in self.symbols}
        self.pairs: dict[tuple[int, int], int] = {}
        self.order: dict[int, int] = dict.fromkeys(self.symbols, -1)  # rank of the merge that makes a token
        for rank, merge in enumerate(model["merges"]):
            left, right = (vocabulary[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            joined = vocabulary[model_token(model, merge)]
            self.pairs.setdefault((left, right), joined)
            if joined not in self.symbols:
                self.symbols[joined] = self.symbols[left] + self.symbols[right]
                self.parts[joined] = (left, right)
                self.order[joined] = rank
        self.ids = {symbols: number for number, symbols in self.symbols.items()}
        self.lengths = {number: len(symbols) for number, symbols in self.symbols.items()}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        for symbols, number in self.ids.items():
            self.automaton.add_word(symbols, (number, len(symbols)))
            for k in range(len(symbols) - 1, 0, -1):
                if symbols[:k] in self.ids:
                    self.shorter[number] = self.ids[symbols[:k]]
                    break
        self.automaton.make_automaton()
        self.allowed = _Store(self._may_touch, WORDS)

        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words_in = regex.compile(WORD_PATTERN).findall
        self.library = Tokenizer.from_str(text)
        self.words = _Store(self._word, WORDS)
        self.chunks = _Store(self._chunk, CHUNKS)

        names = {number: token for token, number in vocabulary.items()} | {n: t for t, n in self.special.items()}
        table = [(names.get(n, "") + " ").encode() for n in range(max(names) + 1)]
        self.table = np.frombuffer(b"".join(table), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(x) for x in table])))

    def _may_touch(self, pair: tuple[int, int]) -> bool:
        """Whether merging in rank order leaves these two tokens side by side.

        Undo the later of the two last merges again and again, looking at the symbols that meet at the
        seam: had they a merge of their own, earlier than both their own later merges, it would have come first.
        """
        left, right = pair
        ceiling = 1 << 60  # rank of the merge that was undone last
        while True:
            joined = self.pairs.get((left, right))
            if joined is not None and self.order[joined] < ceiling:
                return False
            # On the left, equal ranks merge first.
            if self.order[left] > self.order[right]:
                ceiling = self.order[left]
                left = self.parts[left][1]
            elif self.order[right] >= 0:
                ceiling = self.order[right] + 1
                right = self.parts[right][0]
            elif self.order[left] >= 0:
                ceiling = self.order[left]
                left = self.parts[left][1]
            else:
                return True

    def merge(self, symbols: str) -> list[int]:
        """The tokens of one word, given as symbols."""
        size = len(symbols)
        if symbols in self.ids:  # the longest match from the start, and there is no neighbour
            return [self.ids[symbols]]
        longest = [0] * size
        reach = [0] * size
        for end, (number, length) in self.automaton.iter(symbols):
            start = end - length + 1
            if length > reach[start]:
                reach[start], longest[start] = length, number
        lengths, shorter, allowed = self.lengths, self.shorter, self.allowed
        taken: list[int] = []
        dead = bytearray(size + 1)  # places from which no way on was found
        at, token = 0, longest[0]
        while at < size:
            end = at + lengths[token]
            if not dead[end] and (not taken or allowed[taken[-1], token]):
                taken.append(token)
                at = end
                if at < size:
                    token = longest[at]
                continue
            while True:
                if token in shorter:
                    token = shorter[token]
                    break
                dead[at] = 1
                token = taken.pop()
                at -= lengths[token]
        return taken

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        symbols = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        return np.array(self.merge(symbols), "<u4").tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        out = []
        for piece in self.split_special.split(text) if self.split_special else [text]:
            if piece in self.special:
                out.append(self.special[piece].to_bytes(4, "little"))
            elif PLAIN.match(piece):
                out += map(self.words.__getitem__, self.words_in(piece.lower()))
            else:
                normal = self.library.normalizer.normalize_str(piece)
                for printed, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    out.append(self.words[bytes(map(_PRINTED.__getitem__, printed)).decode()])
        return b"".join(out)

    def encode(self, text: bytes) -> bytes:
        """The ids of a text in UTF-8, as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def forget(self) -> None:
        """Give back the memory of remembered words; the worker may go on with other work."""
        for store in (self.chunks, self.words, self.allowed):
            store.forget()

    def decode(self, ids: bytes):
        """Pieces of the decoded text: the tokens as written in the file, one space between them."""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        for k in range(0, len(numbers), DECODE_PIECE):
            some = numbers[k : k + DECODE_PIECE]
            begin = self.offsets[some]
            lengths = self.offsets[some + 1] - begin
            if k + DECODE_PIECE >= len(numbers):
                lengths[-1] -= 1  # no space after the last token
            ends = np.cumsum(lengths)
            yield self.table[np.arange(ends[-1]) + np.repeat(begin - (ends - lengths), lengths)].tobytes()


_PRINTED = byte_of_character()


def model_token(model: dict, merge) -> str:
    left, right = merge.split(" ") if isinstance(merge, str) else merge
    return left + right


@functools.lru_cache(maxsize=2)
def _built(text: str) -> WordBpe:
    return WordBpe(text)


class Vocabulary:
    """A tokenizer file sent to the executors once (its size is that of the file); built there on first use."""

    def __init__(self, spark: SparkSession, path: str):
        self._text = spark.sparkContext.broadcast(Path(path).read_text())

    def __call__(self) -> WordBpe:
        return _built(self._text.value)

    def forget(self) -> None:
        self().forget()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _text_bytes(column: pa.Array):
    """Each text as bytes; NULL is empty."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns of ``docs`` with ``ids`` (array of int) of the column ``text``."""
    kept = [c for c in docs.columns if c != "ids"]
    place = kept.index("text")
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = vocabulary()
        encoded = [coder.encode(x) for x in _text_bytes(batch.column(place))]
        return pa.RecordBatch.from_arrays([*batch.columns, _id_lists(encoded)], [*kept, "ids"])

    return in_arrow(docs.select(*kept), work, schema, vocabulary.forget)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns with ``decoded``, the text of the column ``ids``."""
    kept = [c for c in encoded.columns if c != "decoded"]
    place = kept.index("ids")
    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField("decoded", T.StringType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = vocabulary()
        texts = [b"".join(coder.decode(x)).decode() for x in _id_bytes(batch.column(place))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, "decoded"])

    return in_arrow(encoded.select(*kept), work, schema)


def _id_bytes(column: pa.Array):
    if column.null_count:
        column = column.fill_null(pa.scalar([], column.type))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy().astype("<u4")
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield values[a:b].tobytes()


def token_digests(docs: DataFrame, vocabulary: Vocabulary, with_ids: bool = False) -> DataFrame:
    """All columns but the text, with the number of ids and digests of the ids and of the decoded text.

    The same encoder and decoder in one pass; the decoded text is digested piece by piece and not kept.
    ``with_ids`` adds the ids themselves. Own columns named like a new one keep their name, and the new one gets
    underscores behind its own.
    """
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    made = T.StructType.fromDDL(made)
    names = [c for c in docs.columns if c != "text"]
    new = []
    for name in made.names:
        while name in names:
            name += "_"
        new.append(name)
    hidden, _ = set_aside(docs, "text")
    kept = [c for c in hidden.columns if c != "text"]
    schema = T.StructType([*[hidden.schema[c] for c in kept], *made])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = vocabulary()
        counts, ids_digests, text_digests, every = [], [], [], []
        for text in _text_bytes(batch.column(len(kept))):
            ids = coder.encode(text)
            counts.append(len(ids) // 4)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            decoded = hashlib.sha256()
            for piece in coder.decode(ids):
                decoded.update(piece)
            text_digests.append(decoded.hexdigest())
            if with_ids:
                every.append(ids)
        columns = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
        if with_ids:
            columns.append(_id_lists(every))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], schema.names)

    coded = in_arrow(hidden.select(*kept, "text"), work, schema, vocabulary.forget)
    return coded.toDF(*names, *new)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in encoded]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(read(spark, folder, "documents").select("doc_id", "text"), Vocabulary(spark, default_path()))


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage, the last: the ids of every text, and digests of both directions."""
    return token_digests(docs, Vocabulary(spark, default_path()), with_ids=True)

"""Chat formatting by token-level assembly.

A conversation becomes one sequence of token ids. Each role and each text is
encoded on its own, with special tokens switched off, and the marks between
them are spliced in as reserved ids above the tokenizer's vocabulary, so no
text can produce one::

    BEGIN role-ids HEAD text-ids END   for every turn

Texts are escaped first: a backslash is doubled, and one is put after the first
character of every control string, the template's own and those of common
templates. The rendered text thus holds control strings only where the template
put them, and the escape is undone by dropping the backslash from each pair.

The loss mask follows from the segments' lengths: +1 where a text under loss
begins, -1 where it ends, and the prefix sum of those. A sequence longer than
``PIECE_TOKENS`` goes on in further rows of the same conversation, so a
conversation with a third of all turns is many bounded rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framelake.llm.common import python_ready, written

BEGIN, HEAD, END = "<|turn|>", "<|says|>", "<|done|>"
MARKS = (BEGIN, HEAD, END)  # as reserved ids: vocabulary size + position
CONTROL = (*MARKS, "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
LOSS_ROLES = ("assistant",)
PIECE_TOKENS = 1 << 16

_CONTROL_START = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL_START.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """A doubled backslash becomes one, a single one goes."""
    return re.sub(r"\\(\\?)", r"\1", text)


class Codec:
    """Ids of segments, and texts of ids, by a byte-level tokenizer that keeps every byte."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.reserved = self.tokenizer.get_vocab_size()
        self.begin, self.head, self.end = range(self.reserved, self.reserved + len(MARKS))

    def encode(self, segments: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(segments, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False) if ids else ""


_codecs: dict[str, Codec] = {}  # of a Python worker


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_turns(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """``conv_id, turn, role, text, role_ids, text_ids``, row by row: the costly
    part, before any shuffle. A null role or text counts as empty."""
    ids = T.ArrayType(T.IntegerType())
    source = conversations.schema
    schema = T.StructType([source["conv_id"], source["turn"], T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("role_ids", ids), T.StructField("text_ids", ids)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path)
        for batch in batches:
            segments = [c.encode([escape(s) for s in batch.column(i).to_pylist()]) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(s, arrow.field(4).type) for s in segments]], schema=arrow)

    rows = conversations.select("conv_id", "turn", *[F.coalesce(n, F.lit("")).alias(n) for n in ("role", "text")])
    return python_ready(rows).mapInArrow(run, schema)


def loss_mask(lengths: np.ndarray, under_loss: np.ndarray) -> np.ndarray:
    """One bit per token of consecutive segments: whether its segment is under
    loss, by prefix sums of where such segments begin and end."""
    ends = np.cumsum(lengths)
    steps = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, dtype=np.int32)
    np.add.at(steps, (ends - lengths)[under_loss], 1)
    np.add.at(steps, ends[under_loss], -1)
    return np.cumsum(steps[:-1]).astype(np.int8)


def _pieces(turns: Iterable[tuple], c: Codec, loss_roles: tuple[str, ...], piece_tokens: int) -> Iterator[tuple]:
    """``conv_id, piece, turns, ids, mask`` from sorted ``(conv_id, role, role_ids, text_ids)``.
    Turns are whole until one alone exceeds the piece, which is then cut."""
    conv, piece, count = None, 0, 0
    parts: list[np.ndarray] = []
    flags: list[bool] = []

    def cut() -> Iterator[tuple]:
        nonlocal piece, count, parts, flags
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        ids, mask = np.concatenate(parts), loss_mask(lengths, np.array(flags))
        for at in range(0, len(ids), piece_tokens):
            yield conv[0], piece, count if at == 0 else 0, ids[at : at + piece_tokens], mask[at : at + piece_tokens]
            piece += 1
        count, parts, flags = 0, [], []

    size = 0
    for conv_id, role, role_ids, text_ids in turns:
        if parts and (conv[0] != conv_id or size + len(text_ids) > piece_tokens):
            yield from cut()
            size = 0
        if conv is None or conv[0] != conv_id:
            conv, piece = (conv_id,), 0
        segments = [[c.begin], role_ids, [c.head], text_ids, [c.end]]
        parts += [np.asarray(s, dtype=np.int32) for s in segments]
        flags += [False, False, False, role in loss_roles, False]
        count += 1
        size += sum(map(len, segments))
    if parts:
        yield from cut()


def format_conversations(conversations: DataFrame, tokenizer_path: str, loss_roles: tuple[str, ...] = LOSS_ROLES, piece_tokens: int = PIECE_TOKENS) -> DataFrame:
    """Token sequences ``conv_id, piece, n_turns, ids, loss`` of the
    conversations (columns ``conv_id, turn, role, text``; others are not read).

    Turns go by ``turn`` (nulls first), repeated turn numbers by role, then
    text; a null text or role is empty; a null ``conv_id`` is a conversation of
    its own; an empty table gives an empty result. Texts are encoded before the
    shuffle; after it a task streams through its sorted rows and holds one
    piece at a time, never a conversation.
    """
    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([conversations.schema["conv_id"], T.StructField("piece", T.IntegerType()), T.StructField("n_turns", T.LongType()), T.StructField("ids", ids), T.StructField("loss", T.ArrayType(T.ByteType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path)
        turns = (turn for batch in batches for turn in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        yield from _batched(_pieces(turns, c, loss_roles, piece_tokens), arrow)

    encoded = encode_turns(conversations, tokenizer_path)
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "role_ids", "text_ids").mapInArrow(run, schema)


def _batched(rows: Iterable[tuple], schema: pa.Schema, tokens: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= tokens or len(held) >= 10_000:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class _Reader:
    """Reads one conversation back, piece by piece."""

    def __init__(self, c: Codec):
        self.c, self.turns = c, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0
        self.segment: list[int] = []
        self.masked: list[int] = []

    def _text(self, ids: list[int]) -> str:
        text = self.c.decode(ids)
        self.chars += len(text)
        return unescape(text)

    def feed(self, ids: np.ndarray, loss: np.ndarray) -> None:
        marks = np.flatnonzero(ids >= self.c.reserved)
        at = 0
        for mark in [*marks.tolist(), len(ids)]:
            self.segment += ids[at:mark].tolist()
            self.masked += ids[at:mark][loss[at:mark] == 1].tolist()
            at = mark + 1
            if mark == len(ids):
                break
            self._mark(int(ids[mark]))

    def _mark(self, mark: int) -> None:
        self.chars += len(MARKS[mark - self.c.reserved])
        if mark == self.c.head:
            self.turns += 1
            self.turns_sha.update(self._text(self.segment).encode() + b"\n")
        elif mark == self.c.end:
            self.turns_sha.update(self._text(self.segment).encode() + b"\n")
            masked = unescape(self.c.decode(self.masked))
            self.loss_chars += len(masked)
            self.loss_sha.update(masked.encode())
            self.masked = []
        self.segment = []

    def row(self) -> tuple:
        return self.turns, self.turns_sha.hexdigest(), self.loss_chars, self.loss_sha.hexdigest(), self.chars


def read_back(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per conversation what its sequence holds: ``n_turns``, ``turns_sha256``
    (role, newline, text, newline of each turn), ``loss_chars`` and
    ``loss_sha256`` (all text under the mask) and ``formatted_chars`` (of the
    rendered text). Pieces are streamed in order, one at a time."""
    columns = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]
    schema = T.StructType([formatted.schema["conv_id"], *[T.StructField(n, t) for n, t in columns]])
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        c, conv, reader = codec(tokenizer_path), None, None
        for batch in batches:
            for at, conv_id in enumerate(batch.column(0).to_pylist()):
                if reader is None or conv != conv_id:
                    if reader is not None:
                        yield (conv, *reader.row())
                    conv, reader = conv_id, _Reader(c)
                reader.feed(*(np.asarray(batch.column(i)[at].values) for i in (1, 2)))
        if reader is not None:
            yield (conv, *reader.row())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows(batches):
            held.append(row)
            if len(held) == 10_000:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    ordered = python_ready(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.select("conv_id", "ids", "loss").mapInArrow(run, schema)


def formatted_digests(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """The conversations formatted, written, and read back."""
    return read_back(written(format_conversations(conversations, tokenizer_path), "chat-tokens"), tokenizer_path)

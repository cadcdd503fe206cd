"""Token ids as directly addressable codes.

An id is split into chunks of ``WIDTH`` bits, lowest first. Level k holds the
k-th chunk of every id that has one, in order, and a bitmap that says which of
them continue on level k + 1. A rank directory counts the set bits before each
512-bit block, so the place of an id's next chunk is one directory entry plus
the bits of part of a block: any token, or run of tokens, is read without
decoding others.

Layout of one segment, little-endian::

    4 bytes   b"DAC1"
    u32       chunk width in bits (8)
    u64       number of tokens
    u32       number of levels, then 4 zero bytes
    per level:
      u64     number of chunks n
      n       chunks, one byte each, padded to a multiple of 8
      ...     bitmap, bit i of chunk i in byte i // 8, lowest first, padded to 8
      ...     rank directory: u64 for each 512 bits of the bitmap

A token file is a Parquet file whose rows are segments in the order of their
documents: the Spark writer commits files whole and works on any store. Files
(one per task) follow each other in ascending ``doc_id``; a segment holds whole
documents, about ``SEGMENT_TOKENS`` tokens or one longer document.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framelake.llm.common import python_ready
from framelake.session import scratch_path

WIDTH = 8
MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
CACHE_BYTES = 48 << 20  # of each of the two generations
_ENTRY = 200  # bytes of a cache entry beside its piece and ids
MARK = "0"

_HEAD = struct.Struct("<4sIQI4x")
# Latin letters: in UTF-8 without capitals beyond A-Z (C3 9F is ß, C3 A0 to
# C3 BF are à to ÿ, C3 B7 is not a letter), and as text with them.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_LETTERS_UPPER = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# One closing punctuation mark at the end of a piece, after a letter. The mark
# comes first in the pattern, so the search skips to marks.
_CLOSING = re.compile(rb"([.,;:!?#*$%&])(?:(?<=[a-z].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))(?![^\x20\x09-\x0D])")


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode_ids(ids: np.ndarray) -> bytes:
    """A segment of unsigned 32-bit ids."""
    rest = np.asarray(ids, dtype=np.uint32)
    levels = []
    while len(rest):
        more = rest >> np.uint32(WIDTH) != 0
        bitmap = _padded(np.packbits(more, bitorder="little").tobytes())
        ones = np.bitwise_count(np.frombuffer(bitmap + bytes(-len(bitmap) % (RANK_BITS // 8)), dtype=np.uint64)).astype(np.uint64)
        before = np.cumsum(ones.reshape(-1, RANK_BITS // 64).sum(axis=1), dtype=np.uint64)
        directory = np.concatenate((np.zeros(1, dtype=np.uint64), before[:-1]))
        levels.append(b"".join([struct.pack("<Q", len(rest)), _padded(rest.astype(np.uint8).tobytes()), bitmap, directory.astype("<u8").tobytes()]))
        rest = rest[more] >> np.uint32(WIDTH)
    return b"".join([_HEAD.pack(MAGIC, WIDTH, len(ids), len(levels)), *levels])


class TokenCodes:
    """Random access to the tokens of a segment."""

    def __init__(self, data: bytes):
        magic, width, self.count, levels = _HEAD.unpack_from(data)
        if magic != MAGIC or width != WIDTH:
            raise ValueError("not a token segment of this format")
        at, self.levels = _HEAD.size, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n + -n % 8
            size = -(-n // 64) * 8
            bitmap = np.frombuffer(data, np.uint8, size, at)
            blocks = -(-n // RANK_BITS)
            directory = np.frombuffer(data, "<u8", blocks, at + size)
            at += size + 8 * blocks
            self.levels.append((chunks, bitmap, directory))

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, at: int) -> int:
        """Set bits before position ``at``."""
        block = at // RANK_BITS
        if block == len(directory):  # the end, on a block's border
            block -= 1
        bits = np.bitwise_count(bitmap[block * RANK_BITS // 8 : at // 8]).sum(dtype=np.int64)
        if at % 8:
            bits += int(bitmap[at // 8] & ((1 << at % 8) - 1)).bit_count()
        return int(directory[block]) + int(bits)

    def tokens(self, start: int, count: int) -> np.ndarray:
        """Tokens ``start`` to ``start + count``, touching only their own chunks."""
        if not 0 <= start <= start + count <= self.count:
            raise IndexError("tokens outside the segment")
        out = np.zeros(count, dtype=np.uint32)
        where: np.ndarray | slice = slice(None)
        shift = 0
        for chunks, bitmap, directory in self.levels:
            if not count:
                break
            out[where] |= chunks[start : start + count].astype(np.uint32) << np.uint32(shift)
            bits = np.unpackbits(bitmap[start // 8 : -(-(start + count) // 8)], bitorder="little")[start % 8 : start % 8 + count]
            more = np.flatnonzero(bits)
            if len(more):
                start = self._rank(bitmap, directory, start)
            count = len(more)
            where = more if isinstance(where, slice) else where[more]
            shift += WIDTH
        return out

    def token(self, at: int) -> int:
        return int(self.tokens(at, 1)[0])


class WordEncoder:
    """Ids of whole texts by a tokenizer that treats white-space separated
    pieces apart, each distinct piece encoded once.

    It holds for ``word_bpe_49k.json``: canonical composition stops at a space,
    letters are lowered one by one, so A-Z can be lowered first, and its pattern
    matches no white space and parts letters from punctuation, so a piece's
    closing punctuation mark is a piece of its own. New pieces of Latin letters go to
    the merges directly, past the normaliser and the pattern, which would leave
    them as they are.

    The cache has two generations of ``cache_bytes`` each: when the young one is
    full it becomes the old one, whose pieces come back as they are met, so
    frequent pieces stay and rare ones go."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        (self.between,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.cache_bytes, self.held = cache_bytes, 0

    def _learn(self, pieces: Iterable[bytes]) -> None:
        """Put the ids of new pieces into the cache."""
        letters, as_written = [], []
        for piece in pieces:
            if _LETTERS.fullmatch(piece) is not None:
                letters.append(piece)
                as_written.append(piece)
                continue
            text = piece.decode()
            if _LETTERS_UPPER.fullmatch(text) is not None:
                letters.append(text.lower().encode())
                as_written.append(piece)
            else:
                self.cache[piece] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if not letters:
            return
        # All in one call, a lone digit between them, whose id shows where one ends.
        text = f" {MARK} ".join(p.decode() for p in letters)
        ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        data, at = ids.tobytes(), 0
        for piece, end in zip(as_written, [*(4 * np.flatnonzero(ids == self.between)).tolist(), len(data)], strict=True):
            self.cache[piece] = data[at:end]
            at = end + 4

    def _meet(self, pieces: set[bytes]) -> None:
        """Put pieces that the young cache lacks into it."""
        if self.held > self.cache_bytes:
            self.old, self.cache, self.held = self.cache, {}, 0
        known = [piece for piece in pieces if piece in self.old]
        for piece in known:
            self.cache[piece] = self.old[piece]
        new = pieces.difference(known)
        if new:
            self._learn(new)
        self.held += sum(map(len, pieces)) + sum(len(self.cache[p]) for p in pieces) + _ENTRY * len(pieces)

    def encode(self, text: bytes) -> bytes:
        """The ids of the UTF-8 ``text``, four little-endian bytes each."""
        pieces = _CLOSING.sub(rb" \1", text.lower()).split()
        new = set(pieces).difference(self.cache)
        if new:
            before = self.cache
            self._meet(new)
            if self.cache is not before:
                self._meet(set(pieces).difference(self.cache))
        return b"".join(map(self.cache.__getitem__, pieces))


_encoders: dict[str, WordEncoder] = {}  # of a Python worker


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _segments(documents: Iterable[tuple[object, bytes]], segment_tokens: int) -> Iterator[tuple[list, list[int], np.ndarray]]:
    """Documents (id, bytes of ids) gathered into segments."""
    ids, lengths, parts, total = [], [], [], 0
    for doc_id, data in documents:
        ids.append(doc_id)
        lengths.append(len(data) // 4)
        parts.append(data)
        total += lengths[-1]
        if total >= segment_tokens:
            yield ids, lengths, np.frombuffer(b"".join(parts), dtype="<u4")
            ids, lengths, parts, total = [], [], [], 0
    if ids:
        yield ids, lengths, np.frombuffer(b"".join(parts), dtype="<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode ``docs`` (columns ``doc_id`` and ``text``; others are not read)
    into a token file at ``path``, ``end_id`` after each document.

    Documents come in ascending ``doc_id``, nulls first, repeated ids by text.
    A null or empty text has the end id alone. An empty table gives an empty
    file. Rows are range-partitioned before the encoding, so a task holds one
    Arrow batch and one segment at a time and no key decides its size."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("lengths", T.ArrayType(T.IntegerType())),
            T.StructField("segment", T.BinaryType()),
        ]
    )
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = _encoder(tokenizer_path).encode, TaskContext.get().partitionId(), 0
        documents = (
            (i, encode(t or b"") + end)
            for batch in batches
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True)
        )
        for ids, lengths, tokens in _segments(documents, segment_tokens):
            row = {"part": part, "start": start, "n_tokens": len(tokens), "doc_ids": ids, "lengths": lengths, "segment": encode_ids(tokens)}
            start += len(tokens)
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = to_arrow_schema(schema)
    ordered = python_ready(docs).select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Segments of a token file, ``first`` being the number of tokens in the
    file before the segment. Only the totals of its parts, one row per writing
    task, go through the unpartitioned window and are broadcast."""
    segments = spark.read.parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return segments.join(F.broadcast(parts.select("part", before.alias("before"))), "part").withColumn("first", F.col("before") + F.col("start")).drop("before")


def document_checks(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, out of the segments."""
    id_type = segments.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("doc_id", id_type), *[T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, ids, lengths, data = (batch.column(c)[row] for c in range(4))
                sizes = np.asarray(lengths.values)
                ends = np.cumsum(sizes, dtype=np.int64)
                tokens = memoryview(TokenCodes(data.as_py()).tokens(0, int(ends[-1])).astype("<u4").tobytes())
                sums = [zlib.crc32(tokens[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                columns = [ids.values, pa.array(first.as_py() + ends - sizes), pa.array(sizes.astype(np.int64)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return python_ready(segments).select("first", "doc_ids", "lengths", "segment").mapInArrow(run, T.StructType(fields))


def token_index(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> DataFrame:
    """``docs`` written as a token file (in the shared folder, unless ``path``
    is given) and read back: one row per document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm-token-file")
    write_tokens(docs, path, tokenizer_path, end_id)
    return document_checks(read_tokens(spark, path))

"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items go into one automaton, whose states stand for
the word sequences that occur in some item. Document words are streamed through
it, keeping the longest suffix that is such a sequence. Where that suffix
reaches ``WINDOW`` words, all of it occurs in some item and is marked; an item
of fewer words is marked where it occurs whole. States know which items hold
their last ``WINDOW`` words, so the items come out of the same pass.

The items are a stated query set run against all documents in blocks: an
automaton is built from at most ``BLOCK_BYTES`` of item texts, plus one item. A
larger benchmark takes several passes, each with a broadcast of such a block,
over what the pass before has left, so neither the driver nor a worker ever
holds more than one block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import python_ready, written

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_BYTES = 8 << 20

Block = tuple[str, Broadcast]  # a name, and (item_id, text) pairs

# Bytes of UTF-8 text after A-Z are lower-cased: digits, letters and all of a
# non-ASCII character belong to words, the rest separates them.
_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class ItemAutomaton:
    """Suffix automaton of several word sequences, with what is reported at each state."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [0]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.by_window: dict[int, set] = {}  # state of a window -> its items
        self.short: dict[int, list[tuple[int, object]]] = {}  # state of a whole short item -> its length, items
        for item, words in items:
            state = 0
            for at, word in enumerate(words, 1):
                state = self.next[state][word]
                if at >= window:
                    self.by_window.setdefault(self.window_state(state), set()).add(item)
            if 0 < len(words) < window:
                self.short.setdefault(state, []).append((len(words), item))
        # A state also ends with the short items that end its suffixes.
        ends: dict[int, list[tuple[int, object]]] = {}
        if self.short:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                inherited = ends.get(self.link[state], []) + self.short.get(state, [])
                if inherited:
                    ends[state] = inherited
        self.short = ends

    def _extend(self, last: int, word: bytes) -> int:
        """State of the sequence of ``last`` followed by ``word``, added if new."""
        nexts, link, length = self.next, self.link, self.length
        target = nexts[last].get(word)
        if target is not None:
            return target if length[target] == length[last] + 1 else self._split(last, word, target)
        state = self._add({}, 0, length[last] + 1)
        at = last
        while True:
            target = nexts[at].get(word)
            if target is not None:
                link[state] = target if length[target] == length[at] + 1 else self._split(at, word, target)
                return state
            nexts[at][word] = state
            if at == 0:
                return state
            at = link[at]

    def _add(self, nexts: dict, link: int, length: int) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: bytes, target: int) -> int:
        """Separate the shorter sequences of ``target``, which ``at`` reaches, into a state of their own."""
        own = self._add(dict(self.next[target]), self.link[target], self.length[at] + 1)
        self.link[target] = own
        while self.next[at].get(word) == target:
            self.next[at][word] = own
            if at == 0:
                break
            at = self.link[at]
        return own

    def window_state(self, state: int) -> int:
        """State of the last ``window`` words of a sequence at least that long."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Marked spans of ``words`` (start, end exclusive; in order, apart) and the items found."""
        nexts, link, length, short, window = self.next, self.link, self.length, self.short, self.window
        spans: list[tuple[int, int]] = []
        found: set = set()
        state = matched = 0
        for at, word in enumerate(words):
            target = nexts[state].get(word)
            if target is not None:
                state = target
                matched += 1
            else:
                while state and target is None:
                    state = link[state]
                    target = nexts[state].get(word)
                if target is None:
                    matched = 0
                    continue
                matched = length[state] + 1
                state = target
            reach = 0
            if matched >= window:
                reach = matched
                found |= self.by_window[self.window_state(state)]
            if state in short:
                for size, item in short[state]:
                    if size <= matched:
                        reach = max(reach, size)
                        found.add(item)
            if reach:
                start = at + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at + 1))
        return spans, found


def without(text: bytes, automaton: ItemAutomaton) -> tuple[bytes, int, list]:
    """``text`` without its marked spans, again until none is left (a cut may
    bring the parts of another together), the number of words taken out, and the items."""
    removed, items = 0, set()
    while True:
        folded = text.translate(_WORD_BYTES)
        spans, found = automaton.scan(folded.split())
        if not spans:
            return text, removed, sorted(items)
        items |= {i for i in found if i is not None}
        bounds, at = [], 0
        for word in folded.split():
            at = folded.index(word, at)
            bounds.append((at, at + len(word)))
            at += len(word)
        kept, done = [], 0
        for start, end in spans:
            removed += end - start
            kept.append(text[done : bounds[start][0]])
            done = bounds[end - 1][1]
        text = b"".join([*kept, text[done:]])


def _item_texts(items: DataFrame) -> DataFrame:
    """The distinct items with a text: a repeated one would be in one block as
    often as it repeats, whatever the number of blocks."""
    texts = items.select("item_id", F.col("text").cast("binary").alias("text")).where(F.col("text").isNotNull())
    return written(texts.distinct(), "decontaminate-items")


def _block_count(texts: DataFrame, block_bytes: int) -> int:
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def _block(texts: DataFrame, number: int, count: int) -> Block:
    """One of ``count`` parts of the items, broadcast."""
    rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).collect()
    return uuid.uuid4().hex, texts.sparkSession.sparkContext.broadcast([(r["item_id"], bytes(r["text"])) for r in rows])


_built: dict[tuple[str, int], ItemAutomaton] = {}  # in a Python worker: the automaton of the block it works with


def _automaton(block: Block, window: int) -> ItemAutomaton:
    key, items = block[0], block[1]
    if (key, window) not in _built:
        _built.clear()
        _built[key, window] = ItemAutomaton([(item, words_of(text)) for item, text in items.value], window)
    return _built[key, window]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in _column(batch, "text").cast(pa.large_binary()).to_pylist()]


def mark(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without ``text`` and with ``n_words``, ``spans`` (array of word
    ``start`` and ``end``, apart and in order) and ``items`` (ids of the items
    with an occurring window, sorted).

    ``docs`` needs ``text`` and should hold only what is to be carried along;
    a column of its own called like one of the results gives way to it.
    ``items`` has ``item_id`` and ``text``. Null and empty texts have no words
    and no spans; items without words match nothing; items of equal texts are
    all reported, of equal ids once; an item without an id marks words and is
    not listed. Repeated rows are reported alike; empty tables give empty
    results, or no spans.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("text", "n_words", "spans", "items")]
    item_type = items.schema["item_id"].dataType
    marks = [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(item_type)),
    ]
    state = python_ready(docs).select(*[f"`{f.name}`" for f in kept], "text", *[F.lit(None).cast(f.dataType).alias(f.name) for f in marks])
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), *marks])
    texts = _item_texts(items)
    count = _block_count(texts, block_bytes)
    for number in range(count):
        block = _block(texts, number, count)
        state = state.mapInArrow(_marker(block, window), schema)
        if number < count - 1:
            state = written(state, "decontaminate-marks")
            block[1].unpersist()
    return state.drop("text")


def _marker(block: Block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(block, window)
        for batch in batches:
            counts, all_spans, all_items = [], [], []
            for text, before, known in zip(_texts(batch), _column(batch, "spans").to_pylist(), _column(batch, "items").to_pylist(), strict=True):
                words = words_of(text)
                spans, found = automaton.scan(words)
                if before:
                    spans = _union(spans, [(s["start"], s["end"]) for s in before])
                counts.append(len(words))
                all_spans.append([{"start": s, "end": e} for s, e in spans])
                all_items.append(sorted({i for i in found if i is not None}.union(known or ())))
            columns = {f.name: _column(batch, f.name) for f in batch.schema}
            for name, values in (("n_words", counts), ("spans", all_spans), ("items", all_items)):
                columns[name] = pa.array(values, columns[name].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return run


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(a + b):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns: marked spans are cut out of ``text``
    until none is left, and a document that loses more than ``max_coverage`` of
    its words goes. Untouched documents keep their text to the byte. A column
    ``n_chars``, if there is one, is set to the new length of a changed text.
    Nulls, repeated rows and empty tables as in ``mark``."""
    others = [c for c in docs.columns if c != "text"]
    state = python_ready(docs).select(
        F.struct(*[f"`{c}`" for c in others]).alias("row"), "text", F.lit(None).cast("long").alias("words"), F.lit(0).cast("long").alias("removed"), F.lit(0).cast("long").alias("lately")
    )
    texts = _item_texts(items)
    count = _block_count(texts, block_bytes)
    while True:
        for number in range(count):
            block = _block(texts, number, count)
            state = state.mapInArrow(_cutter(block, window), state.schema)
            if count > 1:
                state = written(state, "decontaminate-cuts")
                block[1].unpersist()
        if count == 1:
            break
        if state.where("lately > 0").isEmpty():
            break
        state = state.withColumn("lately", F.lit(0).cast("long"))
    state = state.where(F.col("removed") <= F.lit(max_coverage) * F.col("words"))
    length = F.when(F.col("removed") > 0, F.length("text"))
    own = {c: F.col("row").getField(c) for c in others} | {"text": F.col("text")}
    if "n_chars" in own:
        own["n_chars"] = F.coalesce(length.cast(docs.schema["n_chars"].dataType), own["n_chars"])
    return state.select(*[own[c].alias(c) for c in docs.columns])


def _cutter(block: Block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(block, window)
        for batch in batches:
            texts = _column(batch, "text").cast(pa.large_binary()).to_pylist()
            words, removed, lately = (_column(batch, c).to_pylist() for c in ("words", "removed", "lately"))
            for at, text in enumerate(texts):
                if words[at] is None:
                    words[at] = len(words_of(text or b""))
                if text and words[at]:
                    texts[at], cut, _ = without(text, automaton)
                    removed[at] += cut
                    lately[at] += cut
            columns = {f.name: _column(batch, f.name) for f in batch.schema}
            columns["text"] = pa.array(texts, pa.large_binary()).cast(columns["text"].type)
            for name, values in (("words", words), ("removed", removed), ("lately", lately)):
                columns[name] = pa.array(values, columns[name].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return run

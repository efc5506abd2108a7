"""Packing documents into token sequences by an order-preserving dynamic program.

The documents of a block stand one after another as one line of tokens. A sequence is a stretch of the line
between two cuts, at most LENGTH long. Cuts may lie at the ends of documents (free), at the ends of
sentences (SENTENCE tokens of penalty) and, where neither comes for long and near the end of a block,
between any words or tokens (ANYWHERE). The program minimises padding plus penalties:

    cost(j) = penalty(j) + min over i with 0 < at(j) - at(i) <= LENGTH of cost(i) + LENGTH - (at(j) - at(i))

The smallest cost(i) + at(i) within reach lies at the head of a queue of rising values, so a cut costs
constant time. A stretch as long as a power of two needs no padding: at the end of a block, where
too little is left for a whole sequence, there is one more transition for each power.
"""

from __future__ import annotations

import os
import threading
from array import array
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import raws, slices, trim

LENGTH, END = 2048, 1
SENTENCE, ANYWHERE = 1.0, 3.0
#: Tokens that one program arranges, and that a task holds.
BLOCK = 1 << 20
#: Without an end of a sentence for so long, any token may end a sequence. On sf0.1, 0.32 % of the tokens are padding; 0.16 % with 8, 0.47 % with 24.
STRIDE = 16
#: Bytes of words and their tokens that a worker process remembers, and seconds without a task until it forgets them.
MOST_BYTES, IDLE = 400 << 20, 3.0
#: Bytes that a word takes besides its letters, about.
WORD_BYTES = 170
#: New words that are encoded as one text.
TOGETHER = 128
ENDS = (".", "!", "?", "。", "！", "？", "…", '."', ".”", ".)", '?"', '!"')


class _Places(dict):
    """Places of words in order of first use; `new` lists those that have no tokens yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        self.new.append(word)
        self.bytes += len(word) + WORD_BYTES
        return out


class Tokens:
    """Token ids of texts, word by word with memory: no token reaches over white space in a tokenizer that drops it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: A token of its own that may stand between words, so that many are encoded at once.
        self.between = min(((k, v.content) for k, v in self.tokenizer.get_added_tokens_decoder().items() if v.special), default=None)
        self._clear()

    def _clear(self) -> None:
        self.place = _Places()
        self.flat, self.start, self.ends = array("I"), array("q", [0]), bytearray()

    def _coded(self, words: list[str]) -> list[np.ndarray]:
        if self.between is None:
            return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        code, text = self.between
        odd = [i for i, w in enumerate(words) if "<" in w or text in w]  # may hold such a token, or a part of one
        plain = ["" if "<" in w or text in w else w for w in words]
        out: list[np.ndarray] = []
        joined = [text.join(plain[k : k + TOGETHER]) for k in range(0, len(plain), TOGETHER)]
        for found in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(found.ids, np.uint32)
            first, *others = np.split(ids, np.flatnonzero(ids == code))
            out += [first, *(x[1:] for x in others)]
        for i, x in zip(odd, self.tokenizer.encode_batch([words[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = np.array(x.ids, np.uint32)
        return out

    def encode(self, texts: list[bytes | None], most: int = MOST_BYTES) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: its ids and END, the places after each word, and whether a sentence ends there."""
        if self.place.bytes > most:
            self._clear()
        places = []
        for x in texts:
            words = (x or b"").split()
            places.append(np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)))
        new = self.place.new
        for a in range(0, len(new), 4096):
            own = [w.decode("utf-8", "replace") for w in new[a : a + 4096]]
            coded = self._coded(own)
            self.flat.frombytes(np.concatenate(coded).tobytes())
            self.start.frombytes((self.start[-1] + np.cumsum([len(x) for x in coded])).tobytes())
            self.ends.extend(w.endswith(ENDS) for w in own)
        new.clear()
        flat, start, ends = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.empty(0, np.uint32), np.frombuffer(self.start, np.int64), np.frombuffer(self.ends, np.bool_)
        out = []
        for at in places:
            size = start[at + 1] - start[at]
            after = np.cumsum(size)
            n = int(after[-1]) if len(after) else 0
            ids = np.full(n + 1, END, np.uint32)
            ids[:n] = flat[np.arange(n) + np.repeat(start[at] - (after - size), size)]
            out.append((ids, after, ends[at]))
        del flat, start, ends  # arrays that are looked at can't grow
        return out


_LOADED: dict[str, Tokens] = {}
_USED = {"tasks": 0, "turn": 0}


@contextmanager
def tokens_of(path: str) -> Iterator[Tokens]:
    """One for a worker process, which serves many tasks; what it remembers goes when no task has come for IDLE seconds."""
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    _USED["tasks"] += 1
    _USED["turn"] += 1
    try:
        yield _LOADED[path]
    finally:
        _USED["tasks"] -= 1
        turn = _USED["turn"]

        def forget() -> None:
            if not _USED["tasks"] and _USED["turn"] == turn:
                _LOADED.pop(path, None)
                trim()

        timer = threading.Timer(IDLE, forget)
        timer.daemon = True
        timer.start()


def candidates(docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Where the line of these documents may be cut, rising, from 0 to its end, and the penalties."""
    total = sum(len(x[0]) for x in docs)
    cost = np.full(total + 1, np.inf)
    base = 0
    for ids, after, ends in docs:
        cost[base + after[ends]] = SENTENCE
        base += len(ids)
        cost[base] = 0
    known = np.flatnonzero(np.isfinite(cost))
    known = np.unique(np.concatenate([[0], known, [total]]))
    more = np.maximum((np.diff(known) - 1) // STRIDE, 0)
    fill = np.repeat(known[:-1] - (np.cumsum(more) - more) * STRIDE, more) + (np.arange(more.sum()) + 1) * STRIDE
    cost[fill] = ANYWHERE
    rest = np.arange(max(0, total - length), total)
    cost[rest] = np.minimum(cost[rest], ANYWHERE)
    cost[0] = cost[total] = 0
    at = np.flatnonzero(np.isfinite(cost))
    return at, cost[at]


def cuts(at: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """The best cuts of the line, from 0 to its end. Neighbouring candidates must be at most `length` apart."""
    places, penalties = at.tolist(), penalty.tolist()
    powers = [1 << k for k in range(length.bit_length() - 1)]
    n = len(places)
    cost, back = [0.0] * n, [0] * n
    total = places[-1]
    index = {p: i for i, p in enumerate(places) if p > total - 2 * length}  # where the powers are looked up
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        here = places[j]
        while places[queue[0][1]] < here - length:
            queue.popleft()
        value, i = queue[0]
        best, source = value + length - here, i
        if here > total - length:
            for p in powers:
                k = index.get(here - p)
                if k is not None and cost[k] < best:
                    best, source = cost[k], k
        best += penalties[j]
        cost[j], back[j] = best, source
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], n - 1
    while j:
        out.append(places[j])
        j = back[j]
    return [0, *out[::-1]]


def pieces(docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the stretches that the cuts make of the documents."""
    if not docs:
        return
    edges = cuts(*candidates(docs, length), length)
    sequence, left, offset = 0, edges[1] - edges[0], 0
    for doc, (ids, _, _) in enumerate(docs):
        start, n = 0, len(ids)
        while start < n:
            take = min(left, n - start)
            yield doc, start, take, sequence, offset
            start, left, offset = start + take, left - take, offset + take
            if not left and sequence + 2 < len(edges):
                sequence += 1
                left, offset = edges[sequence + 1] - edges[sequence], 0


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", remembered: int = MOST_BYTES) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids binary of little-endian unsigned 32-bit, doc_tokens, sequence_id, offset).

    Documents keep the order of the rows of their partition, and no sequence spans partitions; so
    nothing is shuffled. A null or empty text is the END id alone. Rows that repeat an id are packed each for
    itself. Very long texts are cut like others. An empty table gives no rows. Other columns aren't read.
    remembered: bytes of words and their tokens that a worker keeps; less costs time, not results.
    """
    rows = docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tokens_of(tokenizer) as tokens:
            yield from arranged(batches, tokens)

    def arranged(batches: Iterator[pa.RecordBatch], tokens: Tokens) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        own: list = []
        held: list = []
        size = 0

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal base, size
            out, last = [], -1
            for doc, start, n, sequence, offset in pieces(held, length):
                ids = held[doc][0]
                out.append((own[doc], start, n, ids[start : start + n].astype("<u4").tobytes(), len(ids), base + sequence, offset))
                last = sequence
            base += last + 1
            own.clear(), held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate([id_type, *types])], names)

        id_type = None
        for batch in slices(batches):
            id_type = batch.column(0).type
            for one, coded in zip(batch.column(0).to_pylist(), tokens.encode(raws(batch.column(1)), remembered), strict=True):
                own.append(one), held.append(coded)
                size += len(coded[0])
                if size >= BLOCK:
                    yield flush(id_type)
        if held:
            yield flush(id_type)

    return rows.mapInArrow(work, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

"""Substring deduplication of word sequences by recompression.

A document starts as the sequence of its word names. A round first names maximal runs of a symbol
(symbol, length), then splits the symbols into left and right ones by a bit of their name and names
each adjacent left-right pair (left, right). Names are fingerprints of what they stand for, so they agree over
all documents without an exchange, and equal substrings get equal symbols inside, whatever stands around
them. With each symbol goes the stretch of words that its making depended on; a symbol whose stretch lies in
a window is in every occurrence of the window. A window's anchor is its symbol of the highest round, the smallest by
name, the leftmost of equals; equal windows have equal anchors, and the name of the anchor's stretch brings them together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, slices, written
from .exchange import ANSWER, DETAIL, RECORD, decide, halves, keyed, mask, parts_of, raws, unpack
from .minhash import WordHashes, mixed

WINDOW, ROUNDS = 13, 2
#: Words that are parsed at once.
PIECE = 200_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Prefix:
    """Fingerprints of stretches of a sequence of names."""

    def __init__(self, names: np.ndarray, seed: int = 0):
        n = len(names)
        names = mixed(names + _U(seed)) if seed else names
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(names * _powers(_BASE, n), out=self.sums[1:]) if n else None
        self.back = _powers(_BACK, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(_U))


def compress(names: np.ndarray, rounds: int = ROUNDS) -> list[dict[str, np.ndarray]]:
    """The symbols after each of rounds 0, 1, ...: name, start and end in words, and the stretch [low, high) they depend on.

    Beyond the ends lies something unknown, so stretches there pass the ends.
    """
    n = len(names)
    at = np.arange(n)
    level = {"name": names, "start": at, "end": at + 1, "low": at, "high": at + 1}
    out = [level]
    for k in range(1, rounds + 1):
        name, size = level["name"], len(level["name"])
        if not size:
            break
        # runs; that a run is maximal depends on the symbols beside it
        head = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        tail = np.concatenate([head[1:], [size]]) - 1
        length = tail - head + 1
        run = np.where(length > 1, mixed(name[head] * _U(3) + mixed(length.astype(_U) + _U(1000 * k))), name[head])
        low = np.where(head > 0, level["low"][np.maximum(head - 1, 0)], -1)
        high = np.where(tail < size - 1, level["high"][np.minimum(tail + 1, size - 1)], n + 1)
        start, end = level["start"][head], level["end"][tail]
        # pairs of a left and a right symbol; an unpaired symbol depends on the one that it might have joined
        right = (mixed(run + _U(7777 * k)) & _U(1)).astype(bool)
        m = len(run)
        joins = np.zeros(m, bool)
        joins[:-1] = ~right[:-1] & right[1:]
        joined = np.zeros(m, bool)
        joined[1:] = joins[:-1]
        nxt, prv = np.minimum(np.arange(m) + 1, m - 1), np.maximum(np.arange(m) - 1, 0)
        new = np.where(joins, mixed(mixed(run + _U(k)) * _U(5) + run[nxt]), run)
        new_end = np.where(joins, end[nxt], end)
        new_low = np.where(joins | ~right, low, np.where(np.arange(m) > 0, low[prv], -1))
        new_high = np.where(joins | ~right, np.where(np.arange(m) < m - 1, high[nxt], n + 1), high)
        keep = ~joined
        level = {"name": new[keep], "start": start[keep], "end": new_end[keep], "low": np.minimum(new_low[keep], start[keep]), "high": np.maximum(new_high[keep], new_end[keep])}
        out.append(level)
    return out


def anchors(names: np.ndarray, ok: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window start: the stretch [low, high) of its anchor; -1 where no window is (`ok` false)."""
    count = len(ok)
    low, high = np.full(count, -1), np.full(count, -1)
    open_ = ok.copy()
    for level in reversed(compress(names, rounds)):
        todo = np.flatnonzero(open_)
        if not len(todo):
            break
        # stretches rise with their symbols, so the symbols in a window are neighbours
        a = np.searchsorted(level["low"], todo, "left")
        b = np.searchsorted(level["high"], todo + window, "right")
        has = a < b
        todo, a, b = todo[has], a[has], b[has]
        if not len(todo):
            continue
        order = mixed(level["name"] + _U(99))
        best = np.empty(len(todo), np.int64)
        # smallest of a stretch of symbols from two overlapping stretches of a power of two
        at, value, k = np.arange(len(order)), order, 0
        span = b - a
        while True:
            here = np.flatnonzero((span >> k) == 1)
            if len(here):
                x, y = at[a[here]], at[b[here] - (1 << k)]
                best[here] = np.where(order[y] < order[x], y, x)
            if not (span >> (k + 1)).any():
                break
            half = 1 << k
            x, y = at[:-half], at[half:]
            at, k = np.where(order[y] < order[x], y, x), k + 1
        low[todo], high[todo] = level["low"][best], level["high"][best]
        open_[todo] = False
    return low, high


def _pieces(batch: pa.RecordBatch, known: WordHashes, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
    """Documents side by side, one word that is nowhere else between them: names, window starts that
    lie in a document, and (row, first word, number of words, place in the document)."""
    held, size, spots = [], 0, []

    def out():
        names = np.concatenate(held)
        ok = np.zeros(max(0, len(names) - window + 1), bool)
        for _, at, n, _ in spots:
            ok[at : at + max(0, n - window + 1)] = True
        return names, ok, list(spots)

    for row, raw in enumerate(raws(batch.column("text"))):
        words = (raw or b"").split()
        if len(words) < window:
            continue
        h = np.fromiter(map(known.__getitem__, words), _U, len(words))
        for at in range(0, len(h) - window + 1, PIECE):  # a very long text comes in pieces that share window - 1 words
            part = h[at : at + PIECE + window - 1]
            held += [part, np.array([mixed(np.array([size + 1], _U))[0]], _U)]
            spots.append((row, size, len(part), at))
            size += len(part) + 1
            if size >= PIECE:
                yield out()
                held, size, spots = [], 0, []
    if held:
        yield out()


def range_records(batch: pa.RecordBatch, window: int = WINDOW, known: WordHashes | None = None) -> Iterator[np.ndarray]:
    """The records of a batch (dkey, rank, text): a run of windows that share an anchor each."""
    known = WordHashes() if known is None else known
    dkey, rank = halves(batch.column("dkey")), batch.column("rank").to_numpy()
    for names, ok, spots in _pieces(batch, known, window):
        low, high = anchors(names, ok, window)
        new = np.ones(len(ok), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | ~ok[:-1]
        head = np.flatnonzero(new & ok)
        bounds = np.flatnonzero(np.concatenate([(new & ok) | ~ok, [True]]))
        tail = bounds[np.searchsorted(bounds, head, "right")]
        out = np.empty(len(head), RECORD)
        prints = Prefix(names)
        out["name"] = prints.of(low[head], high[head])
        out["ctx"] = prints.of(head, tail - 1 + window) + mixed((low[head] - head).astype(_U))
        first = np.array([x[1] for x in spots])
        spot = np.searchsorted(first, head, "right") - 1
        row = np.array([x[0] for x in spots])[spot]
        out["dkey"], out["more"], out["rank"] = dkey[row, 0], dkey[row, 1], rank[row]
        out["a"], out["m"], out["f"] = head - first[spot] + np.array([x[3] for x in spots])[spot], tail - head, 0
        yield out


def window_records(batch: pa.RecordBatch, window: int = WINDOW, known: WordHashes | None = None) -> Iterator[np.ndarray]:
    """A record for each single window of the ranges in `answers` that need detail, under two fingerprints."""
    known = WordHashes() if known is None else known
    for rank, raw, packed in zip(batch.column("rank").to_pylist(), raws(batch.column("text")), batch.column("answers").to_pylist(), strict=True):
        own = unpack(packed, ANSWER)
        own = own[(own["f"] & DETAIL) > 0]
        if not len(own):
            continue
        words = raw.split()
        h = np.fromiter(map(known.__getitem__, words), _U, len(words))
        start = np.unique(np.concatenate([np.arange(a, a + m) for a, m in zip(own["a"].tolist(), own["m"].tolist(), strict=True)]))
        out = np.empty(len(start), RECORD)
        out["name"], out["ctx"] = Prefix(h).of(start, start + window), Prefix(h, 12345).of(start, start + window)
        out["dkey"], out["more"], out["rank"], out["a"], out["m"], out["f"] = own["dkey"][0], own["more"][0], rank, start, 1, 0
        yield out


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, list[str]]:
    """(dkey, answers) of keyed documents: the windows that also start in a document of smaller id; and
    the paths of the tables it lies in."""
    known: dict = {}

    def ranges(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return range_records(batch, window, known.setdefault("words", WordHashes()))

    def windows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return window_records(batch, window, known.setdefault("words", WordHashes()))

    rows = docs.select("dkey", "rank", "text")
    parts = parts_of(rows)
    first, path = written(decide(rows, ranges, True, parts), "ranges")
    second, path2 = written(decide(rows.join(first, "dkey"), windows, True, parts), "windows")
    return first.unionByName(second), [path, path2]


def joined(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """docs with the list `all` of packed answers, null if there are none."""
    return docs.join(ranges.groupBy("dkey").agg(F.collect_list("answers").alias("all")), "dkey", "left")


def dedup_words(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, and kept_text unless with_text is false): words under a window of `window` words that also
    starts in a document of smaller id are removed; the others are joined by one space.

    Ids are integers; others raise an error. Rows of equal id don't remove from each other; a null id is larger than
    all. Null, empty and short texts lose nothing. Only the id and text columns are read.
    """
    rows = keyed(docs, id_col, text_col)
    ranges, paths = repeated_ranges(rows, window)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = []
            for raw, packed in zip(raws(batch.column("text")), batch.column("all").to_pylist(), strict=True):
                words = (raw or b"").split()
                n, kept = len(words), words
                if packed:
                    gone = mask(n, np.concatenate([unpack(x, ANSWER) for x in packed]), window)
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                text = b" ".join(kept)
                got.append((n, n - len(kept), hashlib.sha256(text).hexdigest(), text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[i] for x in got], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))] + [pa.array([x[3] for x in got], pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    found = joined(rows, ranges).select("doc_id", "text", "all").mapInArrow(work, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    out, _ = written(found if with_text else found.drop("kept_text"), "kept")
    for path in paths:
        remove(docs.sparkSession, path)
    return out

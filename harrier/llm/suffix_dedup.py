"""Exact substring deduplication on bytes with suffix arrays built by two-stage sorting.

A suffix array of everything can't be dealt out, so strings that may be equal are brought together first: each
window of WIDTH bytes has an anchor, the smallest fingerprint of K bytes in it (the leftmost of equals), and equal
windows have equal anchors. Ranges of windows around an anchor that is nowhere else are done; ranges that
are equal throughout count as one. The different ranges around one anchor meet in a task, which sorts
their suffixes in two stages: those smaller than their successor directly, the others by scanning the
buckets of first bytes in order, where their successors already stand. Adjacent common prefixes of WIDTH
bytes then show which windows occur twice.

Where more than MOST_RANGES different ranges share an anchor, no single task could hold them: their windows
are dealt by two fingerprints of the window itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, remove, slices, written
from .exchange import ANSWER, COVERED, DETAIL, RECORD, decide, document_key, halves, keyed, mask, pack, parts_of, raws, unpack
from .minhash import mixed
from .recompress import Prefix, joined

WIDTH, K = 200, 48
PIECE = 1 << 18
MOST_RANGES = 20_000
#: Ranges that are compared in one task beside each other, about; those of one anchor stay together.
RANGES_A_PART = 4000
_U = np.uint64
_BYTES = mixed(np.arange(1, 257, dtype=_U))


def _slide_min(x: np.ndarray, w: int) -> np.ndarray:
    """The place of the smallest, leftmost of equals, of each w neighbours."""
    at = np.arange(len(x), dtype=np.int32)
    k = 1
    while 2 * k <= w:
        a, b = at[:-k], at[k:]
        at = np.where(x[b] < x[a], b, a)
        k *= 2
    if k < w:
        a, b = at[: len(at) - (w - k)], at[w - k :]
        at = np.where(x[b] < x[a], b, a)
    return at


def range_records(batch: pa.RecordBatch, width: int = WIDTH, k: int = K) -> Iterator[np.ndarray]:
    """The records of a batch (dkey, rank, text): a run of windows that share an anchor each."""
    held, size, spots = [], 0, []
    dkeys, ranks = halves(batch.column("dkey")), batch.column("rank").to_numpy()

    def out() -> np.ndarray:
        text = b"".join(held)
        codes = np.frombuffer(text, np.uint8)
        prints = Prefix(_BYTES[codes])
        start = np.arange(len(codes) - k + 1)
        order = prints.of(start, start + k)
        place = _slide_min(order, width - k + 1)  # of each window of `width` bytes
        ok = np.zeros(len(place), bool)
        for _, at, n, _ in spots:
            ok[at : at + n - width + 1] = True
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (ok[1:] != ok[:-1])
        cut = np.flatnonzero(new)
        head, tail = cut, np.append(cut[1:], len(place))
        head, tail = head[ok[head]], tail[ok[head]]
        # neighbours in different documents never share a run: the windows across an end are not ok
        rows = np.empty(len(head), RECORD)
        rows["name"] = order[place[head]]
        rows["ctx"] = [xxhash.xxh3_64_intdigest(text[a : b - 1 + width], seed=s) for a, b, s in zip(head.tolist(), tail.tolist(), (place[head] - head).tolist(), strict=True)]
        first = np.array([x[1] for x in spots])
        spot = np.searchsorted(first, head, "right") - 1
        row = np.array([x[0] for x in spots])[spot]
        rows["dkey"], rows["more"], rows["rank"] = dkeys[row, 0], dkeys[row, 1], ranks[row]
        rows["a"], rows["m"], rows["f"] = head - first[spot] + np.array([x[3] for x in spots])[spot], tail - head, 0
        return rows

    for row, raw in enumerate(raws(batch.column("text"))):
        for at in range(0, len(raw or b"") - width + 1, PIECE):  # pieces of a very long text share width - 1 bytes
            part = raw[at : at + PIECE + width - 1]
            held.append(part)
            spots.append((row, size, len(part), at))
            size += len(part)
            if size >= PIECE:
                yield out()
                held, size, spots = [], 0, []
    if held:
        yield out()


def suffix_array(text: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted positions of `text` in the order of their suffixes, each up to the end of its range.

    `ends` are the ranges' ends, rising; an end sorts before all bytes, and equal suffixes by place. A position is small if its
    suffix is under its successor's: if the first byte that differs from its own is larger. Else, or where its run of equal bytes
    meets an end, it is large. With the wanted ones go the places behind the runs of large ones, which their order hangs on.
    """
    n = len(text)
    at_end = np.zeros(n + 1, bool)
    at_end[ends] = True
    stops = np.flatnonzero(np.append((text[1:] != text[:-1]) | at_end[1:-1], True)) + 1
    behind = stops[np.searchsorted(stops, np.arange(n), "right")]  # where a position's run of equal bytes ends
    last = at_end[behind]
    small = ~last & (text[np.minimum(behind, n - 1)] > text)
    need = np.zeros(n, bool)
    need[wanted] = True
    more = np.asarray(wanted)
    while len(more):
        more = np.unique(behind[more[~small[more] & ~last[more]]])
        more = more[~need[more]]
        need[more] = True

    # stage one: the small suffixes, by comparing bytes
    raw = text.tobytes()
    direct = np.flatnonzero(need & small)
    until = ends[np.searchsorted(ends, direct, "right")]
    order = sorted(range(len(direct)), key=[raw[a:b] for a, b in zip(direct.tolist(), until.tolist(), strict=True)].__getitem__)
    direct = direct[order]

    # stage two: a scan bucket by bucket; the large suffixes of a byte go before its small ones, shorter runs before longer, in the
    # order of what lies behind the run, which begins with a smaller byte and so already stands
    rank = np.full(n + 1, -1, np.int64)
    large = np.flatnonzero(need & ~small)
    large = large[np.argsort(text[large], kind="stable")]
    cuts, small_cuts = np.searchsorted(text[large], np.arange(257)), np.searchsorted(text[direct], np.arange(257))
    out, placed = [], 0
    for c in range(256):
        bucket = large[cuts[c] : cuts[c + 1]]
        if len(bucket):
            to = behind[bucket]
            bucket = bucket[np.lexsort((np.where(last[bucket], to - n - 2, rank[to]), to - bucket))]
        bucket = np.concatenate([bucket, direct[small_cuts[c] : small_cuts[c + 1]]])
        rank[bucket] = np.arange(placed, placed + len(bucket))
        placed += len(bucket)
        out.append(bucket)
    sa = np.concatenate(out)
    keep = np.zeros(n, bool)
    keep[wanted] = True
    return sa[keep[sa]]


def common_prefixes(text: np.ndarray, sa: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Of each suffix and the one before it in `sa`, the length of the common prefix, up to `most`."""
    out = np.zeros(len(sa), np.int64)
    until = ends[np.searchsorted(ends, sa, "right")]
    for a in range(1, len(sa), 20_000):
        x, y = sa[a - 1 : a + 19_999], sa[a : a + 20_000]
        x = x[: len(y)]
        limit = np.minimum(np.minimum(until[a - 1 : a - 1 + len(y)] - x, until[a : a + len(y)] - y), most)
        same = np.zeros(len(y), np.int64)
        left = np.arange(len(y))
        for k in range(0, most, 8):
            step = np.arange(k, min(k + 8, most))
            equal = text[np.minimum(x[left, None] + step, len(text) - 1)] == text[np.minimum(y[left, None] + step, len(text) - 1)]
            run = np.where(equal.all(axis=1), len(step), np.argmin(equal, axis=1))
            same[left] = k + run
            left = left[run == len(step)]
            if not len(left):
                break
        out[a : a + len(y)] = np.minimum(same, limit)
    return out


def repeated_starts(pieces: list[bytes], counts: list[int], width: int = WIDTH) -> list[np.ndarray]:
    """For each piece, which of its first `count` windows of `width` bytes also start at another place."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(x) for x in pieces])
    starts = ends - [len(x) for x in pieces]
    wanted = np.concatenate([np.arange(s, s + c) for s, c in zip(starts.tolist(), counts, strict=True)])
    sa = suffix_array(text, ends, wanted)
    lcp = common_prefixes(text, sa, ends, width)
    hit = np.zeros(len(text), bool)
    twice = np.flatnonzero(lcp >= width)
    hit[sa[twice]] = True
    hit[sa[twice - 1]] = True
    return [hit[s : s + c] for s, c in zip(starts.tolist(), counts, strict=True)]


def _runs(hit: np.ndarray, base: int, dkey: bytes) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out = np.zeros(len(edge) // 2, ANSWER)
    (out["dkey"], out["more"]), out["a"], out["m"], out["f"] = np.frombuffer(dkey, "<i8"), base + edge[::2], edge[1::2] - edge[::2], COVERED
    return out


def contexts(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(dkey, answers, text) -> the ranges that need detail: (dkey, name, a, m, piece)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            held = 0
            pack_up = lambda rows: pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["dkey", "name", "a", "m", "piece"])
            for dkey, raw, packed in zip(batch.column("dkey").to_pylist(), raws(batch.column("text")), batch.column("answers").to_pylist(), strict=True):
                own = unpack(packed, ANSWER)
                own = own[(own["f"] & DETAIL) > 0]
                for name, a, m in zip(own["name"].view("i8").tolist(), own["a"].tolist(), own["m"].tolist(), strict=True):
                    out.append((dkey, name, a, m, raw[a : a + m - 1 + width]))
                    held += m + width
                if held > 8 << 20:
                    yield pack_up(out)
                    out, held = [], 0
            yield pack_up(out)

    return rows.select("dkey", "text", "answers").mapInArrow(work, "dkey binary, name long, a int, m int, piece binary")


def sorted_ranges(found: DataFrame, n: int, width: int = WIDTH) -> DataFrame:
    """The windows of (dkey, name, a, m, piece) that occur twice below one name: (dkey, answers)."""
    parts = max(1, n // RANGES_A_PART)

    def work(group: pa.Table) -> pa.Table:
        dkey, a, m, pieces = (group.column(x).to_pylist() for x in ("dkey", "a", "m", "piece"))
        out = [(k, _runs(hit, base, k)) for k, base, hit in zip(dkey, a, repeated_starts(pieces, m, width), strict=True)]
        out = [(k, pack(x)) for k, x in out if len(x)]
        return pa.table([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], ["dkey", "answers"])

    dealt = found.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(work, "dkey binary, answers binary")


def single_windows(found: DataFrame, parts: int, width: int = WIDTH) -> DataFrame:
    """The same for names with too many ranges: each window by two fingerprints of its own."""

    def extract(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for dkey, a, m, piece in zip(*(batch.column(x).to_pylist() for x in ("dkey", "a", "m", "piece")), strict=True):
            codes = _BYTES[np.frombuffer(piece, np.uint8)]
            start = np.arange(m)
            out = np.empty(m, RECORD)
            out["name"], out["ctx"] = Prefix(codes).of(start, start + width), Prefix(codes, 12345).of(start, start + width)
            out["dkey"], out["more"] = np.frombuffer(dkey, "<i8")
            out["rank"], out["a"], out["m"], out["f"] = 0, a + start, 1, 0
            yield out

    return decide(found, extract, False, parts)


def repeated_ranges(rows: DataFrame, width: int = WIDTH) -> tuple[DataFrame, list[str]]:
    """(dkey, answers) of keyed documents: the windows that also start elsewhere; and the paths of the tables it lies in."""
    parts, paths = parts_of(rows), []

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = written(df, name)
        paths.append(path)
        return out

    first = kept(decide(rows.select("dkey", "rank", "text"), lambda batch: range_records(batch, width), False, parts), "ranges")
    # a row of its own text is enough for copies: their windows are all covered
    found, path = written(contexts(rows.select("dkey", "text").join(first, "dkey"), width), "contexts")
    hot = kept(found.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > MOST_RANGES).select("name", F.lit(True).alias("hot")), "hot")
    n, out = found.count(), first
    if not hot.isEmpty():
        out = out.unionByName(kept(single_windows(found.join(hot, "name").drop("hot"), parts, width), "singles"))
        found = found.join(hot, "name", "left_anti")
    if n:
        out = out.unionByName(kept(sorted_ranges(found, n, width), "sorted"))
    remove(rows.sparkSession, path)
    return out, paths


def _kept(raw: bytes | None, packed: list[bytes] | None, width: int) -> tuple[np.ndarray, bytes]:
    raw = raw or b""
    if not packed:
        return np.zeros(len(raw), bool), raw
    gone = mask(len(raw), np.concatenate([unpack(x, ANSWER) for x in packed]), width)
    return gone, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def dedup_bytes(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): bytes under a string of `width` bytes that also starts
    at another place, in the same document or not, are removed.

    Null and empty texts have 0 bytes. Rows that repeat an id or a text are documents of their own, so a
    repeated row of `width` bytes or more loses all. Null ids are kept. Only the id and text columns are read.
    """
    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = []
            for raw, packed in zip(raws(batch.column("text")), batch.column("all").to_pylist(), strict=True):
                gone, kept = _kept(raw, packed, width)
                spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                got.append((len(gone), len(gone) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[i] for x in got], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    ranges, paths = repeated_ranges(rows, width)
    out, _ = written(joined(rows, ranges).select("doc_id", "text", "all").mapInArrow(work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "kept")
    for path in paths:
        remove(docs.sparkSession, path)
    return out


def deduplicated(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their own columns and what is left of their texts.

    Where a cut splits a character of several bytes, the character's other bytes go too, so texts stay valid.
    """
    rows = keyed(docs, id_col, text_col)
    key, own, cut = (fresh(x, docs.columns) for x in ("dedup_key", "dedup_all", "dedup_text"))
    ranges = repeated_ranges(rows, width)[0].groupBy("dkey").agg(F.collect_list("answers").alias(own)).withColumnRenamed("dkey", key)
    text, one = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")

    @F.arrow_udf("string")
    def left(texts: pa.Array, packed: pa.Array) -> pa.Array:
        return pa.array([None if raw is None else _kept(raw, p, width)[1].decode("utf-8", "ignore") for raw, p in zip(raws(texts), packed.to_pylist(), strict=True)], pa.string())

    out = docs.withColumn(key, document_key(one, text)).join(ranges, key, "left")
    out = out.withColumn(cut, F.when(F.col(own).isNull(), text).otherwise(left(text, F.col(own))))
    return out.select(*(F.col(f"`{cut}`").alias(x) if x == text_col else F.col(f"`{x}`") for x in docs.columns))

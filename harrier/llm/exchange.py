"""Which ranges of text windows occur elsewhere: records dealt by fingerprint in packed blocks.

A record says that a document has windows [a, a + m) around an anchor: `name` is a fingerprint of content that
lies in each of them, `ctx` one of all that they cover. Records of one name meet in one task; two records
of equal ctx have equal windows. Where a name has several ctx, the windows must be compared in detail.

Before the exchange, a task settles what its own records show and sends one record a name, so
a passage that a third of all documents share reaches its task once per sending block of records, and
copies within a block are not sent at all. The answers are packed by document in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

from .common import raws, slices  # noqa: F401

RECORD = np.dtype([("name", "u8"), ("ctx", "u8"), ("rank", "i8"), ("dkey", "i8"), ("more", "i8"), ("a", "i4"), ("m", "u2"), ("f", "u1")])
ANSWER = np.dtype([("dkey", "i8"), ("more", "i8"), ("name", "u8"), ("a", "i4"), ("m", "u2"), ("f", "u1")])
REPEATED, SEVERAL = 1, 2
COVERED, DETAIL = 1, 2
#: Records that a task holds before it settles and sends them, and bytes of text whose records one part has, about.
BLOCK, PART_BYTES = 300_000, 16 << 20
LAST = np.iinfo(np.int64).max


def pack(rows: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(rows[x]).tobytes() for x in rows.dtype.names)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(raw: bytes, kind: np.dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n, at = len(raw) // kind.itemsize, 0
    out = np.empty(n, kind)
    for x in kind.names:
        size = n * kind[x].itemsize
        out[x] = np.frombuffer(raw[at : at + size], kind[x])
        at += size
    return out


def settle_records(records: np.ndarray, smaller: bool) -> tuple[np.ndarray, np.ndarray]:
    """The answers that these records give, and the records that stand for them in an exchange.

    smaller: a window counts as elsewhere only in a document of smaller rank; else anywhere else.
    """
    if not len(records):
        return np.empty(0, ANSWER), records
    r = records[np.lexsort((records["a"], records["more"], records["dkey"], records["rank"], records["ctx"], records["name"]))]
    n = len(r)
    first = np.ones(n, bool)
    first[1:] = r["name"][1:] != r["name"][:-1]
    start = first.copy()
    start[1:] |= r["ctx"][1:] != r["ctx"][:-1]
    name_of, ctx_of = np.cumsum(first) - 1, np.cumsum(start) - 1
    several = np.bincount(name_of, start) > 1
    several |= np.bincount(name_of, (r["f"] & SEVERAL) > 0) > 0
    several = several[name_of]
    if smaller:
        least = r["rank"][start][ctx_of]
        covered, own = r["rank"] > least, r["rank"] == least
        sent = np.where(several, first, own)
        mark = np.where(several, SEVERAL, 0)
    else:
        covered = (np.bincount(ctx_of)[ctx_of] > 1) | ((r["f"] & REPEATED) > 0)
        own, sent = start, first
        mark = np.where(several, SEVERAL, 0) | np.where(covered, REPEATED, 0)
    detail = several & own
    # what was sent as one of several had its answer where it came from
    hit = (covered | detail) & ((r["f"] & SEVERAL) == 0)
    answers = np.empty(int(hit.sum()), ANSWER)
    for x in ("dkey", "more", "name", "a", "m"):
        answers[x] = r[x][hit]
    answers["f"] = (COVERED * covered + DETAIL * detail)[hit]
    out = r[sent]
    out["f"] = mark[sent]
    return answers, out


def _deal(rows: np.ndarray, by: str, parts: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of rows by part, in order of document within each, so that they pack well."""
    part = ((rows[by].astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
    order = np.lexsort((rows["a"], rows["more"], rows["dkey"], part))
    rows, part = rows[order], part[order]
    cut = np.flatnonzero(np.diff(part)) + 1
    for x, at in zip(np.split(rows, cut), [0, *cut], strict=True):
        if len(x):
            yield int(part[at]), pack(x)


def _table(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int32()), pa.array([x[2] for x in rows], pa.binary())], ["part", "kind", "block"])


def halves(keys: pa.Array) -> np.ndarray:
    """Keys of 16 bytes, or numbers, as (n, 2) 64-bit numbers."""
    if pa.types.is_integer(keys.type):
        return np.stack([keys.to_numpy(), np.zeros(len(keys), np.int64)], axis=1)
    return np.frombuffer(b"".join(keys.to_pylist()), "<i8").reshape(-1, 2)


def parts_of(docs: DataFrame) -> int:
    """In how many parts the records of these texts meet: by their bytes, so that a part fits a task at any size."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def decide(docs: DataFrame, extract: Callable[[pa.RecordBatch], Iterator[np.ndarray]], smaller: bool, parts: int) -> DataFrame:
    """(dkey, answers): the packed answers of every document that has any, each in one row.

    extract gives the records of a batch of rows, piece by piece. A task holds BLOCK records, or
    the records of its share of the names, one of `parts`.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            answers, records = settle_records(np.concatenate(held), smaller)
            held.clear()
            yield _table([(p, 0, x) for p, x in _deal(records, "name", parts)])
            yield _table([(p, 1, x) for p, x in _deal(answers, "dkey", parts)])

        for batch in slices(batches):
            for records in extract(batch):
                held.append(records)
                if sum(map(len, held)) >= BLOCK:
                    yield from flush()
        yield from flush()

    def meet(group: pa.Table) -> pa.Table:
        part, kind, blocks = group.column("part")[0].as_py(), group.column("kind").to_pylist(), group.column("block").to_pylist()
        records = [unpack(x, RECORD) for x, k in zip(blocks, kind, strict=True) if k == 0]
        out = [(part, 1, x) for x, k in zip(blocks, kind, strict=True) if k == 1]
        if records:
            answers, _ = settle_records(np.concatenate(records), smaller)
            out += [(p, 1, x) for p, x in _deal(answers, "dkey", parts)]
        return pa.Table.from_batches([_table(out)])

    def gather(group: pa.Table) -> pa.Table:
        rows = np.concatenate([unpack(x, ANSWER) for x in group.column("block").to_pylist()])
        rows = rows[np.lexsort((rows["a"], rows["more"], rows["dkey"]))]
        cut = np.flatnonzero((rows["dkey"][1:] != rows["dkey"][:-1]) | (rows["more"][1:] != rows["more"][:-1])) + 1
        pieces = np.split(rows, cut)
        return pa.table([pa.array([key_of(x[0]) for x in pieces], pa.binary()), pa.array([pack(x) for x in pieces], pa.binary())], ["dkey", "answers"])

    shape = "part int, kind int, block binary"
    met = docs.mapInArrow(send, shape).groupBy("part").applyInArrow(meet, shape)
    return met.groupBy("part").applyInArrow(gather, "dkey binary, answers binary")


def key_of(row: np.void) -> bytes:
    return np.array([row["dkey"], row["more"]], "<i8").tobytes()


def document_key(doc_id: Column, text: Column) -> Column:
    """16 bytes: rows alike in id and text share a key."""
    part = lambda seed: F.unhex(F.lpad(F.hex(F.xxhash64(F.lit(seed), doc_id.isNull(), doc_id, text.isNull(), text)), 16, "0"))
    return F.concat(part(11), part(12))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, dkey, rank, text). Ids are integers, as smaller ones are asked for; a null id ranks last."""
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType
    if not isinstance(kind, (IntegralType, NullType)):
        raise TypeError(f"{id_col} must be an integer to be compared, not {kind.simpleString()}")
    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return out.select("doc_id", document_key(F.col("doc_id"), F.col("text")).alias("dkey"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"), "text")


def mask(n: int, answers: np.ndarray, width: int) -> np.ndarray:
    """Of n units, those under windows [a, a + m) of `width` units that are covered."""
    edge = np.zeros(n + 1, np.int32)
    own = answers[(answers["f"] & COVERED) > 0]
    if len(own):
        np.add.at(edge, own["a"], 1)
        np.add.at(edge, np.minimum(own["a"].astype(np.int64) + own["m"] - 1 + width, n), -1)
    return np.cumsum(edge[:-1]) > 0

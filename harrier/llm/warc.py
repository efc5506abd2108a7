"""WARC archives: a writer with revisit records and a salvage reader.

The writer stores each record as a gzip member of its own, in files of bounded size under a shared
folder; a file appears under its final name only when complete, so a task that runs again after a lost
executor replaces its own files. The reader checks gzip sums, header syntax, lengths and
payload digests. After a failed check it searches for the next gzip member or version line at which a
whole valid record starts, recovers from there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove, scratch, written

ROTATE_BYTES = 64 << 20
SPLIT_BYTES = 128 << 20
WINDOW = 1 << 20
MIN_REVISIT_BYTES = 0
GZIP, PLAIN = b"\x1f\x8b\x08", b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with the payload, or a revisit with its length and digest only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&' + chr(39) + '()*+,;=%-._~')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class Damaged(Exception):
    """A check failed."""


class _Source:
    """Random access in windows, so that no file is held whole."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.held):
            want = max(n, WINDOW)
            self.at, self.held = at, self.file.read_at(min(want, max(0, self.size - at)), at) if at < self.size else b""
        return self.held[at - self.at : at - self.at + n]


def _parse(read, start: int) -> tuple[dict[str, str], int, int]:
    """Headers, block start and length of the record at `start`; raises Damaged."""
    n, seen = 4096, 0
    while True:
        head = read(start, n)
        end = head.find(b"\r\n\r\n", max(0, seen - 3))
        if not re.match(rb"WARC/1\.\d\r\n", head) or (end < 0 and len(head) < n):
            raise Damaged("no version line and headers")
        if end >= 0:
            break
        # what can't be headers isn't read on to the end of the file
        if any(x[:1] not in (b" ", b"\t") and b":" not in x for x in head.split(b"\r\n")[1:-1]):
            raise Damaged("bad header line")
        n, seen = 2 * n, len(head)
    found: dict[str, str] = {}
    for line in head[:end].split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and found:  # folded
            continue
        key, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        found[key.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if "warc-type" not in found or not re.fullmatch(r"\d+", found.get("content-length", "")):
        raise Damaged("no type or length")
    return found, start + end + 4, int(found["content-length"])


def _checked(found: dict[str, str], block: bytes, tail: bytes) -> dict:
    if tail != b"\r\n\r\n":
        raise Damaged("no record end after the stated length")
    payload, stated = block, len(block)
    if found.get("content-type", "").startswith("application/http"):
        head, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise Damaged("no HTTP headers")
        said = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        stated = int(said[1]) if said else len(payload)
    kind, digest = found["warc-type"].lower(), found.get("warc-payload-digest", "")
    if kind != "revisit":
        if digest.lower().startswith("sha1:") and digest[5:].upper() != digest_of(payload):
            raise Damaged("payload digest differs")
        stated, digest = len(payload), digest or f"sha1:{digest_of(payload)}"
    return {"headers": found, "record_type": kind, "payload": None if kind == "revisit" else payload, "payload_bytes": stated, "payload_digest": digest[5:].upper() if digest.lower().startswith("sha1:") else digest}


def _inflated(source: _Source, at: int) -> tuple[bytes, int]:
    """The gzip member at `at` and where it ends; zlib checks its sum and length."""
    unpack, out, here = zlib.decompressobj(31), [], at
    while not unpack.eof:
        raw = source.read(here, 1 << 16)
        if not raw:
            raise Damaged("gzip member cut off")
        try:
            out.append(unpack.decompress(raw))
        except zlib.error as error:
            raise Damaged(f"gzip: {error}") from None
        if here == at and out[0] and not out[0].startswith(PLAIN[: len(out[0])]):
            raise Damaged("gzip member without a record")
        here += len(raw)
    return b"".join(out), here - len(unpack.unused_data)


def _one(source: _Source, at: int) -> tuple[list[dict], int]:
    """The records that start at `at` (a gzip member may hold several), and the end; raises Damaged."""
    if source.read(at, 3) == GZIP:
        raw, end = _inflated(source, at)
        rows, here = [], 0
        while here < len(raw):
            found, start, n = _parse(lambda a, k: raw[a : a + k], here)
            rows.append(_checked(found, raw[start : start + n], raw[start + n : start + n + 4]))
            here = start + n + 4
        return rows, end
    if source.read(at, len(PLAIN)) != PLAIN:
        raise Damaged("neither a gzip member nor a version line")
    found, start, n = _parse(source.read, at)
    if start + n + 4 > source.size:
        raise Damaged("the stated length passes the end of the file")
    return [_checked(found, source.read(start, n), source.read(start + n, 4))], start + n + 4


def _next(source: _Source, at: int) -> tuple[int, list[dict], int] | None:
    """The first place from `at` on where whole valid records start."""
    while at < source.size:
        raw = source.read(at, WINDOW)
        for hit in re.finditer(re.escape(GZIP) + rb"|(?:WARC/1\.)", raw):
            try:
                return at + hit.start(), *_one(source, at + hit.start())
            except Damaged:
                continue
        if len(raw) < WINDOW:
            return None
        at += len(raw) - len(PLAIN) + 1
    return None


def _chain(file, size: int, at: int, end: int) -> Iterator[dict]:
    """Rows of what starts in [at, end), where `at` is a place that the chain of records from the file's start comes to; then
    {"kind": "end"} with the place that it comes to at or past `end`."""
    source = _Source(file, size)
    while at < end:
        try:
            rows, to = _one(source, at)
        except Damaged as why:
            got = _next(source, at + 1)
            stop = got[0] if got else size
            yield {"kind": "gap", "offset": at, "length": stop - at, "reason": str(why)}
            if got is None or stop >= end:
                at = stop
                break
            at, rows, to = got
        for row in rows:
            yield row | {"kind": "record", "offset": at, "length": to - at}
        at = to
        while source.read(at, 2) == b"\r\n":  # stray ends between plain records
            at += 2
    yield {"kind": "end", "offset": at}


def _exit(file, size: int, at: int, end: int) -> int:
    for row in _chain(file, size, at, end):
        at = row["offset"]
    return at


def read_range(file, size: int, start: int = 0, end: int | None = None, entry: int | None = None) -> Iterator[dict]:
    """Rows of what the chain of records from the file's start comes to in [start, end): kind "record" or "gap", offset, length and, for gaps, the reason.

    So the rows of the ranges of a file are together those of the whole file, wherever it is cut and damaged and whatever its
    payloads hold. entry: where the chain comes to `start` or past it, if known; otherwise the file is followed from its beginning.
    """
    end = size if end is None else min(end, size)
    entry = entry if entry is not None else _exit(file, size, 0, start) if start else 0
    for row in _chain(file, size, entry, end):
        if row["kind"] != "end":
            yield row


def _guess(file, size: int, start: int) -> int:
    """Where the chain most likely comes to `start` or past it: the first valid record there."""
    got = _next(_Source(file, size), start) if start else (0,)
    return got[0] if got else size


def write_warc(rows: DataFrame, folder: str, rotate_bytes: int = ROTATE_BYTES) -> DataFrame:
    """Write (page_id, url, payload binary, refers_to, revisit) under `folder`; one row per file: path, size, records.

    The result is lazy: the files are written as it is evaluated.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        out, held, done, n = None, 0, 0, 0
        made: list[tuple[str, int, int]] = []
        names = lambda: (f"{base}/_part-{context.partitionId():06d}-{done:05d}.{context.taskAttemptId()}", f"part-{context.partitionId():06d}-{done:05d}.warc.gz")

        def close() -> None:
            nonlocal out, held, done, n
            if out is not None:
                out.close()
                store.move(names()[0], f"{base}/{names()[1]}")
                made.append((f"{folder.rstrip('/')}/{names()[1]}", held, n))
                out, held, n, done = None, 0, 0, done + 1

        for batch in batches:
            for page, url, payload, refers, revisit in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None:
                    out = store.open_output_stream(names()[0])
                raw = member(encode_record(page, url, payload or b"", refers, revisit))
                out.write(raw)
                held, n = held + len(raw), n + 1
                if held >= rotate_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in made], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "size", "records"])

    ordered = rows.select("page_id", "url", "payload", "refers_to", "revisit")
    return ordered.mapInArrow(write, "path string, size long, records long")


_RECORD = "path string, kind string, offset long, length long, reason string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _opened(path: str):
    store, base = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return store.open_input_file(base)


def entries(files: DataFrame, split_bytes: int) -> DataFrame:
    """(path, size, start, entry): the ranges of the files and where each is to be read from.

    Every range is followed from its first valid record, in parallel, for the place that it ends at. Where that
    record isn't the place that the range before ends at, because damage crosses the border or a payload holds a record,
    the range is followed again from the right one. What meets is a row per range of a file.
    """
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, size, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                with _opened(path) as file:
                    entry = _guess(file, size, start)
                    out.append((path, size, start, entry, _exit(file, size, entry, min(start + split_bytes, size))))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], ["path", "size", "start", "entry", "to"])

    def resolve(group: pa.Table) -> pa.Table:
        group = group.sort_by("start")
        path, size, out, at = group.column("path")[0].as_py(), group.column("size")[0].as_py(), [], 0
        with _opened(path) as file:
            for start, entry, to in zip(*(group.column(c).to_pylist() for c in ("start", "entry", "to")), strict=True):
                out.append((path, size, start, at))
                at = to if entry == at else _exit(file, size, at, min(start + split_bytes, size))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(types[:4])], ["path", "size", "start", "entry"])

    ranges = ranges.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4))
    followed = ranges.mapInArrow(follow, "path string, size long, start long, entry long, to long")
    return followed.groupBy("path").applyInArrow(resolve, "path string, size long, start long, entry long")


def read_warc(files: DataFrame, payloads: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records and gaps of the archives in `files` (path, size): a row each, by `kind`.

    Files are cut into ranges of `split_bytes`, and each range is read from the place that its predecessor ends at; see `entries`.
    Empty files give no rows. A file that is nothing but damage gives one gap.
    """
    files = files.select("path", "size").where("size > 0")
    ranges = files.where(F.col("size") <= split_bytes).select("path", "size", *(F.lit(0).cast("long").alias(x) for x in ("start", "entry")))
    ranges = ranges.unionByName(entries(files.where(F.col("size") > split_bytes), split_bytes))

    def number(value: str | None) -> int | None:
        hit = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(hit[1]) if hit else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [x.split()[0] for x in _RECORD.split(", ")] + ["payload"] * payloads
        kinds = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in _RECORD.split(", ")] + [pa.binary()] * payloads

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(columns, kinds, strict=True)], columns)

        for batch in batches:
            for path, size, start, entry in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                rows, held = [], 0
                with _opened(path) as file:
                    for row in read_range(file, size, start, start + split_bytes, entry):
                        head = row.get("headers", {})
                        rows.append(row | {"path": path, "page_id": number(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "refers_to": number(head.get("warc-refers-to"))})
                        held += len(row.get("payload") or b"") if payloads else 200
                        if held > 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                yield packed(rows)

    return ranges.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4)).mapInArrow(read, _RECORD + ", payload binary" * payloads)


def archive_pages(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per page and give the files (path, size, records).

    Of pages with equal payloads of at least `min_revisit_bytes`, the one with the largest id is the response and the
    others revisit it. Null html is an empty payload; a null url leaves its header out; null ids count as
    smallest and, alone with a payload, are responses. Rows that tie on the largest id are all responses. A payload
    that a third of the pages share is counted in partial sums and joined by a join that Spark splits.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.encode(F.col(f"`{html_col}`"), "UTF-8"), F.lit(b""))
    slim = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    slim = slim.withColumn("digest", F.unhex(F.sha1("payload")))
    tops = slim.where(F.length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = slim.join(tops, "digest", "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows = rows.select("page_id", "url", "payload", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("revisit"))
    folder = folder or scratch(spark, "warc")
    files = write_warc(rows, folder)
    listing = f"{folder}-files"
    files.write.parquet(listing)
    return spark.read.parquet(listing)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """The pages written and read back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    The archives are scratch and removed once they are read back.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    rows = read_warc(archive_pages(pages, folder, **options), payloads=False)
    out, _ = written(rows.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")
    for path in (folder, f"{folder}-files"):
        remove(spark, path)
    return out

"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

A document's set is its distinct 5-word shingles, as 64-bit hashes. The sketch has T bins. In round
i < T every shingle is hashed into one bin; in round T + i all go to bin i; a bin keeps its smallest
(round, hash). The rounds end when all bins are filled, so every coordinate is filled after 2 T rounds at
the latest and two sketches agree in a coordinate with about the Jaccard similarity, with concentration
like that of independent minima. BANDS bands of ROWS coordinates find a pair at similarity 0.75 with
probability 1 - (1 - 0.75 ** ROWS) ** BANDS, all but 7e-8.

Documents of equal sets are one node. The smallest node in a band's bucket is its hub, and each node is
compared with its hubs on the full sets, so a bucket of many copies costs about one comparison a member. What then
remains are nodes that share a bucket but no component. Where their sketches leave a similarity of 0.75 possible they are put
into one family, by a spanning forest, and the members of a family that are in different components are all
compared on their full sets, block by block. Neither step makes a row for a pair: what a task puts out are the
links that join its nodes. So no link between components is lost, and the work that grows with the square of a
family is counting in memory, for those members only that are not in its largest component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stars
from .common import free, fresh, raws, remove, slices, written
from .components import written_components

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 30, 3
#: The bands take the first BANDS * ROWS coordinates; the estimate takes all.
T = 256
#: Sketches of a pair at similarity 0.75 agree in less than this share of T with probability 1e-8, less than the bands miss.
POSSIBLE = 0.58
#: Sketches, and shingles of full sets, that are one block of those that meet, about.
BLOCK, BLOCK_SHINGLES = 1024, 400_000
#: Bytes of words and their hashes that a task remembers, and what a word takes besides its letters, about.
MOST_BYTES, WORD_BYTES = 48 << 20, 170
_U = np.uint64
_MULTIPLY = [_U(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, SHINGLE + 1)]


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound of bytes."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        if self.held > MOST_BYTES:
            self.clear()
            self.held = 0
        self.held += len(word) + WORD_BYTES
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(raw: bytes, known: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of k-word shingles of a text in UTF-8; of fewer words, one of them all."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, _U)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], _U)
    h = np.fromiter(map(known.__getitem__, words), _U, len(words))
    n = len(h) - k + 1
    out = np.zeros(n, _U)
    for i in range(k):
        out += h[i : i + n] * _MULTIPLY[i]
    return np.unique(mixed(out))


def sketch(items: np.ndarray, t: int = T) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    full = _U(0xFFFFFFFFFFFFFFFF)
    out, i = np.full(t, full), 0
    while i < 2 * t and (out == full).any():
        step = max(1, min(2 * t - i, (t - i if i < t else 2 * t - i), 2 * t // len(items)))
        rounds = np.arange(i, i + step, dtype=_U)[:, None]
        h = mixed((items[None, :] ^ mixed(rounds * _U(0x9E3779B97F4A7C15) + _U(1))))
        value = (rounds << _U(48)) | (h & _U(0xFFFFFFFFFFFF))
        if i < t:
            np.minimum.at(out, (((h >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64).ravel(), value.ravel())
        else:
            bins = rounds[:, 0].astype(np.int64) - t
            out[bins] = np.minimum(out[bins], value.min(axis=1))
        i += step
    return out


def band_keys(s: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = s[: bands * rows].reshape(bands, rows)
    out = np.arange(bands, dtype=_U)
    for i in range(rows):
        out = mixed(out * _U(0x9E3779B97F4A7C15) ^ parts[:, i])
    return out.view(np.int64)


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.encode(F.col(f"`{text}`"), "UTF-8"), F.lit(b""))))


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, tkey, n_shingles, node, sketch, keys); tkey is a digest of the text, node one of the set, null if empty."""
    source = docs.select("doc_id", text_key("text").alias("tkey"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in slices(batches):
            n, node, short, keys = [], [], [], []
            for raw in raws(batch.column(2)):
                items = shingles(raw or b"", known)
                n.append(len(items))
                if len(items):
                    s = sketch(items)
                    node.append(xxhash.xxh3_128_digest(items.tobytes()))
                    keys.append(band_keys(s))
                    short.append(s.astype(np.uint8).tobytes())
                else:
                    node.append(None), short.append(None), keys.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(short, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "tkey", "n_shingles", "node", "sketch", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, tkey binary, n_shingles long, node binary, sketch binary, keys array<long>")


def link_test(percent: int) -> Callable[[np.ndarray, np.ndarray], bool]:
    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        small, large = sorted((len(x), len(y)))
        if 100 * small < percent * large:
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    return linked


def verified(edges: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of (x, hub), those whose full sets link. texts: (node, item), all nodes of the edges among them."""
    known = WordHashes()
    return stars.verified(edges, texts, lambda raw: shingles(raw, known), link_test(percent))


def _labelled(nodes: DataFrame, label: DataFrame, on: str, name: str) -> DataFrame:
    got = nodes.join(label.select(F.col("node").alias(on), F.col("label").alias(name)), on, "left")
    return got.withColumn(name, F.coalesce(name, on))


def met(rows: DataFrame, group: str, weight: str, most: int) -> DataFrame:
    """Rows (group, node, label, weight, ...) of groups with several labels gain (bx, by, own): each two nodes of a group whose
    labels differ meet in a pair of blocks, and a block weighs about `most`.

    A group that weighs less is one block. In a larger one the members of its heaviest label have blocks of their own,
    which meet the others' blocks but not each other; so a group that is one label but for a few costs a copy of each.
    """
    per = rows.groupBy(group, "label").agg(F.sum(weight).alias("_w")).groupBy(group)
    per = per.agg(F.count("*").alias("_labels"), F.sum("_w").alias("_all"), F.max(F.struct("_w", "label")).alias("_top")).where("_labels > 1")
    one = F.col("_all") <= most
    others = F.when(one, 1).otherwise(F.ceil((F.col("_all") - F.col("_top._w")) / most)).cast("int")
    heavy = F.when(one, 0).otherwise(F.ceil(F.col("_top._w") / most)).cast("int")
    rows = rows.join(per.select(group, F.col("_top.label").alias("_main"), others.alias("_k"), heavy.alias("_h")), group)
    h, k, mine = F.xxhash64("node"), F.col("_k"), (F.col("_h") > 0) & (F.col("label") == F.col("_main"))
    rows = rows.withColumn("own", F.when(mine, k + F.pmod(h, F.greatest("_h", F.lit(1)))).otherwise(F.pmod(h, k)).cast("int"))
    rows = rows.withColumn("_to", F.explode(F.sequence(F.lit(0), F.when(mine, k).otherwise(k + F.col("_h")) - 1)))
    return rows.withColumn("bx", F.least("own", "_to")).withColumn("by", F.greatest("own", "_to")).drop("_main", "_k", "_h", "_to")


class _Joined:
    """Which of a task's nodes are joined already: by their labels, and by what was found since."""

    def __init__(self, label: np.ndarray):
        self.root = np.unique(label, return_inverse=True)[1]

    def join(self, i: int, others: np.ndarray) -> list[int]:
        """Joins i with the others; one of each group that was apart from it."""
        own = self.root[i]
        roots, first = np.unique(self.root[others], return_index=True)
        apart = roots != own
        if apart.any():
            self.root[np.isin(self.root, roots)] = own
        return others[first[apart]].tolist()


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and labels of a pair of blocks, and the places of those that ask and of those asked."""
    node, label = (np.array(group.column(c).to_pylist(), object) for c in ("node", "label"))
    own, bx, by = group.column("own").to_numpy(), group.column("bx")[0].as_py(), group.column("by")[0].as_py()
    return node, label, np.flatnonzero(own == bx), np.flatnonzero(own == by)


def _edges(pairs: list[tuple[bytes, bytes]], names: tuple[str, str]) -> pa.Table:
    return pa.table([pa.array([x[i] for x in pairs], pa.binary()) for i in (0, 1)], list(names))


def possible(buckets: DataFrame, label: DataFrame, sketches: DataFrame) -> DataFrame:
    """Edges (a, b) that join all pairs which share a bucket, but no component, and whose sketches leave the
    similarity possible: of each pair of blocks a spanning forest, so no more edges than rows."""
    rows = _labelled(buckets.select("key", "node"), label, "node", "label").withColumn("weight", F.lit(1))

    def work(group: pa.Table) -> pa.Table:
        node, label_, asks, gives = _sides(group)
        s = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
        kind, to = np.unique(label_, return_inverse=True)[1], s[gives]
        least, joined, out = POSSIBLE * s.shape[1], _Joined(np.arange(len(node))), []
        for i in asks:
            near = np.count_nonzero(to == s[i], axis=1) >= least
            j = gives[near & (kind[gives] != kind[i])]
            if len(j):
                out += [(node[i], node[k]) for k in joined.join(i, j)]
        return _edges(out, ("a", "b"))

    return met(rows, "key", "weight", BLOCK).join(sketches, "node").groupBy("key", "bx", "by").applyInArrow(work, "a binary, b binary").distinct()


def linked_within(families: DataFrame, label: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(family, node, n_shingles) -> edges (a, b): of each pair of blocks as many links as join what its links join.

    All pairs of a family that are not in one component yet are compared on their full sets, by counting
    for one of them which shingles of all the others it holds. Nothing is left out by estimate here.
    """
    rows = _labelled(families, label, "node", "label").withColumn("weight", F.col("n_shingles") + 64)
    rows = met(rows, "family", "weight", BLOCK_SHINGLES).join(texts, "node").select("family", "bx", "by", "node", "label", "own", "item")

    def work(group: pa.Table) -> pa.Table:
        node, label_, asks, gives = _sides(group)
        known, sets = WordHashes(), {}
        for i in np.union1d(asks, gives).tolist():
            sets[i] = shingles(group.column("item")[i].as_py(), known)
        gives = gives[np.argsort([len(sets[i]) for i in gives], kind="stable")]
        size = np.array([len(sets[i]) for i in gives])
        flat, place = np.unique(np.concatenate([sets[i] for i in gives]), return_inverse=True)
        start = np.concatenate([[0], np.cumsum(size)])
        joined, out, held = _Joined(label_), [], np.zeros(len(flat), np.int32)
        for i in asks:
            own = sets[i]
            # only sizes within the share of its own can be linked
            lo, hi = np.searchsorted(100 * size, percent * len(own), "left"), np.searchsorted(percent * size, 100 * len(own), "right")
            if lo >= hi or (joined.root[gives[lo:hi]] == joined.root[i]).all():
                continue
            at = np.minimum(np.searchsorted(flat, own), len(flat) - 1)
            at = at[flat[at] == own]
            held[at] = 1
            both = np.add.reduceat(held[place[start[lo] : start[hi]]], start[lo:hi] - start[lo])
            held[at] = 0
            j = gives[lo:hi][100 * both >= percent * (len(own) + size[lo:hi] - both)]
            if len(j):
                out += [(node[i], node[k]) for k in joined.join(i, j)]
        return _edges(out, ("a", "b"))

    return rows.groupBy("family", "bx", "by").applyInArrow(work, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, tkey, node, label), a row per row of docs; tkey is a digest of its text, node of its set,
    label the component's smallest node.

    Null, empty and blank texts have no shingles and stand alone. Texts of under 5 words are one shingle.
    Rows that repeat an id or a text are rows of their own; equal sets are linked. Null ids are allowed:
    they are never a component's id unless all in it are null. Only the id and text columns are read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    first, first_path = written(sketched(docs), "sketches")
    whole = first.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("_rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
    nodes, nodes_path = written(whole.select("node", "n_shingles", "_rep.doc_id", "_rep.tkey", "sketch", "keys"), "nodes")

    bands = nodes.select("node", F.explode("keys").alias("key"))
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets, buckets_path = written(bands.join(hubs, "key"), "buckets")
    needed = buckets.select("node").distinct().join(nodes.select("node", "doc_id", "tkey"), "node").select("node", "tkey", F.col("doc_id").alias("_id"))
    keyed = docs.withColumn("tkey", text_key("text"))
    texts = keyed.join(needed, (keyed["tkey"] == needed["tkey"]) & keyed["doc_id"].eqNullSafe(needed["_id"])).select("node", F.encode("text", "UTF-8").alias("item"))
    # rows that repeat id and text are one node's text
    texts, texts_path = written(texts.dropDuplicates(["node"]), "texts")
    free(spark)

    pairs = buckets.where("node <> hub").select(F.col("node").alias("x"), "hub").distinct()
    links, links_path = written(verified(pairs, texts, percent), "links")
    label, label_path = written_components(links)
    free(spark)
    family, family_path = written_components(possible(buckets, label, nodes.select("node", "sketch")))
    families = family.withColumnRenamed("label", "family").join(nodes.select("node", "n_shingles"), "node")
    more, more_path = written(linked_within(families, label, texts, percent), "more")
    free(spark)
    # a component so far counts as a star
    stars_ = label.select(F.col("node").alias("a"), F.col("label").alias("b"))
    final, final_path = written_components(stars_.unionByName(more))

    least = _labelled(nodes.select("node", "doc_id"), final, "node", "label")
    least = least.join(least.groupBy("label").agg(F.min("doc_id").alias("component_id")), "label").select("node", "label", "component_id")
    out = first.select("doc_id", "n_shingles", "node", "tkey").join(least, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "tkey", "node", "label")
    out, _ = written(out, "near-duplicates")
    for path in (first_path, nodes_path, buckets_path, texts_path, links_path, label_path, family_path, more_path, final_path):
        remove(spark, path)
    free(spark)
    return out


def deduplicated(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with their own columns, of which one row of each component stays: that of the
    smallest id, and of rows that tie on it one of the smallest text digest. Texts without shingles all stay.
    """
    found = near_duplicates(docs, percent, id_col, text_col)
    alone = found.where("node is null").select("doc_id", "tkey", F.lit(False).alias("single"))
    # by the component itself: its id may be null, or that of another component too
    best = found.where("node is not null and kept").groupBy("label").agg(F.first("doc_id").alias("doc_id"), F.min("tkey").alias("tkey"))
    best = best.select("doc_id", "tkey", F.lit(True).alias("single"))
    stay = best.unionByName(alone.distinct())
    tkey, key, single = (fresh(x, docs.columns) for x in ("tkey", "row_key", "single"))
    stay = stay.select(F.xxhash64(F.col("doc_id").isNull(), "doc_id", "tkey").alias(key), F.col("single").alias(single)).distinct()
    own = F.col(f"`{id_col}`")
    out = docs.withColumn(tkey, text_key(text_col)).withColumn(key, F.xxhash64(own.isNull(), own, F.col(tkey))).join(stay, key)
    # a filter on the rank alone lets every task pass on one row a key, so rows that all repeat don't meet
    once = out.where(F.col(single)).withColumn(tkey, F.row_number().over(Window.partitionBy(key).orderBy(key))).where(F.col(tkey) == 1)
    names = [F.col(f"`{x}`") for x in docs.columns]
    return once.select(*names).union(out.where(~F.col(single)).select(*names))

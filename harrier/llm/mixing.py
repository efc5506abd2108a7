"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document draws u from a hash of its id and gets the key -ln(u) / weight, so small keys go to
good documents more often. Within a source, documents stand in key order and their word counts are
prefix-summed to the source's budget. Whole epochs come first: floor(target / size) copies of every
document, and the rest of the budget goes to the first documents in key order; the document that
crosses the budget gives only the words that are missing.

No task holds a source. Cells of the key's logarithm deal a source's documents; sums per cell find the one that
the budget ends in, which is cut into finer cells until it has at most ROWS documents. Only that cell is ordered, by a
row for each distinct (key, id, size); rows that repeat are counted, and numbered by the partitions that they lie in.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, n_words, settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20_240_607
#: Cells per octave of the key are 2 to the power of these, coarse to fine, until the cell that the budget ends in has at most ROWS documents.
LEVELS = (5, 13, 21, 29, 37, 45)
ROWS = 100_000
SALTS = 64


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: falls with the share of mark-up symbols; a null or empty text has 1."""
    marks = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 5.0 * marks / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(skey, source, source_size) gains (target): `share` of all sizes goes to the sources by weight, none
    above `most` times its size, the excess to the others by weight until none is above.

    Ordered by code point, null last, the sources weigh weights[0], weights[1], ... in turn. The
    windows run over one row per source. The level at which the sources without a full cap stand is
    found in closed form: by rising cap / weight, a source is full if its cap is at most what the
    level would be were all before it full.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    filling = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    return (
        sizes.withColumn("_rank", F.row_number().over(every) - 1)
        .withColumn("_w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn("_left", F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(filling), F.lit(0.0)))
        .withColumn("_rest", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(filling), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_rest"))
        .withColumn("_at", F.max(F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))).over(whole))
        .withColumn("target", F.coalesce(F.least("_cap", F.col("_w") * F.col("_at")), F.col("_cap")))
        .select("skey", "source", "source_size", "target")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, tag: Column | None = None) -> DataFrame:
    """One row per document: (doc_id, size, source, source_size, target, taken), with `tag` if given.

    Null text: size 0, takes 0 words. Null source: a source of its own, the last. Null ids draw like
    any other value. Repeated rows draw the same key and stand side by side; both count. Ties of the key are
    broken by id, size and tag, so reruns agree. An empty table gives an empty result. Other columns
    are not looked at, whatever their names.
    """
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    tag = F.lit(0).cast("long") if tag is None else tag
    drawn = F.concat_ws(":", F.lit(str(seed)), F.col(f"`{id_col}`").cast("string"), tag.cast("string"))
    u = (F.conv(F.substring(F.md5(drawn.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    slim = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        n_words(text).alias("size"),
        source.cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")).alias("skey"),
        (-F.log(u) / (quality_weight(text) if weight is None else weight)).alias("_p"),
        tag.alias("tag"),
    )
    # keys lie between 2 ** -54 and some 2 ** 10, whatever the weight, so their logarithms spread evenly enough
    slim = settle(slim.withColumn("_log", F.log2("_p") + 64).withColumn("_salt", F.pmod(F.xxhash64("_p"), F.lit(SALTS)).cast("int")))

    def cell(level: int) -> Column:
        return F.floor(F.col("_log") * float(1 << level))

    sums = slim.groupBy("skey", cell(LEVELS[0]).alias("_cell")).agg(F.sum("size").alias("_s"), F.count("*").alias("_n"), F.first("source").alias("source"))
    sizes = sums.groupBy("skey").agg(F.first("source").alias("source"), F.sum("_s").alias("source_size"))
    plan = source_targets(sizes, weights, share, most)
    plan = plan.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = settle(plan.withColumn("_rem", F.floor(F.col("target")).cast("long") - F.col("_epochs") * F.col("source_size")))

    def crossing(parts: DataFrame) -> DataFrame:
        """Of each source, the cell that the budget ends in, with the words before it and its number of documents."""
        order = Window.partitionBy("skey").orderBy("_cell")
        parts = parts.withColumn("_start", F.col("_start") + F.sum("_s").over(order) - F.col("_s"))
        parts = parts.where((F.col("_start") <= F.col("_rem")) & (F.col("_rem") < F.col("_start") + F.col("_s")))
        return settle(parts.select("skey", "_rem", "_start", F.col("_cell").alias("_edge"), "_n"))

    def salted(per_source: DataFrame) -> DataFrame:
        """SALTS copies of a row per source, so that a source's documents need not meet to learn it."""
        return per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    at = 0
    edge = crossing(sums.drop("source").join(plan.select("skey", "_rem", F.lit(0).cast("long").alias("_start")), "skey"))
    while at + 1 < len(LEVELS) and (edge.agg(F.max("_n")).first()[0] or 0) > ROWS:
        inner = slim.join(salted(edge.drop("_n")), ["skey", "_salt"]).where(cell(LEVELS[at]) == F.col("_edge"))
        at += 1
        edge = crossing(inner.groupBy("skey", "_rem", "_start", cell(LEVELS[at]).alias("_cell")).agg(F.sum("size").alias("_s"), F.count("*").alias("_n")))

    rows = slim.join(salted(plan.drop("source").join(edge.drop("_rem", "_n"), "skey", "left")), ["skey", "_salt"]).withColumn("_cell", cell(LEVELS[at]))
    here = F.col("_edge").isNotNull() & (F.col("_cell") == F.col("_edge"))
    rest = rows.where(~here).withColumn("_part", F.when(F.col("_edge").isNotNull() & (F.col("_cell") < F.col("_edge")), F.col("size")).otherwise(0))
    # the cell itself: a row for all that repeat, then the place among them
    last = settle(rows.where(here).withColumn("_pid", F.spark_partition_id()))
    alike = ["skey", "_p", "doc_id", "size", "tag"]
    counts = last.groupBy(*alike, "_pid").agg(F.count("*").alias("_m"))
    before = Window.partitionBy("skey").orderBy("_p", "doc_id", "size", "tag", "_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum(F.col("_m") * F.col("size")).over(before), F.lit(0)))
    numbered = last.withColumn("_i", F.row_number().over(Window.partitionBy(*alike, "_pid").orderBy("_salt")) - 1)
    same = [numbered[c].eqNullSafe(counts[c]) if c in ("doc_id", "tag") else numbered[c] == counts[c] for c in (*alike, "_pid")]
    numbered = numbered.join(counts, functools.reduce(lambda x, y: x & y, same)).select(*(numbered[c] for c in rows.columns), (F.col("_before") + F.col("_i") * numbered["size"]).alias("_before"))
    numbered = numbered.withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rem") - F.col("_start") - F.col("_before")))).drop("_before")
    out = rest.unionByName(numbered)
    return out.select("doc_id", "size", "source", "source_size", "target", (F.col("_epochs") * F.col("size") + F.col("_part")).cast("long").alias("taken"), F.col("_epochs").alias("epochs"), F.col("_part").cast("long").alias("part"), "tag")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with their own columns: a copy per whole epoch, then the selected ones.

    A document that is taken in part keeps its first words, joined by one space. Documents without
    words come once per whole epoch. Null and repeated ids are allowed: rows are matched by id and a
    hash of text and source, and rows alike in all of these are interchangeable.
    """
    text, source = options.get("text_col", "text"), options.get("source_col", "source")
    key, own, one = (fresh(x, docs.columns) for x in ("_mix_key", "_mix_own", "_mix_one"))
    digest = F.xxhash64(F.lit(7), F.col(f"`{text}`"), F.col(f"`{source}`"), F.col(f"`{options.get('id_col', 'doc_id')}`"))
    plan = mix(docs, tag=digest, **options)
    copies = F.col("epochs") + (F.col("part") > 0).cast("long")
    # rows alike in the tag draw alike; only where the budget ends among them do their plans differ, so a tag has three at most
    plan = plan.groupBy("tag", copies.alias("copies"), "part", "size").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("tag").orderBy(F.col("copies").desc(), F.col("part").desc()))
    plan = plan.withColumn("upto", upto).groupBy("tag").agg(F.sort_array(F.collect_list(F.struct("upto", "copies", "part", "size"))).alias(own))
    out = docs.withColumn(key, digest).join(plan.withColumnRenamed("tag", key), key)
    names = list(docs.columns)
    plain = out.where(F.size(own) == 1).withColumn(one, F.element_at(own, 1))
    turn = F.row_number().over(Window.partitionBy(key).orderBy(key))
    mixed = out.where(F.size(own) > 1).withColumn(one, turn).withColumn(one, F.element_at(F.filter(F.col(own), lambda x: x["upto"] >= F.col(one)), 1))
    out = plain.unionByName(mixed)
    out = out.withColumn(own, F.explode(F.when(F.col(f"{one}.copies") > 0, F.sequence(F.lit(1).cast("long"), F.col(f"{one}.copies")))))
    cut = (F.col(own) == F.col(f"{one}.copies")) & (F.col(f"{one}.part") > 0) & (F.col(f"{one}.part") < F.col(f"{one}.size"))
    short = F.array_join(F.slice(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"([^\x20\x09-\x0D]+)"), 1), 1, F.greatest(F.col(f"{one}.part"), F.lit(1)).cast("int")), " ")
    return out.withColumn(text, F.when(cut, short).otherwise(F.col(f"`{text}`"))).select(*(f"`{x}`" for x in names))

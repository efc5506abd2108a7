"""URL filters: explicit rules, and a path-template tree per host for what no rule fits.

The tree, in DataFrame functions only: paths are cut into segments, and a segment that few pages of its host have at
its place becomes a wildcard of its shape (number, hexadecimal, word, with its file ending), so a template is a path of literals
and wildcards, as deep as the path. Every prefix of a template is a branch. Labelled pages are counted
for all branches at once; a branch whose share of good pages does not differ significantly from its parent's is merged
into it, at any depth. What is left are the branches that differ; each holds the templates below it that are in no
branch of their own, and is rejected if its share of good pages, smoothed towards its host's and the host's
towards the whole table's, is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: (verdict, host, path): fits the host and its subdomains where the path starts so; the longest wins.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Copies of a small row that many others are joined with.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first "://": the host up to / ? # (A-Z lowered), then the path up to ? #. Else both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host + path, and its verdict; nulls if none does. Ties: the first listed."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        rule = F.when(fits, F.lit(own + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """The wildcard that a variable segment becomes; keeps a file ending."""
    ending = F.lower(F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1))
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
    kind = F.when(segment == "", "").when(stem.rlike(r"^[0-9]+$"), "{n}").when(stem.rlike(r"^[0-9A-Fa-f-]{8,}$"), "{x}").otherwise("{w}")
    return F.concat(kind, ending)


def templates(paths: DataFrame, least_rows: int = 5) -> DataFrame:
    """(host, path, n) -> (host, path, template): a segment that under `least_rows` pages of the host have at its place becomes a wildcard.

    paths has a row for each different path. Its segments are counted once for all depths, in partial sums, and the counts
    joined back in SALTS copies, so a segment that a third of all pages share isn't one task.
    """
    segs = paths.select("host", "path", "n", F.posexplode(F.split(F.regexp_replace("path", "^/", ""), "/", -1)).alias("depth", "seg"))
    often = segs.groupBy("host", "depth", "seg").agg(F.sum("n").alias("_n")).where(F.col("_n") >= least_rows)
    often = often.select("host", "depth", "seg", F.lit(True).alias("_often"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    out = segs.withColumn("_salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(often, ["host", "depth", "seg", "_salt"], "left")
    step = F.when(F.col("_often"), F.col("seg")).otherwise(_shape(F.col("seg")))
    steps = F.sort_array(F.collect_list(F.struct("depth", step.alias("step"))))
    return out.groupBy("host", "path").agg(F.concat(F.lit("/"), F.array_join(F.transform(steps, lambda x: x["step"]), "/")).alias("template"))


def judged(counts: DataFrame, threshold: float = 0.5, strength: float = 10.0, z: float = 2.58) -> DataFrame:
    """(host, template, good, bad) -> (host, template, depth, purity, verdict); depth is that of the branch that the template is in.

    With p a parent's share of good pages and n a branch's labelled pages, a branch within z standard errors of p is
    merged into its parent; one without labels always is. Templates without labels in their branch get
    their host's purity, hosts without labels the table's.
    """
    n = F.col("good") + F.col("bad")
    whole = counts.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum(n), F.lit(0)) + 2)).alias("_prior"))
    prior = whole.first()["_prior"]
    hosts = counts.groupBy("host").agg(((F.sum("good") + strength * prior) / (F.sum(n) + strength)).alias("_host"))
    # a branch's key is a digest of its prefix, so a long path costs a few bytes for each of its branches
    parts = F.split(F.substring("template", 2, 1 << 30), "/", -1)
    prefix = lambda i: F.concat(i.cast("string"), F.lit(":"), F.md5(F.array_join(F.slice(parts, 1, i), "/")))
    keys = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.when(i == 0, "0").otherwise(prefix(F.greatest(i, F.lit(1)))))
    rows = counts.withColumn("_keys", keys).select("host", "template", "good", "bad", "_keys", F.posexplode("_keys").alias("depth", "_key"))
    rows = rows.withColumn("_parent", F.get("_keys", F.col("depth") - 1)).drop("_keys")
    nodes = settle(rows.groupBy("host", "_key").agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"), F.first("_parent").alias("_parent")))
    above = nodes.select("host", F.col("_key").alias("_parent"), ((F.col("_g") + 0.5) / (F.col("_g") + F.col("_b") + 1)).alias("_p"))
    m = F.col("_g") + F.col("_b")
    differs = (m > 0) & (F.abs(F.col("_g") / F.greatest(m, F.lit(1)) - F.col("_p")) > z * F.sqrt(F.col("_p") * (1 - F.col("_p")) / F.greatest(m, F.lit(1))))
    own = nodes.join(above, ["host", "_parent"]).where(differs).select("host", "_key", F.lit(True).alias("_differs"))
    found = rows.join(own, ["host", "_key"], "left").groupBy("host", "template")
    found = found.agg(F.max_by(F.struct("depth", "_key"), F.when(F.col("_differs") | (F.col("depth") == 0), F.col("depth"))).alias("_branch"), F.first("good").alias("good"), F.first("bad").alias("bad"))
    pooled = found.groupBy("host", "_branch").agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b")).join(hosts, "host")
    pooled = pooled.withColumn("purity", (F.col("_g") + strength * F.col("_host")) / (F.col("_g") + F.col("_b") + strength))
    out = found.drop("good", "bad").join(pooled, ["host", "_branch"])
    return out.select("host", "template", F.col("_branch.depth").alias("depth"), "purity", F.when(F.col("purity") < threshold, "block").otherwise("allow").alias("verdict"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", least_rows: int = 5, **options) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, template, purity).

    `labels` has (id, good boolean); a null in either is no label. Null urls and urls without "://"
    have an empty host and path and one template of their own. Repeated rows are judged alike, each
    keeps its row. Pages with a null id can't be labelled. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    known = labels.toDF("page_id", "_good").where(F.col("page_id").isNotNull() & F.col("_good").isNotNull())
    known = known.groupBy("page_id").agg(F.min("_good").alias("_good"))  # labels that differ: the bad one
    slim = slim.join(known, "page_id", "left")
    paths = slim.groupBy("host", "path").agg(F.count("*").alias("n"), F.count_if(F.col("_good")).alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    paths = settle(paths)
    named = settle(paths.join(templates(paths, least_rows), ["host", "path"]))
    verdicts = judged(named.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), **options)
    verdicts = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = named.withColumn("_salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(verdicts, ["host", "template", "_salt"])
    out = slim.join(named.select("host", "path", "template", "purity", "verdict"), ["host", "path"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("verdict")).alias("verdict"), "template", "purity")

"""Quality rules: fixed base rules, then a learned decision list over text statistics.

The list is learned by sequential covering: a rule is a conjunction of thresholds, grown one condition
at a time by the largest information gain on two thirds of the rows, pruned from the end on the other
third, and kept if it is precise there; the rows it covers go, and the next rule is sought. The rules
become one ordered Spark conditional expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, raws, settle, slices

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_upper", "n_digits", "n_distinct")
STATS = BASE + MORE
#: Ratios that the rules may test, besides n_words.
FEATURES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct", "n_words"),
}
NAMES = ("n_words", *FEATURES)
MAX_LABELLED = 20_000
SYMBOLS, SPACE = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
UPPER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def text_stats(raw: bytes) -> tuple[int, ...]:
    """The STATS of one text in UTF-8; of an empty one, zeros."""
    words = raw.split()
    n, without = len(words), raw.translate(None, SPACE)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    chars = len(without.decode("utf-8", "replace"))
    ids = _Ids()
    found = list(map(ids.__getitem__, words))
    repeated = 0
    if n > 3 and len(ids) < n:
        a, size = np.array(found, np.int64), len(ids)
        pair = a[:-1] * size + a[1:]
        if size >= 1 << 21:  # three ids no longer fit into 63 bits
            pair = np.unique(pair, return_inverse=True)[1]
        triple = pair[:-1] * size + a[2:]
        order = np.argsort(triple)
        same = np.flatnonzero(triple[order[1:]] == triple[order[:-1]])
        hit = np.zeros(n, bool)
        for start in (order[same], order[same + 1]):
            for k in range(3):
                hit[start + k] = True
        repeated = int(hit.sum())
    less = lambda of: len(without) - len(without.translate(None, of))
    return n, chars, less(SYMBOLS), len(lines) - len(set(lines)), repeated, chars + len(raw) - len(without), len(lines), less(UPPER), less(DIGITS), len(ids)


_KIND = pa.struct([(x, pa.int64()) for x in STATS])


def stats_of(text: Column) -> Column:
    """A struct of STATS of a string column; a null text counts as empty."""

    @F.arrow_udf(", ".join(f"{x}: long" for x in STATS))
    def stats(texts: pa.Array) -> pa.Array:
        parts = slices([pa.RecordBatch.from_arrays([texts], ["text"])])
        rows = [text_stats(x) if x else (0,) * len(STATS) for part in parts for x in raws(part.column(0))]
        columns = np.array(rows, np.int64).reshape(-1, len(STATS))
        return pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(len(STATS))], fields=list(_KIND))

    return stats(text)


def base_failed(s) -> Column:
    return (s("n_words") < 50) | (100 * s("n_repeat_words") > 50 * s("n_words"))


def features(s) -> dict[str, Column]:
    ratio = lambda a, b: s(a).cast("double") / F.greatest(s(b), F.lit(1))
    return {"n_words": s("n_words").cast("double")} | {k: ratio(*v) for k, v in FEATURES.items()}


@dataclass(frozen=True)
class Rule:
    """Rejects where all (feature, "<" or ">", threshold) hold."""

    tests: tuple[tuple[str, str, float], ...]

    def covers(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, sign, at in self.tests:
            v = x[:, NAMES.index(name)]
            out &= v < at if sign == "<" else v > at
        return out

    def column(self, of: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, at in self.tests:
            out = out & (of[name] < at if sign == "<" else of[name] > at)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {t:.6g}" for n, s, t in self.tests)


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray], most: int) -> Rule:
    inside, tests = np.ones(len(x), bool), []
    while len(tests) < most and bad[inside].any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best = (1e-9, None)
        for j, name in enumerate(NAMES):
            v = x[inside, j]
            for sign in "<>":
                # counts of bad and good rows beyond each cut
                side = np.searchsorted(cuts[j], v, "right" if sign == "<" else "left")
                beyond = (lambda of: np.cumsum(np.bincount(side[of], minlength=len(cuts[j]) + 1))[:-1]) if sign == "<" else (lambda of: np.cumsum(np.bincount(side[of], minlength=len(cuts[j]) + 1)[::-1])[::-1][1:])
                own = bad[inside]
                p, n = beyond(own), beyond(~own)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best[0]:
                    best = (gain[k], (name, sign, float(cuts[j][k])))
        if best[1] is None:
            break
        name, sign, at = best[1]
        v = x[inside, NAMES.index(name)]
        below, above = (v[v < at], v[v >= at]) if sign == "<" else (v[v <= at], v[v > at])
        tests.append((name, sign, float((below.max() + above.min()) / 2) if len(below) and len(above) else at))  # the middle of the gap
        inside = Rule(tuple(tests)).covers(x)
    return Rule(tuple(tests))


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    worth = []
    for k in range(1, len(rule.tests) + 1):
        hit = Rule(rule.tests[:k]).covers(x)
        p, n = bad[hit].sum(), (~bad[hit]).sum()
        worth.append(((p + 1) / (p + n + 2), p, -k))
    return Rule(rule.tests[: -max(worth)[2]]) if worth else rule


def learn(x: np.ndarray, bad: np.ndarray, most_rules: int = 12, most_tests: int = 4, precision: float = 0.95, least: int = 5, n_cuts: int = 96, seed: int = 7) -> list[Rule]:
    """Ordered rules that reject; none if the labelled rows don't hold both classes.

    A rule stays only if at least `precision` of the labelled rows that it covers are bad, on the rows it
    was grown on and on those it was pruned on, and it covers `least` bad ones at least.
    """
    rng, rules = np.random.default_rng(seed), []
    left = np.ones(len(x), bool)
    part = rng.random(len(x)) < 2 / 3
    while len(rules) < most_rules and bad[left].sum() >= least and (~bad[left]).any():
        grow, prune = left & part, left & ~part
        if not bad[grow].any() or not prune.any():
            break
        cuts = []
        for j in range(x.shape[1]):
            v = np.unique(x[grow, j])
            mid = (v[1:] + v[:-1]) / 2
            cuts.append(mid if len(mid) <= n_cuts else np.unique(np.concatenate([np.quantile(x[grow, j], np.linspace(0, 1, n_cuts // 2)), np.quantile(x[grow & bad, j], np.linspace(0, 1, n_cuts // 2))])))
        rule = _prune(_grow(x[grow], bad[grow], cuts, most_tests), x[prune], bad[prune])
        hit = rule.covers(x) & left
        good_enough = lambda of: bad[hit & of].sum() >= precision * max(1, (hit & of).sum())
        if not rule.tests or bad[hit].sum() < least or not good_enough(part) or not good_enough(~part):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, **options) -> list[Rule]:
    """The rules, from at most `max_labelled` labelled documents (those whose id hashes lowest).

    labels: (id, quality), 0 for bad; null ids and qualities are no labels. The sample has at most
    that many rows, so it is broadcast and its statistics come to the driver. No labels: no rules.
    """
    known = labels.toDF("_id", "_quality").where(F.col("_id").isNotNull() & F.col("_quality").isNotNull())
    known = known.groupBy("_id").agg(F.min("_quality").alias("_quality"))
    known = settle(known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    text, own = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    rows = docs.select(own.alias("_id"), text.alias("_text")).join(F.broadcast(known), "_id").select("_id", "_quality", stats_of(F.col("_text")).alias("_s"))
    s = lambda n: F.col(f"_s.{n}")
    rows = rows.where(~base_failed(s)).select("_id", "_quality", *(v.alias(k) for k, v in features(s).items()))
    got = rows.orderBy(F.xxhash64("_id"), "_id", *NAMES).limit(max_labelled).toPandas()
    return learn(got[list(NAMES)].to_numpy(float), got["_quality"].to_numpy() == 0, **options)


def apply(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The documents with three more columns, named so that they clash with none: a struct of STATS, base_failed, kept.

    Null, empty and blank texts have no words and fail the base rules. Each row is judged by itself,
    so repeated rows get the same result; any other column passes through. Empty tables stay empty.
    """
    stats, failed, kept = (fresh(x, docs.columns) for x in ("stats", "base_failed", "kept"))
    out = docs.withColumn(stats, stats_of(F.col(f"`{text_col}`")))
    s = lambda n: F.col(f"`{stats}`.{n}")
    of = features(s)
    verdict = F.when(base_failed(s), False)
    for rule in rules:
        verdict = verdict.when(rule.column(of), False)
    return out.withColumn(failed, base_failed(s)).withColumn(kept, verdict.otherwise(True))

"""Near duplicates, substring deduplication, quality rules and mixing against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harrier.llm import components, exchange, minhash, mixing, quality, recompress, suffix_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LAST = float("inf")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def brute_words(corpus, n=13):
    first = {}
    for i, text, *_ in corpus:
        own = words(text)
        for p in range(len(own) - n + 1):
            key = tuple(own[p : p + n])
            first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = Counter()
    for i, text, *_ in corpus:
        own, gone = words(text), set()
        for p in range(len(own) - n + 1):
            if first[tuple(own[p : p + n])] < (LAST if i is None else i):
                gone |= set(range(p, p + n))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out[i, len(own), len(gone), sha(kept.encode())] += 1
    return out


def test_recompress(docs, corpus):
    got = recompress.dedup_words(docs)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(corpus)


def test_recompress_in_small_pieces(docs, corpus, monkeypatch):
    """Texts that don't fit a piece or a block give the same."""
    monkeypatch.setattr(recompress, "PIECE", 50)
    monkeypatch.setattr(exchange, "BLOCK", 40)
    batch = next(iter(docs.select(F.col("doc_id").alias("dkey"), F.col("doc_id").alias("rank"), "text").where("text is not null and doc_id is not null").toArrow().combine_chunks().to_batches()))
    seen = Counter()
    for records in recompress.range_records(batch):
        for r in records:
            for p in range(r["a"], r["a"] + r["m"]):
                seen[int(r["dkey"]), p] += 1
    expected = Counter()
    for i, text in zip(batch.column("dkey").to_pylist(), batch.column("text").to_pylist(), strict=True):
        for p in range(len(words(text)) - 12):
            expected[i, p] += 1
    assert seen == expected


def test_symbols_agree_inside_equal_strings():
    r = np.random.default_rng(2)
    for _ in range(30):
        shared = r.integers(0, 5, 40).astype(np.uint64)
        sides = [np.concatenate([r.integers(0, 5, r.integers(1, 30)).astype(np.uint64), shared, r.integers(0, 5, r.integers(1, 30)).astype(np.uint64)]) for _ in range(2)]
        at = [next(k for k in range(len(s)) if (s[k : k + 40] == shared).all()) for s in sides]
        for one, two in zip(*(recompress.compress(s, 3) for s in sides), strict=True):
            inside = [{(n, s - a, e - a) for n, s, e, lo, hi in zip(x["name"].tolist(), x["start"].tolist(), x["end"].tolist(), x["low"].tolist(), x["high"].tolist(), strict=True) if lo >= a and hi <= a + 40} for x, a in ((one, at[0]), (two, at[1]))]
            assert inside[0] == inside[1]


def brute_bytes(corpus, n=200):
    raw = [(i, (t or "").encode()) for i, t, *_ in corpus]
    count = Counter(b[p : p + n] for _, b in raw for p in range(len(b) - n + 1))
    out = Counter()
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if count[b[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        out[i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))] += 1
    return out


@pytest.mark.parametrize("most", [suffix_dedup.MOST_RANGES, 2])
def test_suffix_dedup(docs, corpus, most, monkeypatch):
    """Also where nearly every anchor has more ranges than a task may sort."""
    monkeypatch.setattr(suffix_dedup, "MOST_RANGES", most)
    got = suffix_dedup.dedup_bytes(docs)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(corpus)


def test_two_stage_sorting():
    r = np.random.default_rng(4)
    for _ in range(100):
        pieces = [bytes(r.choice([97, 98, 99], r.integers(5, 40)).astype(np.uint8)) for _ in range(r.integers(1, 6))]
        counts = [int(r.integers(1, max(2, len(p) - 3))) for p in pieces]
        raw, ends = b"".join(pieces), np.cumsum([len(p) for p in pieces])
        starts = ends - [len(p) for p in pieces]
        wanted = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts, strict=True)])
        end = lambda i: ends[np.searchsorted(ends, i, "right")]  # noqa: B023, E731
        sa = suffix_dedup.suffix_array(np.frombuffer(raw, np.uint8), ends, wanted)
        assert [raw[i : end(i)] for i in sa] == sorted(raw[i : end(i)] for i in wanted)
        assert sorted(sa) == sorted(wanted)
        lcp = suffix_dedup.common_prefixes(np.frombuffer(raw, np.uint8), sa, ends, 9)
        for k in range(1, len(sa)):
            a, b = raw[sa[k - 1] : end(sa[k - 1])], raw[sa[k] : end(sa[k])]
            same = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert lcp[k] == min(same, 9)


def brute_near(corpus, k=5, percent=75):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, *_ in corpus:
        own = words((text or "").translate(low))
        sets.append(frozenset(zip(*(own[j:] for j in range(k)), strict=False)) if len(own) >= k else frozenset([tuple(own)] if own else []))
    parent = list(range(len(corpus)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for a, row in enumerate(corpus):
        if row[0] is not None:
            ids[find(a)].append(row[0])
    out = Counter()
    for a, row in enumerate(corpus):
        least = row[0] if not sets[a] else min(ids[find(a)], default=None)
        out[row[0], len(sets[a]), least, row[0] == least] += 1
    return out, sets, [find(a) for a in range(len(corpus))]


def test_near_duplicates(docs, corpus):
    got = minhash.near_duplicates(docs).cache()
    expected, sets, group = brute_near(corpus)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == expected
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({g for g, s in zip(group, sets, strict=True) if s}) + sum(not s for s in sets)


def test_large_group_of_near_copies(spark):
    """Every neighbour in a chain links; the ends don't: one component, found without all pairs."""
    base = [f"w{i}" for i in range(300)]
    rows, own = [], list(base)
    for i in range(120):
        rows.append((i, " ".join(own)))
        own[(7 * i) % 300] = f"n{i}"
    corpus = [(i, t) for i, t in rows]
    expected, _, _ = brute_near(corpus)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == expected


def test_sketches():
    r = np.random.default_rng(0)
    for n in (1, 3, 40, 3000):
        items = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        s = minhash.sketch(items)
        assert (s != np.uint64(2**64 - 1)).all()
        assert (s == minhash.sketch(items[::-1])).all()
    errors = []
    for _ in range(60):
        items = r.integers(0, 2**63, 700).astype(np.uint64)
        a, b = items[:600], items[100:]
        errors.append((minhash.sketch(a) == minhash.sketch(b)).mean() - 500 / 700)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.045


def test_components(spark):
    edges = [(b"a", b"b"), (b"b", b"c"), (b"x", b"y"), (b"q", b"q"), (b"c", b"a")] + [(bytes([100, i]), bytes([100, i + 1])) for i in range(40)]
    got = {bytes(r.node): bytes(r.label) for r in components.components(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "a binary, b binary")).collect()}
    assert got[b"a"] == got[b"b"] == got[b"c"] == b"a"
    assert got[b"y"] == b"x"
    assert {v for k, v in got.items() if k[0] == 100} == {bytes([100, 0])}
    assert b"q" not in got


def brute_stats(text):
    own = words(text)
    triples = Counter(zip(own, own[1:], own[2:], strict=False))
    hit = {p + k for p, t in enumerate(zip(own, own[1:], own[2:], strict=False)) if triples[t] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    return len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_quality(spark, docs, corpus):
    extra = [(900, "é ü\nx\nx\n\n \nx | & #\n", "en", "a", 1), (901, "a b c a b c d", "en", "a", 1)]
    own = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"kept": F.lit(5), "STATS": F.lit("x"), "base_failed": F.lit(1)})
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(50)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality.apply(own, quality.fit(docs, labels))
    got = out.select("doc_id", "text", *(F.col(f"`_stats`.{x}") for x in quality.BASE), "_base_failed", "_kept").collect()
    assert out.where("kept = 5 and `STATS` = 'x'").count() == len(got) == len(corpus) + 2
    for r in got:
        assert tuple(r[2:7]) == brute_stats(r.text)
        assert r["_base_failed"] == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r["_base_failed"] and r["_kept"])


def test_decision_list():
    r = np.random.default_rng(1)
    x = r.random((3000, len(quality.NAMES)))
    bad = ((x[:, 1] > 0.8) & (x[:, 3] < 0.5)) | (x[:, 5] > 0.95)
    rules = quality.learn(x, bad)
    hit = np.any([rule.covers(x) for rule in rules], axis=0)
    assert (hit == bad).mean() > 0.97
    held = r.random((3000, len(quality.NAMES)))
    truth = ((held[:, 1] > 0.8) & (held[:, 3] < 0.5)) | (held[:, 5] > 0.95)
    assert (np.any([rule.covers(held) for rule in rules], axis=0) == truth).mean() > 0.97
    assert quality.learn(x, np.zeros(3000, bool)) == []
    noise = quality.learn(x, r.random(3000) < 0.2)
    assert not noise or np.any([rule.covers(x) for rule in noise], axis=0).mean() < 0.02


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else rest * w[s] / sum(w[t] for t in names if t not in full) for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_mixing(docs, corpus):
    got = mixing.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for _, text, _, source, _ in corpus:
        sizes[source] += len(words(text))
    target = filled(sizes)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken >= r.size * int(target[r.source] // sizes[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    out = mixing.mixed_documents(docs.withColumn("Copies", F.lit(1)))
    assert out.columns == [*docs.columns, "Copies"]
    assert sum(len(words(r.text)) for r in out.collect()) == sum(taken.values())


def test_mixing_prefers_quality(spark):
    rows = [(i, " ".join(["word"] * 10 if i % 2 else ["wo#*%rd"] * 10), "ab"[i % 3 > 0]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 6), share=1.0)
    by = {r[0]: r[1] for r in got.where("source = 'a'").groupBy((F.col("doc_id") % 2).alias("clean")).agg(F.avg("taken")).collect()}
    assert by[1] > 2 * by[0]


def test_mixing_of_low_weights(spark, monkeypatch):
    """Documents of low quality are drawn too, not taken by id; and cells are cut until few documents are left."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.expr("repeat('w#####%% ', 10)").alias("text"), F.lit("a").alias("source"))
    plain = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.5, most=1).collect()}
    assert sum(plain.values()) == 100_000
    taken = [i for i, n in plain.items() if n]
    assert len(taken) == 10_000
    assert abs(sum(taken) / len(taken) - 10_000) < 250  # a mean of ids that are drawn at random
    monkeypatch.setattr(mixing, "ROWS", 3)
    assert {r.doc_id: r.taken for r in mixing.mix(docs, share=0.5, most=1).collect()} == plain


def test_mixing_of_repeated_rows(spark):
    rows = [(None, "one two three", "a")] * 500 + [(7, "one two three four", "a")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = [(r.doc_id, r.taken) for r in mixing.mix(docs, share=0.5, most=1).collect()]
    assert sum(n for _, n in got) == 1750
    whole = [n for _, n in got if n]
    assert len([n for i, n in got if n not in (0, 3 if i is None else 4)]) <= 1  # one document crosses the budget
    assert len(whole) >= 437


def test_empty_tables(spark, nothing):
    assert recompress.dedup_words(nothing).count() == 0
    assert suffix_dedup.dedup_bytes(nothing).count() == 0
    assert suffix_dedup.deduplicated(nothing).columns == nothing.columns
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.deduplicated(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_documents(nothing).count() == 0
    assert quality.fit(nothing, nothing.select("doc_id", F.lit(1))) == []
    assert quality.apply(nothing, []).count() == 0


def test_clashing_columns(docs):
    own = docs.withColumns({c: F.lit(1) for c in ("dedup_key", "DEDUP_ALL", "tkey", "row_key", "single", "dkey", "rank", "answers", "node", "all")})
    for f in (suffix_dedup.deduplicated, minhash.deduplicated, mixing.mixed_documents):
        out = f(own)
        assert out.columns == own.columns
        assert out.where("single <> 1 or `DEDUP_ALL` <> 1").count() == 0


def test_deduplicated_texts_stay_valid(docs, corpus):
    got = Counter((r.doc_id, r.text) for r in suffix_dedup.deduplicated(docs).collect())
    assert sum(got.values()) == len(corpus)
    assert (None, None) in got
    assert all("\ufffd" not in (t or "") for _, t in got)

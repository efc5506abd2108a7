"""Packing and image copies."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harrier.llm import media, media_fixture, packing
from harrier.llm.queries import tokenizer_path


def best(at, penalty, length):
    """The cheapest cuts by trying every earlier cut."""
    cost = [0.0] + [np.inf] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= length:
                whole = n & (n - 1) == 0 and (at[j] > at[-1] - length or n == length)
                cost[j] = min(cost[j], cost[i] + (0 if whole else length - n) + penalty[j])
    return cost[-1]


def test_program_is_optimal():
    r = np.random.default_rng(0)
    for _ in range(60):
        length = int(r.choice([8, 16]))
        at = np.unique(np.concatenate([[0], np.cumsum(r.integers(1, length // 2, 40))]))
        penalty = r.choice([0.0, 1.0, 3.0], len(at))
        penalty[0] = penalty[-1] = 0
        cuts = packing.cuts(at, penalty, length)
        assert cuts[0] == 0
        assert cuts[-1] == at[-1]
        price = dict(zip(at.tolist(), penalty, strict=True))
        total = 0.0
        for a, b in zip(cuts, cuts[1:], strict=False):
            n = b - a
            assert 0 < n <= length
            total += (0 if n & (n - 1) == 0 and (b > at[-1] - length or n == length) else length - n) + price[b]
        assert total == pytest.approx(best(at, penalty, length))


def test_pack(spark, docs, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    long = spark.createDataFrame([(777, " ".join(f"tok{i % 97}" for i in range(30_000)), "en", "a", 1)], docs.schema)
    got = packing.pack(docs.unionByName(long).withColumn("length", F.lit(1)), tokenizer_path()).collect()
    expected = defaultdict(int)
    for i, text, *_ in [*corpus, *map(tuple, long.collect())]:
        expected[i, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    padding = total = 0
    found, left = defaultdict(int), []
    for key in sorted(sequences):
        own = sorted(sequences[key], key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        n = sum(r.length for r in own)
        assert n <= 2048
        total += n
        padding += 0 if n & (n - 1) == 0 else 2048 - n
        for r in own:  # a document's pieces stand one after another
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.length
            if r.start == 0:
                left = []
            assert r.start == len(left)
            left = left + ids
            if len(left) == r.doc_tokens:
                found[r.doc_id, tuple(left)] += 1
    assert found == expected
    assert padding < 0.03 * total
    assert packing.pack(docs.where("false"), tokenizer_path()).count() == 0


def test_words_tokenize_like_whole_texts():
    tokens = packing.Tokens(tokenizer_path())
    texts = ["Don't stop. ΑΣ ΑΣ, naïve é́x", "a\u00a0b\u3000c \x85 \x1c d", "x" * 3000, "日本語 テキスト🙂🙂", "12,345.67 <b>&amp;</b>", "", "   "]
    for text, (ids, after, _) in zip(texts, tokens.encode([x.encode() for x in texts]), strict=True):
        assert ids.tolist() == [*tokens.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert len(after) == len(text.encode().split())


IMAGES = "image_id long, data binary, width int, height int, channels int"


def row(i, image, channels=1):
    raw = np.clip(np.rint(image), 0, 255).astype(np.uint8)
    if channels == 3:
        raw = np.repeat(raw[..., None], 3, axis=2)
    return (i, bytearray(raw.tobytes()), raw.shape[1], raw.shape[0], channels)


def test_image_copies(spark):
    own = [media_fixture.render(bytes([i])) for i in range(12)]
    rows = [row(i, x) for i, x in enumerate(own)]
    rows += [row(100 + i, media_fixture.edited(own[i], i)) for i in range(9)]
    rows += [row(200, own[3], 3), row(201, own[4]), row(201, own[4])]
    rows += [(300, None, 1, 1, 1), (301, None, 1, 1, 1), (302, bytearray(b"abc"), 5, 5, 1), (303, bytearray(b""), 0, 0, 0), row(304, np.zeros((64, 64))), row(None, own[5])]
    got = media.image_copies(spark.createDataFrame(rows, IMAGES).withColumn("node", F.lit(1)).repartition(3)).collect()
    assert len(got) == len(rows)
    of = {r.image_id: r.component_id for r in got}
    assert all(of[i] == i for i in range(12))
    assert all(of[100 + i] == i for i in range(9))
    assert of[200] == 3
    assert of[201] == 4
    assert of[None] == 5
    assert of[301] == of[300] == 300
    assert of[302] == 302
    assert [r.n_features for r in got if r.image_id == 304] == [0]
    assert media.image_copies(spark.createDataFrame([], IMAGES)).count() == 0


EDITS = {
    "half": lambda x: x[len(x) // 5 : len(x) // 5 + len(x) // 2, len(x) // 4 : len(x) // 4 + len(x) // 2],
    "two thirds": lambda x: x[len(x) // 8 : len(x) // 8 + 2 * len(x) // 3, len(x) // 6 : len(x) // 6 + 2 * len(x) // 3],
    "scale 0.8": lambda x: media_fixture.scaled(x, 0.8),
    "scale 1.25": lambda x: media_fixture.scaled(x, 1.25),
    "noise": lambda x: x + np.random.default_rng(3).normal(0, 12, x.shape),
    "brightness": lambda x: x * 0.8 + 30,
    "turn": np.rot90,
    "recompression": lambda x: media_fixture.recompressed(x, 8),
}


@pytest.mark.parametrize(("side", "n"), [(96, 40), (384, 8)])
def test_recall_of_each_edit(side, n):
    """Copies that share enough keys and pass the comparison; and none of other images does. Measured at 96 pixels: half 0.93, scale 0.8 0.97, others 1.00."""
    clean = lambda x: media.features(np.clip(np.rint(x), 0, 255))
    images = [media_fixture.render(bytes([i, 77]), side) for i in range(n)]
    own = [clean(x) for x in images]
    for name, edit in EDITS.items():
        found = 0
        for image, x in zip(images, own, strict=True):
            y = clean(edit(image))
            found += len(np.intersect1d(media.keys(x), media.keys(y))) >= media.MIN_SHARED and media.same_image(x, y)
        assert found >= 0.9 * n, (name, found)
    assert not any(media.same_image(x, y) for x, y in zip(own, own[1:], strict=False))


def test_images_of_vectors(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)] + [(50, [3.0, 1.0]), (51, None), (None, [9.0])], "vec_id long, embedding array<float>")
    got = {r.image_id: r.component_id for r in media.image_copies(media_fixture.images(vectors)).collect()}
    assert {k: v for k, v in got.items() if k is not None and k != v} == {1: 0, 33: 32, 65: 64, 100: 6}


def test_crc(spark):
    assert spark.range(1).select(F.crc32(F.lit(bytearray(b"abcd")))).first()[0] == zlib.crc32(b"abcd")

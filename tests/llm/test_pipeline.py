"""The pipeline against its stages by brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from harrier.llm import queries
from test_words import brute_near, words


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_stages(spark, docs, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "repeated strings", "mixed sources", "packed"]
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in now.collect()]
        now = stage(spark, now, folder).cache()
        after = [tuple(r) for r in now.collect()]
        if k < 4:
            assert now.columns == docs.columns, name
        if name == "quality rules":
            assert not Counter(after) - Counter(before)
            assert all(len(words(r[1])) >= 50 for r in after)
        if name == "near duplicates":
            _, sets, group = brute_near(before)
            assert len(after) == len(set(group))
            assert not Counter(after) - Counter(before)
        if name == "repeated strings":
            assert Counter(r[0] for r in after) == Counter(r[0] for r in before)
            assert all(r[4] == len(r[1]) for r in after)
        if name == "mixed sources":
            size = Counter()
            for r in before:
                size[r[3]] += len(words(r[1]))
            total = sum(len(words(r[1])) for r in after)
            assert abs(total - min(1.5, 2) * sum(size.values())) <= len(size) + 1
        if name == "packed":
            assert now.agg(F.sum("length")).first()[0] == sum(np.unique([0])) + now.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
            assert now.where("start = 0").count() == len(before)


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES}
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", [q for q in queries.ORACLES])
def test_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rows = queries.QUERIES[name](spark, sf)
    columns = sorted(rows.columns)
    theirs = con.sql(queries.ORACLES[name])
    assert sorted(theirs.columns) == columns
    own = [tuple(repr(r[c]) for c in columns) for r in rows.collect()]
    other = [tuple(repr(dict(zip(theirs.columns, r, strict=True))[c]) for c in columns) for r in theirs.fetchall()]
    assert sorted(own) == sorted(other)

"""Bounds of what is sampled, read and scored, and extra columns with clashing names."""

import numpy as np
import pandas as pd
from korvane.llm import langid, quality, vectors, warc
from pyspark.sql import functions as F


def test_a_query_scores_only_the_codes_of_the_cells_it_reads():
    rng = np.random.default_rng(0)
    x = vectors.unit(rng.standard_normal((3000, 12)))
    index = vectors.Index(vectors.k_means(x, 40, 5), x)
    cell = np.sort(vectors.nearest(x, index.centres)[:2000])
    cell = cell[cell != 7]  # a cell that no vector of the group lies in
    codes = rng.integers(0, 256, (len(cell), len(index.cuts))).astype(np.uint8)
    q = vectors.unit(rng.standard_normal((9, 12)))
    reads = [rng.choice(60, k * 3, replace=False) for k in range(9)]
    held = vectors.Cells(index, cell, codes)
    every = index.distances(q, cell, codes)
    for i, (at, d) in enumerate(held.read(q, reads)):
        assert sorted(at) == np.flatnonzero(np.isin(cell, reads[i])).tolist()
        assert np.allclose(d, every[i, at], atol=1e-12)
    assert held.scored == sum(np.isin(cell, r).sum() for r in reads) < len(cell) * len(q)


def test_language_samples_keep_to_their_bounds(spark):
    rows = [(k, f"mot {k} " * 20, f"l{k % 40}" if k % 10 else "big") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    size = lambda df: int(df["text"].str.len().sum())
    some = langid.labelled_sample(docs, 30, 1 << 20)
    assert some["lang"].nunique() == docs.select("lang").distinct().count() and some.groupby("lang").size().max() <= 60
    assert size(langid.labelled_sample(docs, 10**6, 1 << 20, total_bytes=40_000)) < 60_000
    few = langid.labelled_sample(docs, 30, 1 << 20, most_langs=3)
    assert few["lang"].nunique() == 3 and "big" in set(few["lang"])


def test_quality_samples_keep_to_their_bounds(spark):
    docs = spark.createDataFrame([(k, "x" * (100_000 if k == 7 else 100)) for k in range(900)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(900)] + [(2, 1, 0), (4, 7, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    rows, share = quality.labelled_sample(docs, labels, 10_000)
    of = dict(zip(rows["doc_id"], rows["y"], strict=True))
    assert len(rows) == len(of) > 500 and 0.4 < share < 0.6
    # Of several labels the largest counts; those that are no label count for nothing.
    assert of.get(2, 1) == 1 and of.get(4, 0) == 0
    few, _ = quality.labelled_sample(docs, labels, 10_000, most_bytes=2000)
    assert few.groupby("y")["text"].apply(lambda t: t.str.len().sum()).max() <= 2000 + 100_000 and few.groupby("y").size().min() >= 1
    assert 20 < len(few) < 60 or 7 in set(few["doc_id"])
    pd.testing.assert_frame_equal(few, quality.labelled_sample(docs, labels, 10_000, most_bytes=2000)[0])
    plain = quality.score(docs.limit(0).union(spark.createDataFrame([(1, "é")], "doc_id long, text string")), {"prior": 0.25}).collect()
    assert [tuple(r) for r in plain] == [(1, 2, 0, 0, 0.25)]


def test_clashing_columns_of_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(c) for c in rng.standard_normal(4)], k % 2) for k in range(60)] + [(70, [1.0, 0.0, 0.0, 0.0], 0), (71, [2.0, 0.0, 0.0, 0.0], 0)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    more = plain.select("*", *[F.lit("clash").alias(c) for c in ("id", "query", "cell", "node", "dim", "score", "rank", "ids", "component", "n_links", "kept", "home", "vector", "weight", "least")])
    told = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert told(vectors.near_vectors(more)) == told(vectors.near_vectors(plain))
    assert told(vectors.search(more, F.col("vec_id") % 10 == 0)) == told(vectors.search(plain, F.col("vec_id") % 10 == 0))
    empty = plain.where("false")
    assert vectors.near_vectors(empty).collect() == [] == vectors.search(empty, F.col("vec_id") % 10 == 0).collect()


def test_clashing_columns_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a/1", "x" * 1500), (2, "http://a/2", "x" * 1500), (3, None, None)], "page_id long, url string, html string")
    more = pages.select("*", *[F.lit("clash").alias(c) for c in ("payload", "digest", "record_type", "refers_to", "payload_bytes", "payload_digest", "id")])
    a, b = warc.page_records(pages), warc.page_records(more)
    common = [c for c in a.columns if c in b.columns]
    assert common and sorted(map(repr, a.select(common).collect())) == sorted(map(repr, b.select(common).collect()))

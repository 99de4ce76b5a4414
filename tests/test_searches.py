"""Searches in large indexes: bounds of exact search, and the stored full-text index."""

import numpy as np
from korvane.operators import fulltext, retrieval
from pyspark.sql import functions as F


def test_bounded_search_is_exact_and_scores_less(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "GROUP", 50)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 6)) * 5
    rows = [(k, [float(c) for c in centres[k % 12] + rng.standard_normal(6) * 0.2], k % 2) for k in range(600)]
    rows += [(700, None, 0), (701, [0.0] * 6, 0), (702, [1.0], 0), (703, [1.0] * 6, 5), (704, rows[0][1], 0), (705, [2 * c for c in rows[0][1]], 0)]
    index = spark.createDataFrame(rows, "id long, e array<double>, label int")
    asked = index.where("id % 10 = 0 OR id > 699").select(F.col("id").alias("query_id"), F.col("e").alias("query_vector"), "label")
    told = lambda df: {(r["query_id"], r["rank"]): round(r["score"], 9) for r in df.collect()}
    assert told(retrieval.search_bounded(index, asked, 4, "id", "e", ["label"])) == told(retrieval.search_many(index, asked, 4, "id", "e", ["label"]))
    every = sum(len([r for r in rows if r[1] and len(r[1]) == 6 and any(r[1]) and r[2] == q[2] and r[0] != q[0]]) for q in rows if (q[0] % 10 == 0 or q[0] > 699) and q[1] and len(q[1]) == 6 and any(q[1]))
    scored = retrieval.scored_pairs(index, asked, 4, "id", "e", ["label"])
    assert scored.count() == scored.select("query_id", "id").distinct().count() < 0.6 * every


def test_stored_index_finds_what_the_search_finds(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Le zonage des lots, le ZONAGE", "avis"), (2, "un lot zoné", None), (3, None, "zonage"), (4, "", ""), (5, "rien ici", "rien"), (6, "Le zonage", "avis")], "id long, text string, title string")
    fields, path = [("text", "B"), ("title", "A")], f"file://{tmp_path}/index"
    fulltext.build_index(docs, fields, "id", path, 8)
    for q in ("Zonage lots", "avis", "absent", ""):
        a = [(r["id"], round(r["score"], 9), r["n_words"]) for r in fulltext.search(docs, fields, q, 4, "id").collect()] if q else []
        assert [(r["key"], round(r["score"], 9), r["n_words"]) for r in fulltext.search_index(spark, path, q, 4, 8).collect()] == a
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = fulltext.postings(spark, path, ["zonage"], 8)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(word,zonage)" in plan, plan
    held = {r["word"]: r["n_docs"] for r in spark.read.parquet(path).select("word", "n_docs").distinct().collect()}
    assert held["zonage"] == 3 and held["avis"] == 2
    fulltext.build_index(docs, fields, "id", path + "s", 8, stemmed=True)
    assert [r["key"] for r in fulltext.search_index(spark, path + "s", "lots", 4, 8, stemmed=True).collect()] == [1, 2]


def test_stems(spark):
    cases = {"logements": "log", "logement": "log", "municipaux": "municipal", "municipal": "municipal", "bureaux": "bureau", "zones": "zon", "zone": "zon", "lots": "lot", "lot": "lot", "actives": "actif", "2024s": "2024s", "rue": "rue", "demolitions": "demolition"}
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, w string").select("i", fulltext.stem(F.col("w")).alias("s")).orderBy("i").collect()
    assert dict(zip(cases, [r["s"] for r in rows], strict=True)) == cases

"""The pipeline's stages, each on what the one before kept, against the operators' own results row by row."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from korvane.llm import langid, mixing, packing, quality, simhash
from korvane.llm.common import stage

SF = "/root/testdata/sf0.01"


def test_stages_are_the_contract():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "mixing sources to target weights", "packing"]


def test_each_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    start = docs.toPandas()

    good = stage(quality.keep_good(spark, docs, SF), "t0")
    model = quality.fit(docs, labels)
    sizes = quality.sizer(model["good"], model["bad"])
    x = quality.features(np.array([sizes(t) for t in start["text"]]))
    keep = 1 / (1 + np.exp(-np.clip(x @ model["w"], -30, 30))) >= min(0.5, model["keep_from"])
    kept = good.toPandas()
    assert good.columns == columns and sorted(kept["doc_id"]) == sorted(start["doc_id"][keep])
    marks = labels.toPandas().merge(kept[["doc_id"]].drop_duplicates().assign(kept=True), "left", "doc_id")
    held = marks[[zlib.crc32(str(i).encode()) % 3 == 1 for i in marks["doc_id"]]]
    assert held[held["quality"] == 1]["kept"].notna().mean() > 0.97
    assert held[held["quality"] == 0]["kept"].isna().mean() > 0.6

    known = stage(langid.keep_identified(spark, good, SF), "t1")
    assert known.columns == columns and known.count() >= 0.99 * len(kept)
    model = langid.fit(good)
    said = {r["id"] for r in langid.predict(good, model).where("accepted").collect()}
    assert {r["doc_id"] for r in known.select("doc_id").collect()} == said

    single = stage(simhash.keep_one(spark, known, SF), "t2")
    rows = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in known.collect()}
    ids = sorted(rows)
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    fps = np.array([rows[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[k]) <= 4):
            a, b = sorted((find(i), find(ids[j])))
            label[b] = a
    assert single.columns == columns and sorted(r["doc_id"] for r in single.select("doc_id").collect()) == sorted({find(i) for i in ids})

    mixed = stage(mixing.mixed(spark, single, SF), "t3")
    expected = Counter(r["doc_id"] for r in mixing.replicate(single, mixing.rates(single)).collect())
    assert mixed.columns == columns and Counter(r["doc_id"] for r in mixed.collect()) == expected

    pieces = packing.packed(spark, mixed, SF).toPandas()
    tokens = pieces.groupby("doc_uid")
    assert tokens.ngroups == mixed.count() and (tokens["length"].sum() == tokens["doc_tokens"].first()).all()
    assert Counter(tokens["doc_id"].first()) == expected

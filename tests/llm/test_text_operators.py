"""SimHash, quality, language, mixing and packing, against brute force and on awkward rows."""

import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from korvane.llm import langid, mixing, packing, quality, simhash
from korvane.llm.common import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(WORDS, int(rng.integers(1, 200)))) for _ in range(60)]
    texts += [texts[0], texts[0], texts[1] + " extra", None, "", "   \n", "12 34 -- !!", "ünïcödé Ärger ß", "a" * 5000, "x " * 60000, "<|endoftext|> it's 3rd\x00\x1c don't"]
    rows = [(k, t, "en", "hot" if k % 3 else f"s{k % 7}", len(t or ""), "kept", 9) for k, t in enumerate(texts)]
    rows += [rows[5], (None, "no id here at all today", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component string, copy int")


def slow_fingerprint(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, fps, near):
    label = {k: i for k, i in enumerate(ids)}
    changed = True
    while changed:
        changed = False
        for a in range(len(ids)):
            for b in range(len(ids)):
                if near(fps[a], fps[b]) and label[b] is not None and (label[a] is None or label[b] < label[a]):
                    label[a], changed = label[b], True
    return label


def test_simhash_equals_brute_force(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert Counter((r["id"], r["fp"] % 2**64) for r in rows) == Counter((r["doc_id"], slow_fingerprint(r["text"])) for r in docs.collect())
    ids, fps = [r["id"] for r in rows], [r["fp"] % 2**64 for r in rows]
    expected = smallest_reachable(ids, fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert [r["component"] for r in rows] == [expected[k] for k in range(len(rows))]


@pytest.mark.parametrize("distance", [1, 2, 4])
@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_block_keys_meet_all_close_pairs(n, distance):
    rng = np.random.default_rng(n % 97 + distance)
    keys = simhash.block_keys(n, distance)
    for _ in range(200):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, distance, replace=False):
            b ^= 1 << int(bit)
        assert any(all((a ^ b) >> f & (1 << w) - 1 == 0 for f, w in key) for key in keys)


@pytest.mark.parametrize("chunk", [4, 16, 60])
def test_simhash_splits_hot_keys(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**62))
    fps = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (150, 2))} | {int(x) for x in rng.integers(0, 2**62, 100)}
    distinct = spark.createDataFrame([(f, k) for k, f in enumerate(sorted(fps))], "fp long, rep long")
    found = {r["node"]: r["component"] for r in components(simhash.links(distinct)).collect()}
    ordered = sorted(fps)
    expected = smallest_reachable(list(range(len(ordered))), ordered, lambda a, b: (a ^ b).bit_count() <= 4)
    assert all(found.get(k, k) == expected[k] for k in range(len(ordered)))


def test_simhash_stage_keeps_one_of_each_group(docs, spark):
    kept = simhash.keep_one(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 0 in ids and 60 not in ids and 61 not in ids and ids.count(5) == 1


def test_simhash_of_null_and_repeated_ids(spark):
    rng = np.random.default_rng(11)
    texts = [" ".join(rng.choice(WORDS, 80)) for _ in range(8)]
    big = 2**60 + 1
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3]), (9, texts[4]), (None, texts[4]), (big, texts[5]), (None, None), (7, texts[6])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(table).collect()
    component = {(r["id"], r["fp"] % 2**64): r["component"] for r in found}
    of = lambda i, t: component[i, slow_fingerprint(t)]
    assert len(found) == len(rows)
    assert of(None, texts[0]) is None and of(7, texts[2]) == of(7, texts[3]) == of(8, texts[3]) == 7 and of(None, texts[4]) == 9 and of(big, texts[5]) == big
    kept = Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(spark, table, "").collect())
    assert kept == Counter([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4]), (big, texts[5]), (None, None), (7, texts[6])])


def test_simhash_links_through_rows_without_ids(spark, monkeypatch):
    fps = {"a": 0, "b": 0b1111, "c": 0b11111111, "far": 2**63 - 1}
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *a, **k: docs)
    rows = spark.createDataFrame([(5, fps["a"]), (None, fps["b"]), (3, fps["c"]), (3, fps["far"])], "id long, fp long")
    got = {(r["id"], r["fp"]): r["component"] for r in simhash.near_duplicates(rows).collect()}
    assert got == {(5, fps["a"]): 3, (None, fps["b"]): 3, (3, fps["c"]): 3, (3, fps["far"]): 3}
    by = {r["fp"]: r["root"] for r in simhash.groups(rows).collect()}
    assert by[fps["a"]] == by[fps["b"]] == by[fps["c"]] != by[fps["far"]]


def test_quality_learns_and_takes_all_rows(spark, docs):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(WORDS, 60)) for _ in range(240)]
    bad = ["## " + " | ".join(w[::-1] + "$$" for w in rng.choice(WORDS, 60)) for _ in range(240)]
    rows = [(k, t) for k, t in enumerate(x for pair in zip(good, bad, strict=True) for x in pair)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, (k + 1) % 2, 0) for k in range(480)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(table, labels)
    out = {r["id"]: r["score"] for r in quality.score(table, model).collect()}
    held = [k for k in out if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([(out[k] >= 0.5) == (k % 2 == 0) for k in held]) > 0.97
    odd = quality.score(docs, model)
    assert odd.count() == docs.count() and odd.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.fit(docs, none)).count() == 0


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.predict(docs, langid.fit(docs, most=300)).join(docs.withColumnRenamed("doc_id", "id"), "id").collect()
    held = [r for r in rows if zlib.crc32(str(r["id"]).encode()) % 4 == 2]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98


def test_language_of_awkward_rows(docs):
    model = langid.fit(docs)
    rows = langid.predict(docs, model).collect()
    by = {r["id"]: r for r in rows}
    assert len(rows) == docs.count()
    for k, r in ((d["doc_id"], d) for d in docs.collect()):
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (by[k]["lang_pred"] == "und") == (not letters) and 0 <= by[k]["score"] <= 1
    empty = docs.limit(0)
    assert langid.predict(empty, langid.fit(empty)).count() == 0


def test_every_language_is_learnt(spark):
    rows = [(k, f"wort{k // 8} text", f"l{k // 8:03}") for k in range(8 * 410)]
    rows += [(90_000 + k, "wort", f"rare{k}") for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.labelled_sample(table, 800, 8 << 20)
    learnt = {x for i, _, x in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(found["lang"]) == learnt and len(learnt) > 430
    assert langid.labelled_sample(table, 800, 20).groupby("lang").size().mean() < 3
    assert set(langid.fit(table.where("lang LIKE 'rare%'"))["langs"]) == {x for x in learnt if x.startswith("rare")}


def test_language_equals_brute_force(spark, docs):
    """Whole predictions text by text: every n-gram of every word by itself, no table, batch or cache."""
    import math
    import re

    model = langid.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))

    def slow(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        total, n = np.zeros(len(model["langs"])), 0
        for word in re.findall("[a-z\x80-\U0010ffff]+", low):
            raw = b"<" + word.encode() + b">"
            for size in langid.SIZES:
                for k in range(len(raw) - size + 1):
                    h = 14695981039346656037
                    for c in raw[k : k + size]:
                        h = (h ^ c) * 1099511628211 % 2**64
                    total += model["scores"][(h ^ h >> 29) % langid.BUCKETS]
                    n += 1
        z = (total / max(n, 1) + model["bias"]) / model["heat"]
        p = [math.exp(x - z.max()) for x in z]
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        return model["langs"][int(np.argmax(p))], max(p) / sum(p)

    short = docs.where("length(text) < 3000 OR text IS NULL")
    rows = langid.predict(short, model).collect()
    expected = {r["doc_id"]: slow(r["text"]) for r in short.collect()}
    assert len(rows) == short.count()
    for r in rows:
        lang, p = expected[r["id"]]
        assert r["lang_pred"] == lang and abs(r["score"] - p) < 1e-5


def test_quality_equals_brute_force(spark, docs):
    """Whole scores text by text, with compressors made anew for each."""
    import math

    import zstandard

    sf = "/root/testdata/sf0.01"
    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))

    def size(raw, part):
        kind = zstandard.DICT_TYPE_AUTO if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        return len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind), write_content_size=False, write_dict_id=False).compress(part))

    for r in quality.score(docs, model).collect():
        raw = next((d["text"] for d in docs.collect() if d["doc_id"] == r["id"]), None)
        raw = (raw or "").encode()
        parts = [raw[k : k + 2048] for k in range(0, len(raw), 2048)]
        good, bad = (sum(size(model[c], p) for p in parts) for c in ("good", "bad"))
        score = 1 / (1 + math.exp(-(model["w"][0] + model["w"][1] * 10 * (bad - good) / max(len(raw), 1))))
        assert (r["bytes"], r["good_bytes"], r["bad_bytes"]) == (len(raw), good, bad) and abs(r["score"] - score) < 1e-9
    assert quality.score(docs.limit(0), model).count() == 0


def test_filter_stages_on_awkward_rows(spark, docs, tmp_path):
    """Nulls, blank texts, repeated rows, clashing columns and empty tables, by the stages' own rules."""
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert quality.keep_good(spark, docs, folder).count() == docs.count()
    sf = "/root/testdata/sf0.01"
    for stage_of in (quality.keep_good, langid.keep_identified, simhash.keep_one, mixing.mixed):
        out = stage_of(spark, docs, sf)
        assert out.columns == docs.columns and out.count() <= docs.count() * 4
        assert stage_of(spark, docs.limit(0), sf).count() == 0
    model = langid.fit(docs)
    said = Counter((r["id"], r["accepted"]) for r in langid.predict(docs, model).collect())
    kept = Counter(r["doc_id"] for r in langid.keep_identified(spark, docs, sf).collect())
    assert kept == Counter({i: n for (i, ok), n in said.items() if ok})
    assert packing.packed(spark, docs, sf).select("doc_uid").distinct().count() == docs.count()
    assert packing.packed(spark, docs.limit(0), sf).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(spark, unlabelled, sf).count() == sum(any(c.isalpha() for c in r["text"] or "") for r in docs.collect())


def test_temperature_comes_from_whole_texts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    seen = []
    real = langid.softmax
    monkeypatch.setattr(langid, "softmax", lambda z: seen.append(z) or real(z))
    rows = [(k, " ".join(["same"] * 40 + [("aaa" if k % 2 else "zzz") + str(rng.integers(9))] * 400), "a" if k % 2 else "z") for k in range(60)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    logits = seen[0] * 2.0**-4
    assert len(logits) and np.ptp(logits[:, 0] - logits[:, 1]) > 1e-3 and model["langs"] == ["a", "z"]


def test_subwords_are_those_of_each_word_alone():
    words = [b"ab", b"xyz", b"q"]
    grams, owner = langid.subwords(words)
    for k, w in enumerate(words):
        assert sorted(grams[owner == k]) == sorted(langid.subwords([w])[0])


def test_unseen_words_are_summed_in_parts():
    """All words of a slice summed at once took a worker some 200 MB beside its texts."""
    rng = np.random.default_rng(3)
    model = {"langs": ["a", "b", "c", "d"], "scores": rng.normal(size=(langid.BUCKETS, 4)).astype(np.float32)}
    words = [*(b"wort%x" % k for k in range(100_000)), b"", b"w" * 200_000, b"end"]
    grams, owner = langid.subwords(words)
    whole = np.stack([np.bincount(owner, s, len(words)) for s in (*model["scores"][grams].T, None)], 1)
    sums = langid.Sums(model)
    assert [sums[w] for w in words] == [*range(len(words))]
    tracemalloc.start()
    table = sums.table()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(table, whole)
    assert peak < 64 << 20
    assert langid.Sums(model).table().shape == (0, 5)


def test_mixing_equals_sql(docs):
    documents = docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas()
    documents["n_chars"] = documents["n_chars"].astype("Int64")
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    expected = con.execute(mixing.OP4_SQL).df()
    out = mixing.mix(docs.drop("component")).toPandas()
    key = lambda t: sorted(zip(t["shuffle_key"], t["copy"], t["rate"].round(9), strict=True))
    assert key(out) == key(expected)
    assert "copy_input" in out.columns and set(out["copy_input"].dropna()) == {9.0}


def test_mixing_stage_keeps_clashing_columns(spark, docs):
    out = mixing.mixed(spark, docs, "")
    assert out.columns == docs.columns and {r["copy"] for r in out.collect()} <= {9, None}


def test_mixing_meets_targets(spark):
    docs = spark.range(40000).selectExpr("id AS doc_id", "repeat('x', 10) AS text", "CASE WHEN id % 10 = 0 THEN 'a' WHEN id = 1 THEN 'c' ELSE 'b' END AS source")
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("z", 5.0)], "source string, weight double")
    n = {r["source"]: r["count"] for r in mixing.mix(docs, weights).groupBy("source").count().collect()}
    order = [[r["shuffle_key"] for r in part] for part in mixing.mix(docs.limit(3000), None).select("shuffle_key").rdd.glom().collect()]
    assert [k for part in order for k in part] == sorted(k for part in order for k in part) and len([p for p in order if p]) > 1
    assert "c" not in n and abs(n["a"] / 30000 - 1) < 0.05 and abs(n["b"] / 10000 - 1) < 0.05
    assert mixing.mix(docs.limit(0)).count() == 0


def test_packing_is_exact(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4"))
    rows = packing.pack(docs, with_ids=True).toPandas()
    at = rows.sort_values(["doc_uid", "start"]).groupby("doc_uid")
    assert len(at) == docs.count()
    for _, g in at:
        expected = ids[None if g["id"].isna().all() else int(g["id"].iloc[0])]
        assert np.concatenate(g["ids"].to_list()).tolist() == expected.tolist() and (g["doc_tokens"] == len(expected)).all()
        assert (g["start"].to_numpy() == np.concatenate(([0], g["length"].cumsum()[:-1]))).all()
        assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(g["ids"], g["ids_crc32"], strict=True))
    for _, g in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        n = g["length"].sum()
        assert n <= 4096 and n & (n - 1) == 0 and (g["offset"].to_numpy() == np.concatenate(([0], g["length"].cumsum()[:-1]))).all()
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["cased", "large"])
def test_packing_takes_any_tokenizer(spark, docs, tmp_path, kind):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = packing.tokenizer_path("byte_bpe_50k.json")
    if kind == "large":  # ids of more than 16 bits
        big = Tokenizer(models.WordLevel({"?": 0, "Hello": 69_999, "World": 1, "two": 66_000} | {f"w{k}": k for k in range(3, 69_000) if k != 66_000}, unk_token="?"))
        big.pre_tokenizer = pre_tokenizers.Whitespace()
        path = str(tmp_path / "large.json")
        big.save(path)
    whole = Tokenizer.from_file(path)
    table = spark.createDataFrame([(1, "Hello World the Cat"), (2, "  two\n\nlines "), (3, None), (4, "")], "doc_id long, text string").union(docs.select("doc_id", "text").where("doc_id = 7"))
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    rows = packing.pack(table, tokenizer=path, with_ids=True).toPandas()
    assert rows["doc_uid"].nunique() == len(texts)
    for _, g in rows.sort_values(["doc_uid", "start"]).groupby("doc_uid"):
        assert np.concatenate(g["ids"].to_list()).tolist() == [*whole.encode(texts[g["id"].iloc[0]] or "", add_special_tokens=False).ids, 2]
    assert not packing.Words(path).plain and packing.Words(packing.tokenizer_path()).plain


def test_shard_index_is_bm25():
    rng = np.random.default_rng(9)
    docs = [packing.Doc(k, k, rng.integers(0, 40, int(rng.integers(1, 200))).astype(np.uint16)) for k in range(30)]
    df = np.array([sum(t in set(d.ids.tolist()) for d in docs) for t in range(40)])
    idf = np.maximum(0, np.log((30 - df + 0.5) / (df + 0.5))).astype(np.float32)
    mean = np.mean([len(d.ids) for d in docs])
    index = packing.Index(docs, idf, mean)
    for d in docs:
        expected = []
        for e in docs:
            n = Counter(e.ids.tolist())
            expected.append(sum(idf[t] * n[t] * 2.2 / (n[t] + 1.2 * (0.25 + 0.75 * len(e.ids) / mean)) for t in set(d.ids.tolist()) if n[t]))
        assert np.allclose(index.scores(d.terms), expected, rtol=1e-4)


def test_a_window_takes_the_best_unused_neighbours():
    """Each window against a plain walk down the seed's ranking: whole ones that fit among the first LOOK, then the best cut."""
    rng = np.random.default_rng(10)
    pool = [packing.Doc(k, k, (rng.integers(0, 60, int(rng.integers(20, 120))) + 60 * (k % 3)).astype(np.uint16)) for k in range(90)]
    idf = np.ones(200, np.float32)
    index, left = packing.Index(pool, idf, 70.0), {d.id: len(d.ids) for d in pool}
    for pieces in packing.fill(pool, idf, 70.0, False, 256):
        seed = pieces[0][0].id
        assert seed == min((k for k in left if left[k]), key=lambda k: (-len(pool[k].ids), k))
        score = index.scores(pool[seed].terms)
        left[seed] -= pieces[0][2]
        room = 256 - pieces[0][2]
        near = sorted((k for k in left if left[k]), key=lambda k: (-score[k], k))[: packing.LOOK]
        expected = []
        for k in near:
            if left[k] <= room:
                expected.append((k, left[k]))
                room -= left[k]
                left[k] = 0
        for k in near:
            if room and left[k]:
                n = min(room, left[k])
                expected.append((k, n))
                room -= n
                left[k] -= n
        assert [(d.id, n) for d, _, n in pieces[1:]] == expected


def test_packing_prefers_lexical_neighbours():
    rng = np.random.default_rng(0)
    pool, idf = [], np.ones(200, np.float32)
    for k in range(40):
        half = k % 2
        pool.append(packing.Doc(k, k, (rng.integers(0, 90, 500) + 100 * half).astype(np.uint16)))
    same = [len({d.id % 2 for d, _, _ in w}) == 1 for w in packing.fill(pool, idf, 500.0, False)]
    assert np.mean(same) >= 0.75


def test_words_are_parted_as_the_tokenizer_does():
    import pyarrow as pa

    words = packing.Words(packing.tokenizer_path())
    rng = np.random.default_rng(4)
    odd = ["don't", "'sx'll\"'re", "a1b22", "\u00bdx\u00b2", "\u00dcber-\u00c4rger\u00df", "\u0130stanbul", "\u03a3\u03af\u03c3\u03c5\u03a6\u039f\u03a3", "x\u00a0y", "x\x85y", "\x1c\x1f a\x0bb\x0cc", "<|endoftext|>b", "e\u0301cole", "\u65e5\u672c", "\U0001f600!?", "\u0149\u017f\u00aa\u00b5", "\x00\x01", " lead", "trail ", "", "\u00ad", "x\u2028y"]
    alphabet = list("abcdexyz'-.,019 \n") + ["\u00e9", "\u00fc", "\u00df", "\u00c9", "\u0152", "\u00b3", "\u20ac"]
    texts = odd + ["".join(rng.choice(alphabet, int(rng.integers(1, 60)))) for _ in range(2000)]
    ids, ends = words.encode_all(pa.array(texts))
    for t, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
        assert ids[a:b].tolist() == words.whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_common_words_outlast_a_full_table(monkeypatch):
    """A table of words beyond its bounds forgets rare words, and encodes common ones once; slices without a word are no matter."""
    import pyarrow as pa

    monkeypatch.setattr(packing, "KEPT_WORDS", 50)
    monkeypatch.setattr(packing, "KEPT_PIECES", 50, raising=False)
    words, asked = packing.Words(packing.tokenizer_path()), Counter()
    piece = words.piece
    monkeypatch.setattr(words, "piece", lambda p: asked.update([p]) or piece(p))
    letters = "abcdefghij"
    common = [f"the{x}" for x in letters]
    for k in range(5):
        rare = [f"q{letters[k]}{x}{y}z" for x in letters[:7] for y in letters]
        texts = [None, " ".join(common * 8), " \n", " ".join(rare), "Thea x\u00e9"]
        ids, ends = words.encode_all(pa.array(texts))
        for t, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
            assert ids[a:b].tolist() == words.whole.encode(t or "", add_special_tokens=False).ids
        ids, ends = words.encode_all(pa.array([None, "", " "], pa.string()))
        assert len(ids) == 0 and ends.tolist() == [0, 0, 0]
    assert [asked[w] for w in common] == [1] * len(common)
    assert all(asked[f"q{letters[k]}abz"] == 1 for k in range(5)) and len(words.known) <= 50

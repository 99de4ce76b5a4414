"""Context-tree weighting, WARC, vectors and licence scans, against brute force and on awkward rows."""

import gzip
import io
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from korvane.llm import ctw, licenses, vectors, warc
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(WORDS, int(rng.integers(1, 30)))) for _ in range(40)]
    texts += [texts[0], None, "", " \n", "Ärger  über\tß", "UPPER lower", "z" * 400, "a  b   \n\n\tc \r\n", "  lead and trail  "]
    rows = [(k, t, "x", 1.5) for k, t in enumerate(texts)] + [(5, texts[5], "x", 1.5), (None, "without an id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, block double")


# Context-tree weighting.


def slow_scores(rows, depth):
    """The whole tree as dictionaries, node by node."""
    n = defaultdict(lambda: [0, 0])
    for _, t, held in rows:
        if not held:
            data = bytes([255]) * depth + t + b"\xff"
            for k in range(depth, len(data)):
                for j in range(8):
                    for d in range(depth + 1):
                        n[(data[k - d : k], 1 << j | data[k] >> (8 - j))][data[k] >> (7 - j) & 1] += 1
    children = defaultdict(list)
    for context, q in n:
        if context:
            children[(context[1:], q)].append((context, q))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    log = {}
    for node in sorted(n, key=lambda x: -len(x[0])):
        own = kt(*n[node])
        log[node] = own if len(node[0]) == depth else np.logaddexp(math.log(0.5) + own, math.log(0.5) + sum(log[c] for c in children[node]))

    def one(context, q):
        path = [(context[len(context) - d :], q) for d in range(depth + 1)]
        path = [x for x in path if x in n]
        if not path:
            return 0.5
        p = None
        for node in reversed(path):
            a, b = n[node]
            own, est = kt(a, b), (b + 0.5) / (a + b + 1)
            w = 1.0 if len(node[0]) == depth else math.exp(math.log(0.5) + own - log[node])
            p = est if p is None else w * est + (1 - w) * p
        return p

    out = []
    for i, t, held in rows:
        data, total = bytes([255]) * depth + t + b"\xff", 0.0
        for k in range(depth, len(data)):
            for j in range(8):
                p = one(data[k - depth : k], 1 << j | data[k] >> (8 - j))
                total += math.log10(p if data[k] >> (7 - j) & 1 else 1 - p)
        out.append((i, held, total))
    return out


def test_ctw_equals_whole_tree(docs, monkeypatch):
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 300)
    rows = [(r["doc_id"], ctw.lowered(r["text"]), r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in docs.collect()]
    got = ctw.score_texts(docs, held_out=ctw.crc_mod("doc_id", 5) == 1).collect()
    a, b = Counter((r["id"], r["held_out"]) for r in got), Counter((i, h) for i, _, h in rows)
    assert a == b
    expected = defaultdict(list)
    for i, _, s in slow_scores(rows, ctw.DEPTH):
        expected[i].append(s)
    for r in got:
        assert min(abs(r["score"] - s) for s in expected[r["id"]]) <= 1e-6, (r, expected[r["id"]])


def test_ctw_base_counts(docs):
    words = {}
    rows = docs.collect()
    counts, n = Counter(), 0
    for r in rows:
        words[r["doc_id"]] = [*ctw.lowered(r["text"]).split(), b"\xff"]
        if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1:
            counts.update(words[r["doc_id"]])
            n += len(words[r["doc_id"]])
    for r in ctw.score_texts(docs, held_out=ctw.crc_mod("doc_id", 5) == 1).collect():
        w = words[r["id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert abs(r["base_score"] - sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (len(counts) + 1))) for x in w)) < 1e-6


def test_ctw_edges(docs):
    assert ctw.score_texts(docs.limit(0)).count() == 0
    assert ctw.score_texts(docs, held_out=F.lit(True)).where("score IS NULL OR score > 0 OR n_known > 0").count() == 0


def test_ctw_is_a_distribution():
    texts, train = [b"abracadabra", b"alakazam", b"cadabra"], np.ones(3, bool)
    keys, counts = ctw.count_grams(texts, train)
    tree = ctw.Tree(keys, counts, ctw.TOP)
    import pandas as pd

    sums = ctw.sums_of_part(pd.DataFrame({"kind": [0], "block": [0], "keys": [ctw.squeeze_sorted(keys)], "counts": [ctw.squeeze(counts.astype(np.uint64))]}))
    above = ctw.upper(sums)
    for context in (b"abrac", b"zzzzz", b"kazam"):
        key = int.from_bytes(bytes(reversed(context)), "big") << 8
        total = 10 ** ctw.log10_of(np.arange(256, dtype=np.uint64) + np.uint64(key), tree, above)
        assert abs(total.sum() - 1) < 1e-9


# WARC.


def test_warc_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    big = "".join(rng.choice(list("abcdefgh ä€"), 3000))
    rows = [(k, f"http://x/{k}", t, "e") for k, t in enumerate([big, big, "short", "short", None, "", big + "x", "y" * 200000])] + [(9, None, big, "e"), (9, "dup\r\nid", big, "e"), (None, "u", big, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    path = f"file://{tmp_path}/w"
    warc.write_pages(pages, path)
    for size in (700, 5000, 1 << 20):
        got = warc.read_archives(spark, path, size).collect()
        assert len(got) == len(rows) == len({(r["file"], r["offset"]) for r in got})
        for r in got:
            assert r["record_type"] == "revisit" or len(r["payload"]) == r["payload_bytes"]
        by = {r["record_id"]: r for r in got}
        assert by["urn:page:9"]["record_type"] == "response" and by["urn:page:0"]["refers_to"] == "urn:page:9" and by["urn:page:1"]["payload_bytes"] == len(big.encode())
        assert by["urn:page:2"]["record_type"] == by["urn:page:3"]["record_type"] == "response" and by["urn:page:4"]["payload"] == b""
        assert sum(r["record_type"] == "revisit" for r in got) == 3


def test_warc_owns_each_record_once_and_skips_damage():
    members = [warc.record({"record_id": f"urn:page:{k}", "record_type": "response", "target_uri": "u", "refers_to": None, "payload_digest": "00" * 20, "payload_bytes": n, "payload": np.random.default_rng(k).bytes(n)}) for k, n in enumerate([10, 5000, 0, 90000, 700, 40])]
    starts = np.cumsum([0, *map(len, members)])[:-1].tolist()
    data = b"".join(members)
    for size in (50, 977, 40000, len(data)):
        got = [o for a in range(0, len(data), size) for o, _ in warc.records_in(io.BytesIO(data), a, min(a + size, len(data)))]
        assert got == starts
    fake = gzip.compress(b"WARC/1.1 is not here") + b"\x1f\x8b\x08junk" + gzip.compress(b"hello")
    mixed = members[0] + fake + members[1] + members[2][:-4] + members[3]
    got = [r["record_id"] for a in range(0, len(mixed), 333) for _, r in warc.records_in(io.BytesIO(mixed), a, min(a + 333, len(mixed)))]
    assert got == ["urn:page:0", "urn:page:1", "urn:page:3"]
    marks = [(o, r["record_type"]) for o, r in warc.records_in(io.BytesIO(mixed), 0, len(mixed), True)]
    at = [0, len(members[0]), len(members[0] + fake), len(members[0] + fake + members[1]), len(members[0] + fake + members[1] + members[2]) - 4]
    assert marks == list(zip(at, ["response", "damaged", "response", "damaged", "response"], strict=True))
    cut = [(o, r["record_type"]) for o, r in warc.records_in(io.BytesIO(members[0] + members[1][:-9]), 0, len(members[0] + members[1]) - 9, True)]
    assert cut == [(0, "response"), (len(members[0]), "damaged")]


def test_warc_digests_of_other_writers():
    raw = warc.record({"record_id": "a", "record_type": "revisit", "target_uri": "u", "refers_to": "b", "payload_digest": "ab" * 20, "payload_bytes": 5, "payload": None})
    text = gzip.decompress(raw).decode()
    at = re.search("sha1:[A-Z2-7]+", text)[0]
    found = lambda d: warc.parse(text.replace(at, d).encode())["payload_digest"]
    assert found(at) == found(at.lower()) == found("sha1:" + "AB" * 20) == "ab" * 20
    assert found("sha1:not base 32!") is None and found("sha256:" + "0" * 64) is None and found("md5:xyz") is None


def test_warc_writer_leaves_nothing_of_failed_attempts(tmp_path):
    writer = warc.WarcWriter({"path": f"file://{tmp_path}/w"})
    folder = tmp_path / "w" / f".{writer.job}"
    folder.mkdir(parents=True)
    for name in ("part-0-good.warc.gz", "part-0-failed.warc.gz", "part-1-empty.warc.gz"):
        (folder / name).write_bytes(b"")
    writer.commit([warc.Written(f"{folder}/part-0-good.warc.gz", 3), warc.Written(f"{folder}/part-1-empty.warc.gz", 0), None])
    assert [p.name for p in (tmp_path / "w").rglob("*.gz")] == ["part-0-good.warc.gz"] and not folder.exists()
    other = warc.WarcWriter({"path": f"file://{tmp_path}/w"})
    (tmp_path / "w" / f".{other.job}").mkdir()
    other.abort([])
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == [writer.job]


def test_warc_of_a_long_url():
    url = "http://x/" + "u" * (2 << 20)
    data = warc.record({"record_id": "urn:page:1", "record_type": "response", "target_uri": url, "refers_to": None, "payload_digest": "00" * 20, "payload_bytes": 5, "payload": b"hello"})
    got = [r for _, r in warc.records_in(io.BytesIO(data), 0, len(data))]
    assert [(r["target_uri"], r["payload"]) for r in got] == [(url, b"hello")]


def test_warc_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_pages(pages, f"file://{tmp_path}/none")
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


# Vectors.


@pytest.fixture(scope="module")
def embeddings(spark):
    rng = np.random.default_rng(2)
    rows, base = [], rng.normal(size=(8, 12))
    for k in range(300):
        v = base[k % 8] + rng.normal(size=12) * [0.02, 0.2, 1.0][k % 3]
        rows.append((k, v.tolist(), k % 3 if k % 11 else None, "z"))
    rows += [(400 + k, rows[6][1], 0, "z") for k in range(30)]  # copies
    rows += [(450, [2 * x for x in rows[6][1]], 0, "z"), (500, None, 0, "z"), (501, [0.0] * 12, 0, "z"), (502, [float("nan")] * 12, 0, "z"), (503, [float("inf")] + [1.0] * 11, 0, "z"), (504, [None] + [1.0] * 11, 0, "z"), (505, [1.0, 2.0], 0, "z"), (None, rows[6][1], 0, "z"), (550, [1.0, 2.0], 0, "z")]
    rows.append(rows[7])
    rows += [(9, rows[10][1], 0, "z"), (9, (-np.array(rows[10][1])).tolist(), 0, "z"), (9, rows[33][1], 0, "z")]  # an id of unlike vectors
    rows += [(600, [1e200 * x for x in rows[6][1]], 0, "z"), (601, [1e-200 * x for x in rows[6][1]], 0, "z"), (602, [1e300 * x for x in rows[6][1]], 0, "z"), (603, [1e-300 * x for x in rows[6][1]], 0, "z"), (650, [3e-310] + [0.0] * 11, 0, "z"), (651, [1e308] + [0.0] * 11, 0, "z")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")


def cosine(u, v):
    u, v = np.array(u), np.array(v)
    u, v = u / np.abs(u).max(), v / np.abs(v).max()
    return u @ v / (np.linalg.norm(u) * np.linalg.norm(v))


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_metric_join_equals_brute_force(embeddings, monkeypatch):
    for chunk, per, most in ((4096, 2000, 256), (16, 10, 256), (8, 4, 3)):
        monkeypatch.setattr(vectors, "CHUNK", chunk)
        monkeypatch.setattr(vectors, "PER_PIVOT", per)
        monkeypatch.setattr(vectors, "MOST_PIVOTS", most)
        monkeypatch.setattr(vectors, "DEAL", 5 * chunk)
        rows = embeddings.collect()
        links = defaultdict(set)
        for a in range(len(rows)):
            for b in range(len(rows)):
                x, y = rows[a], rows[b]
                if a != b and x[0] is not None and y[0] is not None and x[2] is not None and x[2] == y[2] and good(x[1]) and good(y[1]) and len(x[1]) == len(y[1]):
                    if cosine(x[1], y[1]) >= 0.98:
                        links[a].add(b)
        label, changed = {a: r[0] for a, r in enumerate(rows)}, True
        while changed:
            changed = False
            for a in links:
                m = min(label[b] for b in links[a])
                if m < label[a]:
                    label[a], changed = m, True
        expected = Counter((r[0], len(links[a]), label[a], r[0] is not None and r[0] == label[a]) for a, r in enumerate(rows))
        assert Counter(tuple(r) for r in vectors.near_vectors(embeddings).collect()) == expected
    assert vectors.near_vectors(embeddings.limit(0)).count() == 0


def test_pivot_cells_hold_all_neighbours():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6))
    x = np.concatenate([x, x[:200] + rng.normal(size=(200, 6)) * 0.05])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, cell, home = vectors.cells_of(x, vectors.spread_pivots(x[:100], 20), 0.2)
    cells = defaultdict(set)
    for r, c in zip(row, cell, strict=True):
        cells[c].add(r)
    of = {r: c for r, c, h in zip(row, cell, home, strict=True) if h}
    close = np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.2
    assert all(b in cells[of[a]] for a, b in zip(*np.nonzero(close), strict=True))


def brute_nearest(rows, k):
    usable = [(r[0], r[1]) for r in rows if r[0] is not None and good(r[1]) and len(r[1]) == 12]
    out = {}
    for q in {i for i, _ in usable if i % 50 == 0}:
        best = defaultdict(lambda: -9.0)
        for own in (v for i, v in usable if i == q):
            for i, v in usable:
                if i != q:
                    best[i] = max(best[i], cosine(own, v))
        out[q] = sorted((-x, i) for i, x in best.items())[:k]
    return out


def test_search_finds_the_nearest(embeddings):
    expected = brute_nearest(embeddings.collect(), 5)
    got = defaultdict(list)
    for r in vectors.search(embeddings, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], r["score"], r["rank"]))
    assert set(got) == set(expected)
    hits = 0
    for q, best in expected.items():
        assert [r for _, _, r in got[q]] == [1, 2, 3, 4, 5] and all(i != q for i, _, _ in got[q])
        assert all(abs(a[1] + b[0]) < 0.2 for a, b in zip(got[q], best, strict=True))
        hits += sum(x >= -best[-1][0] - 1e-9 for _, x, _ in got[q])  # parallel vectors tie but for rounding
    assert hits >= 0.9 * 5 * len(expected)
    copies = [i for i, _, _ in got[400]]
    assert set(copies) <= {6, 450, 600, 601, 602, 603} | set(range(401, 430)) and len(copies) == 5


def test_search_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = rows.toPandas()
    v = np.stack(x["embedding"]).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = x["vec_id"].to_numpy()
    got = vectors.search(rows, F.col("vec_id") % 50 == 0).toPandas().groupby("query_id")["id"].apply(set)
    hits = n = 0
    for at in np.flatnonzero(ids % 50 == 0):
        s = v @ v[at]
        s[at] = -9
        hits += len(set(ids[np.lexsort((ids, -s))[:5]]) & got[ids[at]])
        n += 5
    assert hits >= 0.9 * n


def test_search_edges(spark, embeddings):
    assert vectors.search(embeddings.limit(0), F.lit(True)).count() == 0
    two = spark.createDataFrame([(50, [1.0, 0.0]), (51, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vectors.search(two, F.col("vec_id") == 50).collect()] == [(50, 1, 51, pytest.approx(0.5**0.5))]


def test_search_reads_on_until_there_are_enough(spark):
    """More tight clusters than cells: one probe finds nearly all, and some lone pairs have a cell of their own."""
    rng = np.random.default_rng(0)
    centres, lone = rng.normal(size=(90, 12)), rng.normal(size=(30, 12))
    x = np.concatenate([np.repeat(centres, 39, 0) + rng.normal(size=(3510, 12)) * 1e-3, np.repeat(lone, 2, 0) + rng.normal(size=(60, 12)) * 1e-4])
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    out = vectors.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") >= 3510).collect()
    got = defaultdict(list)
    for r in out:
        got[r["query_id"]].append(r["id"])
    assert set(got) == set(range(3510, 3570))
    assert all(len(v) == len(set(v)) == 5 and q not in v for q, v in got.items())


def test_search_counts_an_id_of_many_vectors_once(spark):
    rng = np.random.default_rng(6)
    rows = [(1, (np.ones(6) + rng.normal(size=6) * 1e-3).tolist()) for _ in range(30)] + [(0, [1.0] * 6)] + [(k, rng.normal(size=6).tolist()) for k in range(2, 9)]
    got = [r["id"] for r in vectors.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert len(got) == len(set(got)) == 5 and got[0] == 1


def test_search_of_a_repeated_id(spark):
    rng = np.random.default_rng(7)
    rows = [(7, rng.normal(size=6).tolist()) for _ in range(5)] + [(50, rng.normal(size=6).tolist()), (50, rng.normal(size=6).tolist()), (3, rng.normal(size=6).tolist()), (4, rng.normal(size=6).tolist())]
    got = vectors.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 50).orderBy("rank").collect()
    best = {i: max(cosine(a, b) for j, a in rows if j == 50 for k, b in rows if k == i) for i in (3, 4, 7)}
    assert [(r["id"], round(r["score"], 9)) for r in got] == [(i, round(x, 9)) for i, x in sorted(best.items(), key=lambda x: -x[1])]


def test_groups_of_cells_hold_all_parts(monkeypatch):
    monkeypatch.setattr(vectors, "SCAN", 10)
    monkeypatch.setattr(vectors, "GROUPS", 1)
    parts, base = vectors.groups_of(np.array([3, 4, 5, 25, 2, 10, 1]))
    used = [(base[c] + p) for c in range(7) for p in range(parts[c])]
    assert parts.tolist() == [1, 1, 1, 3, 1, 1, 1] and base.tolist()[0] == base.tolist()[1] != base.tolist()[2] and len(set(range(base[3], base[3] + 3)) & {g for c, g in enumerate(base) if c != 3}) == 0 and min(used) == 0


def test_asymmetric_distances_are_those_of_decoded_vectors():
    rng = np.random.default_rng(8)
    x = vectors.unit(rng.normal(size=(600, 12)))
    index = vectors.Index(vectors.k_means(x, 9, 5), x)
    home = vectors.nearest(x, index.centres)
    codes = index.codes(x, home)
    decoded = index.centres[home] + np.concatenate([b[codes[:, p]] for p, b in enumerate(index.books)], 1)
    assert np.allclose(index.distances(x[:20], home, codes), ((x[:20, None] - decoded[None]) ** 2).sum(2))


def test_cells_needed():
    ranked, held = np.array([[0, 1, 2], [2, 1, 0], [1, 0, 2]]), np.array([1, 2, 9])
    assert vectors.cells_needed(ranked, held, 1, 6).tolist() == [3, 1, 3]
    assert vectors.cells_needed(ranked, held, 2, 3).tolist() == [2, 2, 2]
    assert vectors.cells_needed(ranked, held, 1, 99).tolist() == [3, 3, 3]


# Licences.


def slow_base(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    at = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def slow_found(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    line = "".join(f" {w} " for w in words)
    every = [(m.start(), -m.end(), t, k, label) for k, (t, label, word, p) in enumerate(licenses.rules()) if f" {word} " in line for m in re.finditer(licenses.padded(p), line)]
    kept = [d for d in every if not any((e[0], e[1]) != (d[0], d[1]) and e[0] <= d[0] and e[1] <= d[1] and e[2] <= d[2] or (e[0], e[1]) == (d[0], d[1]) and (e[2], e[3]) < (d[2], d[3]) for e in every)]
    word = lambda at: line[:at].count(" ") // 2
    return sorted((word(d[0]), word(-d[1]), d[4]) for d in kept if d[2] < 4 or min(e[2] for e in kept) == 4)


TEXTS = [
    "MIT License MIT license, the mit-license",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "SPDX-License-Identifier: GPL-2.0-or-later",
    "This is CC BY-NC-SA 4.0, that is CC BY 4.0; CC\nBY",
    "http://www.apache.org/licenses/LICENSE-2.0.txt and https://creativecommons.org/licenses/by-sa/3.0/",
    "submit licenses, gnu generally, ccby, accc by",
    "Ümit license mit licenseß mit license",
    "Redistribution and use in source and binary forms, with or without modification, are permitted ... All rights reserved.",
    None,
    "",
    "?!",
    "plain words only",
    "licensed under whatever, free software",
    "gnu general public license " * 300, 
    "SPDX-License-Identifier: MIT. spdx id mit spdx expression mit " * 40 + "licensed under the GPL " * 60,
    "Boost Software License - GNU GPL v3, LGPL 2.1; BSD 3-Clause License",
]


def test_licence_scan_equals_brute_force(spark):
    docs = spark.createDataFrame([(k if k else None, t, 3) for k, t in enumerate([*TEXTS, TEXTS[0]])], "doc_id long, text string, labels int")
    rows = licenses.scan(docs).collect()
    texts = {k if k else None: t for k, t in enumerate([*TEXTS, TEXTS[0]])}
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        n, places, first, last, labels = slow_base(texts[r["id"]])
        base = r["base"] or []
        assert (r["n_words"], sum(e["n"] for e in base), min((e["first"] for e in base), default=None), max((e["last"] for e in base), default=None), ",".join(sorted({e["label"] for e in base}))) == (n, places, first, last, labels)
        assert sorted((d["start"], d["end"], d["label"]) for d in r["found"] or []) == slow_found(texts[r["id"]]), texts[r["id"]][:80]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licence_scan_of_very_many_detections(spark):
    docs = spark.createDataFrame([(1, "gnu general public license " * 40_000)], "doc_id long, text string")
    found = licenses.scan(docs).select(F.size("found").alias("n"), F.element_at("found", -1).alias("last")).first()
    assert found["n"] == 40_000 and (found["last"]["start"], found["last"]["end"]) == (159_996, 160_000)


def test_licence_rules_hold_their_keywords():
    assert len(licenses.rules()) >= 300
    gate = re.compile(licenses.gate().replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff"))
    for _, label, word, pattern in licenses.rules():
        assert word in licenses.always(pattern) and label
        sample = " ".join(sorted(licenses.always(pattern))).replace("licen[cs]e", "licence")
        assert gate.search(sample), pattern

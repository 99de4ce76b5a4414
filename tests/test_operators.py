"""Operators on small fixtures."""

import json
import math
import pathlib
import re
import shutil
import subprocess
import sys
import unicodedata
from collections import Counter

import pytest
from korvane import more_queries, site_queries  # noqa: F401
from korvane.functions import columns as C
from korvane.operators import lots, pyramid, relational, retrieval, spatial, texts
from korvane.plans import programs
from korvane.plans.datasets import Dataset, Registry
from korvane.queries import QUERIES
from korvane.sources import readers, snapshots
from korvane.streaming import events
from pyspark.sql import functions as F


def test_chunks_overlap_and_stay_small():
    text = "\n\n".join(" ".join(f"w{p}_{k}" for k in range(30)) for p in range(20))
    found = texts.chunk(text, 100, 40)
    assert all(texts.words(c) <= 100 for c in found)
    assert found[1].startswith("w2_0") and found[0].endswith("w2_29")
    assert texts.chunk(None) == texts.chunk("  ") == []
    assert [texts.words(c) for c in texts.chunk(" ".join(["x"] * 250), 100, 10)] == [100, 100, 50]


def test_tables_of_a_page(spark):
    html = "<table><tr><th>a<th>b &amp; c</tr><tr><td> 1 <td>2<tr><td>3</table><p>x</p><table><tr><td><b>y</b></td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "no table")], "page_id long, html string")
    assert [tuple(r) for r in texts.html_tables(pages).orderBy("table", "row", "col").collect()] == [(1, 0, 0, 0, "a"), (1, 0, 0, 1, "b & c"), (1, 0, 1, 0, "1"), (1, 0, 1, 1, "2"), (1, 0, 2, 0, "3"), (1, 1, 0, 0, "y")]


def test_scalar_functions(spark):
    rows = spark.createDataFrame([("12-345 A rue Saint-Jean, Québec, G1R 1A1", " N/A "), ("7 côte d'Abraham", "x"), ("nothing", None)], "a string, b string")
    got = rows.select(C.address(F.col("a")).alias("a"), C.present(F.col("b")).alias("p"), C.fold(F.col("a")).alias("f"), C.number(F.lit("1e3")).alias("n"), C.number(F.lit("x")).alias("z"), C.key_text(F.lit(" 1 234 ")).alias("k")).collect()
    assert got[0]["a"].asDict() == {"unit": "12", "civic": 345, "suffix": "A", "street": "rue Saint-Jean", "municipality": "Québec", "postal_code": "G1R1A1"}
    assert got[1]["a"]["civic"] == 7 and got[2]["a"]["civic"] is None
    assert [r["p"] for r in got] == [False, True, False]
    assert got[1]["f"] == "7 cote d abraham" and (got[0]["n"], got[0]["z"], got[0]["k"]) == (1000.0, None, "1234")


def test_geojson(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 3], [0, 0]]
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"properties": {"id": 1, "more": {"x": 2}}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    r = readers.read_geojson(spark, str(tmp_path / "f.json"), "id long, more struct<x:int>").withColumn("ring", readers.ring_of(F.col("coordinates"))).select("id", "more", "geometry_type", spatial.ring_area(F.col("ring")).alias("a"), spatial.ring_length(F.col("ring")).alias("l")).first()
    assert tuple(r) == (1, '{"x":2}', "Polygon", 6.0, 12.0)


def test_delimited_falls_back_to_another_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,name\n1,Montréal\n".encode("windows-1252"))
    (tmp_path / "b.csv").write_bytes("id,name\n1,Montréal\n".encode())
    for name in ("a.csv", "b.csv"):
        assert readers.read_delimited(spark, str(tmp_path / name), "id int, name string").first()["name"] == "Montréal"


def test_missing_snapshot_names_the_job(spark, tmp_path):
    with pytest.raises(readers.MissingDataset, match="run the job of lots"):
        readers.read_snapshot(spark, str(tmp_path), "lots")


def test_upsert_keeps_other_partitions_and_null_keys(spark):
    old = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", None, 5), ("b", 1, 30)], "p string, k int, v int")
    new = spark.createDataFrame([("a", 2, 21), ("a", 2, 22), ("a", None, 6), ("a", 3, 23)], "p string, k int, v int")
    got = lambda prune: sorted((tuple(r) for r in snapshots.upsert(old, new, ["k"], [F.desc("v")], F.col("p") == "a", prune).collect()), key=repr)
    assert got(True) == sorted([("a", 2, 22, "updated"), ("a", 3, 23, "inserted"), ("a", None, 6, "updated"), ("b", 1, 30, "kept")], key=repr)
    assert ("a", 1, 10, "kept") in got(False)


def test_overwrite_touches_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    snapshots.overwrite(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]
    with pytest.raises(ValueError, match="length"):
        snapshots.write_vectors(spark.createDataFrame([([1.0],)], "e array<double>"), path, "e", 2)


def test_digest_ignores_order(spark):
    a = spark.createDataFrame([(1, 0.1 + 0.2), (2, None)], "id int, v double")
    b = spark.createDataFrame([(None, 2), (0.3, 1)], "v double, id int")
    c = spark.createDataFrame([(1, 0.31), (2, None)], "id int, v double")
    d = [snapshots.content_digest(x).first()["digest"] for x in (a, b, c)]
    assert d[0] == d[1] != d[2]
    assert snapshots.content_digest(a.limit(0)).first()["n_rows"] == 0


def test_fit_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a int, old string, extra double")
    out = snapshots.fit_columns(df, {"a": "long", "new": "string", "gone": "int", "rest": "string"}, {"old": "new"}, "rest").first()
    assert tuple(out) == (1, "x", None, '{"extra":2.5}')


def test_cut_covers_every_key_once(spark):
    keys = spark.range(3000).select(F.lpad(F.conv(F.pmod(F.xxhash64("id"), F.lit(4**6)).cast("string"), 10, 4), 8, "0").alias("q"))
    cut = pyramid.adaptive_cut(keys, "q", 200, 1, 8)
    assert cut.agg(F.sum("n")).first()[0] == 3000 and cut.where("n > 200 AND zoom < 8").count() == 0
    assert pyramid.cell_in_cut(keys, "q", cut, 1, 8).where("cell IS NULL").count() == 0


def test_unique_and_required(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match=r"\(1,\) x 2"):
        relational.require_unique(df, ["k"], "rows")
    with pytest.raises(ValueError, match="missing columns z: make z"):
        relational.require_columns(df, ["k", "z"], "make z")
    with pytest.raises(ValueError, match="no rows: load"):
        relational.require_rows(df.limit(0), "load")


def test_search_and_index_check(spark):
    index = spark.createDataFrame([("doc0", [1.0, 0.0, 0.0], "m", 1), ("doc1", [0.0, 1.0, 0.0], "m", 2), ("doc2", [0.8, 0.6, 0.0], "m", 1)], "chunk_id string, embedding array<float>, model string, label int")
    assert [r["chunk_id"] for r in retrieval.search(index, [1.0, 0.0, 0.0], 3).collect()] == ["doc0", "doc2", "doc1"]
    assert [r["chunk_id"] for r in retrieval.search(index, [1.0, 0.0, 0.0], 3, where=F.col("label") == 2).collect()] == ["doc1"]
    assert retrieval.check_index(index, "m", 3) is index
    with pytest.raises(ValueError, match="build it anew"):
        retrieval.check_index(index, "other", 3)
    hits = spark.createDataFrame([(2, "b", "second"), (1, "a", "first")], "rank int, title string, text string")
    assert retrieval.context(hits).first()["context"] == "[1] a\nfirst\n\n[2] b\nsecond"


def test_lease_up_fills_evenly(spark):
    r = spark.range(1).select(lots.lease_up(F.lit(1200.0), F.lit(12), 2).alias("v"), lots.lease_up(F.lit(1200.0), F.lit(0), 1).alias("w")).first()
    assert r["v"] == pytest.approx([650.0, 1200.0]) and r["w"] == pytest.approx([1200.0])


def test_registry_orders_and_runs(spark, tmp_path):
    reg = Registry()
    reg.add(Dataset("raw", "bronze", ("id",), lambda s, i: s.range(5)))
    reg.add(Dataset("even", "silver", ("id",), lambda s, i: i["raw"].where("id % 2 = 0"), ("raw",)))
    with pytest.raises(ValueError, match="later layer"):
        reg.add(Dataset("bad", "bronze", ("id",), lambda s, i: i["even"], ("even",)))
    assert reg.order(["even"]) == ["raw", "even"]
    assert reg.run(spark, str(tmp_path), ["even"])["even"].count() == 3


def test_streams_equal_tables(spark, tmp_path, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "in")
    table.repartition(1).write.parquet(folder)
    stream = spark.readStream.schema(table.schema).parquet(folder)
    q = events.windowed(stream).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    expected = {(r["window_start"], r["event_type"]): r["n"] for r in events.windowed(table).collect()}
    assert {(r["window_start"], r["event_type"]): r["n"] for r in spark.table("w").collect()} == expected
    target = str(tmp_path / "latest")
    q = stream.writeStream.foreachBatch(events.merge_into(target, ["user_id"])).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.awaitTermination(120)
    merged = events.read_merged(spark, target)
    assert merged.count() == table.select("user_id").distinct().count()
    newest = {r["user_id"]: (r["ts"], r["event_id"]) for r in events.latest_per_key(table, ["user_id"], [F.desc("ts"), F.desc("event_id")]).collect()}
    assert {r["user_id"]: (r["ts"], r["event_id"]) for r in merged.collect()} == newest


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path, merge = str(tmp_path / "t"), events.merge_into(str(tmp_path / "t"), ["k"], 8)
    batch = lambda rows: spark.createDataFrame(rows, "k long, ts long, event_id long, v string")
    assert events.read_merged(spark, path) is None
    merge(batch([]), 0)
    merge(batch([(k, 1, k, "old") for k in range(40)]), 0)
    before = events.manifest(spark, path)[1]
    merge(batch([(3, 2, 99, "new"), (3, 0, 98, "late")]), 1)
    version, after = events.manifest(spark, path)
    assert version == 2 and sum(before[b] != after[b] for b in before) == 1
    rows = {r["k"]: r["v"] for r in events.read_merged(spark, path).collect()}
    assert rows == {k: "new" if k == 3 else "old" for k in range(40)}
    (tmp_path / "t" / "manifest-3").mkdir()  # a crash before the manifest was whole
    assert events.manifest(spark, path)[0] == 2 and events.read_merged(spark, path).count() == 40
    merge(batch([(3, 3, 100, "newer")]), 2)
    assert {r["v"] for r in events.read_merged(spark, path).where("k = 3").collect()} == {"newer"}


def test_staged_tables_can_be_removed(spark):
    from korvane import storage

    with storage.staging(spark):
        inner = storage.stage(spark.range(3), "t")
        assert inner.count() == 3
    assert not storage.exists(spark, inner._korvane_path)

    df = storage.stage(spark.range(3), "t")
    assert df.count() == 3 and storage.exists(spark, df._korvane_path)
    storage.drop_all_staged(spark)
    assert not storage.exists(spark, df._korvane_path)


def test_full_text_search_meets_all_documents(spark, tmp_path):
    texts_of = ["Licénsed à GNU, licensed en été", None, "license ünïcödé", "plain license", "rien du tout à voir", "", None, "LICENSE gnu GNU é"]
    rows = [(k, t, "src3" if k in (1, 2) else "Src3" if k == 7 else "other") for k, t in enumerate(texts_of)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = {}
    for k, text, source in rows:
        seen, score = set(), 0.0
        for value, weight in ((text, 0.4), (source, 1.0)):
            plain = "".join(c for c in unicodedata.normalize("NFD", value or "") if not unicodedata.combining(c)).lower()
            for word, n in Counter(re.findall("[a-z0-9]+", plain)).items():
                if word in ("licensed", "license", "gnu", "src3", "ete"):
                    seen.add(word)
                    score += weight * (1 + math.log(n))
        if seen:
            expected[k] = (round(score, 6), len(seen))
    got = QUERIES["full_text_search"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["score"], r["n_words"]) for r in got} == expected and {0, 1, 2, 7} <= set(expected)


def roots(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in list(up)}


def test_components_of_the_whole_table(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_orderkey").collect()
    expected = roots([(r["l_partkey"], 1000000000 + r["l_orderkey"]) for r in lines])
    assert {tuple(r) for r in QUERIES["connected_components"](spark, sf_dir).select("node", "component").collect()} == set(expected.items())


def test_links_of_all_orders(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").collect()
    by = {r["o_orderkey"]: r for r in orders}
    keys, occasions = {}, {}
    for r in orders:
        keys.setdefault(("c", r["o_custkey"]), []).append(r["o_orderkey"])
        day = str(r["o_orderdate"])[:10]
        keys.setdefault(("d", day), []).append(r["o_orderkey"])
        occasions.setdefault(day, set()).add(r["o_orderpriority"])
    edges = [(k, k) for k in by]
    for (kind, key), items in keys.items():
        if kind == "c" or len(occasions[key]) < 2:
            edges += [(items[0], k) for k in items]
    groups = {}
    for item, group in roots(edges).items():
        groups.setdefault(group, []).append(by[item])
    expected = set()
    for group, rows in groups.items():
        if any(r["o_orderstatus"] == "F" for r in rows):
            kinds = Counter(r["o_orderpriority"] for r in rows)
            expected.add((group, len(rows), min(r["o_orderdate"] for r in rows), ",".join(sorted({r["o_orderstatus"] for r in rows})), min(kinds, key=lambda k: (-kinds[k], k))))
    got = QUERIES["decision_links"](spark, sf_dir).select("group_id", "n_items", "first_date", "statuses", "kind").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_programs_of_tall_sites(spark):
    limits = {"tower": (400.0, 2000.0, 20, 0, 5, None, None), "deep": (400.0, 400.0, 20, 0, 5, None, None), "shops": (300.0, 4000.0, 20, 18, 5, 0, None), "none": (400.0, 400.0, 20, 20, 0, None, None)}
    rows = [(k, *v) for k, v in limits.items()]
    sites = spark.createDataFrame(rows, "key string, buildable_m2 double, lot_m2 double, floors_max int, commercial_max int, basements_max int, dwellings_max int, density_max double")
    e, annuity = programs.Economics(rent=4000.0, rate_per_square_foot=90.0), (1 - 1.06**-30) / 0.06
    expected = {}
    for key, (plate, lot, floors, shops, deepest, most, _) in limits.items():
        found = []
        for r in range(floors + 1):
            for c in range(min(shops, floors - r) + 1):
                for b in range(deepest + 1):
                    dwellings = min(math.floor(plate * r / 85), 1 << 40 if most is None else most)
                    stalls = math.ceil(dwellings * 0.5 + plate * c / 100)
                    if r + c and stalls <= math.floor(plate * b / 32) + math.floor((lot - plate) * 0.25 / 32):
                        noi = (dwellings * 4000 * 12 * 0.95 + plate * c / 0.09290304 * 90 * 0.95) * 0.65
                        found.append((-round(noi * annuity - plate * (r + c) * 2600 - plate * b * 1500, 2), r, c, b))
        expected[key] = min(found)[1:] if found else (None, None, None)
    got = {r["key"]: r for r in programs.best_programs(sites, e).collect()}
    assert {k: (r["residential"], r["commercial"], r["basements"]) for k, r in got.items()} == expected
    assert expected["tower"][0] == 20 and expected["deep"][2] > 3 and expected["shops"][1] > 12 and got["none"]["status"] == "infeasible"


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from korvane import storage

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
    Session.conf["spark.master"] = "local[2]"
    assert storage.shared_dir(Session).startswith("file://") and storage.shared_dir(Session) == Session.conf["spark.checkpoint.dir"]


def test_chunks_carry_what_still_fits():
    cases = [
        (["a b c", "d e f", "g h i"], 6, 0, ["a b c\n\nd e f", "g h i"]),
        (["a b c", "d e f", "g h i"], 6, 3, ["a b c\n\nd e f", "d e f\n\ng h i"]),
        (["a b c", "d e f", "g h i j k l"], 6, 3, ["a b c\n\nd e f", "g h i j k l"]),
        (["a b c d e"], 2, 0, ["a b", "c d", "e"]),
        (["a b", "c d", "e f"], 2, 1, ["a b", "c d", "e f"]),
        (["a", "b b", "c c c", "d d d"], 6, 5, ["a\n\nb b\n\nc c c", "c c c\n\nd d d"]),
        (["a a", "b b", "c", "d d d"], 5, 5, ["a a\n\nb b\n\nc", "c\n\nd d d"]),
    ]
    for units, most, overlap, expected in cases:
        assert texts.chunk("\n\n".join(units), most, overlap) == expected
        assert texts.chunk("\n\n".join(units), most, overlap, lambda t: len(t.split())) == expected
    letters = texts.chunk(" ".join("w" * (k % 7 + 1) for k in range(300)), 20, 0, len)
    assert all(len(x) <= 20 for c in letters for x in c.split("\n\n")) and " ".join(letters).replace("\n\n", " ") == " ".join("w" * (k % 7 + 1) for k in range(300))


def test_chunk_query_equals_a_plain_walk(spark, sf_dir):
    """Each chunk's words are a stretch of the document's, in order, and together they cover it."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {}
    for r in QUERIES["chunk_documents"](spark, sf_dir).orderBy("doc_id", "chunk_index").collect():
        assert r["num_tokens"] == len(r["text"].split()) <= 512 and r["chunk_id"] == f"{r['doc_id']}:{r['chunk_index']:04d}"
        found.setdefault(r["doc_id"], []).append(r["text"])
    assert {k: v for k, v in found.items()} == {k: texts.chunk(t) for k, t in docs.items() if texts.chunk(t)}
    for k, chunks in found.items():
        words, at = docs[k].split(), 0
        for c in chunks:
            own = c.split()
            start = next(b for b in range(at, -1, -1) if words[b : b + len(own)] == own)
            at = start + len(own)
        assert at == len(words)


def test_rates_of_either_sign(spark):
    from korvane.functions import finance

    flows = [[-100.0, 60.0, 60.0], [100.0, -60.0, -60.0], [1.0, 2.0], [-1.0, -2.0], [0.0, 0.0]]
    got = [r[0] for r in spark.createDataFrame([(k, f) for k, f in enumerate(flows)], "k int, f array<double>").orderBy("k").select(finance.irr(F.col("f"))).collect()]
    rate = (0.6 + (0.36 + 2.4) ** 0.5) / 2 - 1
    assert [None if x is None else round(x, 9) for x in got] == [round(rate, 9), round(rate, 9), None, None, None]


def test_digest_of_zeros_and_nan(spark):
    a = spark.createDataFrame([(1, 0.0), (2, None)], "id int, v double")
    b = spark.createDataFrame([(1, -0.0), (2, float("nan"))], "id int, v double")
    assert snapshots.content_digest(a).first() == snapshots.content_digest(b).first()


def test_words_for_nothing_and_urls(spark):
    rows = spark.createDataFrame([("non",), ("S.O.",), ("No",), ("oui",)], "a string").select(C.present(F.col("a"))).collect()
    assert [r[0] for r in rows] == [False, False, False, True]
    url = lambda **k: spark.range(1).select(texts.canonical_url(F.lit("HTTP://WWW.Site.ca/Page/?q=1#top"), **k)).first()[0]
    assert url() == "http://www.site.ca/Page/?q=1" and url(drop_query=True, one_scheme=True, drop_www=True) == "https://site.ca/Page"


def test_cells_of_repeated_and_null_keys(spark):
    keys = spark.createDataFrame([("0123", 1), ("0123", 2), (None, 3), ("3333", 4)], "q string, quadkey int")
    cut = spark.createDataFrame([("01",)], "quadkey string")
    assert sorted(((r["quadkey"], r["cell"]) for r in pyramid.cell_in_cut(keys, "q", cut, 1, 4).collect())) == [(1, "01"), (2, "01"), (3, None), (4, None)]


def test_ranks_and_percentiles_of_hot_keys(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "b").alias("k"), (F.col("id") * 7919 % 61).cast("double").alias("v"), "id")
    got = relational.rank_within(rows, ["k"], [F.desc_nulls_last("v"), F.asc("id")], "r", 7).collect()
    expected = {}
    for r in sorted(got, key=lambda r: (-r["v"], r["id"])):
        expected[r["k"]] = expected.get(r["k"], 0) + 1
        assert r["r"] == expected[r["k"]]
    assert len(got) == 5000
    skewed = rows.withColumn("v", F.when(F.col("id") % 3 == 0, 1e9 + F.col("id")).when(F.col("id") % 3 == 1, 5.0)).union(spark.createDataFrame([("one", 2.5, 0), ("none", None, 0)], "k string, v double, id long"))
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    got = {r["k"]: tuple(r)[1:] for r in relational.exact_percentiles(skewed, ["k"], "v", shares, 16).collect()}
    # Buckets that are still large are cut again, also where far values leave nearly all others in one.
    heavy = skewed.withColumn("v", F.when(F.col("id") == 7, 1e300).when(F.col("id") == 11, -1e300).otherwise(F.col("v") / 1e6))
    again = {r["k"]: tuple(r)[1:] for r in relational.exact_percentiles(heavy, ["k"], "v", shares, 16, 50).collect()}
    want = {r["k"]: tuple(r)[1:] for r in heavy.where("v IS NOT NULL").groupBy("k").agg(*[F.percentile("v", q).alias(n) for n, q in shares.items()]).collect()}
    assert again.keys() == want.keys() and all(abs(x - y) <= 1e-9 * max(1, abs(y)) for k in again for x, y in zip(again[k], want[k], strict=True))
    expected = {r["k"]: tuple(r)[1:] for r in skewed.where("v IS NOT NULL").groupBy("k").agg(*[F.percentile("v", q).alias(n) for n, q in shares.items()]).collect()}
    assert got.keys() == expected.keys() and all(abs(x - y) < 1e-6 for k in got for x, y in zip(got[k], expected[k], strict=True))


def test_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "BLOCK", 3)
    rows = [(k, [float(k % 5), float(k % 3), 1.0]) for k in range(40)] + [(50, [0.0, 0.0, 0.0]), (51, [1.0])]
    index = spark.createDataFrame(rows, "id long, e array<double>")
    asked = index.where("id % 4 = 0").select(F.col("id").alias("query_id"), F.col("e").alias("query_vector"))
    got = {}
    for r in retrieval.search_many(index, asked, 4, "id", "e").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    cos = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    full = [(k, v) for k, v in rows if len(v) == 3 and any(v)]
    assert set(got) == set(range(0, 40, 4))
    for q, found in got.items():
        best = sorted(((-round(cos(dict(full)[q], v), 12), k) for k, v in full if k != q))[:4]
        assert sorted(round(-cos(dict(full)[q], dict(full)[k]), 12) for k in found) == [x for x, _ in best]


def test_the_rest_works_without_the_training_part(tmp_path):
    """A copy without the subpackage, its tests and the pipeline imports, lists its queries and answers one."""
    root = pathlib.Path(__file__).parent.parent
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "*.md"))
    code = "import __spark_entry__ as e, sys; q = e.queries(); assert len(q) > 60 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q), sorted(q); assert 'xxhash' not in sys.modules; print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120, check=False)
    assert out.returncode == 0, out.stderr

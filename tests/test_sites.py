"""Polygons, positions, planning texts, placement, envelopes, payloads and grids on small fixtures."""

import datetime
import json
import math

import numpy as np
import pytest
from korvane import site_queries  # noqa: F401
from korvane.functions import geodesy, planning
from korvane.operators import placement, polygons, pyramid, texts
from korvane.plans import envelopes, payloads
from korvane.queries import QUERIES
from korvane.sources import grids, snapshots
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def square(x, y, w, h=None):
    h = w if h is None else h
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def inside(p, shape):
    """Even-odd over all rings of a shape."""
    n = 0
    for r in shape:
        for a, b in zip(r, [*r[1:], r[0]], strict=True):
            if (a["y"] > p[1]) != (b["y"] > p[1]) and p[0] < a["x"] + (p[1] - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]):
                n += 1
    return n % 2 == 1


def test_clips_of_any_turn(spark):
    cases = [
        (square(0, 0, 4), square(2, 2, 4), 4.0),
        (square(0, 0, 4)[::-1], square(2, 2, 4)[::-1], 4.0),
        (square(0, 0, 4), square(10, 10, 1), 0.0),
        (square(0, 0, 4), square(4, 0, 4), 0.0),
        (square(1, 1, 1), square(0, 0, 9), 1.0),
        (ring((0, 0), (4, 0), (0, 4)), ring((4, 4), (0, 4), (4, 0)), 0.0),
        (ring((0, 0), (4, 0), (0, 4)), square(0, 0, 2), 4.0),
        (ring((0, 0), (6, 0), (6, 6), (3, 1), (0, 6)), square(0, 0, 6, 1), 6.0),
        ([], square(0, 0, 1), 0.0),
    ]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(cases)], f"k int, a {RING}, b {RING}")
    got = rows.orderBy("k").select(F.when(F.size(polygons.clip(F.col("a"), F.col("b"))) > 2, polygons.ring_area(polygons.clip(F.col("a"), F.col("b")))).otherwise(0.0)).collect()
    assert [round(r[0], 9) for r in got] == [area for _, _, area in cases]


def test_overlay_of_hollow_and_bent_shapes(spark):
    rng = np.random.default_rng(0)
    star = lambda x, y: [ring(*[(x + (3 if k % 2 else 1.2) * math.cos(k * math.pi / 5), y + (3 if k % 2 else 1.2) * math.sin(k * math.pi / 5)) for k in range(10)])]
    frame = [square(-2, -2, 5), square(-1, -1, 2.5)]
    shapes = [star(x, y) for x, y in rng.uniform(-3, 3, (6, 2))] + [None]
    rows = spark.createDataFrame([(k, s, frame) for k, s in enumerate(shapes)], f"k int, a array<{RING}>, b array<{RING}>")
    got = [r[0] for r in rows.orderBy("k").select(polygons.shared_area(F.col("a"), F.col("b"))).collect()]
    grid = [(x, y) for x in np.arange(-2, 3, 0.02) + 0.01 for y in np.arange(-2, 3, 0.02) + 0.01]
    for area, shape in zip(got, shapes, strict=True):
        expected = sum(inside(p, shape) and inside(p, frame) for p in grid[::7]) * 0.0004 * 7 if shape else 0.0
        assert abs(area - expected) < 0.25


def test_joined_parcels(spark):
    around = [square(x, y, 1) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    rows = [("hollow", r) for r in around] + [("pair", square(10, 0, 2)), ("pair", square(12, 0, 2)[::-1]), ("apart", square(0, 20, 1)), ("apart", square(5, 20, 1))]
    parcels = spark.createDataFrame(rows, f"zone string, ring {RING}")
    assert {r["zone"]: tuple(r)[1:] for r in polygons.dissolved(parcels, ["zone"]).collect()} == {"hollow": (8.0, 16.0, 16), "pair": (8.0, 12.0, 6), "apart": (2.0, 8.0, 8)}
    found = {}
    for r in polygons.outlines(parcels, ["zone"]).collect():
        pts = [(p["x"], p["y"]) for p in r["outline"]]
        found.setdefault(r["zone"], []).append(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, [*pts[1:], pts[0]], strict=True)) / 2)
    assert {k: sorted(v) for k, v in found.items()} == {"hollow": [-1.0, 9.0], "pair": [8.0], "apart": [1.0, 1.0]}
    cover = polygons.coverage(spark.createDataFrame([("a", square(0, 0, 2)), ("a", square(1, 1, 2)), ("b", None)], f"zone string, ring {RING}"), ["zone"], "ring")
    assert {r["zone"]: r["covered"] for r in cover.collect()} == {"a": 7.0, "b": 0.0}


def test_boundaries_of_a_plain_and_a_through_lot(spark):
    w, d = 15.238, 31.237
    lots = spark.createDataFrame([("plain", square(0, 0, w, d)), ("through", square(50, 0, w, d)), ("corner", square(100, 0, w, d)), ("inner", square(200, 0, 5))], f"lot string, ring {RING}")
    front = [("plain", 1, 0, 0, w, 0), ("through", 1, 50, 0, 50 + w, 0), ("through", 2, 50, d, 50 + w, d), ("corner", 1, 100, 0, 100 + w, 0), ("corner", 2, 100, 0, 100, d), ("inner", 2, 200, 0, 205, 0)]
    streets = spark.createDataFrame([(k, r, *map(float, p)) for k, r, *p in front], "lot string, rank int, ax double, ay double, bx double, by double")
    got = {r["lot"]: tuple(round(x, 6) if isinstance(x, float) else x for x in r)[1:] for r in polygons.boundary_split(lots, streets).collect()}
    assert got == {"plain": (w, 0.0, w, round(2 * d, 6), False), "through": (w, w, 0.0, round(2 * d, 6), True), "corner": (w, d, w, d, False)}
    margins = F.array(F.lit(3.0), F.lit(1.5), F.lit(4.0), F.lit(None).cast("double"))
    left = lots.where("lot = 'plain'").select(polygons.ring_area(polygons.inset(F.col("ring"), margins))).first()[0]
    assert abs(left - (w - 1.5) * (d - 7)) < 1e-9
    assert lots.where("lot = 'plain'").select(F.size(polygons.inset(F.col("ring"), F.array(F.lit(40.0))))).first()[0] == 0


def test_positions(spark):
    rows = spark.createDataFrame([(-73.5673, 45.5017), (-71.2080, 46.8139)], "lon double, lat double")
    m = rows.select(geodesy.metric(F.col("lon"), F.col("lat"), -73.5).alias("m")).select("m.*").collect()
    assert abs(m[0]["x"] / 0.9996 + 5258.6) < 5 and 5.0e6 < m[0]["y"] < 5.1e6
    far = rows.select(geodesy.great_circle_m(F.lit(-73.5673), F.lit(45.5017), F.lit(-71.2080), F.lit(46.8139))).first()[0]
    assert abs(far - math.dist(*[(r["x"] / 0.9996, r["y"] / 0.9996) for r in m])) < 1500
    degree = rows.select(geodesy.metric(F.lit(-73.5), F.lit(45.0), -73.5).alias("a"), geodesy.metric(F.lit(-73.5), F.lit(46.0), -73.5).alias("b")).first()
    assert abs((degree["b"]["y"] - degree["a"]["y"]) / 0.9996 - 111141.5) < 2
    cells = [(x, y) for x in range(8) for y in range(8)]
    at = {r["d"]: (r["x"], r["y"]) for r in spark.createDataFrame(cells, "x int, y int").withColumn("d", geodesy.hilbert(F.col("x"), F.col("y"), 3)).collect()}
    assert sorted(at) == list(range(64)) and all(abs(at[k][0] - at[k + 1][0]) + abs(at[k][1] - at[k + 1][1]) == 1 for k in range(63)) and at[0] == (0, 0)
    box = spark.range(1).select(geodesy.corners_metric(F.struct(F.lit(-74.0).alias("x0"), F.lit(45.0).alias("y0"), F.lit(-73.0).alias("x1"), F.lit(46.0).alias("y1")), -73.5).alias("b")).first()["b"]
    assert box["x0"] == -box["x1"] < -38000 and box["y1"] > box["y0"] + 110000


def said(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("v")).first()["v"]


def test_planning_texts(spark):
    of = lambda text, f: said(spark, text, f)
    assert of("Le budget est adopté.", planning.item_kind) is None and of(None, planning.item_kind) is None
    assert of("Usage conditionnel dans un immeuble patrimonial", planning.item_kind) == "conditional_use"
    assert of("zones 14040Hb, 14040 Hb et 14051Mc", planning.zones) == ["14040Hb", "14051Mc"]
    assert of("Plan: 11111Ha 22222Hb. Relativement à la zone 14040Hb et 14041Hc, on dit. Zone visée : 15000 Cd", lambda c: planning.subject_zones(c, F.lit("titre 10000Ha"))) == ["10000Ha", "14040Hb", "14041Hc", "15000Cd"]
    assert of("R.C.A.1V.Q. 463, RCA 1 VQ 463 et R.V.Q. 3310", planning.bylaws) == ["R.C.A.1V.Q. 463", "R.V.Q. 3310"]
    assert of("AT2024-123 et CA1-2024-0456, N° de dossier : 998877", planning.document_numbers) == ["AT2024-123", "CA1-2024-0456"] and of("No de dossier: 12", planning.file_number) == "12"
    assert of("le lot 1 234 567, lots no 2345678 et lot numéro 1 234 567", planning.lot_numbers) == ["1234567", "2345678"]
    found = of("au 100, chemin Sainte-Foy. Le conseil est d'accord; au 12 A, rue St. Louis Ouest, au 5 à 9, avenue de la Couronne et 7, rue X", planning.addresses)
    assert found == ["100, chemin Sainte-Foy", "12 A, rue St. Louis Ouest", "5 à 9, avenue de la Couronne"]
    assert of("groupes d'usages H1, H2 et C2 et P3; le H9", planning.usage_groups) == ["H1", "H2", "C2", "P3"]
    changes = of("Le maximum autorisé passe de huit à dix logements. Le projet va de 2 logements à 4. Il y a de 3 à 5 arbres. Le nombre maximal de logements à 8 alors que le projet en propose 10", planning.dwelling_changes)
    assert [tuple(c) for c in changes] == [(8, 10, "zoning"), (8, 10, "zoning"), (2, 4, "project")]
    assert of("un total de 10 logements, douze logements et 10 logements", planning.dwelling_counts) == [10, 12] and of("trois étages, 4 étages", planning.storeys) == [3, 4]
    assert of("une hauteur maximale de 13,5 mètres", planning.height_m) == 13.5 and of("9 m de hauteur", planning.height_m) == 9.0 and of("rien", planning.height_m) is None
    cases = {"Il est résolu d'adopter le règlement": "adopted", "la demande de dérogation mineure est refusée": "refused", "on autorise la démolition": "approved", "AVIS DE MOTION": "notice_of_motion", "consultation publique": "consultation", "rien": None}
    assert {t: of(t, planning.decision) for t in cases} == cases
    assert of("refused", planning.outcome) == "refused" and of("consultation", planning.outcome) == "in_progress" and of(None, planning.outcome) is None
    days = {"séance tenue le lundi 7 juillet 2025, à": datetime.date(2025, 7, 7), "Date et heure\nLe 1er août 2025": datetime.date(2025, 8, 1), "30 Avril 2025Date :": datetime.date(2025, 4, 30), "Date : 2 mai 2024": datetime.date(2024, 5, 2), "tenue le 31 février 2024": None, "rien": None}
    assert {t: of(t, planning.decision_date) for t in days} == days
    speaks = {"Le conseil de quartier de Maizerets est d'accord avec le projet.": "favorable", "Le conseil de quartier recommande d'approuver la demande avec les modifications suivantes.": "favorable_with_conditions", "Le conseil de quartier s'oppose au projet": "unfavorable", "Le conseil siège.": None}
    assert {t: (of(t, planning.opinion) or {"opinion": None})["opinion"] for t in speaks} == speaks
    assert of("A 9\n B 0\nAbstention 2\nA 3\nD 4\nB 1 oui", planning.votes) == {"A": 3, "B": 0, "Abstention": 2}


def test_placement_prefers_the_exact_street_and_the_own_borough(spark):
    items = spark.createDataFrame([(1, '["1 234 567","9999999"]', '["355, boulevard Réné Ouest","12, rue A"]', '["12, rue A"]', '["14040Hb"]', "[]"), (2, None, '["12, rue B"]', None, None, None), (3, "[]", "[]", "[]", '["00000Xx"]', "[]")], "item long, lot_numbers string, addresses string, subject_addresses string, zone_codes string, subject_zone_codes string")
    lots = spark.createDataFrame([("1 234 567", 1), ("1234567", 2), ("2", 1), ("3", 1), ("4", 1)], "lot_number string, scrape_date int")
    doors = spark.createDataFrame([(1, 355, "Boulevard René Ouest", "2", "X", 1), (2, 12, "rue A", "4", "other", 1), (3, 12, "rue A", "3", "mine", 1), (4, 12, "rue B est", "2", "mine", 1), (5, 12, "rue A", "2", "mine", 0), (5, 12, "rue A", "4", "other", 1)], "address_id long, civic_number int, street_name string, lot_number string, neighborhood string, scrape_date int")
    zones = spark.createDataFrame([("14040Hb", "z", 1)], "feature_id string, source_table string, scrape_date int")
    sites = placement.place_items(items, lots, doors, zones, "mine")
    got = sorted((tuple(r) for r in sites.collect()), key=repr)
    assert got == sorted([
        (1, "lot", "1 234 567", True, "lot_number", "1234567", None), (1, "address", "355, boulevard Réné Ouest", False, "address", "2", None), (1, "address", "12, rue A", True, "address", "3", None),
        (1, "zone", "14040Hb", False, "zone", None, "14040Hb"), (2, "address", "12, rue B", False, "address_cardinal", "2", None),
    ], key=repr)
    assert tuple(placement.placed_counts(items, sites).first()) == (3, 2, 1, 1, 3, 1)
    asked = spark.createDataFrame([(1, "12, rue A"), (2, "12 rue B"), (3, "99, rue A"), (4, None)], "decision long, address string")
    assert [(r["neighborhood"], r["match_basis"]) for r in placement.borough_of(asked, doors).orderBy("decision").collect()] == [(None, None), (None, None), (None, None), (None, None)]
    assert placement.borough_of(spark.createDataFrame([(1, "12, rue B")], "decision long, address string"), doors).first()["neighborhood"] == "mine"


def test_envelopes_of_single_houses(spark):
    columns = "lot_uid int, feature_id string, permits_residential boolean, permits_commercial boolean, solver_ready boolean, max_dwellings int, governs_residential boolean, permits_equipment boolean"
    rows = [(1, "a", True, None, True, 1, True, None), (1, "a", True, False, True, 2, False, None), (2, "a", True, False, True, 1, False, True), (2, "a", True, False, True, 2, True, None), (3, "a", True, True, True, 1, None, None), (4, "a", True, False, True, None, None, None), (5, "a", True, False, False, 1, None, True), (6, "a", True, False, True, 1, None, None)]
    found = envelopes.candidate_envelopes(spark.createDataFrame(rows, columns))
    assert sorted(r["lot_uid"] for r in found.collect()) == [2, 2, 3, 4] and found.columns[0] == "lot_uid"
    assert sorted(r["lot_uid"] for r in envelopes.single_family_pieces(spark.createDataFrame(rows, columns)).collect()) == [1, 6]
    assert sorted(r["lot_uid"] for r in envelopes.equipment_pieces(spark.createDataFrame(rows, columns)).collect()) == [2, 5]
    bare = spark.createDataFrame([(1, "a", 3)], "lot_uid int, feature_id string, max_dwellings int")
    assert envelopes.candidate_envelopes(bare).count() == 1


def test_payloads(spark):
    rents = spark.createDataFrame([("n1", "total", 900.0, 2023, "Oct"), ("n1", "1", None, 2024, "Oct"), (None, "total", 700.0, 2024, "Oct")], "neighborhood string, bedroom_type string, average_rent_cad double, survey_year int, survey_period string")
    got = {r["neighborhood"]: json.loads(r["rents"]) for r in payloads.rents_payload(rents).collect()}
    assert got["n1"]["overall_average_rent_cad"] == 900.0 and got["n1"]["num_published_cells"] == 1 and got["n1"]["survey_year"] == 2024 and [c["bedroom_type"] for c in got["n1"]["cells"]] == ["1", "total"]
    lots = spark.createDataFrame([(1, "n1"), (2, None), (3, "n9")], "lot int, neighborhood string")
    held = {r["lot"]: r["rents"] for r in payloads.with_payloads(lots, [payloads.rents_payload(rents)]).collect()}
    assert "900" in held[1] and "700" in held[2] and held[3] is None
    costs = spark.createDataFrame([("b", 1.0, 2.0), ("a", 3.0, 4.0), ("z", 0.0, 0.0)], "cost_id string, low double, high double")
    r = payloads.cost_payload(costs, ["a", "missing", "b"]).first()
    assert [c["cost_id"] for c in json.loads(r["costs"])] == ["a", "b"] and r["missing"] == ["missing"]


def test_grids(spark):
    assert grids.header_names(["", "Normes", None, "Autres"], ["Zone", "Marge (m)", "Marge  (m)", "Marge (m)"]) == ["Zone", "Normes: Marge (m)", "Normes: Marge (m)", "Autres: Marge (m)"]
    head = [(0, ["", "Hauteur", "", "Marge"]), (1, ["Zone", "Max", "Note", "Max"])]
    sheet = lambda rows: spark.createDataFrame(head + rows, "row_index int, cells array<string>")
    out = grids.read_grid(sheet([(2, [" Z1 ", "3", " ", "4"]), (3, ["Z2", "5", "x", None]), (4, [None, "1", "1", "1"]), (5, ["Z9", "1", "1", "1"])]), "zone")
    assert out.columns == ["zone", "Hauteur: Max", "Note", "Marge: Max"] and [tuple(r) for r in out.orderBy("zone").collect()] == [("Z1", "3", None, "4"), ("Z2", "5", "x", None)]
    with pytest.raises(ValueError, match="more than once: Z1"):
        grids.read_grid(sheet([(2, ["Z1", "", "", ""]), (3, ["Z1", "", "", ""])]), "zone")
    roads = spark.createDataFrame([(1, "Liaison maritime", None), (2, None, "Traverse"), (3, None, None), (4, "Autoroute", "Pont")], "id int, class string, kind string")
    assert [r["id"] for r in grids.roadway_only(roads, {"class": grids.NOT_ROAD_CLASSES, "kind": grids.NOT_ROAD_CHARACTERISTICS, "none": ["x"]}).orderBy("id").collect()] == [3, 4]


def test_several_datasets_are_shown_at_once(spark, tmp_path):
    root = str(tmp_path / "p")
    assert snapshots.published(spark, root) == (0, {})
    assert snapshots.publish({"a": spark.range(3), "b": spark.range(2)}, root) == 1
    assert snapshots.publish({"a": spark.range(5).withColumn("p", F.col("id") % 2)}, root, ["p"]) == 2
    assert (snapshots.read_published(spark, root, "a").count(), snapshots.read_published(spark, root, "b").count()) == (5, 2)
    (tmp_path / "p" / "manifest-3").mkdir()  # a crash before the manifest was whole
    assert snapshots.published(spark, root)[0] == 2
    todo = spark.createDataFrame([(1,), (2,), (3,), (None,)], "lot int")
    done = spark.createDataFrame([(1, 0.05), (2, 0.1), (None, 0.05)], "lot int, tolerance double")
    assert sorted(r["lot"] for r in snapshots.left_to_do(todo, done, ["lot"], {"tolerance": 0.05}).collect()) == [2, 3]


def test_cells_of_boroughs(spark):
    lots = spark.createDataFrame([("0123", "a"), ("0121", "b"), ("3333", "a"), ("0123", None), (None, "c")], "q string, hood string")
    cut = spark.createDataFrame([("01",), ("3",)], "quadkey string")
    assert sorted(map(tuple, pyramid.cell_bridge(lots, "q", cut, "hood", 1, 4).collect())) == [("a", "01"), ("a", "3"), ("b", "01")]


def test_chunks_are_found_in_their_text(spark):
    text = "one two  three\n\nfour five\n\none two three four"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    chunks = spark.createDataFrame([(1, 0, "one two three"), (1, 1, "three\n\nfour five"), (1, 2, "one two three four"), (1, 3, "not there")], "doc_id long, chunk_index int, text string")
    spans = texts.chunk_spans(docs, chunks)
    got = {r["chunk_index"]: (r["start"], r["end"]) for r in spans.collect()}
    assert [text[slice(*got[k])].split() if got[k][0] is not None else None for k in range(4)] == [["one", "two", "three"], ["three", "four", "five"], ["one", "two", "three", "four"], None]
    marks = spark.createDataFrame([("m", 1, 10, 20), ("n", 1, 0, 0)], "mark string, doc_id long, mark_start int, mark_end int")
    assert sorted(r["chunk_index"] for r in texts.chunks_over(spans, marks).collect()) == [0, 1]


def test_chunk_positions_are_those_of_the_words(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    chunks = {(r["doc_id"], r["chunk_index"]): r["text"] for r in QUERIES["chunk_documents"](spark, sf_dir).collect()}
    rows = QUERIES["chunk_positions"](spark, sf_dir).collect()
    assert len(rows) == len(chunks)
    assert np.mean([r["start"] is not None and docs[r["doc_id"]][r["start"] : r["end"]].split() == chunks[r["doc_id"], r["chunk_index"]].split() for r in rows]) > 0.95


def test_returns_equal_a_plain_walk(spark):
    from korvane.plans import proforma

    t = proforma.Terms(hold_years=4)
    numbers = "acquisition site_costs rebuild_cost rebuild_residential_noi rebuild_commercial_noi rebuild_industrial_noi rebuild_dwellings rebuild_commercial_m2 rebuild_industrial_m2 enhance_cost enhance_residential_noi enhance_commercial_noi enhance_industrial_noi enhance_dwellings standing_noi verdict".split()
    base = dict(zip(numbers, [900.0, 20.0, 3000.0, 260.0, 90.0, None, 90.0, 1000.0, None, 400.0, 45.0, None, None, 10.0, 60.0, 5.0], strict=True))
    cases = [base | {"thesis": "teardown"}, base | {"acquisition": None, "thesis": "infill"}, base | {"enhance_cost": 0.0, "thesis": "improvement"}, base | {"thesis": "improvement", "verdict": None}]
    rows = spark.createDataFrame([(k, c["thesis"], *[c[n] for n in numbers]) for k, c in enumerate(cases)], "k int, thesis string, " + ", ".join(f"{n} double" for n in numbers))
    got = {r["k"]: r for r in proforma.screened(proforma.returns(rows, t), "thesis", "verdict", t).collect()}

    def stream(outlay, budget, income, cap, let, before=0.0, cap_before=4.5):
        built, years = (18 if let else 0), [-outlay]
        for y in range(4):
            total = 0.0
            for m in range(12 * y + 1, 12 * y + 13):
                total += income / 12 * (max(0.0, min(1.0, (m - built) / let)) if let else 1.0) - (budget / built if let and m <= built else 0.0) - before / 12
            years.append(total)
        years[-1] += (income / cap * 100 - before / cap_before * 100) * 0.98
        return years

    def rate(flows):
        value = lambda q: sum(f / (1 + q) ** i for i, f in enumerate(flows))
        lo, hi = -0.9, 2.0
        if value(lo) * value(hi) >= 0:
            return None
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (value(mid) > 0) == (value(lo) > 0) else (lo, mid)
        return lo * 100

    cap = 4.5 + 90 * 1.75 / 350
    rebuild = stream(920, 3000 * 1.26, 350, cap, 12)
    adding = stream(0, 400 * 1.26, 45, 4.5, 6)
    hold = stream(900, 0, 60, 4.5, 0)
    owner = stream(20, 3000 * 1.26, 350, cap, 12, 60.0)
    expected = {"buyer_hold": hold, "buyer_enhance": [a + b for a, b in zip(hold, adding, strict=True)], "buyer_rebuild": rebuild, "owner_enhance": adding, "owner_rebuild": owner}
    for name, flows in expected.items():
        assert abs(got[0][f"{name}_irr_pct"] - rate(flows)) < 1e-6, name
        assert abs(got[0][f"{name}_multiple"] - sum(x for x in flows if x > 0) / -sum(x for x in flows if x < 0)) < 1e-9
    assert got[0]["rebuild_let_months"] == 12 and abs(got[0]["rebuild_cap_pct"] - cap) < 1e-9
    assert got[1]["buyer_rebuild_irr_pct"] is None and got[1]["owner_rebuild_irr_pct"] is not None and not got[1]["is_good"]
    assert got[2]["buyer_enhance_irr_pct"] is None and got[2]["site_irr_pct"] is None and not got[2]["clears_hurdle"]
    assert got[3]["site_irr_pct"] == got[3]["buyer_enhance_irr_pct"] and not got[3]["is_good"]
    assert proforma.returns(rows.limit(0), t).count() == 0


def test_second_readings(spark):
    text = F.col("t")
    rows = spark.createDataFrame([("zoning_amendment", "minutes", "Le conseil de quartier parle de logements", None), ("housing", "extract", "rien", 4), (None, "minutes", "logement", None)], "kind string, source string, t string, after int")
    none = F.lit(None).cast("string")
    got = [r[0] for r in rows.select(planning.gaps(text, F.col("kind"), F.col("source"), F.col("after"), F.array().cast("array<string>"), none, none)).collect()]
    assert got == [["max_dwellings_after", "subject_zone_codes", "decision", "council_opinion"], ["decision"], []]
    long = "a" * 3000 + " avis de motion " + "b" * 5000 + " logement " + "c" * 5000
    shown = said(spark, long, planning.focus)
    assert shown.startswith("a" * 2000) and "avis de motion" in shown and " logement " in shown and "[…]" in shown and len(shown) <= 7000 and "\x01" not in shown
    assert said(spark, "court", planning.focus) == "court"
    key = lambda *v: said(spark, "x", lambda c: planning.cache_key(F.lit(1), F.lit(2), c, *v))
    assert len(key("1", "m")) == 64 and key("1", "m") != key("2", "m")


def test_permissions(spark):
    from korvane.operators import lots

    of = lambda codes: spark.range(1).select(lots.class_max_dwellings(F.array(*[F.lit(c) for c in codes]) if codes else F.array().cast("array<string>"))).first()[0]
    assert (of(["H.1(2)"]), of(["H.2", "H.4"]), of(["H", "H.1"]), of(["H.7", "H.1"]), of(["C.1"]), of([]), of(["H.3A", "I.2"])) == (1, 8, None, None, None, None, 3)
    levels = [(["all", "ground"], 4, 0), (["all_except_ground", "ground"], 4, 0), (["below_ground"], 0, 1), (["ground", "second", "second"], 2, 0), ([], 0, 0)]
    for marks, storeys, cellars in levels:
        a = F.array(*[F.lit(m) for m in marks]) if marks else F.array().cast("array<string>")
        r = spark.range(1).select(lots.storeys_by_levels(a, F.lit(4)), lots.basement_levels(a, True), lots.basement_levels(a, False), lots.storey_ceiling(F.lit(20.0)), lots.storey_ceiling(F.lit(1.0))).first()
        assert tuple(r) == (storeys, cellars, 1 if "all" in marks or "below_ground" in marks else 0, 6, 1)


def test_tables_of_bars_headers_and_cuts(spark, tmp_path):
    from korvane.sources import readers

    docs = spark.createDataFrame([(1, "title\na | b  c | \nx|y\n1 | 2 | 3"), (2, None)], "doc_id long, text string")
    assert [tuple(r) for r in texts.pipe_tables(docs).orderBy("row", "col").collect()] == [(1, 0, 0, "a"), (1, 0, 1, "b c"), (1, 0, 2, ""), (1, 1, 0, "1"), (1, 1, 1, "2"), (1, 1, 2, "3")]
    sheet = spark.createDataFrame([(0, ["Titre", None]), (1, ["Quartier", " Studio "]), (2, ["a", "1"]), (3, ["b", "2"])], "row_index int, cells array<string>")
    assert [r["row_index"] for r in readers.below_header(sheet, ["quartier", "studio"]).orderBy("row_index").collect()] == [2, 3] and readers.below_header(sheet, ["none"]).count() == 0
    keys = spark.createDataFrame([("0123",), ("3333",), (None,)], "q string")
    with pytest.raises(ValueError, match="lots: 1 rows outside the cut, such as 3333"):
        pyramid.require_in_cut(keys, "q", spark.createDataFrame([("01",)], "quadkey string"), 1, 4, "lots")
    (tmp_path / "f.json").write_text("\n".join(json.dumps({"type": "Feature", "properties": {"id": k}, "geometry": {"type": "Point", "coordinates": [k, 2]}}) for k in range(3)))
    rows = readers.read_geojson(spark, str(tmp_path / "f.json"), "id long", lines=True).orderBy("id").collect()
    assert [(r["id"], r["geometry_type"], json.loads(r["coordinates"])) for r in rows] == [(k, "Point", [k, 2]) for k in range(3)]
    kinds = [("pdf", r"\.pdf$"), ("page", "^https://a/")]
    assert [r[0] for r in spark.createDataFrame([("https://a/x.pdf",), ("https://a/x",), ("ftp://b",)], "u string").select(texts.link_kind(F.col("u"), kinds)).collect()] == ["pdf", "page", None]


def test_sites_and_their_futures(spark):
    from korvane.plans import sites

    rows = spark.createDataFrame([("A", None, 1930, 100.0), (None, "P", 2000, 0.0), ("non", "s.o.", None, None), (None, None, 1930, 50.0)], "h string, r string, y int, f double")
    got = [tuple(r) for r in rows.select(*sites.heritage_flags(*[F.col(c) for c in "hryf"])).collect()]
    assert got == [(True, False, True, True), (False, True, False, False), (False, False, False, False), (False, False, True, False)]
    values = [(1, 100.0, 20.0, 150.0, 0.0, 90.0, "a"), (2, 100.0, None, 100.0, 0.0, 200.0, "a"), (3, None, None, 50.0, 60.0, None, "a"), (4, 100.0, -5.0, 100.0, 0.0, 100.0, "none")]
    valued = sites.futures(spark.createDataFrame(values, "k int, hold double, enhance_gain double, rebuild double, site_costs double, assessed double, thesis string"))
    got = {r["k"]: (r["owner_best"], r["price"], r["buyer_best"]) for r in valued.collect()}
    assert got == {1: ("rebuild", 100.0, "rebuild"), 2: ("hold", 200.0, "none"), 3: ("hold", None, None), 4: ("hold", 100.0, "hold")}
    ranked = sites.rank_sites(valued.withColumn("rate", F.col("buyer_rebuild")), "thesis", "rate", "rate", "owner_gain_rebuild", "k", 1)
    assert {r["k"]: (r["thesis_rank"], r["is_top"], r["num_ranked"]) for r in ranked.collect()} == {1: (1, True, 1), 2: (None, False, 1), 3: (None, False, 1), 4: (None, False, 0)}


def test_unit_economics_of_missing_boroughs(spark):
    rents = spark.createDataFrame([("n1", "studio", 800.0), ("n1", "all", 900.0), ("n1", "2_bedroom", None), (None, "studio", 700.0)], "neighborhood string, bedroom_type string, average_rent_cad double")
    vacancy = spark.createDataFrame([("n1", "studio", "all", 2.0), ("n1", "studio", "rows", 9.0), ("n2", "studio", "all", 1.0)], "neighborhood string, bedroom_type string, dwelling_type string, vacancy_rate_pct double")
    got = {r["neighborhood"]: (r["rents"], r["vacancies"], len(r["suppressed"])) for r in payloads.unit_economics(rents, vacancy).collect()}
    assert got == {"n1": ({"studio": 800.0}, {"studio": 2.0}, 3), None: ({"studio": 700.0}, {}, 3), "n2": ({}, {"studio": 1.0}, 4)}

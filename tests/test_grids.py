"""Columns of printed grids from all their lines, and grids that sections drive."""

from korvane.sources import grids


def cells(spark, rows):
    """rows: (line, label, [(centre, text)])"""
    out = []
    for line, label, values in rows:
        out.append((1, line, 1, 0.0, 50.0, label))
        out += [(1, line, k + 2, c - 5.0, c + 5.0, t) for k, (c, t) in enumerate(values)]
    return spark.createDataFrame(out, "page int, line int, cell int, x0 double, x1 double, text string")


def test_columns_are_clusters_with_support(spark):
    page = cells(spark, [(1, "Usages", [(100, "a"), (115, "b"), (131, "c"), (300, "d")]), (2, "HAUTEUR", [(104, "e"), (302, "f"), (500, "stray")]), (3, "autre", [(200, "g"), (310, "h"), (290, "i")])])
    got = {r["column_index"]: r["centre"] for r in grids.column_centres(page, ["usages", "hauteur"]).collect()}
    # A chain of cells within reach of one another is one column; one line's stray is none.
    assert got == {0: 115.0, 1: 302.0}
    placed = {(r["label"], r["column_index"]): r["text"] for r in grids.clustered_grid(page, ["usages", "hauteur"]).collect()}
    assert placed == {("Usages", 0): "c", ("Usages", 1): "d", ("HAUTEUR", 0): "e", ("HAUTEUR", 1): "f", ("autre", 1): "h"}
    assert grids.clustered_grid(page, ["rien"]).collect() == []


def test_sections_carry_down(spark):
    page = cells(spark, [(1, "Avant", [(100, "0")]), (2, "1- USAGES permis", []), (3, "Résidence", [(100, "H1"), (200, "H2")]), (4, "2- Marges", [(100, "tête")]), (5, "Avant", [(100, "6,5"), (200, "7")]), (6, "Côté", [(100, "2")]), (7, "3- Étages", []), (8, "Nombre", [(100, "2 à 4"), (200, "x")])])
    sections = {"1- usages": "usages", "2- marges": "margins", "3- etages": "storeys"}
    values = grids.sectioned_grid(page, sections, ["residence", "avant"])
    assert {(r["section"], r["label"], r["column_index"], r["text"]) for r in values.collect()} == {("usages", "Résidence", 0, "H1"), ("usages", "Résidence", 1, "H2"), ("margins", "Avant", 0, "6,5"), ("margins", "Avant", 1, "7"), ("margins", "Côté", 0, "2"), ("storeys", "Nombre", 0, "2 à 4"), ("storeys", "Nombre", 1, "x")}
    norms = grids.grid_norms(values, "usages", {("margins", "avant"): "front_m"}, ("margins", ["cote", "cote 2"]), ("storeys", "nombre")).orderBy("column_index").collect()
    assert [tuple(r)[1:] for r in norms] == [(0, ["H1"], 6.5, 2.0, 2, 4, ["one side margin printed"]), (1, ["H2"], 7.0, None, None, None, ["no storeys stated"])]

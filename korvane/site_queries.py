"""Queries of polygons, planning texts, placement and published grids over derived columns, with their SQL; see queries.py.

The tables hold no shapes and no planning texts: rings, texts and grids are derived from keys, as the docstrings say.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import finance, geodesy, planning
from .functions.columns import truth
from .operators import lots, placement, polygons, texts
from .plans import envelopes, payloads, proforma
from .plans import sites as planning_sites
from .queries import PLACES_SQL, places, query, table
from .sources import grids


def at(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x, y, w, h):
    return F.array(at(x, y), at(x + w, y), at(x + w, y + h), at(x, y + h))


# Polygons.


@query("""
WITH t AS (SELECT p_partkey AS tri, CAST(p_partkey * 7919 % 2003 AS DOUBLE) AS ax, CAST(p_partkey * 104729 % 2003 AS DOUBLE) AS ay, CAST(p_partkey % 90 + 20 AS DOUBLE) AS s FROM part),
b AS (SELECT c_custkey AS box, CAST(c_custkey * 6007 % 2003 AS DOUBLE) AS bx, CAST(c_custkey * 3331 % 2003 AS DOUBLE) AS b_y, CAST(c_custkey % 40 + 1 AS DOUBLE) AS w, CAST(c_custkey % 43 + 1 AS DOUBLE) AS h FROM customer),
j AS (SELECT tri, box, greatest(ax, bx) AS x0, greatest(ay, b_y) AS y0, bx + w AS x1, b_y + h AS y1, ax + ay + s AS c FROM t JOIN b ON bx + w > ax AND bx < ax + s AND b_y + h > ay AND b_y < ay + s),
a AS (SELECT tri, box, (power(greatest(c - x0 - y0, 0), 2) - power(greatest(c - x1 - y0, 0), 2) - power(greatest(c - x0 - y1, 0), 2) + power(greatest(c - x1 - y1, 0), 2)) / 2 AS area FROM j WHERE x1 > x0 AND y1 > y0)
SELECT tri, box, round(area, 6) AS area FROM a WHERE area > 0
""")
def polygon_clip(spark, sf_dir):
    """Triangles of parts clipped to boxes of customers."""
    k, c = F.col("p_partkey"), F.col("c_custkey")
    ax, ay, s = k * 7919 % 2003, k * 104729 % 2003, k % 90 + 20
    t = table(spark, sf_dir, "part").select(k.alias("tri"), F.array(at(ax, ay), at(ax + s, ay), at(ax, ay + s)).alias("a"))
    b = table(spark, sf_dir, "customer").select(c.alias("box"), rectangle(c * 6007 % 2003, c * 3331 % 2003, c % 40 + 1, c % 43 + 1).alias("b"))
    return polygons.clip_join(t, b, "a", "b", 60.0).select("tri", "box", F.round("area", 6).alias("area"))


@query("""
WITH l AS (SELECT p_partkey AS l, CAST(p_partkey * 7919 % 1009 AS DOUBLE) AS x, CAST(p_partkey * 104729 % 1009 AS DOUBLE) AS y, CAST(p_partkey % 20 + 10 AS DOUBLE) AS s FROM part),
b AS (SELECT s_suppkey AS b, CAST(s_suppkey * 6007 % 1009 AS DOUBLE) AS x, CAST(s_suppkey * 3331 % 1009 AS DOUBLE) AS y, CAST(s_suppkey % 60 + 30 AS DOUBLE) AS s FROM supplier),
r AS (SELECT l, b, l.x AS lx, l.y AS ly, l.s AS ls, b.x AS bx, b.y AS b_y, b.s AS bs FROM l JOIN b ON l.x <= b.x + b.s AND b.x <= l.x + l.s AND l.y <= b.y + b.s AND b.y <= l.y + l.s),
o AS (SELECT l, b, greatest(least(lx + ls, bx + bs) - greatest(lx, bx), 0) * greatest(least(ly + ls, b_y + bs) - greatest(ly, b_y), 0)
  - greatest(least(lx + ls, bx + bs) - greatest(lx + ls / 2, bx), 0) * greatest(least(ly + ls, b_y + bs) - greatest(ly + ls / 2, b_y), 0)
  - greatest(least(lx + ls, bx + bs * 0.75) - greatest(lx, bx + bs * 0.25), 0) * greatest(least(ly + ls, b_y + bs * 0.75) - greatest(ly, b_y + bs * 0.25), 0)
  + greatest(least(lx + ls, bx + bs * 0.75) - greatest(lx + ls / 2, bx + bs * 0.25), 0) * greatest(least(ly + ls, b_y + bs * 0.75) - greatest(ly + ls / 2, b_y + bs * 0.25), 0) AS area FROM r)
SELECT l, b, round(area, 6) AS area FROM o WHERE area > 0.000001
""")
def shape_overlay(spark, sf_dir):
    """L-shaped lots of parts over zones of suppliers that have a square hole: neither side is convex."""
    k, z = F.col("p_partkey"), F.col("s_suppkey")
    x, y, s = k * 7919 % 1009, k * 104729 % 1009, k % 20 + 10
    ell = F.array(F.array(at(x, y), at(x + s, y), at(x + s, y + s / 2), at(x + s / 2, y + s / 2), at(x + s / 2, y + s), at(x, y + s)))
    bx, by, w = z * 6007 % 1009, z * 3331 % 1009, z % 60 + 30
    hollow = F.array(rectangle(bx, by, w, w), rectangle(bx + w * 0.25, by + w * 0.25, w * 0.5, w * 0.5))
    out = polygons.overlay(table(spark, sf_dir, "part").select(k.alias("l"), ell.alias("_a")), table(spark, sf_dir, "supplier").select(z.alias("b"), hollow.alias("_b")), "_a", "_b", 60.0, 1e-6)
    return out.select("l", "b", F.round("area", 6).alias("area"))


@query("""
WITH g AS (SELECT p_partkey AS k, p_partkey % 40 AS i, p_partkey // 40 AS j, p_size % 3 AS zone FROM part),
n AS (SELECT a.zone, count(*) AS shared FROM g a JOIN g b ON a.zone = b.zone AND ((b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)) GROUP BY 1)
SELECT g.zone, count(*) * 25.0::DOUBLE AS area, (4 * count(*) - 2 * coalesce(any_value(shared), 0)) * 5.0::DOUBLE AS perimeter, 4 * count(*) - 2 * coalesce(any_value(shared), 0) AS n_sides FROM g LEFT JOIN n ON n.zone = g.zone GROUP BY 1
""")
def geometry_union(spark, sf_dir):
    """Square lots of parts on a grid, joined by a zone."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select((F.col("p_size") % 3).alias("zone"), rectangle(k % 40 * 5, F.floor(k / 40) * 5, 5, 5).alias("ring"))
    return polygons.dissolved(rows, ["zone"])


@query("""
WITH s AS (SELECT p_partkey, CAST(p_partkey * 7919 % 300 AS BIGINT) AS x, CAST(p_partkey * 104729 % 300 AS BIGINT) AS y, p_size % 6 + 1 AS w, p_partkey % 5 + 1 AS h FROM part),
u AS (SELECT DISTINCT cx, cy FROM (SELECT unnest(range(x, x + w)) AS cx, y, h FROM s) q, range(0, 10) r(d), LATERAL (SELECT y + d AS cy) WHERE d < h)
SELECT cx // 50 AS i, cy // 50 AS j, CAST(count(*) AS DOUBLE) AS covered, round(count(*) / 2500.0 * 100, 6) AS coverage_pct FROM u GROUP BY ALL
""")
def cell_coverage(spark, sf_dir):
    """How much of each square cell the footprints of parts cover, ground under several of them once."""
    k, w, h = F.col("p_partkey"), F.col("p_size") % 6 + 1, F.col("p_partkey") % 5 + 1
    x, y = k * 7919 % 300, k * 104729 % 300
    prints = table(spark, sf_dir, "part").select(rectangle(x, y, w, h).alias("ring")).distinct()  # ground under equal footprints counts once
    cells = spark.range(0, 7).withColumnRenamed("id", "i").crossJoin(spark.range(0, 7).withColumnRenamed("id", "j"))  # 49 cells
    cells = cells.select("i", "j", rectangle(F.col("i") * 50, F.col("j") * 50, 50, 50).alias("cell"))
    pieces = polygons.clip_join(prints, cells, "ring", "cell", 50.0)
    return polygons.coverage(pieces, ["i", "j"], "piece").select("i", "j", F.round("covered", 6).alias("covered"), F.round(F.col("covered") / 2500 * 100, 6).alias("coverage_pct"))


def leaning(spark, sf_dir):
    """A lot for each part: 30 deep, its left line leans in by p_size % 40 and its right one by p_partkey % 5."""
    k, w, lean = F.col("p_partkey"), F.col("p_partkey") % 17 + 60, F.col("p_size") % 40
    x, y = k * 200, F.lit(0)
    ring = F.array(at(x, y), at(x + w, y), at(x + w - k % 5, y + 30), at(x + lean, y + 30))
    return table(spark, sf_dir, "part").select(k.alias("lot"), w.alias("w"), lean.alias("lean"), ring.alias("ring"))


@query("""
WITH l AS (SELECT p_partkey AS lot, p_partkey % 17 + 60 AS w, p_size % 40 AS lean, p_partkey % 5 AS back, p_partkey % 3 = 0 AS corner FROM part), s AS (SELECT *, sqrt(lean * lean + 900.0) AS slant FROM l)
SELECT lot, CAST(w AS DOUBLE) AS front_m, round(CASE WHEN corner THEN slant ELSE 0 END, 6) AS secondary_m, round(w - lean - back + CASE WHEN 30 / slant <= 0.7071 AND NOT corner THEN slant ELSE 0 END, 6) AS rear_m,
  round(sqrt(back * back + 900.0) + CASE WHEN 30 / slant > 0.7071 AND NOT corner THEN slant ELSE 0 END, 6) AS side_m, corner AND 30 / slant <= 0.7071 AS secondary_is_rear FROM s
""")
def boundary_split(spark, sf_dir):
    """Leaning lots: a line that leans far runs along the street and is rear, and every third lot has a second street to its left."""
    rows = leaning(spark, sf_dir)
    x = F.col("lot") * 200
    side = lambda rank, bx, by: F.struct(F.lit(rank).alias("rank"), x.cast("double").alias("ax"), F.lit(0.0).alias("ay"), bx.cast("double").alias("bx"), by.cast("double").alias("by"))
    both = F.when(F.col("lot") % 3 == 0, F.array(side(1, x + F.col("w"), F.lit(0)), side(2, x + F.col("lean"), F.lit(30)))).otherwise(F.array(side(1, x + F.col("w"), F.lit(0))))
    out = polygons.boundary_split(rows.select("lot", "ring"), rows.select("lot", F.explode(both).alias("s")).select("lot", "s.*"))
    return out.select("lot", *[F.round(c, 6).alias(c) for c in ("front_m", "secondary_m", "rear_m", "side_m")], "secondary_is_rear")


@query("""
WITH l AS (SELECT p_partkey AS lot, p_partkey % 17 + 60 AS w, p_size % 40 AS lean, p_partkey % 5 AS back, p_size % 7 AS front, p_size % 4 AS side, CASE WHEN p_partkey % 3 != 0 THEN p_size % 5 END AS rear FROM part)
SELECT lot, round((w - side * (sqrt(lean * lean + 900.0) + sqrt(back * back + 900.0)) / 30) * (30 - front - coalesce(rear, 0)) - (lean + back) / 60.0::DOUBLE * (power(30 - coalesce(rear, 0), 2) - front * front), 6) AS area FROM l
""")
def inset_area(spark, sf_dir):
    """What margins to the front, the sides and the rear leave of leaning lots; a null margin is none."""
    size, rear = F.col("p_size"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size") % 5)
    margins = F.array(*[c.cast("double") for c in (size % 7, size % 4, rear, size % 4)])
    rows = leaning(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("lot"), margins.alias("m")), "lot")
    return rows.select("lot", F.round(polygons.ring_area(polygons.inset(F.col("ring"), F.col("m"))), 6).alias("area"))


@query("""
WITH l AS (SELECT p_partkey AS lot, p_partkey % 30 AS i, p_partkey // 30 AS j FROM part),
r AS (SELECT s_suppkey AS road, CAST(s_suppkey % 7 * 45 AS DOUBLE) AS a, CAST(s_suppkey % 7 * 45 + s_suppkey % 50 + 20 AS DOUBLE) AS b, s_suppkey % 4 AS j FROM supplier)
SELECT lot, road, greatest(least(i * 12 + 12, b) - greatest(i * 12, a), 0) AS length FROM l JOIN r ON r.j = l.j WHERE least(i * 12 + 12, b) > greatest(i * 12, a)
""")
def shared_boundary(spark, sf_dir):
    """Lots in rows over road parcels whose corners are not theirs."""
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    rows = table(spark, sf_dir, "part").select(k.alias("lot"), rectangle(k % 30 * 12, F.floor(k / 30) * 100, 12, 30).alias("ring"))
    a, w = s % 7 * 45, s % 50 + 20
    roads = table(spark, sf_dir, "supplier").select(s.alias("road"), rectangle(a, s % 4 * 100 - 10, w, 10).alias("ring"))
    return polygons.shared_boundary(rows, roads)


@query("""
WITH p AS (SELECT l_orderkey AS lot, l_linenumber % 2 AS zone, l_partkey AS road, sum(l_quantity % 7) / 4.0 AS length FROM lineitem GROUP BY ALL)
SELECT lot, zone, road, CAST(length AS DOUBLE) AS length, CAST(row_number() OVER (PARTITION BY lot, zone ORDER BY length DESC, road) AS INTEGER) AS frontage_rank FROM p WHERE length >= 0.5
""")
def piece_frontage(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("lot"), (F.col("l_linenumber") % 2).alias("zone"), F.col("l_partkey").alias("road")).agg((F.sum(F.col("l_quantity") % 7) / 4).alias("length"))
    return lots.piece_frontage(rows)


@query("""
SELECT o_custkey, count(DISTINCT coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, 'c' || o_orderstatus)) AS n_keys, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS mean_decided FROM orders GROUP BY 1
""")
def coalesced_counts(spark, sf_dir):
    key = F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")), F.concat(F.lit("c"), F.col("o_orderstatus")))
    mean = F.round(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 4)
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.countDistinct(key).alias("n_keys"), mean.alias("mean_decided"))


# Positions.


@query(f"""WITH {PLACES_SQL},
k AS (SELECT 1 / 298.257223563 / (2 - 1 / 298.257223563) AS n), p AS (SELECT c_custkey, radians(lat) AS phi, radians(lon + 73.5) AS lam, n, 2 * sqrt(n) / (1 + n) AS e FROM places, k),
t AS (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM p), z AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t),
c AS (SELECT *, n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1, 13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3, 0.9996 * 6378137.0 / (1 + n) * (1 + n * n / 4 + power(n, 4) / 64) AS r FROM z)
SELECT c_custkey, round(r * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)), 3) AS x,
  round(r * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta)), 3) AS y, true AS returns FROM c
""")
def metric_places(spark, sf_dir):
    """Places in metres about a meridian, and whether the way back ends within a hundredth of a millionth of a degree."""
    p = places(spark, sf_dir).withColumn("m", geodesy.metric(F.col("lon"), F.col("lat"), -73.5)).withColumn("b", geodesy.unmetric(F.col("m.x"), F.col("m.y"), -73.5))
    back = (F.abs(F.col("b.lon") - F.col("lon")) < 1e-8) & (F.abs(F.col("b.lat") - F.col("lat")) < 1e-8)
    return p.select("c_custkey", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"), back.alias("returns"))


@query("""
WITH RECURSIVE c AS (SELECT p_partkey, CAST(p_partkey * 7919 % 1024 AS BIGINT) AS x, CAST(p_partkey * 104729 % 1024 AS BIGINT) AS y FROM part),
h AS (SELECT p_partkey, x, y, 9 AS k, CAST(0 AS BIGINT) AS d FROM c UNION ALL
  SELECT p_partkey, CASE WHEN (y >> k) & 1 = 0 THEN CASE WHEN (x >> k) & 1 = 1 THEN (1 << k) - 1 - (y & ((1 << k) - 1)) ELSE y & ((1 << k) - 1) END ELSE x & ((1 << k) - 1) END,
    CASE WHEN (y >> k) & 1 = 0 THEN CASE WHEN (x >> k) & 1 = 1 THEN (1 << k) - 1 - (x & ((1 << k) - 1)) ELSE x & ((1 << k) - 1) END ELSE y & ((1 << k) - 1) END,
    k - 1, d + (1 << k) * (1 << k) * xor(3 * ((x >> k) & 1), (y >> k) & 1) FROM h WHERE k >= 0)
SELECT p_partkey, d AS hilbert, CAST(row_number() OVER (ORDER BY d, p_partkey) AS INTEGER) AS place FROM h WHERE k = -1
""")
def hilbert_order(spark, sf_dir):
    """Cells of level 10 in the order of the Hilbert curve; the places come from ranges, not from one window."""
    from .operators.relational import rank_within

    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", geodesy.hilbert(k * 7919 % 1024, k * 104729 % 1024, 10).alias("hilbert"))
    return rank_within(rows, [], [F.asc("hilbert"), F.asc("p_partkey")], "place")


# Planning texts.

#: Texts about orders: each key's numbers stand where a by-law, a notice or a minute has them.
ITEM_SQL = """
i AS (SELECT o_orderkey AS item, CAST(10000 + o_orderkey % 89999 AS VARCHAR) AS z, CAST(o_orderkey % 9 + 1 AS VARCHAR) AS arr, CAST(100 + o_orderkey % 899 AS VARCHAR) AS num, CAST(1000000 + o_orderkey % 8999999 AS VARCHAR) AS lot,
  CAST(o_orderkey % 4000 + 1 AS VARCHAR) AS civic, o_orderkey % 4 AS street, o_orderkey % 5 AS kind, CAST(o_orderkey % 28 + 1 AS INTEGER) AS day, CAST(o_orderkey % 12 + 1 AS INTEGER) AS month, o_orderkey % 30 + 2 AS n, o_orderkey % 11 + 2 AS floors FROM orders)
"""


def planning_texts(spark, sf_dir):
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    pick = lambda n, *options: F.element_at(F.array(*[F.lit(o) for o in options]), (k % n + 1).cast("int"))
    lot, zone = text(1000000 + k % 8999999), text(10000 + k % 89999)
    kind = pick(5, "Modification réglementaire de la zone.", "Projet particulier de construction.", "Demande de dérogation mineure.", "Demande de démolition du bâtiment.", "Le trésorier dépose son rapport.")
    said = pick(5, "il est résolu d’adopter le règlement.", "il est résolu d'adopter le projet.", "la demande de dérogation est refusée.", "il est résolu d’autoriser la démolition.", "Le budget suit.")
    street = pick(4, "chemin Sainte-Foy. Le conseil est d'accord", "rue St. Louis", "boulevard René-Lévesque Ouest", "avenue de la Couronne")
    month = F.element_at(F.array(*[F.lit(m) for m in ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")]), (k % 12 + 1).cast("int"))
    parts = [
        "Séance tenue le lundi ", text(k % 28 + 1), " ", month, " 2024, à 19 h.\nRèglement R.C.A. ", text(k % 9 + 1), " V.Q. ", text(100 + k % 899), " et R.V.Q. 1400, relativement à la zone ", zone, " Hb.\n", kind,
        "\nLes zones voisines sont 11111Ha et ", zone, "Hb. Le lot numéro ", F.concat(F.substring(lot, 1, 1), F.lit(" "), F.substring(lot, 2, 3), F.lit(" "), F.substring(lot, 5, 3)), " du cadastre est au ",
        text(k % 4000 + 1), ", ", street, ".\nGroupes d’usages H1, C2 et P3. Le nombre de logements autorisé passe de ", text(k % 30 + 2), " à ", text(k % 30 + 6), " logements; le bâtiment de deux étages et de ", text(k % 11 + 2), " étages a une hauteur maximale de 12,5 m.\n A 9 \n B ",
        text(k % 7), "\nAbstention 2\nLe conseil, ", said,
    ]
    # A small file is one task, and reading a text costs much: orders are dealt over all partitions.
    orders = table(spark, sf_dir, "orders").select("o_orderkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return orders.select(k.alias("item"), F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("text"))


@query(f"""WITH {ITEM_SQL}
SELECT item, CASE kind WHEN 0 THEN 'zoning_amendment' WHEN 1 THEN 'zoning_amendment' WHEN 2 THEN 'zoning_amendment' WHEN 3 THEN 'zoning_amendment' ELSE 'zoning_amendment' END AS item_kind,
  CASE kind WHEN 1 THEN 'ppcmoi' WHEN 2 THEN 'minor_variance' WHEN 3 THEN 'demolition' WHEN 0 THEN 'zoning_amendment' END AS kind_of_matter,
  z || 'Hb,11111Ha' AS zones, z || 'Hb' AS subject, 'R.C.A.' || arr || 'V.Q. ' || num || ',R.V.Q. 1400' AS bylaws, lot AS lots,
  civic || CASE street WHEN 0 THEN ', chemin Sainte-Foy' WHEN 1 THEN ', rue St. Louis' WHEN 2 THEN ', boulevard René-Lévesque Ouest' ELSE ', avenue de la Couronne' END AS addresses, 'H1,C2,P3' AS usages,
  CAST(n AS INTEGER) AS before, CAST(n + 4 AS INTEGER) AS after, 'zoning' AS scope, CASE WHEN floors = 2 THEN '2' ELSE '2,' || floors END AS storeys, 12.5::DOUBLE AS height_m,
  CASE kind WHEN 0 THEN 'adopted' WHEN 1 THEN 'draft_adopted' WHEN 2 THEN 'refused' WHEN 3 THEN 'approved' END AS decision, CASE kind WHEN 0 THEN 'approved' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'refused' WHEN 3 THEN 'approved' END AS outcome,
  make_date(2024, month, day) AS decided_on, CAST(11 + item % 7 AS INTEGER) AS n_votes FROM i
""")
def planning_items(spark, sf_dir):
    """Fields of a text for each order; `kind_of_matter` is that of its second paragraph alone, as the by-law's number makes every whole text an amendment."""
    text = F.col("text")
    change = F.get(planning.dwelling_changes(text), 0)
    rows = planning_texts(spark, sf_dir).withColumn("decision", planning.decision(text)).withColumn("matter", F.element_at(F.split("text", "\n"), 3))
    return rows.select(
        "item", planning.item_kind(text).alias("item_kind"), planning.item_kind(F.col("matter")).alias("kind_of_matter"), F.array_join(planning.zones(text), ",").alias("zones"), F.array_join(planning.subject_zones(text, F.lit(None)), ",").alias("subject"),
        F.array_join(planning.bylaws(text), ",").alias("bylaws"), F.array_join(planning.lot_numbers(text), ",").alias("lots"), F.array_join(planning.addresses(text), ",").alias("addresses"), F.array_join(planning.usage_groups(text), ",").alias("usages"),
        change["before"].alias("before"), change["after"].alias("after"), change["scope"].alias("scope"), F.array_join(F.transform(planning.storeys(text), lambda n: n.cast("string")), ",").alias("storeys"), planning.height_m(text).alias("height_m"),
        "decision", planning.outcome(F.col("decision")).alias("outcome"), planning.decision_date(text).alias("decided_on"), F.aggregate(F.map_values(planning.votes(text)), F.lit(0), lambda s, n: s + n).alias("n_votes"),
    )


DOORS_SQL = """
items AS (SELECT o_orderkey AS item, o_custkey % 300 AS lot, o_orderkey % 90 + 1 AS civic, o_orderkey % 6 AS street, o_orderkey % 4 AS says, o_custkey % 40 AS zone FROM orders),
doors AS (SELECT c_custkey AS address_id, c_custkey % 90 + 1 AS civic, 'rue ' || chr(CAST(65 + c_nationkey % 5 AS INTEGER)) || 'bord' AS street, CASE c_nationkey % 3 WHEN 1 THEN ' est' WHEN 2 THEN ' ouest' ELSE '' END AS cardinal, 1000000 + c_custkey % 250 AS lot, c_mktsegment AS hood FROM customer),
lots AS (SELECT DISTINCT 1000000 + p_partkey % 280 AS lot FROM part)
"""


@query(f"""WITH {DOORS_SQL},
a AS (SELECT item, civic || ', Rue ' || chr(CAST(65 + street AS INTEGER)) || 'bord' AS site_key, says = 0 AS subject, civic, 'rue ' || lower(chr(CAST(65 + street AS INTEGER))) || 'bord' AS street FROM items WHERE says != 3),
m AS (SELECT a.item, a.site_key, a.subject, d.cardinal != '' AS by_cardinal, d.hood, l.lot FROM a JOIN doors d ON d.civic = a.civic AND lower(d.street) = a.street JOIN lots l ON l.lot = d.lot),
b AS (SELECT *, row_number() OVER (PARTITION BY item, site_key ORDER BY by_cardinal, CASE WHEN hood = 'BUILDING' THEN 0 ELSE 1 END, CAST(lot AS VARCHAR)) AS n FROM m)
SELECT item, 'lot' AS site_kind, substr(CAST(1000000 + i.lot AS VARCHAR), 1, 1) || ' ' || substr(CAST(1000000 + i.lot AS VARCHAR), 2, 3) || ' ' || substr(CAST(1000000 + i.lot AS VARCHAR), 5) AS site_key, true AS is_subject, 'lot_number' AS match_basis, CAST(l.lot AS VARCHAR) AS lot_number, NULL AS feature_id
FROM items i JOIN lots l ON l.lot = 1000000 + i.lot
UNION ALL SELECT item, 'address', site_key, subject, CASE WHEN by_cardinal THEN 'address_cardinal' ELSE 'address' END, CAST(lot AS VARCHAR), NULL FROM b WHERE n = 1
UNION ALL SELECT item, 'zone', 'z' || zone, zone % 2 = 0, 'zone', NULL, 'z' || zone FROM items WHERE zone < 25
""")
def placed_decisions(spark, sf_dir):
    """Orders name lots, addresses and zones; customers are doors, parts lots and nations zones."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    street = F.concat((k % 90 + 1).cast("string"), F.lit(", Rue "), F.char(65 + k % 6), F.lit("bord"))
    lot = (1000000 + c % 300).cast("string")
    spaced = F.concat(F.substring(lot, 1, 1), F.lit(" "), F.substring(lot, 2, 3), F.lit(" "), F.substring(lot, 5, 3))
    zone = F.concat(F.lit("z"), (c % 40).cast("string"))
    items = table(spark, sf_dir, "orders").select(
        k.alias("item"), F.to_json(F.array(spaced)).alias("lot_numbers"), F.when(k % 4 != 3, F.to_json(F.array(street))).alias("addresses"), F.when(k % 4 == 0, F.to_json(F.array(street))).otherwise("[]").alias("subject_addresses"),
        F.to_json(F.array(zone)).alias("zone_codes"), F.when(c % 40 % 2 == 0, F.to_json(F.array(zone))).otherwise("[]").alias("subject_zone_codes"),
    )
    n = F.col("c_nationkey")
    name = F.concat(F.lit("rue "), F.char(65 + n % 5), F.lit("bord"), F.when(n % 3 == 1, " est").when(n % 3 == 2, " ouest").otherwise(""))
    doors = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("address_id"), (F.col("c_custkey") % 90 + 1).cast("int").alias("civic_number"), name.alias("street_name"), (1000000 + F.col("c_custkey") % 250).cast("string").alias("lot_number"), F.col("c_mktsegment").alias("neighborhood"), F.lit(1).alias("scrape_date"))
    parcels = table(spark, sf_dir, "part").select((1000000 + F.col("p_partkey") % 280).cast("string").alias("lot_number"), F.col("p_size").alias("scrape_date"))
    zones = table(spark, sf_dir, "nation").select(F.concat(F.lit("z"), F.col("n_nationkey").cast("string")).alias("feature_id"), F.lit("zoning").alias("source_table"), F.lit(1).alias("scrape_date"))
    return placement.place_items(items, parcels, doors, zones, "BUILDING")


@query(f"""WITH {DOORS_SQL},
m AS (SELECT item, d.cardinal != '' AS by_cardinal, min(d.hood) AS lo, max(d.hood) AS hi FROM items i JOIN doors d ON d.civic = i.civic AND d.street = 'rue ' || chr(CAST(65 + i.street AS INTEGER)) || 'bord' GROUP BY ALL),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY item ORDER BY by_cardinal) = 1)
SELECT i.item, CASE WHEN lo = hi THEN lo END AS neighborhood, CASE WHEN lo = hi THEN CASE WHEN by_cardinal THEN 'address_cardinal' ELSE 'address' END END AS match_basis FROM items i LEFT JOIN b USING (item)
""")
def decision_boroughs(spark, sf_dir):
    """Orders as decisions at an address, customers as doors: the borough of the door, if all doors met agree."""
    k, n = F.col("o_orderkey"), F.col("c_nationkey")
    asked = table(spark, sf_dir, "orders").select(k.alias("item"), F.concat((k % 90 + 1).cast("string"), F.lit(", rue "), F.char(65 + k % 6), F.lit("bord")).alias("address"))
    name = F.concat(F.lit("rue "), F.char(65 + n % 5), F.lit("bord"), F.when(n % 3 == 1, " est").when(n % 3 == 2, " ouest").otherwise(""))
    doors = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 90 + 1).cast("int").alias("civic_number"), name.alias("street_name"), F.col("c_mktsegment").alias("neighborhood"))
    return placement.borough_of(asked, doors, "item").drop("address")


@query()
def chunk_positions(spark, sf_dir):
    """Where the chunks of each document stand in it; a test holds the stretches against the chunks' words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.chunk_spans(docs, texts.chunk_documents(docs))


# Published grids and what lots carry of them.


@query("""
WITH s AS (SELECT CASE WHEN c_nationkey % 6 != 0 THEN c_nationkey % 6 END AS neighborhood, CASE c_custkey % 4 WHEN 0 THEN 'total' ELSE c_custkey % 4 || ' bedrooms' END AS bedroom_type, max(CASE WHEN c_acctbal > 0 THEN round(c_acctbal, 2) END) AS average_rent_cad FROM customer GROUP BY ALL)
SELECT neighborhood, count(average_rent_cad) AS published, max(average_rent_cad) FILTER (WHERE bedroom_type = 'total') AS overall, string_agg(bedroom_type, ',' ORDER BY bedroom_type) AS kinds, 2024 AS survey_year FROM s GROUP BY 1
""")
def rent_payloads(spark, sf_dir):
    """A survey by nation of customers as each borough's JSON, read back; nations divisible by six have no borough."""
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    kind = F.when(k % 4 == 0, "total").otherwise(F.concat((k % 4).cast("string"), F.lit(" bedrooms")))
    rents = table(spark, sf_dir, "customer").groupBy(F.when(n % 6 != 0, n % 6).alias("neighborhood"), kind.alias("bedroom_type")).agg(F.max(F.when(F.col("c_acctbal") > 0, F.round("c_acctbal", 2))).alias("average_rent_cad"))
    rents = rents.withColumn("survey_year", F.lit(2024)).withColumn("survey_period", F.lit("October"))
    lots_of = rents.select("neighborhood").distinct()
    schema = "survey_year int, overall_average_rent_cad double, num_published_cells long, cells array<struct<bedroom_type:string>>"
    read = payloads.with_payloads(lots_of, [payloads.rents_payload(rents)]).withColumn("j", F.from_json("rents", schema))
    return read.select("neighborhood", F.col("j.num_published_cells").alias("published"), F.col("j.overall_average_rent_cad").alias("overall"), F.array_join("j.cells.bedroom_type", ",").alias("kinds"), F.col("j.survey_year").alias("survey_year"))


@query("""
WITH e AS (SELECT l_orderkey AS lot_uid, l_partkey % 3 AS feature_id, l_linenumber, l_quantity % 2 = 0 AS house, l_returnflag = 'A' AS shop, l_linestatus = 'F' AS ready, CASE WHEN l_suppkey % 3 != 0 THEN l_suppkey % 4 END AS most, l_linenumber % 2 = 0 AS governs FROM lineitem),
c AS (SELECT * FROM e WHERE (house OR shop) AND ready),
p AS (SELECT *, bool_or(governs AND house) OVER (PARTITION BY lot_uid, feature_id) AS governed FROM c), q AS (SELECT *, NOT governed OR (governs AND house) AS considered FROM p),
f AS (SELECT lot_uid, feature_id FROM q GROUP BY ALL HAVING bool_or(house AND considered) AND NOT bool_or(shop AND considered) AND NOT bool_or(house AND considered AND NOT coalesce(most <= 1, false)))
SELECT lot_uid, feature_id, count(*) AS n_rows, sum(l_linenumber) AS line_sum FROM c WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lot_uid = c.lot_uid AND f.feature_id = c.feature_id) GROUP BY ALL
""")
def candidate_envelopes(spark, sf_dir):
    """Lines stand in for zoning rows of pieces: which of them a building is designed for, by piece."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("lot_uid"), (F.col("l_partkey") % 3).alias("feature_id"), "l_linenumber", (F.col("l_quantity") % 2 == 0).alias("permits_residential"), (F.col("l_returnflag") == "A").alias("permits_commercial"),
        (F.col("l_linestatus") == "F").alias("solver_ready"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey") % 4).alias("max_dwellings"), (F.col("l_linenumber") % 2 == 0).alias("governs_residential"),
    )
    return envelopes.candidate_envelopes(rows).groupBy("lot_uid", "feature_id").agg(F.count("*").alias("n_rows"), F.sum("l_linenumber").alias("line_sum"))


@query("""
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'supérieur' WHEN 'O' THEN 'moyen' END AS o_orderstatus_label, o_custkey % 4 AS grade, CASE o_custkey % 4 WHEN 0 THEN 'aucun' WHEN 1 THEN 'un' WHEN 2 THEN 'deux' END AS grade_label FROM orders
WHERE o_orderpriority != '5-LOW' OR o_orderkey % 10 = 0
""")
def coded_labels(spark, sf_dir):
    """Labels of coded fields, and the lines of a network that are roads: a low priority stands in for a class that is none, unless it is missing."""
    rows = table(spark, sf_dir, "orders").withColumn("class", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")))
    roads = grids.roadway_only(rows, {"class": ["5-LOW"], "not_there": ["x"]})
    domains = spark.createDataFrame([("o_orderstatus", "F", "supérieur"), ("o_orderstatus", "O", "moyen"), ("grade", "0", "aucun"), ("grade", "1", "un"), ("grade", "2", "deux"), ("other", "x", "y")], "field string, code string, label string")
    coded = roads.select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 4).alias("grade"))
    return grids.with_labels(coded, domains).select("o_orderkey", "o_orderstatus", "o_orderstatus_label", "grade", "grade_label")


@query("""
SELECT 'Z' || p_partkey AS zone, CAST(p_size AS VARCHAR) AS "Hauteur: Max", CAST(p_size % 7 AS VARCHAR) AS "Marges: Max", p_brand AS "H1 autorisé", CASE WHEN p_size % 3 != 0 THEN p_type END AS "Note" FROM part WHERE p_partkey < (SELECT max(p_partkey) - 3 FROM part)
""")
def two_row_headers(spark, sf_dir):
    """Parts as the rows of a sheet with a title, two header rows, and a footer behind a blank row."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    body = p.withColumn("last", F.lit(p.agg(F.max("p_partkey")).first()[0]))
    first = F.when(F.col("p_partkey") < F.col("last") - 3, F.concat(F.lit("Z"), F.col("p_partkey").cast("string"))).when(F.col("p_partkey") == F.col("last") - 3, " ").otherwise("Source: la ville")
    cells = F.array(first, size.cast("string"), (size % 7).cast("string"), F.col("p_brand"), F.lit("unnamed"), F.when(size % 3 != 0, F.col("p_type")).otherwise(" "))
    rows = body.select((F.col("p_partkey") + 3).cast("int").alias("row_index"), cells.alias("cells"))
    head = spark.createDataFrame([(0, ["Grille", None, None, None, None, None]), (1, ["", "Hauteur", "Marges", "", None, ""]), (2, ["Zone", "Max", "Max", "H1  autorisé", None, "Note"])], "row_index int, cells array<string>")
    return grids.read_grid(head.unionByName(rows), "zone", 3)


@query("""
SELECT o_orderkey, coalesce(l.n, 0) > 0 AS has_lines, l.n AS n_lines, CAST(NULL AS DOUBLE) AS absent FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
""")
def optional_columns(spark, sf_dir):
    """Columns of an input that may be absent: one that is there, and one that is not."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    out = payloads.with_optional(payloads.with_optional(o, lines, ["o_orderkey"], {"n_lines": "long"}), None, ["o_orderkey"], {"absent": "double"})
    return out.select("o_orderkey", truth(F.col("n_lines") > 0).alias("has_lines"), "n_lines", "absent")


@query("""
WITH p AS (SELECT p_partkey, p_size % 9 + 1 AS total, p_size % 2 = 0 AS a, p_size % 3 = 0 AS g, p_size % 5 = 0 AS b, p_size % 7 = 0 AS s, p_partkey % 4 AS u FROM part)
SELECT p_partkey, CAST(least(CASE WHEN a THEN total - 1 ELSE 0 END + CASE WHEN g THEN 1 ELSE 0 END + CASE WHEN s THEN 1 ELSE 0 END, total) AS INTEGER) AS storeys, CASE WHEN b THEN 1 ELSE 0 END AS cellars,
  CAST(greatest(floor(total * 2.5 / 3), 1) AS INTEGER) AS ceiling, CASE u WHEN 0 THEN 8 WHEN 1 THEN 1 END AS most_dwellings FROM p
""")
def storey_permissions(spark, sf_dir):
    """Parts stand in for columns of a grid: the levels it marks, a height, and its usage codes."""
    size, k = F.col("p_size"), F.col("p_partkey")
    total = size % 9 + 1
    levels = F.array_compact(F.array(F.when(size % 2 == 0, lots.ALL_BUT_GROUND), F.when(size % 3 == 0, lots.GROUND), F.when(size % 5 == 0, lots.BELOW), F.when(size % 7 == 0, lots.SECOND)))
    usages = F.when(k % 4 == 0, F.array(F.lit("H.2"), F.lit("H.4A (3)"), F.lit("C.1"))).when(k % 4 == 1, F.array(F.lit("H.1"))).when(k % 4 == 2, F.array(F.lit("H"), F.lit("H.1"))).otherwise(F.array(F.lit("C.4")))
    return table(spark, sf_dir, "part").select(k, lots.storeys_by_levels(levels, total).alias("storeys"), lots.basement_levels(levels, True).alias("cellars"), lots.storey_ceiling(total * 2.5).alias("ceiling"), lots.class_max_dwellings(usages).alias("most_dwellings"))


@query("""
WITH i AS (SELECT o_orderstatus AS series, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, avg(o_totalprice) AS idx FROM orders WHERE quarter(o_orderdate) != 2 GROUP BY ALL),
n AS (SELECT series, max(quarter) AS newest, arg_max(idx, quarter) AS idx_now FROM i GROUP BY 1)
SELECT o_orderkey, round(CASE WHEN i.idx > 0 AND i.quarter != newest THEN o_totalprice * idx_now / i.idx ELSE o_totalprice END, 2) AS value, CASE WHEN i.idx > 0 THEN newest ELSE CAST(date_trunc('quarter', o_orderdate) AS DATE) END AS period,
  CASE WHEN i.idx IS NULL THEN 'unescalated' WHEN i.quarter = newest THEN 'measured' ELSE 'escalated' END AS basis
FROM orders LEFT JOIN i ON i.series = o_orderstatus AND i.quarter = CAST(date_trunc('quarter', o_orderdate) AS DATE) LEFT JOIN n ON n.series = o_orderstatus
""")
def moved_rents(spark, sf_dir):
    """Prices of orders moved to the newest quarter of their own status's index, which lacks every second quarter of a year."""
    o = table(spark, sf_dir, "orders").withColumn("quarter", F.trunc("o_orderdate", "quarter"))
    index = o.where(F.quarter("o_orderdate") != 2).groupBy("o_orderstatus", "quarter").agg(F.avg("o_totalprice").alias("idx"))
    newest = index.groupBy("o_orderstatus").agg(F.max("quarter").alias("newest"), F.max_by("idx", "quarter").alias("idx_now"))
    rows = o.join(index, ["o_orderstatus", "quarter"], "left").join(newest, "o_orderstatus", "left")
    return rows.select("o_orderkey", finance.moved(F.col("o_totalprice"), F.col("quarter"), F.col("idx"), F.col("newest"), F.col("idx_now")).alias("m")).select("o_orderkey", F.round("m.value", 2).alias("value"), "m.period", "m.basis")


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey % 7 AS a, 100 + l_suppkey % 5 AS n, l_shipdate FROM lineitem),
r AS (SELECT 'Z' || a AS feature_id, 'R.V.Q. ' || n AS bylaw_number, CAST(l_shipdate AS DATE) AS in_force_date, l_orderkey AS doc_id, l_linenumber AS k FROM c UNION ALL SELECT 'Z' || (a + 1), 'R.V.Q. ' || n, CAST(l_shipdate AS DATE), l_orderkey, l_linenumber FROM c)
SELECT feature_id, bylaw_number, in_force_date, 'R.V.Q.' || substr(bylaw_number, 8) || ' En vigueur le ' || strftime(in_force_date, '%Y-%m-%d') AS excerpt, doc_id FROM r QUALIFY row_number() OVER (PARTITION BY feature_id, bylaw_number ORDER BY doc_id, k, in_force_date) = 1
""")
def bylaws_in_force(spark, sf_dir):
    """Lines stand in for chunks of sheets of two zones that print a by-law."""
    a, n = F.col("l_partkey") % 7, (100 + F.col("l_suppkey") % 5).cast("string")
    ids = F.to_json(F.array(F.concat(F.lit("Z"), a.cast("string")), F.concat(F.lit("Z"), (a + 1).cast("string"))))
    text = F.concat(F.lit("Règlement: R.V.Q."), n, F.lit("\n  En vigueur le "), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(". Rien d'autre."))
    return planning.bylaws_in_force(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("chunk_index"), ids.alias("feature_ids"), text.alias("text")))


@query("""
WITH RECURSIVE f AS (SELECT p_partkey, CASE WHEN p_partkey % 5 != 0 THEN p_retailprice * 100 END AS acquisition, p_retailprice * 300 AS cost, p_retailprice * 25 AS homes, p_retailprice * (p_size % 4) * 5 AS shops, p_size % 30 + 1 AS dwellings, p_retailprice * 6 AS standing, p_retailprice FROM part),
g AS (SELECT *, homes + shops AS noi, 4.5 + shops * 1.75 / (homes + shops) AS cap, greatest(ceil(dwellings / 8.0), 6) AS let, cost * 1.26 AS budget, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * 60 * 1.26 END AS budget2, p_retailprice * 5 AS noi2 FROM f),
m AS (SELECT g.*, y, (SELECT sum(CASE WHEN t > 18 THEN least((t - 18) / let, 1) ELSE 0 END) FROM range(12 * y - 11, 12 * y + 1) r(t)) AS open1, (SELECT sum(CASE WHEN t > 18 THEN least((t - 18) / 6.0, 1) ELSE 0 END) FROM range(12 * y - 11, 12 * y + 1) r(t)) AS open2, (SELECT count(*) FROM range(12 * y - 11, 12 * y + 1) r(t) WHERE t <= 18) / 18.0 AS built FROM g, range(1, 11) years(y)),
z AS (SELECT p_partkey, list(standing + CASE WHEN y = 10 THEN standing / 4.5 * 100 * 0.98 ELSE 0 END ORDER BY y) AS hold, list(noi / 12 * open1 - budget * built + CASE WHEN y = 10 THEN noi / cap * 100 * 0.98 ELSE 0 END ORDER BY y) AS build,
  list(noi / 12 * open1 - budget * built - standing + CASE WHEN y = 10 THEN (noi / cap * 100 - standing / 4.5 * 100) * 0.98 ELSE 0 END ORDER BY y) AS own, list(noi2 / 12 * open2 - budget2 * built + CASE WHEN y = 10 THEN noi2 / 4.5 * 100 * 0.98 ELSE 0 END ORDER BY y) AS adding FROM m GROUP BY p_partkey),
k AS (SELECT g.p_partkey, name, flow FROM g JOIN z USING (p_partkey), LATERAL (SELECT unnest([{'name': 'buyer_hold', 'flow': CASE WHEN acquisition IS NOT NULL THEN list_concat([-acquisition], hold) END}, {'name': 'buyer_rebuild', 'flow': CASE WHEN acquisition IS NOT NULL THEN list_concat([-acquisition], build) END},
  {'name': 'owner_rebuild', 'flow': list_concat([0.0], own)}, {'name': 'owner_enhance', 'flow': CASE WHEN budget2 IS NOT NULL THEN list_concat([0.0], adding) END}, {'name': 'buyer_enhance', 'flow': CASE WHEN acquisition IS NOT NULL AND budget2 IS NOT NULL THEN list_concat([-acquisition], list_transform(hold, lambda x, i: x + adding[i])) END}], recursive := true)) u),
w AS (SELECT p_partkey, name, flow, len(list_filter(flow, lambda x: x > 0)) > 0 AND len(list_filter(flow, lambda x: x < 0)) > 0 AS signs FROM k WHERE flow IS NOT NULL),
h AS (SELECT p_partkey, name, flow, -0.9::DOUBLE AS lo, 2.0::DOUBLE AS hi, 0 AS step FROM w WHERE signs AND list_sum(list_transform(flow, lambda x, i: x / power(0.1, i - 1))) * list_sum(list_transform(flow, lambda x, i: x / power(3.0, i - 1))) < 0
  UNION ALL SELECT p_partkey, name, flow, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END, step + 1 FROM (SELECT *, (lo + hi) / 2 AS mid, list_sum(list_transform(flow, lambda x, i: x / power(1 + (lo + hi) / 2, i - 1))) * list_sum(list_transform(flow, lambda x, i: x / power(1 + lo, i - 1))) > 0 AS up FROM h WHERE step < 60) b),
irr AS (SELECT p_partkey, max(CASE WHEN name = 'buyer_hold' THEN r END) AS a, max(CASE WHEN name = 'buyer_rebuild' THEN r END) AS b, max(CASE WHEN name = 'owner_rebuild' THEN r END) AS c, max(CASE WHEN name = 'owner_enhance' THEN r END) AS d, max(CASE WHEN name = 'buyer_enhance' THEN r END) AS e FROM (SELECT p_partkey, name, (lo + hi) * 50 AS r FROM h WHERE step = 60) x GROUP BY 1)
SELECT p_partkey, round(a, 4) AS buyer_hold_irr_pct, round(b, 4) AS buyer_rebuild_irr_pct, round(c, 4) AS owner_rebuild_irr_pct, round(d, 4) AS owner_enhance_irr_pct, round(e, 4) AS buyer_enhance_irr_pct, round(standing / acquisition * 100, 6) AS hold_yield_pct, round(noi / (acquisition + budget) * 100, 6) AS rebuild_yield_pct, round(cap, 6) AS rebuild_cap_pct, CAST(let AS INTEGER) AS rebuild_let_months,
  round((standing * 10 + standing / 4.5 * 100 * 0.98) / acquisition, 6) AS buyer_hold_multiple, coalesce((noi / (acquisition + budget) * 100 - cap) * 100 >= 150, false) AS clears_cap FROM g LEFT JOIN irr USING (p_partkey)
""")
def site_returns_of_futures(spark, sf_dir):
    """Parts stand in for sites with what stands on them and what could be built; every fifth has no price. The SQL halves its way to the rates of all five flows."""
    k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    nothing = F.lit(None).cast("double")
    sites = table(spark, sf_dir, "part").select(
        k, F.when(k % 5 != 0, price * 100).alias("acquisition"), nothing.alias("site_costs"), (price * 300).alias("rebuild_cost"), (price * 25).alias("rebuild_residential_noi"), (price * (size % 4) * 5).alias("rebuild_commercial_noi"), nothing.alias("rebuild_industrial_noi"),
        (size % 30 + 1).cast("double").alias("rebuild_dwellings"), nothing.alias("rebuild_commercial_m2"), nothing.alias("rebuild_industrial_m2"), F.when(k % 3 == 0, price * 60).alias("enhance_cost"), (price * 5).alias("enhance_residential_noi"), nothing.alias("enhance_commercial_noi"),
        nothing.alias("enhance_industrial_noi"), F.lit(4.0).alias("enhance_dwellings"), (price * 6).alias("standing_noi"), F.lit("teardown").alias("thesis"), F.lit(1.0).alias("verdict"),
    )
    out = proforma.screened(proforma.returns(sites), "thesis", "verdict")
    rates = [F.round(f"{c}_irr_pct", 4).alias(f"{c}_irr_pct") for c in ("buyer_hold", "buyer_rebuild", "owner_rebuild", "owner_enhance", "buyer_enhance")]
    return out.select(k, *rates, *[F.round(c, 6).alias(c) for c in ("hold_yield_pct", "rebuild_yield_pct", "rebuild_cap_pct")], "rebuild_let_months", F.round("buyer_hold_multiple", 6).alias("buyer_hold_multiple"), "clears_cap")


@query("""
SELECT page_id, count(*) AS n_links, count(*) FILTER (WHERE regexp_matches(l, '\\.pdf$')) AS documents, count(*) FILTER (WHERE NOT regexp_matches(l, '\\.pdf$') AND regexp_matches(l, '^https?://')) AS absolute, count(*) FILTER (WHERE NOT regexp_matches(l, '\\.pdf$') AND NOT regexp_matches(l, '^https?://')) AS others
FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '<a href="([^"#]+)"', 1))) AS l FROM pages) GROUP BY page_id
""")
def link_kinds(spark, sf_dir):
    """Links of each page by kind."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(texts.links(F.col("html"))).alias("l"))
    kind = F.coalesce(texts.link_kind(F.col("l"), [("documents", r"\.pdf$"), ("absolute", r"^https?://")]), F.lit("others"))
    return rows.withColumn("kind", kind).groupBy("page_id").agg(F.count("*").alias("n_links"), *[F.count_if(F.col("kind") == x).alias(x) for x in ("documents", "absolute", "others")])


@query("""
WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'non' WHEN 1 THEN 'Secteur A' ELSE ' ' END AS heritage, CASE WHEN p_partkey % 3 = 0 THEN 'PIIA-1' END AS review, 1900 + p_size AS built, CASE WHEN p_partkey % 5 != 0 THEN p_size * 10.0::DOUBLE END AS floor, p_partkey % 7 = 0 AS dirty, p_size % 2 = 0 AS home, (p_size % 3) / 2.0::DOUBLE AS share FROM part),
h AS (SELECT *, heritage = 'Secteur A' AS a, review IS NOT NULL AS b, built < 1940 AS o FROM p),
c AS (SELECT *, coalesce(floor, 0) * CASE WHEN home THEN 150 ELSE 250 END AS demolition, CASE WHEN dirty THEN 12000 ELSE 0 END AS assessment, CASE WHEN dirty THEN 500.0::DOUBLE * CASE WHEN share > 0 THEN 150 ELSE 75 END ELSE 0 END AS remediation FROM h)
SELECT p_partkey, a AS is_heritage_sector, b AS has_review, a OR o AS demolition_review_required, coalesce(floor > 0, false) AND (a OR b) AS is_demolition_restricted, CAST(demolition AS DOUBLE) AS demolition, CAST(assessment AS DOUBLE) AS assessment, CAST(remediation AS DOUBLE) AS remediation, CAST(demolition + assessment + remediation AS DOUBLE) AS site_costs FROM c
""")
def clearing_costs(spark, sf_dir):
    """Parts stand in for sites in sectors, old and new, clean and not."""
    k, size = F.col("p_partkey"), F.col("p_size")
    heritage = F.when(k % 4 == 0, "non").when(k % 4 == 1, "Secteur A").otherwise(" ")
    floor = F.when(k % 5 != 0, size * 10.0)
    flags = planning_sites.heritage_flags(heritage, F.when(k % 3 == 0, "PIIA-1"), 1900 + size, floor)
    return table(spark, sf_dir, "part").select(k, *flags, *planning_sites.site_costs(floor, F.lit(500.0), size % 2 == 0, k % 7 == 0, (size % 3) / 2.0))


@query("""
WITH p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 != 0 THEN o_totalprice END AS hold, CASE WHEN o_orderkey % 3 = 0 THEN (o_custkey % 11 - 5) * 10000.0::DOUBLE END AS gain, o_totalprice * (0.6 + o_custkey % 9 / 10.0::DOUBLE) AS rebuild, CASE WHEN o_orderkey % 5 != 0 THEN o_totalprice * 1.1 END AS assessed, (o_custkey % 4) * 5000.0::DOUBLE AS costs, o_orderstatus AS thesis FROM orders),
v AS (SELECT *, coalesce(hold, 0) AS h, rebuild - costs AS r, CASE WHEN assessed IS NOT NULL THEN greatest(assessed, coalesce(hold, 0)) END AS price FROM p),
b AS (SELECT *, h + gain AS e, r - h AS g, greatest(h, h + gain, r) - price AS best FROM v),
f AS (SELECT k, thesis, round(g, 4) AS owner_gain_rebuild, CASE WHEN 0 >= coalesce(gain, -1) AND 0 >= g THEN 'hold' WHEN coalesce(gain, -1e300) >= g THEN 'enhance' ELSE 'rebuild' END AS owner_best, round(price, 4) AS price,
  CASE WHEN price IS NULL THEN NULL WHEN best < 0 THEN 'none' WHEN h >= coalesce(e, h) AND h >= r THEN 'hold' WHEN coalesce(e, -1e300) >= r THEN 'enhance' ELSE 'rebuild' END AS buyer_best, CASE WHEN price IS NOT NULL THEN round((r - price) / price * 100, 6) END AS rate, g FROM b),
o AS (SELECT *, rate IS NOT NULL AND g > 0 AS ok FROM f)
SELECT k, owner_gain_rebuild, owner_best, price, buyer_best, CASE WHEN ok THEN CAST(row_number() OVER (PARTITION BY ok, thesis ORDER BY rate DESC NULLS LAST, owner_gain_rebuild DESC, k) AS INTEGER) END AS thesis_rank,
  ok AND row_number() OVER (PARTITION BY ok, thesis ORDER BY rate DESC NULLS LAST, owner_gain_rebuild DESC, k) <= 25 AS is_top, count(*) FILTER (WHERE ok) OVER (PARTITION BY thesis) AS num_ranked FROM o
""")
def ranked_sites(spark, sf_dir):
    """Orders stand in for sites; the rate is what rebuilding brings over its price, the status the thesis."""
    k, price, c = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 7 != 0, price).alias("hold"), F.when(k % 3 == 0, (c % 11 - 5) * 10000.0).alias("enhance_gain"), (price * (0.6 + c % 9 / 10)).alias("rebuild"), F.when(k % 5 != 0, price * 1.1).alias("assessed"), ((c % 4) * 5000.0).alias("site_costs"), F.col("o_orderstatus").alias("thesis"))
    valued = planning_sites.futures(rows).withColumns({"rate": F.round(F.col("buyer_rebuild") / F.col("price") * 100, 6), "owner_gain_rebuild": F.round("owner_gain_rebuild", 4)})
    out = planning_sites.rank_sites(valued, "thesis", "rate", "rate", "owner_gain_rebuild", "k")
    return out.select("k", "owner_gain_rebuild", "owner_best", F.round("price", 4).alias("price"), "buyer_best", "thesis_rank", "is_top", "num_ranked")


@query("""
WITH r AS (SELECT CASE WHEN c_nationkey % 6 != 0 THEN c_nationkey % 6 END AS hood, ['studio', '1_bedroom', '2_bedroom', '3_bedroom_plus', 'all'][c_custkey % 5 + 1] AS kind, max(CASE WHEN c_acctbal > 9000 THEN c_acctbal END) AS rent, max(CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN -c_acctbal END) AS rate, bool_or(c_mktsegment = 'BUILDING') AS any_rate FROM customer GROUP BY ALL)
SELECT hood AS neighborhood, count(rent) FILTER (WHERE kind != 'all') AS n_priced, round(sum(rent) FILTER (WHERE kind != 'all'), 2) AS rents, count(rate) FILTER (WHERE kind != 'all') AS n_rates, 4 - count(rent) FILTER (WHERE kind != 'all') AS n_suppressed FROM r GROUP BY 1
""")
def unit_economics(spark, sf_dir):
    """Customers stand in for the cells of two surveys."""
    n, k, bal = F.col("c_nationkey"), F.col("c_custkey"), F.col("c_acctbal")
    kind = F.element_at(F.array(*[F.lit(x) for x in (*payloads.PRICED, "all")]), (k % 5 + 1).cast("int"))
    c = table(spark, sf_dir, "customer").select(F.when(n % 6 != 0, n % 6).alias("neighborhood"), kind.alias("bedroom_type"), F.when(bal > 9000, bal).alias("average_rent_cad"), F.when(bal < 0, -bal).alias("vacancy_rate_pct"), F.when(F.col("c_mktsegment") == "BUILDING", "all").otherwise("rows").alias("dwelling_type"))
    out = payloads.unit_economics(c, c)
    total = F.aggregate(F.map_values("rents"), F.lit(0.0), lambda s, x: s + x)
    return out.select("neighborhood", F.size("rents").cast("long").alias("n_priced"), F.round(F.when(F.size("rents") > 0, total), 2).alias("rents"), F.size("vacancies").cast("long").alias("n_rates"), F.size("suppressed").cast("long").alias("n_suppressed"))


@query("""
WITH e AS (SELECT l_orderkey AS lot, l_linenumber AS column_index, 'Z' || (l_partkey % 3) AS feature_id, CAST(l_quantity AS DOUBLE) AS pct_of_lot, l_suppkey FROM lineitem)
SELECT lot, string_agg(feature_id || ':' || column_index || ':' || (l_suppkey % 4), ',' ORDER BY pct_of_lot DESC, feature_id, column_index, l_suppkey % 4) AS listed FROM e GROUP BY lot
""")
def envelope_lists(spark, sf_dir):
    """Lines stand in for zoning rows of lots; a JSON text of each becomes a value of the list, which is read back."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("lot"), F.col("l_linenumber").alias("column_index"), F.concat(F.lit("Z"), (F.col("l_partkey") % 3).cast("string")).alias("feature_id"), F.col("l_quantity").cast("double").alias("pct_of_lot"), F.to_json(F.array(F.col("l_suppkey") % 4)).alias("usages"))
    read = F.from_json("envelopes", "array<struct<feature_id:string,column_index:int,usages:array<int>>>")
    text = lambda e: F.concat_ws(":", e["feature_id"], e["column_index"].cast("string"), F.get(e["usages"], 0).cast("string"))
    return payloads.envelope_lists(rows, ["lot"], {"usages": "array<int>"}).select("lot", F.array_join(F.transform(read, text), ",").alias("listed"))


@query("""
WITH f AS (SELECT regexp_extract(url, '^([a-z]+://[^/?]*)', 1) AS url, page_id AS feature_id, CASE WHEN page_id % 3 != 0 THEN 't' || (page_id % 4) END AS title FROM pages),
t AS (SELECT url, title, min(feature_id) AS first FROM f WHERE title IS NOT NULL GROUP BY ALL)
SELECT f.url, count(DISTINCT feature_id) AS n_features, min(feature_id) AS first_feature, coalesce((SELECT string_agg(title, '; ' ORDER BY first) FROM t WHERE t.url = f.url), '') AS title FROM f GROUP BY f.url
""")
def features_by_url(spark, sf_dir):
    """Pages stand in for features, their hosts for the documents that describe them."""
    k = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^([a-z]+://[^/?]*)", 1).alias("url"), k.alias("feature_id"), F.when(k % 3 != 0, F.concat(F.lit("t"), (k % 4).cast("string"))).alias("title"))
    return payloads.features_by_url(rows).select("url", F.size("feature_ids").cast("long").alias("n_features"), F.get("feature_ids", 0).alias("first_feature"), "title")


@query("""
WITH p AS (SELECT p_partkey AS page, p_size, p_brand, p_partkey % 3 AS gap FROM part)
SELECT page, 'Hauteur max' AS label, 0 AS column_index, CAST(p_size AS VARCHAR) AS text FROM p WHERE gap != 0 UNION ALL SELECT page, 'Hauteur max', 1, CAST(p_size + 1 AS VARCHAR) FROM p WHERE gap != 1
UNION ALL SELECT page, 'Densité', 1, p_brand || ' et plus' FROM p
""")
def placed_grids(spark, sf_dir):
    """A printed page for each part: a title, a header with two columns, and two lines, shown in pieces as typesetters do."""
    size, gap = F.col("p_size"), F.col("p_partkey") % 3
    piece = lambda x0, x1, y, text: F.struct(F.lit(float(x0)).alias("x0"), F.lit(float(x1)).alias("x1"), F.lit(float(y)).alias("y"), F.lit(10.0).alias("height"), text.alias("text"))
    w = F.lit
    pieces = F.array(
        piece(10, 40, 700, w("Grille")), piece(10, 38, 680, w("Colonne")), piece(100, 110, 680, w("A")), piece(200, 210, 680.5, w("B")), piece(10, 45, 660, w("Haut")), piece(45.5, 60, 660, w("eur")), piece(63, 80, 660, w("max")),
        piece(102, 108, 661, F.when(gap != 0, size.cast("string")).otherwise(" ")), piece(198, 212, 659.5, F.when(gap != 1, (size + 1).cast("string")).otherwise("")), piece(10, 30, 640, w("Densit")), piece(30, 34, 640, w("é")),
        piece(180, 195, 640, F.col("p_brand")), piece(198, 203, 640, w("et")), piece(206, 220, 640, w("plus")), piece(154, 156, 640, w("x")),
    )
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), F.explode(pieces).alias("p")).select("page", "p.*")
    return grids.placed_grid(grids.placed_cells(rows), "colonne")


@query("""
WITH s AS (SELECT p_partkey AS key, p_size * 30.0::DOUBLE AS lot, p_size % 7 AS fm, p_size % 3 AS cm, CASE WHEN p_partkey % 4 != 0 THEN p_size % 20 END AS dm, CASE WHEN p_partkey % 5 != 0 THEN 1.0 + (p_size % 4) / 2.0::DOUBLE END AS density,
  CASE WHEN p_partkey % 6 != 0 THEN p_size * 20.0::DOUBLE * CASE WHEN p_partkey % 9 = 0 THEN 0.5 ELSE 1 END END AS floor, p_partkey % 3 AS storeys, CAST(round(p_size % 5 * CASE WHEN p_partkey % 9 = 0 THEN 0.5 ELSE 1 END) AS BIGINT) AS homes FROM part),
b AS (SELECT *, coalesce(floor > 0 AND storeys >= 1, false) AS stands, floor / nullif(storeys, 0) AS plate FROM s),
c AS (SELECT b.*, r, cc FROM b, range(0, 3) t1(r), range(0, 3) t2(cc) WHERE stands AND r <= least(2, fm - storeys) AND cc <= least(cm, least(2, fm - storeys) - r) AND r + cc > 0),
d AS (SELECT *, least(CAST(floor(plate * r / 85.0) AS BIGINT), greatest(coalesce(dm, 1099511627776) - homes, 0)) AS dw, plate * (r + cc) AS added FROM c),
v AS (SELECT *, (dw * 2400.0 * 12 * 0.95 + plate * cc / 0.09290304 * 60.0 * 0.95) * 0.65 AS noi, added * 1400.0 * 1.5 AS cost FROM d WHERE ceil(dw * 0.5 + plate * cc / 100 * 1.0) <= floor(greatest(lot - plate, 0) * 0.25 / 32.0) AND coalesce((floor + added) / lot <= density, true)),
w AS (SELECT *, noi * ((1 - power(1.06, -30)) / 0.06) - cost AS npv FROM v QUALIFY row_number() OVER (PARTITION BY key ORDER BY round(noi * ((1 - power(1.06, -30)) / 0.06) - cost, 2) DESC, r, cc) = 1)
SELECT b.key, CASE WHEN NOT stands THEN 'no_building' WHEN w.key IS NULL THEN 'no_room' WHEN npv <= 0 THEN 'nothing_pencils' ELSE 'enhanced' END AS status, CASE WHEN npv > 0 THEN CAST(r AS INTEGER) END AS added_residential, CASE WHEN npv > 0 THEN CAST(cc AS INTEGER) END AS added_commercial,
  CASE WHEN npv > 0 THEN dw END AS added_dwellings, CASE WHEN npv > 0 THEN round(npv, 1) END AS npv FROM b LEFT JOIN (SELECT key, r, cc, dw, npv FROM w) w ON w.key = b.key
""")
def enhancements(spark, sf_dir):
    """Parts stand in for pieces of ground with what stands on them."""
    from .plans import programs

    k, size = F.col("p_partkey"), F.col("p_size")
    sites = table(spark, sf_dir, "part").select(
        k.alias("key"), (size * 30.0).alias("lot_m2"), (size % 7).alias("floors_max"), (size % 3).alias("commercial_max"), F.when(k % 4 != 0, size % 20).alias("dwellings_max"), F.when(k % 5 != 0, 1.0 + (size % 4) / 2.0).alias("density_max"),
        F.when(k % 6 != 0, size * 20.0).alias("standing_m2"), (k % 3).alias("standing_storeys"), (size % 5).alias("standing_dwellings"), F.when(k % 9 == 0, 0.5).alias("share"),
    )
    out = programs.best_enhancements(sites, programs.Economics(rent=2400.0, rate_per_square_foot=60.0, cost_m2=1400.0))
    return out.select("key", "status", "added_residential", "added_commercial", "added_dwellings", F.round("npv", 1).alias("npv"))

"""More queries over the driver's tables, each with the same result as SQL; see queries.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import columns as C
from .functions import finance, grid
from .operators import fulltext, linking, lots, relational, retrieval, spatial, texts
from .plans import opportunities, programs
from .queries import PLACES_SQL, boxes, places, query, table


@query()
def decision_links(spark, sf_dir):
    """All orders stand in for items, their customers and dates for the keys that link them. A test holds it against union-find."""
    i = table(spark, sf_dir, "orders").withColumn("item", F.col("o_orderkey"))
    key = F.explode(F.array(F.concat(F.lit("c:"), F.col("o_custkey").cast("string")), F.concat(F.lit("d:"), F.date_format("o_orderdate", "yyyy-MM-dd"))))
    keys = linking.rare_keys(i.select("item", key.alias("key"), "o_orderpriority"), "o_orderpriority", 2, "d:")
    linked = linking.link_items(keys, i).withColumn("decided", F.col("o_orderstatus") == "F").withColumn("first_date", F.col("o_orderdate")).withColumn("kind", F.col("o_orderpriority"))
    out = linking.fold_groups(linked, ["o_orderdate", "item"], "decided", ["first_date"], ["o_orderstatus"], "kind")
    return out.select(F.col("group").alias("group_id"), "n_items", "first_date", F.array_join(F.array_sort("o_orderstatus"), ",").alias("statuses"), "kind")


@query("""
WITH p AS (SELECT p_partkey AS k, p_partkey % 50 AS i, p_partkey // 50 AS j FROM part),
l AS (SELECT * FROM p WHERE i % 4 != 0), r AS (SELECT * FROM p WHERE i % 4 = 0),
s AS (SELECT l.k AS lot, r.k AS road, CASE WHEN l.j = r.j THEN 20.0 ELSE 10.0 END AS length FROM l JOIN r ON (l.j = r.j AND abs(l.i - r.i) = 1) OR (l.i = r.i AND abs(l.j - r.j) = 1)),
x AS (SELECT *, row_number() OVER (PARTITION BY lot ORDER BY length DESC, road) AS n FROM s)
SELECT lot, max(road) FILTER (WHERE n = 1) AS primary_road, CAST(max(length) FILTER (WHERE n = 1) AS DOUBLE) AS primary_m, max(road) FILTER (WHERE n = 2) AS secondary_road, CAST(max(length) FILTER (WHERE n = 2) AS DOUBLE) AS secondary_m, count(*) AS num_frontages
FROM x GROUP BY lot
""")
def lot_frontage(spark, sf_dir):
    """Parts stand in for lots: rectangles of 10 by 20 on a grid, every fourth column a road."""
    k = F.col("p_partkey")
    x, y = (k % 50 * 10).cast("double"), (F.floor(k / 50) * 20).cast("double")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    rows = table(spark, sf_dir, "part").select(k.alias("lot"), (k % 50).alias("i"), F.array(corner(x, y), corner(x + 10, y), corner(x + 10, y + 20), corner(x, y + 20)).alias("ring"))
    return lots.frontage(lots.shared_edges(rows.where("i % 4 != 0").select("lot", "ring"), rows.where("i % 4 = 0").select(F.col("lot").alias("road"), "ring")))


@query("""
WITH a AS (SELECT c_custkey AS lot, CAST(c_custkey * 7919 % 3001 AS DOUBLE) AS ax0, CAST(c_custkey * 104729 % 3001 AS DOUBLE) AS ay0, c_custkey % 40 + 1 AS w, c_custkey % 43 + 1 AS h FROM customer),
b AS (SELECT p_partkey AS zone, CAST(p_partkey * 7919 % 3001 AS DOUBLE) AS bx0, CAST(p_partkey * 104729 % 3001 AS DOUBLE) AS by0, p_partkey % 90 + 1 AS v, p_partkey % 93 + 1 AS g FROM part),
o AS (SELECT lot, zone, greatest(least(ax0 + w, bx0 + v) - greatest(ax0, bx0), 0) * greatest(least(ay0 + h, by0 + g) - greatest(ay0, by0), 0) AS area, CAST(w * h AS DOUBLE) AS lot_area
  FROM a JOIN b ON ax0 <= bx0 + v AND bx0 <= ax0 + w AND ay0 <= by0 + g AND by0 <= ay0 + h)
SELECT lot, zone, area, round(area / lot_area * 100, 6) AS pct_of_lot, round(area / sum(area) OVER (PARTITION BY lot), 6) AS area_share, CAST(row_number() OVER (PARTITION BY lot ORDER BY area DESC, zone) AS INTEGER) AS zone_rank,
  count(*) OVER (PARTITION BY lot) AS num_lot_zones, row_number() OVER (PARTITION BY lot ORDER BY area DESC, zone) = 1 AS is_primary_zone
FROM o WHERE (area / lot_area >= 0.01 AND area >= 1) OR area >= 500
""")
def zone_pieces(spark, sf_dir):
    a = boxes(table(spark, sf_dir, "customer"), "c_custkey", "a", 3001, 40, ("lot", "ax0", "ay0", "ax1", "ay1"))
    b = boxes(table(spark, sf_dir, "part"), "p_partkey", "b", 3001, 90, ("zone", "bx0", "by0", "bx1", "by1"))
    left, right = spatial.box(*[F.col(c) for c in ("ax0", "ay0", "ax1", "ay1")]), spatial.box(*[F.col(c) for c in ("bx0", "by0", "bx1", "by1")])
    pairs = spatial.cell_join(a, b, left, right, 100.0, F.lit(True))
    rows = pairs.select("lot", "zone", spatial.overlap_area(left, right).alias("area"), ((F.col("ax1") - F.col("ax0")) * (F.col("ay1") - F.col("ay0"))).alias("lot_area"))
    out = lots.zone_pieces(rows)
    return out.select("lot", "zone", "area", F.round("pct_of_lot", 6).alias("pct_of_lot"), F.round("area_share", 6).alias("area_share"), "zone_rank", "num_lot_zones", "is_primary_zone")


@query("""
WITH p AS (SELECT c_custkey AS pt, c_custkey * 7919 % 2003 + 0.5::DOUBLE AS x, c_custkey * 104729 % 2003 + 0.25::DOUBLE AS y FROM customer),
b AS (SELECT p_partkey AS area, CAST(p_partkey * 6007 % 2003 AS DOUBLE) AS x0, CAST(p_partkey * 3331 % 2003 AS DOUBLE) AS y0, p_partkey % 30 + 2 AS s FROM part),
w AS (SELECT pt, area FROM p JOIN b ON x >= x0 AND x < x0 + s AND y >= y0 AND y < y0 + s QUALIFY row_number() OVER (PARTITION BY pt ORDER BY s * s, area) = 1),
n AS (SELECT pt, area, greatest(x0 - x, x - x0 - s, 0) AS dx, greatest(y0 - y, y - y0 - s, 0) AS dy FROM p JOIN b ON x >= x0 - 12 AND x <= x0 + s + 12 AND y >= y0 - 12 AND y <= y0 + s + 12 WHERE pt NOT IN (SELECT pt FROM w)),
t AS (SELECT pt, area FROM n WHERE sqrt(dx * dx + dy * dy) <= 12 QUALIFY row_number() OVER (PARTITION BY pt ORDER BY round(sqrt(dx * dx + dy * dy), 9), area) = 1)
SELECT pt, area, 'within' AS placed_by FROM w UNION ALL SELECT pt, area, 'snapped' FROM t
""")
def contained_or_snapped(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pt"), (F.col("c_custkey") * 7919 % 2003 + 0.5).alias("x"), (F.col("c_custkey") * 104729 % 2003 + 0.25).alias("y"))
    x0, y0, s = (F.col("p_partkey") * 6007 % 2003).cast("double"), (F.col("p_partkey") * 3331 % 2003).cast("double"), F.col("p_partkey") % 30 + 2
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("area"), F.array(corner(x0, y0), corner(x0 + s, y0), corner(x0 + s, y0 + s), corner(x0, y0 + s)).alias("ring"))
    return spatial.contained_or_snapped(p, b, "pt", "area", "x", "y", "ring", 50.0, 12.0)


@query("""
SELECT p_partkey, least(CASE WHEN p_size % 4 != 0 THEN p_size % 12 + 1 END, CASE WHEN p_size % 5 != 0 THEN greatest(CAST(floor((p_size % 31 - 4.0) / 3.0) AS BIGINT) + 1, 1) END) AS floors FROM part
""")
def permitted_floors(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", lots.permitted_floors(F.when(size % 4 != 0, size % 12 + 1), F.when(size % 5 != 0, (size % 31).cast("double"))).alias("floors"))


@query("""
WITH p AS (SELECT p_partkey, unnest([{'k': 1, 'use': 'parking', 'n': p_size % 3}, {'k': 2, 'use': 'commercial', 'n': p_size % 2}, {'k': 3, 'use': 'residential', 'n': p_size % 5}], recursive := true) FROM part)
SELECT p_partkey, "use", CAST(sum(n) OVER w - n + 1 AS INTEGER) AS from_level, CAST(sum(n) OVER w AS INTEGER) AS to_level, CAST(n AS INTEGER) AS floors, n * 100.0::DOUBLE AS area
FROM p WHERE n > 0 WINDOW w AS (PARTITION BY p_partkey ORDER BY k)
""")
def floor_stack(spark, sf_dir):
    size, plate = F.col("p_size"), F.lit(100.0)
    runs = lots.floor_stack([("parking", size % 3, plate), ("commercial", size % 2, plate), ("residential", size % 5, plate)])
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(runs).alias("r")).select("p_partkey", "r.*")


@query("""
WITH pairs AS (SELECT DISTINCT l_orderkey AS unit, l_partkey AS lot FROM lineitem), n AS (SELECT unit, count(*) AS n FROM pairs GROUP BY unit)
SELECT lot, count(DISTINCT unit) AS n_units, round(sum(o_totalprice), 2) AS whole, round(sum(o_totalprice / n), 6) AS apportioned
FROM pairs JOIN n USING (unit) JOIN orders ON o_orderkey = unit GROUP BY lot
""")
def apportioned_values(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), F.col("l_partkey").alias("lot"))
    out = lots.apportioned(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unit"), F.col("o_totalprice").alias("value")), pairs)
    return out.select("lot", "n_units", F.round("whole", 2).alias("whole"), F.round("apportioned", 6).alias("apportioned"))


@query("""
WITH f AS (SELECT p_partkey, p_retailprice AS stable, p_size % 30 AS m, 0.04 + (p_size % 5) / 100.0::DOUBLE AS cap FROM part),
y AS (SELECT p_partkey, stable, cap, list_transform(range(0, 5), lambda y: stable / 12 * list_sum(list_transform(range(12 * y + 1, 12 * y + 13), lambda k: CASE WHEN m > 0 THEN least(CAST(k AS DOUBLE) / m, 1) ELSE 1 END))) AS v FROM f)
SELECT p_partkey, round(v[1], 7) AS year_1, round(v[2], 7) AS year_2, round(v[5] + stable / cap, 4) AS year_5,
  round(-10 * stable + list_sum(list_transform(range(1, 6), lambda i: v[i] / power(1.06, i))) + stable / cap / power(1.06, 5), 3) AS npv FROM y
""")
def cash_flows(spark, sf_dir):
    size, stable = F.col("p_size"), F.col("p_retailprice")
    flows = lots.cash_flows(10 * stable, stable, size % 30, 0.04 + (size % 5) / 100.0, 5)
    rows = table(spark, sf_dir, "part").select("p_partkey", flows.alias("f"))
    return rows.select("p_partkey", F.round(F.get("f", 1), 7).alias("year_1"), F.round(F.get("f", 2), 7).alias("year_2"), F.round(F.get("f", 5), 4).alias("year_5"), F.round(finance.npv(F.col("f"), F.lit(0.06)), 3).alias("npv"))


@query(f"""WITH {PLACES_SQL},
t AS (SELECT c_custkey, unnest(range(CAST(floor((lon - 0.01 + 180) / 360 * 4096) AS BIGINT), CAST(floor((lon + 0.01 + 180) / 360 * 4096) AS BIGINT) + 1)) AS tx, CAST(floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 4096) AS BIGINT) AS ty, c_acctbal FROM places)
SELECT tx, ty, count(*) AS n, max(c_acctbal) AS largest FROM t GROUP BY ALL
""")
def tile_cover(spark, sf_dir):
    """Features of a little width on the tiles of level 12 that they touch."""
    p = places(spark, sf_dir)
    tiles = F.sequence(grid.cell_x(F.col("lon") - 0.01, 12), grid.cell_x(F.col("lon") + 0.01, 12))
    rows = p.select(F.explode(tiles).alias("tx"), grid.cell_y(F.col("lat"), 12).alias("ty"), "c_acctbal")
    return rows.groupBy(F.col("tx").cast("long").alias("tx"), F.col("ty").cast("long").alias("ty")).agg(F.count("*").alias("n"), F.max("c_acctbal").alias("largest"))


FOLD_SQL = "trim(regexp_replace(lower(translate(replace(replace({}, 'œ', 'oe'), 'æ', 'ae'), '" + C.ACCENTS + "', '" + C.PLAIN + "')), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
WITH w AS (SELECT doc_id, 'text' AS field, 0.4 AS weight, unnest(string_split({FOLD_SQL.format("text")}, ' ')) AS word FROM documents
  UNION ALL SELECT doc_id, 'source', 1.0, unnest(string_split({FOLD_SQL.format("source")}, ' ')) FROM documents),
h AS (SELECT doc_id, field, word, max(weight) * (1 + ln(count(*))) AS s FROM w WHERE word IN ('licensed', 'license', 'gnu', 'src3', 'ete') GROUP BY ALL)
SELECT doc_id, round(sum(s), 6) AS score, count(DISTINCT word) AS n_words FROM h GROUP BY doc_id ORDER BY n_words DESC, round(sum(s), 9) DESC, doc_id LIMIT 20
""")
def full_text_search(spark, sf_dir):
    """All documents: accents are folded in texts and words asked for, and a row with a null text is found by its source."""
    return fulltext.search(table(spark, sf_dir, "documents"), [("text", "B"), ("source", "A")], "Licensed license GNU src3 ÉTÉ", 20, "doc_id").withColumn("score", F.round("score", 6))


@query("""
WITH p AS (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN '**' WHEN p_partkey % 4 = 1 THEN '--' WHEN p_partkey % 4 = 2 THEN ' $ 1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') || ' ' ELSE '' END AS s, CAST(p_size % 9 AS VARCHAR) || CASE WHEN p_partkey % 2 = 0 THEN ' to ' || CAST(p_size AS VARCHAR) ELSE '' END AS r FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN 1000.0::DOUBLE + p_size END AS value, CASE p_partkey % 4 WHEN 0 THEN 'suppressed' WHEN 1 THEN 'no_units' WHEN 2 THEN 'measured' ELSE 'absent' END AS state,
  CAST(p_size % 9 AS DOUBLE) AS low, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE p_size % 9 END AS DOUBLE) AS high, lower(replace(p_type, ' ', '_')) AS slug, lpad(CAST(p_size AS VARCHAR), 4, '0') AS code
FROM p
""")
def published_figures(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    s = F.when(k % 4 == 0, "**").when(k % 4 == 1, "--").when(k % 4 == 2, F.concat(F.lit(" $ 1,"), F.lpad(size.cast("string"), 3, "0"), F.lit(" "))).otherwise("")
    r = F.concat((size % 9).cast("string"), F.when(k % 2 == 0, F.concat(F.lit(" to "), size.cast("string"))).otherwise(""))
    rows = table(spark, sf_dir, "part").select("p_partkey", C.published(s).alias("p"), C.pair(r).alias("r"), C.slug(F.col("p_type")).alias("slug"), C.code_text(size).alias("code"))
    return rows.select("p_partkey", "p.value", "p.state", "r.low", "r.high", "slug", "code")


@query("""
WITH e AS (SELECT vec_id, label, CAST(vec_id AS VARCHAR) AS chunk_id, embedding FROM embeddings),
old AS (SELECT *, 1 AS scrape_date FROM e WHERE vec_id % 3 != 0), new AS (SELECT * REPLACE (list_reverse(embedding) AS embedding), 2 AS scrape_date FROM e WHERE vec_id % 2 = 0 AND label < 5)
SELECT label, chunk_id, max(scrape_date) AS scrape_date, len(arg_max(embedding, scrape_date)) AS dimension, round(CAST(arg_max(embedding, scrape_date)[1] AS DOUBLE), 6) AS first_component FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY label, chunk_id
HAVING max(scrape_date) = 2 OR label NOT IN (SELECT label FROM new)
""")
def index_load(spark, sf_dir):
    """A second load of even ids of five labels, with vectors turned round, over a first one; the rows carry their vectors."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("vec_id").cast("string").alias("chunk_id"), "embedding")
    again = e.where("vec_id % 2 = 0 AND label < 5").withColumn("embedding", F.reverse("embedding")).withColumn("scrape_date", F.lit(2))
    out = retrieval.load_index(e.where("vec_id % 3 != 0").withColumn("scrape_date", F.lit(1)), again, ["label", "chunk_id"])
    return out.select("label", "chunk_id", "scrape_date", F.size("embedding").cast("long").alias("dimension"), F.round(F.get("embedding", 0).cast("double"), 6).alias("first_component"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role WHEN contains(lower(regexp_replace(text, '\\s+', ' ', 'g')), 'the') THEN 'found' END AS value,
  CASE WHEN turn % 2 = 0 THEN 'read' WHEN contains(lower(regexp_replace(text, '\\s+', ' ', 'g')), 'the') THEN 'proposed' ELSE 'none' END AS source
FROM conversations
""")
def filled_gaps(spark, sf_dir):
    text = F.col("text")
    both = linking.filled(F.when(F.col("turn") % 2 == 0, F.col("role")), F.lit("found"), linking.quoted(text, F.lit(" The ")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", both.alias("f")).select("conv_id", "turn", "f.value", "f.source")


@query("""
WITH s AS (SELECT p_partkey AS key, p_size * 12.0::DOUBLE AS plate, p_size * 30.0::DOUBLE AS lot, p_size % 5 AS fm, p_size % 3 AS cm, p_partkey % 3 AS bm, CASE WHEN p_partkey % 4 != 0 THEN p_size % 20 END AS dm, CASE WHEN p_partkey % 5 != 0 THEN 1.0 + (p_size % 4) / 4.0::DOUBLE END AS density FROM part),
c AS (SELECT s.*, r, cc, b FROM s, range(0, 13) t1(r), range(0, 13) t2(cc), range(0, 4) t3(b) WHERE r <= fm AND cc <= least(cm, fm - r) AND b <= bm AND r + cc > 0),
d AS (SELECT *, least(CAST(floor(plate * r / 85.0) AS BIGINT), coalesce(dm, 1099511627776)) AS dwellings, plate * (r + cc) AS gross FROM c),
n AS (SELECT *, CAST(ceil(dwellings * 0.5 + plate * cc / 100 * 1.0) AS BIGINT) AS stalls, floor(plate * b / 32.0) + floor(greatest(lot - plate, 0) * 0.25 / 32.0) AS offered FROM d),
v AS (SELECT *, (dwellings * 1400.0 * 12 * 0.95 + plate * cc / 0.09290304 * 24.0 * 0.95) * 0.65 AS noi, gross * 2600.0 + plate * b * 1500.0 AS cost FROM n WHERE stalls <= offered AND coalesce(gross / lot <= density, true)),
w AS (SELECT *, noi * ((1 - power(1.06, -30)) / 0.06) - cost AS npv FROM v QUALIFY row_number() OVER (PARTITION BY key ORDER BY round(noi * ((1 - power(1.06, -30)) / 0.06) - cost, 2) DESC, r, cc, b) = 1)
SELECT s.key, CASE WHEN w.key IS NULL THEN 'infeasible' ELSE 'optimal' END AS status, CAST(r AS INTEGER) AS residential, CAST(cc AS INTEGER) AS commercial, CAST(b AS INTEGER) AS basements, dwellings, stalls, round(npv, 1) AS npv
FROM s LEFT JOIN w ON w.key = s.key
""")
def development_program(spark, sf_dir):
    """Parts stand in for sites."""
    k, size = F.col("p_partkey"), F.col("p_size")
    sites = table(spark, sf_dir, "part").select(
        k.alias("key"), (size * 12.0).alias("buildable_m2"), (size * 30.0).alias("lot_m2"), (size % 5).alias("floors_max"), (size % 3).alias("commercial_max"), (k % 3).alias("basements_max"),
        F.when(k % 4 != 0, size % 20).alias("dwellings_max"), F.when(k % 5 != 0, 1.0 + (size % 4) / 4.0).alias("density_max"),
    )
    return programs.best_programs(sites).select("key", "status", "residential", "commercial", "basements", "dwellings", "stalls", F.round("npv", 1).alias("npv"))


@query("""
WITH s AS (SELECT o_orderkey, o_orderpriority = '1-URGENT' AS dirty, o_orderstatus = 'P' AS vacant, CASE WHEN o_custkey % 9 != 0 THEN 1900 + o_custkey % 120 END AS built, (o_orderkey % 10) / 10.0::DOUBLE AS land, o_totalprice - 200000 AS gains FROM orders),
t AS (SELECT *, CASE WHEN dirty THEN 'brownfield' WHEN NOT vacant AND coalesce(built < 1960 AND land >= 0.6, false) THEN 'teardown' WHEN vacant THEN 'infill' WHEN gains > 0 THEN 'improvement' ELSE 'none' END AS thesis FROM s)
SELECT thesis, count(*) AS n, round(sum(gains), 2) AS gains, count(*) FILTER (WHERE land * 20 >= 8 AND built % 13 >= 6 AND gains / 100000 >= 1.2) AS n_passing FROM t GROUP BY thesis
""")
def site_theses(spark, sf_dir):
    built = F.when(F.col("o_custkey") % 9 != 0, 1900 + F.col("o_custkey") % 120)
    land, gains = (F.col("o_orderkey") % 10) / 10.0, F.col("o_totalprice") - 200000
    label = opportunities.site_thesis(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "P", built, land, gains)
    rows = table(spark, sf_dir, "orders").select(label.alias("thesis"), gains.alias("gains"), *opportunities.screens(land * 20, (built % 13).cast("double"), gains / 100000))
    return rows.groupBy("thesis").agg(F.count("*").alias("n"), F.round(F.sum("gains"), 2).alias("gains"), F.count_if("passes").alias("n_passing"))


@query("""
SELECT p_partkey FROM part WHERE p_size BETWEEN 45 AND 46
UNION SELECT p_partkey FROM part WHERE p_partkey % 7 = 0 AND NOT (p_partkey % 14 = 0 AND p_size > 20)
""")
def road_gate(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return opportunities.road_gate(p.where("p_size BETWEEN 45 AND 46"), p.where("p_partkey % 7 = 0"), p.where("p_partkey % 14 = 0"), p.where("p_size > 20"), "p_partkey")


@query("""
WITH l AS (SELECT p_partkey, p_size + 5.0::DOUBLE AS w, p_size * 2.0::DOUBLE AS d, p_size % 7 AS front, CASE WHEN p_partkey % 3 != 0 THEN p_size % 5 END AS rear, p_size % 4 AS side, CASE p_partkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.5 ELSE 1.0 END AS share, CASE WHEN p_partkey % 4 != 0 THEN 40.0::DOUBLE END AS cov FROM part),
a AS (SELECT *, greatest(w - 2 * share * side, 0) * greatest(d - front - coalesce(rear, 0), 0) AS area, w * d * cov / 100 AS cover FROM l)
SELECT p_partkey, CAST(area AS DOUBLE) AS area, CAST(least(area, cover) AS DOUBLE) AS cap, CASE WHEN area <= 0 THEN 'margins' WHEN cover < area THEN 'coverage' ELSE 'margins' END AS binding FROM a
""")
def buildable_area(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size").cast("double")
    kind = F.when(k % 3 == 0, "attached").when(k % 3 == 1, "semi").otherwise("detached")
    box = lots.buildable_box(size + 5, size * 2, size % 7, F.when(k % 3 != 0, size % 5), size % 4, kind, F.when(k % 4 != 0, 40.0))
    return table(spark, sf_dir, "part").select("p_partkey", box.alias("b")).select("p_partkey", "b.*")


@query("""
WITH l AS (SELECT p_partkey AS lot, CAST(p_partkey % 50 * 30 AS DOUBLE) AS x, CAST(p_partkey // 50 * 40 + p_partkey % 5 * 3 AS DOUBLE) AS y FROM part),
e AS (SELECT lot, x AS x0, x + 20 AS x1, unnest([y, y + 25]) AS ey FROM l),
s AS (SELECT s_suppkey AS street, CAST(s_suppkey * 37 % 400 AS DOUBLE) AS sx, CAST(s_suppkey * 53 % 300 AS DOUBLE) AS sy FROM supplier),
d AS (SELECT lot, street, 20.0::DOUBLE AS length, greatest(sqrt(power(greatest(sx - x0, x0 - sx - 200, 0), 2) + power(ey - sy, 2)), sqrt(power(greatest(sx - x1, x1 - sx - 200, 0), 2) + power(ey - sy, 2))) AS away FROM e, s),
n AS (SELECT lot, street, sum(length) AS length, 8.0::DOUBLE AS cutoff_m FROM d WHERE away <= 8 GROUP BY ALL)
SELECT * FROM n UNION ALL SELECT lot, street, sum(length), 16.0::DOUBLE FROM d WHERE away <= 16 AND lot NOT IN (SELECT lot FROM n) GROUP BY ALL
""")
def fallback_frontage(spark, sf_dir):
    k = F.col("p_partkey")
    x, y = (k % 50 * 30).cast("double"), (F.floor(k / 50) * 40 + k % 5 * 3).cast("double")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    rows = table(spark, sf_dir, "part").select(k.alias("lot"), F.array(corner(x, y), corner(x + 20, y), corner(x + 20, y + 25), corner(x, y + 25)).alias("ring"))
    s = F.col("s_suppkey")
    sx, sy = (s * 37 % 400).cast("double"), (s * 53 % 300).cast("double")
    return lots.fallback_frontage(rows, table(spark, sf_dir, "supplier").select(s.alias("street"), sx.alias("ax"), sy.alias("ay"), (sx + 200).alias("bx"), sy.alias("by")))


@query("""
WITH l AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, CAST(p_partkey % 40 AS DOUBLE) AS b FROM part)
SELECT p_partkey, round(CASE WHEN (a + b) / 2 <= a THEN (a + b) / 2 ELSE a END, 6) AS x, round(CASE WHEN (a + b) / 2 <= a THEN 0 ELSE (a + b) / 2 - a END, 6) AS y FROM l
""")
def line_midpoints(spark, sf_dir):
    """Lines of two strokes, to the right and then up."""
    a, b, zero = F.col("p_size").cast("double"), (F.col("p_partkey") % 40).cast("double"), F.lit(0.0)
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array(corner(zero, zero), corner(a, zero), corner(a, b)).alias("line"))
    return rows.select("p_partkey", lots.point_along(F.col("line")).alias("p")).select("p_partkey", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query("""
WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?:GNU|Apache|MIT|CC|Version|version|Licensed)') AS l FROM documents),
p AS (SELECT doc_id, unnest(l) AS mention, unnest(range(0, len(l))) AS place FROM m)
SELECT doc_id, mention, CAST(min(place) AS INTEGER) AS place FROM p GROUP BY ALL
""")
def first_mentions(spark, sf_dir):
    return texts.first_mentions(table(spark, sf_dir, "documents"), "(?:GNU|Apache|MIT|CC|Version|version|Licensed)")


@query("""
WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 6 != 0 THEN p_retailprice END AS h, CASE WHEN p_partkey % 4 != 0 THEN p_retailprice + p_size - 25 END AS e, CASE WHEN p_partkey % 3 != 0 THEN p_retailprice + p_size % 17 - 8 END AS r FROM part)
SELECT p_partkey, CASE WHEN h IS NULL AND e IS NULL AND r IS NULL THEN 'none' WHEN h >= coalesce(e, h) AND h >= coalesce(r, h) THEN 'hold' WHEN e >= coalesce(r, e) AND e > coalesce(h, e - 1) THEN 'enhance' ELSE 'rebuild' END AS future,
  round(greatest(h, e, r) - coalesce(h, 0), 4) AS gain FROM v
""")
def three_futures(spark, sf_dir):
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    best, gain = opportunities.futures(F.when(k % 6 != 0, price), F.when(k % 4 != 0, price + F.col("p_size") - 25), F.when(k % 3 != 0, price + F.col("p_size") % 17 - 8))
    return table(spark, sf_dir, "part").select("p_partkey", best, F.round(gain, 4).alias("gain"))


@query("""
WITH f AS (SELECT p_partkey, p_retailprice AS noi, -8 * p_retailprice AS f0, 12 * p_retailprice AS f2, p_size * 10.0::DOUBLE AS debt FROM part)
SELECT p_partkey, round((1 + sqrt(1 + 4 * 8 * 13)) / 16 * 100 - 100, 4) AS irr_pct, round(noi / (8 * noi) * 100, 4) AS yield_pct, round((noi + 13 * noi) / (8 * noi), 4) AS multiple, round(CASE WHEN debt > 0 THEN noi / debt END, 4) AS cover FROM f
""")
def site_returns(spark, sf_dir):
    """Eight years' income paid, one received after a year and thirteen after two: the rate solves 8 q^2 = q + 13 for q = 1 + rate."""
    noi = F.col("p_retailprice")
    figures = opportunities.returns(F.array(-8 * noi, noi, 13 * noi), noi, 8 * noi, F.col("p_size") * 10.0)
    rows = table(spark, sf_dir, "part").select("p_partkey", *figures)
    return rows.select("p_partkey", *[F.round(c, 4).alias(c) for c in ("irr_pct", "yield_pct", "multiple", "cover")])


@query("""
WITH a AS (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total, CAST(to_json(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY o_orderkey)) AS VARCHAR) AS orders FROM orders GROUP BY 1),
t AS (SELECT o_custkey, arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS largest_order FROM orders GROUP BY 1)
SELECT c_custkey, n_name, r_name, coalesce(n_orders, 0) AS n_orders, total, orders, largest_order, c_acctbal < 0 AS in_debt
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN t ON t.o_custkey = c_custkey
""")
def wide_profile(spark, sf_dir):
    """One wide row a customer: dimensions, measures, its rows as JSON, and its largest one."""
    c, n, r, o = (table(spark, sf_dir, x) for x in ("customer", "nation", "region", "orders"))
    sums = o.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    lists = relational.nested_json(o, ["o_custkey"], ["o_orderkey"], ["o_orderkey", "o_orderstatus"], "orders")
    largest = relational.argmax_row(o, ["o_custkey"], "o_totalprice", "o_orderkey", ["o_orderkey"]).withColumnRenamed("o_orderkey", "largest_order")
    rows = c.withColumn("o_custkey", F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    for part in (sums, lists, largest):
        rows = rows.join(part, "o_custkey", "left")
    return rows.select("c_custkey", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "total", "orders", "largest_order", (F.col("c_acctbal") < 0).alias("in_debt"))

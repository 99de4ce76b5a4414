"""From raw parcels and streets to frontages and addresses: which parcels are road, what the others front on, and where addresses stand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .polygons import SLACK_M, shared_boundary
from .spatial import box, box_of, cell_join, contained_or_snapped, edges, segment_distance, within

#: Metres of street inside a parcel that make it road, and of shared boundary that make a frontage; how far an address may lie from its lot.
ROAD_M, FRONTAGE_M, SNAP_M = 1.0, 0.5, 3.0


def inside_length(ax: Column, ay: Column, bx: Column, by: Column, ring: Column) -> Column:
    """How much of a segment lies inside a ring of any shape: its pieces between the ring's sides whose middles are inside."""
    dx, dy = bx - ax, by - ay

    def crossing(e: Column) -> Column:
        ex, ey = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        turn = F.nullif(dx * ey - dy * ex, F.lit(0.0))
        t = ((e["a"]["x"] - ax) * ey - (e["a"]["y"] - ay) * ex) / turn
        u = ((e["a"]["x"] - ax) * dy - (e["a"]["y"] - ay) * dx) / turn
        return F.when((t > 0) & (t < 1) & (u >= 0) & (u <= 1), t)

    cuts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.array_compact(F.transform(edges(ring), crossing))))
    pieces = F.zip_with(F.slice(cuts, F.lit(1), F.size(cuts) - 1), F.slice(cuts, F.lit(2), F.size(cuts)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    held = lambda p: within(ax + dx * (p["a"] + p["b"]) / 2, ay + dy * (p["a"] + p["b"]) / 2, edges(ring))
    return F.aggregate(F.filter(pieces, held), F.lit(0.0), lambda s, p: s + p["b"] - p["a"]) * F.hypot(dx, dy)


def street_inside(lots: DataFrame, streets: DataFrame, size: float = 50.0) -> DataFrame:
    """(lot, street, length): metres of street sides (street, ax, ay, bx, by) inside parcels (lot, ring), summed by street."""
    segment = box(F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"), F.greatest("ay", "by"))
    pairs = cell_join(streets, lots, segment, box_of(F.col("ring")), size, F.lit(True))
    found = pairs.select("lot", "street", inside_length(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), F.col("ring")).alias("length")).where("length > 0")
    return found.groupBy("lot", "street").agg(F.sum("length").alias("length"))


def road_lots(lots: DataFrame, streets: DataFrame, least: float = ROAD_M, size: float = 50.0) -> DataFrame:
    """(lot, street, street_m_inside, n_streets): parcels that hold `least` metres of street sides or more, with the street most of these belong to, the smaller name of equals."""
    inside = street_inside(lots, streets, size)
    best = F.min(F.struct((-F.round("length", 6)).alias("l"), "street"))
    return inside.groupBy("lot").agg(best.alias("b"), F.sum("length").alias("street_m_inside"), F.count("*").alias("n_streets")).where(F.col("street_m_inside") >= least).select("lot", "b.street", "street_m_inside", "n_streets")


def lot_frontages(lots: DataFrame, streets: DataFrame, least: float = FRONTAGE_M, size: float = 50.0, slack: float = SLACK_M) -> DataFrame:
    """(lot, street, length, rank): what each parcel that is no road shares with road parcels, by their street, longest first; shares under `least` metres are none."""
    roads = road_lots(lots, streets, size=size)
    own = lots.join(roads, "lot", "left_anti").select("lot", "ring")
    road = lots.join(roads.select("lot"), "lot", "left_semi").select(F.col("lot").alias("road"), "ring")
    shared = shared_boundary(own, road, size, slack).join(roads.select(F.col("lot").alias("road"), "street"), "road")
    by_street = shared.groupBy("lot", "street").agg(F.sum("length").alias("length")).where(F.col("length") >= least)
    w = Window.partitionBy("lot").orderBy(F.desc(F.round("length", 6)), "street")
    return by_street.withColumn("rank", F.row_number().over(w))


def lot_addresses(addresses: DataFrame, lots: DataFrame, pieces: DataFrame, snap: float = SNAP_M, size: float = 50.0) -> DataFrame:
    """(address_id, lot, match_basis, snap_distance_m, feature_id, piece_basis, address_rank, is_primary, n_piece_addresses, n_lot_addresses) of each address on a lot.

    addresses (address_id, x, y, civic, suffix), lots (lot, ring), pieces (lot, feature_id, zone_rank, ring). An address is
    on the smallest lot that holds it, else on the nearest within `snap` metres. On its lot it belongs to the piece that
    holds it (piece; the better rank of several), else to the lot's piece of rank 1 (primary), else to none. Ranks count
    within a lot and its piece by civic number, nulls last, suffix, nulls first, and id. Addresses near no lot are left out.
    """
    placed = contained_or_snapped(addresses.select("address_id", "x", "y"), lots.select("lot", "ring"), "address_id", "lot", "x", "y", "ring", size, snap)
    # Rings are large and their files small, so none of them is broadcast.
    rows = addresses.join(placed.hint("merge"), "address_id").join(lots.select("lot", F.col("ring").alias("_lot")).hint("merge"), "lot")
    away = F.array_min(F.transform(edges(F.col("_lot")), lambda e: segment_distance(F.col("x"), F.col("y"), e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])))
    rows = rows.withColumn("snap_distance_m", F.when(F.col("placed_by") == "snapped", away)).drop("_lot")
    # One pass over the lot's own pieces, of which there are a few: those that hold the address come first.
    tried = rows.join(pieces.select("lot", "feature_id", "zone_rank", F.col("ring").alias("_piece")).hint("merge"), "lot", "left")
    held = F.coalesce(within(F.col("x"), F.col("y"), edges(F.col("_piece"))), F.lit(False))
    basis = F.when(held, "piece").when(F.col("zone_rank") == 1, "primary")
    order = F.struct(F.when(held, 0).when(F.col("zone_rank") == 1, 1).otherwise(2).alias("o"), F.coalesce("zone_rank", F.lit(1 << 30)).alias("r"), F.when(basis.isNotNull(), F.col("feature_id")).alias("feature_id"), F.coalesce(basis, F.lit("none")).alias("piece_basis"))
    out = tried.groupBy("address_id", "lot", "civic", "suffix", F.col("placed_by").alias("match_basis"), "snap_distance_m").agg(F.min(order).alias("b"))
    out = out.select("address_id", "lot", "civic", "suffix", "match_basis", "snap_distance_m", "b.feature_id", "b.piece_basis")
    site = Window.partitionBy("lot", "feature_id")
    rank = F.row_number().over(site.orderBy(F.asc_nulls_last("civic"), F.asc_nulls_first("suffix"), "address_id"))
    out = out.withColumns({"address_rank": rank, "n_piece_addresses": F.count("*").over(site), "n_lot_addresses": F.count("*").over(Window.partitionBy("lot"))})
    return out.select("address_id", "lot", "match_basis", "snap_distance_m", "feature_id", "piece_basis", "address_rank", (F.col("address_rank") == 1).alias("is_primary"), "n_piece_addresses", "n_lot_addresses")

"""Where decisions lie: items to sites by lot numbers, addresses and zones, in an order of preference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fold
from .relational import latest_per_key

#: Cardinal words that a street's name may end in.
CARDINALS = ("est", "ouest", "nord", "sud")


def street_core(street: Column) -> Column:
    """A street's name folded, for comparison."""
    return fold(street)


def civic_of(address: Column) -> Column:
    """The first number of an address; null where it has none."""
    return F.nullif(F.regexp_extract(address, r"^\s*(\d{1,5})", 1), F.lit("")).cast("int")


def place_items(items: DataFrame, lots: DataFrame, doors: DataFrame, zones: DataFrame, borough: str) -> DataFrame:
    """(item, site_kind, site_key, is_subject, match_basis, lot_number, feature_id): the sites that items name.

    items (item, lot_numbers, addresses, subject_addresses, zone_codes, subject_zone_codes): JSON lists of texts.
    lots (lot_number, scrape_date), doors (address_id, civic_number, street_name, lot_number, neighborhood, scrape_date),
    zones (feature_id, source_table, scrape_date). Of each the newest row counts. Lots are met by their digits; addresses
    by number and street, or by the street with a cardinal behind it, an exact street and a door of the borough first;
    zones by code. Keys that match nothing give no row.
    """
    named = lambda c: F.from_json(F.coalesce(c, F.lit("[]")), "array<string>")
    digits = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    lot = latest_per_key(lots.withColumn("digits", digits(F.col("lot_number"))), ["digits"], [F.desc("scrape_date"), F.asc("lot_number")]).select("digits", "lot_number")
    none = F.lit(None).cast("string")

    by_lot = items.select("item", F.explode(F.array_distinct(named("lot_numbers"))).alias("site_key")).withColumn("digits", digits(F.col("site_key")))
    by_lot = by_lot.join(lot, "digits").select("item", F.lit("lot").alias("site_kind"), "site_key", F.lit(True).alias("is_subject"), F.lit("lot_number").alias("match_basis"), "lot_number", none.alias("feature_id"))

    asked = items.select("item", F.explode(F.array_distinct(named("addresses"))).alias("site_key"), named("subject_addresses").alias("_s"))
    asked = asked.select("item", "site_key", F.array_contains("_s", F.col("site_key")).alias("is_subject"), civic_of(F.col("site_key")).alias("civic_number"), street_core(F.regexp_replace("site_key", r"^[^,]*,\s*", "")).alias("_street")).where("_street != ''")
    # A street is looked up as it is and with each cardinal, so the join is one of equal keys.
    spelled = F.array(F.struct(F.col("_street").alias("street"), F.lit("address").alias("match_basis")), *[F.struct(F.concat(F.col("_street"), F.lit(f" {c}")).alias("street"), F.lit("address_cardinal").alias("match_basis")) for c in CARDINALS])
    tried = asked.withColumn("_t", F.explode(spelled)).select("item", "site_key", "is_subject", "civic_number", "_t.*")
    door = latest_per_key(doors.where("civic_number IS NOT NULL AND street_name IS NOT NULL"), ["address_id"], [F.desc("scrape_date"), F.asc("lot_number")])
    door = door.select("civic_number", street_core(F.col("street_name")).alias("street"), digits(F.col("lot_number")).alias("digits"), "neighborhood").join(lot, "digits")
    # Of the doors of one number and street only the first can be chosen, so items meet one row and not all doors.
    first = F.struct((~F.coalesce(F.col("neighborhood") == borough, F.lit(False))).alias("b"), F.col("lot_number").alias("lot_number"))
    door = door.groupBy("civic_number", "street").agg(F.min(first).alias("_d"))
    order = F.struct((F.col("match_basis") != "address").alias("a"), F.col("_d.b").alias("b"), F.col("_d.lot_number").alias("lot_number"), F.col("match_basis").alias("match_basis"))
    best = tried.join(door, ["civic_number", "street"]).groupBy("item", "site_key", "is_subject").agg(F.min(order).alias("k"))
    by_address = best.select("item", F.lit("address").alias("site_kind"), "site_key", "is_subject", "k.match_basis", "k.lot_number", none.alias("feature_id"))

    coded = items.select("item", F.explode(F.array_distinct(named("zone_codes"))).alias("site_key"), named("subject_zone_codes").alias("_s")).select("item", "site_key", F.array_contains("_s", F.col("site_key")).alias("is_subject"))
    zone = latest_per_key(zones, ["feature_id"], [F.asc("source_table"), F.desc("scrape_date")]).select(F.col("feature_id").alias("site_key"), "feature_id")
    by_zone = coded.join(zone, "site_key").select("item", F.lit("zone").alias("site_kind"), "site_key", "is_subject", F.lit("zone").alias("match_basis"), none.alias("lot_number"), "feature_id")
    return by_lot.unionByName(by_address).unionByName(by_zone)


def placed_counts(items: DataFrame, sites: DataFrame) -> DataFrame:
    """One row: items, those with a site, those without, and sites by kind."""
    placed = sites.select("item").distinct().withColumn("_placed", F.lit(True))
    kinds = sites.agg(*[F.count_if(F.col("site_kind") == k).alias(f"{k}_sites") for k in ("lot", "address", "zone")])
    counts = items.select("item").distinct().join(placed, "item", "left").agg(F.count("*").alias("n_items"), F.count("_placed").alias("n_placed"), F.count_if(F.col("_placed").isNull()).alias("n_unplaced"))
    return counts.crossJoin(kinds)  # one row each


def borough_of(decisions: DataFrame, doors: DataFrame, key: str = "decision") -> DataFrame:
    """decisions (key, address) with `neighborhood` and `match_basis`: that of their door, an exact street before one with a cardinal; null where boroughs disagree or no door is met."""
    d = decisions.select(key, civic_of(F.col("address")).alias("civic_number"), street_core(F.regexp_replace("address", r"^[^,]*,\s*", "")).alias("_street"))
    spelled = F.array(F.struct(F.col("_street").alias("street"), F.lit(0).alias("rank")), *[F.struct(F.concat(F.col("_street"), F.lit(f" {c}")).alias("street"), F.lit(1).alias("rank")) for c in CARDINALS])
    tried = d.withColumn("_t", F.explode(spelled)).select(key, "civic_number", "_t.*")
    door = doors.select("civic_number", street_core(F.col("street_name")).alias("street"), "neighborhood").where("neighborhood IS NOT NULL").distinct()
    met = tried.join(door, ["civic_number", "street"]).groupBy(key, "rank").agg(F.min("neighborhood").alias("lo"), F.max("neighborhood").alias("hi"))
    best = met.groupBy(key).agg(F.min(F.struct("rank", "lo", "hi")).alias("k"))
    basis = F.when(F.col("k.rank") == 0, "address").otherwise("address_cardinal")
    agree = F.col("k.lo") == F.col("k.hi")
    return decisions.join(best, key, "left").select(*decisions.columns, F.when(agree, F.col("k.lo")).alias("neighborhood"), F.when(agree, basis).alias("match_basis"))

"""Linking of items that share keys, and merging of what different readers say of one item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components


def rare_keys(item_keys: DataFrame, occasion: str, most: int, prefix: str = "") -> DataFrame:
    """(item, key) without the keys of a prefix that turn up on `most` occasions or more: they say nothing of an item."""
    seen = item_keys.where(F.col("key").startswith(prefix)).groupBy("key").agg(F.countDistinct(occasion).alias("n")).where(F.col("n") >= most)
    return item_keys.join(seen, "key", "left_anti").select("item", "key")


def link_items(item_keys: DataFrame, items: DataFrame) -> DataFrame:
    """items with `group`: the smallest item reachable over shared keys; an item that shares none is its own group.

    A key of n items gives n - 1 edges, each to the key's smallest item.
    """
    first = item_keys.groupBy("key").agg(F.min("item").alias("a"))
    edges = item_keys.join(first, "key").select("a", F.col("item").alias("b"))
    found = components(edges)
    return items.join(found, items["item"] == found["node"], "left").withColumn("group", F.coalesce("component", "item")).drop("node", "component")


def fold_groups(linked: DataFrame, order: Sequence[str], decided: str, first: Sequence[str], lists: Sequence[str], kind: str) -> DataFrame:
    """One row for each group in which some item is decided.

    first: the earliest value that is not null, in the order given; lists: all values, each once, in order of first
    occurrence; kind: the most frequent value, of equally frequent ones the smallest.
    """
    place = F.struct(*order)
    firsts = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in first]
    ordered = [F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v"))))), lambda e: e["_v"])).alias(c) for c in lists]
    rows = linked.groupBy("group").agg(F.count("*").alias("n_items"), F.bool_or(decided).alias("_d"), *firsts, *ordered).where("_d").drop("_d")
    counts = linked.where(F.col(kind).isNotNull()).groupBy("group", kind).agg(F.count("*").alias("_n"))
    common = counts.groupBy("group").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(kind).alias("k")))["k"].alias(kind))
    return rows.join(common, "group", "left")


def quoted(text: Column, quote: Column) -> Column:
    """Whether a quotation stands in the text, white space and case aside."""
    flat = lambda c: F.lower(F.regexp_replace(c, r"\s+", " "))
    return F.coalesce(F.contains(flat(text), flat(F.trim(quote))) & (F.trim(quote) != ""), F.lit(False))


def filled(read: Column, proposed: Column, valid: Column) -> Column:
    """struct(value, source): what was read, else what was proposed if it is borne out by the text."""
    taken = read.isNull() & proposed.isNotNull() & valid
    return F.struct(F.when(taken, proposed).otherwise(read).alias("value"), F.when(read.isNotNull(), "read").when(taken, "proposed").otherwise("none").alias("source"))

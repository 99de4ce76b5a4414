"""Relational operators with fixed null, tie-break and ranking rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import stage


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. The order must end in a unique column, so that ties can't show."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key, with their rank. Spark cuts each task's rows to k a key before they are shuffled."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def flag_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank", flag: str = "is_top") -> DataFrame:
    """All rows with their rank within the key, and whether it is n or less."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).withColumn(flag, F.col(rank) <= n)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "rank", parts: int | None = None) -> DataFrame:
    """All rows with their rank within the key, for keys of which a few hold most rows. The order must end in a unique column.

    Rows are range-partitioned by key and order, ranked within their partition, and raised by what the key has in the
    partitions before: no task holds a key whole. The rank is that of row_number().
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = dealt.groupBy(*keys, "_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    local = dealt.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    rows = local.join(starts.select(*own, F.col("_part").alias("_p"), "_before"), on)
    return rows.withColumn(rank, (F.col("_local") + F.col("_before")).cast("int")).select(*df.columns, rank)


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], buckets: int = 4096, few: int = 100_000) -> DataFrame:
    """(keys, a column for each share): interpolated percentiles of a value, nulls aside, for keys of any number of rows.

    A histogram of each key says in which of `buckets` buckets a rank lies. A bucket of more than `few` rows and more than one
    value is cut again between its own least and largest value, as often as it takes, so that a few far values, which
    leave nearly all others in one bucket, cost a round and no large task. The rest is counted by distinct values.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    ends = stage(rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "percentile-ends")
    # The other side of a join by keys and ends, under names of its own.
    other = {k: f"_k{i}" for i, k in enumerate(keys)} | {"_lo": "_lo2", "_hi": "_hi2"}
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    at = lambda q: (F.col("_n") - 1) * F.lit(float(q))
    sides = [F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (F.floor if side == "low" else F.ceil)(at(q)).alias("r"), (at(q) - F.floor(at(q))).alias("part")) for name, q in shares.items() for side in ("low", "high")]
    # A goal is the rank r among the values from _lo to _hi of its key, of which there are _n.
    goals = stage(ends.select(*keys, "_lo", "_hi", "_n", F.explode(F.array(*sides)).alias("g")).select(*keys, "_lo", "_hi", "_n", "g.*"), "percentile-goals")
    wide = (F.col("_n") > few) & (F.col("_lo") < F.col("_hi"))
    upto = lambda *by: Window.partitionBy(*keys, "_lo", "_hi", *by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)

    def within(ranges: DataFrame) -> DataFrame:
        """Values of the ranges (keys, _lo, _hi)."""
        named = ranges.withColumnsRenamed(other)
        return rows.join(named, same & F.col("_v").between(F.col("_lo2"), F.col("_hi2"))).select(*keys, "_v", F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi"))

    def reached(counts: DataFrame, goals: DataFrame, *more: Column | str) -> DataFrame:
        named = goals.select(*[F.col(c).alias(other.get(c, c)) for c in [*keys, "_lo", "_hi", "name", "side", "r", "part"]])
        on = same & (F.col("_lo") == F.col("_lo2")) & (F.col("_hi") == F.col("_hi2")) & (F.col("r") >= F.col("_before")) & (F.col("r") < F.col("_before") + F.col("_c"))
        return counts.join(named, on).select(*keys, *more, "name", "side", "part")

    while goals.where(wide).limit(1).count():
        open_ = goals.where(wide)
        # Halves, so that no difference overflows.
        width = F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * buckets)
        cut = within(open_.select(*keys, "_lo", "_hi").distinct()).groupBy(*keys, "_lo", "_hi", F.coalesce(F.least(width, F.lit(buckets - 1)), F.lit(0)).alias("_b"))
        counts = cut.agg(F.count("*").alias("_c"), F.min("_v").alias("_from"), F.max("_v").alias("_to")).withColumn("_before", F.coalesce(F.sum("_c").over(upto("_b")), F.lit(0)))
        found = reached(counts, open_, "_from", "_to", "_c", (F.col("r") - F.col("_before")).alias("r"))
        found = found.select(*keys, F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), F.col("_c").alias("_n"), "name", "side", "r", "part")
        goals = stage(goals.where(~wide).select(found.columns).unionByName(found), "percentile-goals")
    distinct = within(goals.select(*keys, "_lo", "_hi").distinct()).groupBy(*keys, "_lo", "_hi", "_v").agg(F.count("*").alias("_c"))
    distinct = distinct.withColumn("_before", F.coalesce(F.sum("_c").over(upto("_v")), F.lit(0)))
    met = reached(distinct, goals, "_v")
    pick = lambda name, side, c: F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col(c)))
    out = lambda name: pick(name, "low", "_v") + (pick(name, "high", "_v") - pick(name, "low", "_v")) * pick(name, "low", "part")
    return met.groupBy(*keys).agg(*[out(name).alias(name) for name in shares])


def argmax_row(df: DataFrame, keys: Sequence[str], value: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """For each key the columns of the row with the largest value: nulls last, then the smallest tie column.

    One aggregation with partial results, no window: a key with very many rows costs a row for each task.
    """
    low = F.min(F.struct(F.col(value).isNull().alias("n"), (-F.col(value)).alias("v"), F.col(tie).alias("t"), *[F.col(c).alias(c) for c in columns if c != tie]))
    found = df.groupBy(*keys).agg(low.alias("_row"))
    return found.select(*keys, *[F.col("_row.t" if c == tie else f"_row.{c}").alias(c) for c in columns])


def class_sums(df: DataFrame, keys: Sequence[str], kind: str, value: str, classes: Sequence[str]) -> DataFrame:
    """A sum for each class, null where the key has no row of the class."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(kind) == c, F.col(value))).alias(f"{c.lower()}_{value}") for c in classes])


def ranked_pivot(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each key side by side: column c of the row of rank i as c_i."""
    top = top_k_per_key(df, keys, order, n, "_rank")
    return top.groupBy(*keys).agg(*[F.max(F.when(F.col("_rank") == i, F.col(c))).alias(f"{c}_{i}") for i in range(1, n + 1) for c in columns])


def nested_json(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """Each key's rows as a JSON list of objects, ordered by `order`."""
    entry = F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate(order)], F.struct(*columns).alias("row"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"])
    return df.groupBy(*keys).agg(F.to_json(ordered).alias(name))


def object_json(df: DataFrame, keys: Sequence[str], key: str, value: str, name: str) -> DataFrame:
    """Each key's (key, value) rows as one JSON object in the order of the object's keys. A repeated key keeps its largest value."""
    once = df.where(F.col(key).isNotNull()).groupBy(*keys, key).agg(F.max(value).alias("_v"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("_v").alias("v"))))
    return once.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries)).alias(name))


def allocate_share(df: DataFrame, keys: Sequence[str], basis: str, total: str, name: str) -> DataFrame:
    """`total` shared out within the key in proportion to `basis`; in equal parts, and marked so, where the basis sums to nothing."""
    w = Window.partitionBy(*keys)
    whole, n = F.sum(F.coalesce(basis, F.lit(0.0))).over(w), F.count("*").over(w)
    share = F.when(whole > 0, F.coalesce(basis, F.lit(0.0)) / whole).otherwise(1 / n)
    return df.withColumn(f"{name}_share", share).withColumn(name, F.col(f"{name}_share") * F.col(total)).withColumn(f"{name}_basis", F.when(whole > 0, "measured").otherwise("equal"))


def densify(stats: DataFrame, axes: Sequence[DataFrame], fill: dict[str, object]) -> DataFrame:
    """Every combination of the axes' values, with its statistics or the fill values. The axes are lists of classes, small by nature."""
    grid = axes[0]
    for axis in axes[1:]:
        grid = grid.crossJoin(axis)
    out = grid.join(stats, grid.columns, "left")
    return out.fillna({k: v for k, v in fill.items() if v is not None})


def two_stage_match(left: DataFrame, right: DataFrame, by: Sequence[str], fallback: Sequence[str], columns: Sequence[str], tie: str, key: str) -> DataFrame:
    """Rows of left with `columns` of right: by the columns `by`, the rest by `fallback`, and `matched_by`.

    Where several rows of right match, the one with the smallest `tie` counts. `key` identifies a row of left. Rows that
    match neither way stay, with nulls and `none`. Null keys match nothing.
    """

    def first_of(on: Sequence[str]) -> DataFrame:
        return argmin_row(right.dropna(subset=list(on)), on, tie, columns)

    first = left.join(first_of(by), list(by), "inner").withColumn("matched_by", F.lit("key"))
    rest = left.join(first.select(key), key, "left_anti")
    second = rest.join(first_of(fallback), list(fallback), "left").withColumn("matched_by", F.when(F.col(columns[0]).isNotNull(), "fallback").otherwise("none"))
    return first.select(second.columns).unionByName(second)


def argmin_row(df: DataFrame, keys: Sequence[str], tie: str, columns: Sequence[str]) -> DataFrame:
    low = df.groupBy(*keys).agg(F.min(F.struct(F.col(tie).alias("_t"), *columns)).alias("_row"))
    return low.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def summary_by_class(df: DataFrame, classes: DataFrame, key: str, aggregates: Sequence[Column], zero: Sequence[str]) -> DataFrame:
    """Aggregates for every class of the list, with 0 in the columns `zero` for those without rows."""
    return classes.join(df.groupBy(key).agg(*aggregates), key, "left").fillna(0, subset=list(zero))


def largest_label(pairs: Sequence[tuple[str, Column]], none: str = "none") -> Column:
    """The label of the largest value; of equal ones the first; null values count as the smallest."""
    least = F.lit(float("-inf"))
    values = [F.coalesce(c.cast("double"), least) for _, c in pairs]
    best = F.greatest(*values)
    out = F.when(best == least, F.lit(none))
    for (label, _), value in zip(pairs, values, strict=True):
        out = out.when(value == best, F.lit(label))
    return out


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df without a partner in other; null keys are equal to null keys."""
    o = other.select(*[F.col(k).alias(f"_o_{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_o_{k}"))
        on = c if on is None else on & c
    return df.join(o, on, "left_anti")


def offenders(df: DataFrame, keys: Sequence[str], most: int = 5) -> DataFrame:
    """The first keys, in order, that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).limit(most)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """df, or an error that names the first repeated keys."""
    found = offenders(df, keys).collect()
    if found:
        raise ValueError(f"{what}: repeated {', '.join(keys)}: " + "; ".join(f"{tuple(r[:-1])} x {r['n']}" for r in found))
    return df


def require_columns(df: DataFrame, columns: Sequence[str], remedy: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {', '.join(missing)}: {remedy}")
    return df


def require_rows(df: DataFrame, remedy: str) -> DataFrame:
    if not df.limit(1).count():
        raise ValueError(f"no rows: {remedy}")
    return df

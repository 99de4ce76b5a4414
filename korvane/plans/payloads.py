"""What each lot carries of its borough as JSON: surveys, costs, assumptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The cells that stand for a whole survey.
ALL_BEDROOMS, ALL_DWELLINGS = "total", "total"


def survey_payload(rows: DataFrame, cell: Sequence[str], value: str, overall: Column, name: str, extra: Sequence[str] = (), borough: str = "neighborhood") -> DataFrame:
    """(borough, name): one JSON object for each borough of a survey.

    It holds the newest survey_year and its period, the value of the cell where `overall` holds (`overall_<value>`), how
    many cells are published (`num_published_cells`), and the cells in order. A null borough is a borough of its own.
    """
    newest = F.max_by(F.struct("survey_year", "survey_period"), F.struct("survey_year", "survey_period"))
    cells = F.array_sort(F.collect_list(F.struct(*cell, value, *extra)))
    out = rows.groupBy(borough).agg(
        newest.alias("_s"),
        F.max(F.when(overall, F.col(value))).alias("_overall"),
        F.count(value).alias("_n"),
        cells.alias("_cells"),
    )
    payload = F.struct(F.col("_s.survey_year").alias("survey_year"), F.col("_s.survey_period").alias("survey_period"), F.col("_overall").alias(f"overall_{value}"), F.col("_n").alias("num_published_cells"), F.col("_cells").alias("cells"))
    return out.select(borough, F.to_json(payload).alias(name))


def rents_payload(rents: DataFrame) -> DataFrame:
    return survey_payload(rents, ["bedroom_type"], "average_rent_cad", F.col("bedroom_type") == ALL_BEDROOMS, "rents")


def vacancy_payload(rates: DataFrame) -> DataFrame:
    return survey_payload(rates, ["dwelling_type", "bedroom_type"], "vacancy_rate_pct", (F.col("dwelling_type") == ALL_DWELLINGS) & (F.col("bedroom_type") == ALL_BEDROOMS), "vacancy")


def cost_payload(costs: DataFrame, order: Sequence[str], name: str = "costs") -> DataFrame:
    """One row: entries (cost_id, low, high) in the stated order as a JSON list, and which of the stated ids are missing."""
    spark = costs.sparkSession
    asked = spark.createDataFrame(list(enumerate(order)), "_k int, cost_id string")
    rows = asked.join(costs.select("cost_id", "low", "high", F.lit(True).alias("_there")), "cost_id", "left")
    entries = F.transform(F.array_sort(F.collect_list(F.when(F.col("_there"), F.struct("_k", "cost_id", "low", "high")))), lambda e: e.dropFields("_k"))
    missing = F.transform(F.array_sort(F.collect_list(F.when(F.col("_there").isNull(), F.struct("_k", "cost_id")))), lambda e: e["cost_id"])
    return rows.agg(F.to_json(entries).alias(name), missing.alias("missing"))


def with_payloads(lots: DataFrame, payloads: Sequence[DataFrame], borough: str = "neighborhood") -> DataFrame:
    """lots with the JSON of their borough; null where a borough has none. A lot without a borough gets that of the null borough."""
    out = lots
    for p in payloads:
        names = [c for c in p.columns if c != borough]
        other = p.select(F.col(borough).alias("_b"), *names)
        out = out.join(other, F.col(borough).eqNullSafe(F.col("_b")), "left").drop("_b")
    return out


def with_optional(left: DataFrame, right: DataFrame | None, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """left with columns (name -> type) of right by keys; all null where right is absent. right has one row a key."""
    if right is None:
        return left.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items()])
    return left.join(right.select(*keys, *[F.col(c).cast(t).alias(c) for c, t in columns.items()]), list(keys), "left")


#: Classes of dwellings that are priced, and the mark of the row for all buildings.
PRICED, ALL_BUILDINGS = ("studio", "1_bedroom", "2_bedroom", "3_bedroom_plus"), "all"


def unit_economics(rents: DataFrame, vacancy: DataFrame, borough: str = "neighborhood") -> DataFrame:
    """(borough, rents, vacancies, suppressed): maps of the priced classes that are published, and the priced ones that are not.

    Vacancies are those of all buildings. A null borough is one of its own; a borough that only has vacancies has none of
    the classes priced.
    """
    entries = lambda value: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col("bedroom_type").alias("k"), F.col(value).alias("v"))))))
    keep = lambda df: df.where(F.col("bedroom_type").isin(*PRICED))
    once = lambda df, value: keep(df).groupBy(borough, "bedroom_type").agg(F.max(value).alias(value))
    a = once(rents, "average_rent_cad").groupBy(borough).agg(entries("average_rent_cad").alias("rents"))
    b = once(vacancy.where(F.col("dwelling_type") == ALL_BUILDINGS), "vacancy_rate_pct").groupBy(borough).agg(entries("vacancy_rate_pct").alias("vacancies"))
    b = b.select(F.col(borough).alias("_b"), "vacancies", F.lit(True).alias("_there"))
    every = rents.select(borough).union(vacancy.select(borough)).distinct()
    a = a.select(F.col(borough).alias("_a"), "rents")
    rows = every.join(a, F.col(borough).eqNullSafe(F.col("_a")), "left").join(b, F.col(borough).eqNullSafe(F.col("_b")), "left")
    none = F.create_map().cast("map<string,double>")
    held = F.coalesce("rents", none)
    return rows.select(borough, held.alias("rents"), F.coalesce("vacancies", none).alias("vacancies"), F.array_except(F.array(*[F.lit(x) for x in PRICED]), F.map_keys(held)).alias("suppressed"))


def envelope_lists(rows: DataFrame, keys: Sequence[str], decoded: dict[str, str], name: str = "envelopes") -> DataFrame:
    """(keys, name): each lot's zoning rows as a JSON list by share (largest first), zone and column, with the JSON texts in `decoded` (column -> type) as values."""
    columns = [c for c in rows.columns if c not in keys]
    entry = F.struct((-F.coalesce("pct_of_lot", F.lit(-1.0))).alias("_p"), F.col("feature_id").alias("_z"), F.col("column_index").alias("_c"), F.struct(*[F.from_json(c, decoded[c]).alias(c) if c in decoded else F.col(c) for c in columns]).alias("row"))
    return rows.groupBy(*keys).agg(F.to_json(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"])).alias(name))


def features_by_url(features: DataFrame) -> DataFrame:
    """(url, feature_ids, title): the features that a document is about, as sorted ids, and its different titles in order of the ids."""
    rows = features.where("url IS NOT NULL").groupBy("url").agg(F.array_sort(F.collect_list(F.struct("feature_id", "title"))).alias("_f"))
    titles = F.array_distinct(F.array_compact(F.transform("_f", lambda f: f["title"])))
    return rows.select("url", F.array_distinct(F.transform("_f", lambda f: f["feature_id"])).alias("feature_ids"), F.array_join(titles, "; ").alias("title"))

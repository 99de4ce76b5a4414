"""Published grids: coded domains, headers of two rows, and roads that are none."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ACCENTS, PLAIN, pair
from ..storage import stage

#: Classes and characteristics of network lines that are no roadway.
NOT_ROAD_CLASSES = ("Liaison maritime",)
NOT_ROAD_CHARACTERISTICS = ("Traverse", "Passerelle piétonnière", "Passerelle piétonnière et cycliste", "Pont ferroviaire", "Passage pour pipeline")


def roadway_only(segments: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Segments whose class, in each of the columns, is not listed as no road. A missing class keeps the row, a missing column is no test."""
    for column, excluded in classes.items():
        if column in segments.columns:
            segments = segments.where(~F.coalesce(F.col(column).isin(*excluded), F.lit(False)))
    return segments


def with_labels(rows: DataFrame, domains: DataFrame, suffix: str = "_label") -> DataFrame:
    """rows with a label column beside each coded field, from domains (field, code, label); codes that a domain lacks have a null label.

    Fields are few and so are the codes of a field: each is a map of its own.
    """
    fields = {r["field"]: r["codes"] for r in domains.groupBy("field").agg(F.map_from_entries(F.collect_list(F.struct(F.col("code").cast("string"), "label"))).alias("codes")).collect()}
    for field in [c for c in rows.columns if c in fields]:
        pairs = [F.lit(x) for kv in sorted(fields[field].items()) for x in kv]
        rows = rows.withColumn(f"{field}{suffix}", F.try_element_at(F.create_map(*pairs), F.col(field).cast("string")))
    return rows


def header_names(groups: Sequence[str | None], header: Sequence[str | None]) -> list[str | None]:
    """Names of columns from two header rows: a name that occurs more than once takes its group's, the last one printed, before it."""
    flat = [" ".join((h or "").split()) for h in header]
    counts, names, group = Counter(x for x in flat if x), [], ""
    for k, name in enumerate(flat):
        if k < len(groups) and groups[k]:
            group = " ".join(groups[k].split())
        names.append(None if not name else f"{group}: {name}" if counts[name] > 1 and group else name)
    return names


def read_grid(rows: DataFrame, key: str, headers: int = 2) -> DataFrame:
    """A sheet of rows (row_index, cells array<string>) as a table: the last two of the header rows name the columns.

    Only rows before the first one with a blank first cell are read. A key stated twice is an error. The key column is
    named `key`, columns without a name are left out.
    """
    top = {r["row_index"]: r["cells"] for r in rows.where(F.col("row_index") < headers).collect()}
    names = header_names(top[headers - 2], top[headers - 1])
    first = F.trim(F.coalesce(F.get("cells", 0), F.lit("")))
    body = rows.where(F.col("row_index") >= headers)
    blank = body.where(first == "").agg(F.min("row_index")).first()[0]
    body = body if blank is None else body.where(F.col("row_index") < blank)
    columns = [F.nullif(F.trim(F.get("cells", k)), F.lit("")).alias(n) for k, n in enumerate(names) if n and k]
    out = body.select(first.alias(key), *columns)
    twice = out.groupBy(key).count().where("count > 1").orderBy(key).limit(5).collect()
    if twice:
        raise ValueError(f"{key} stated more than once: {', '.join(r[key] for r in twice)}")
    return out


# Grids printed on pages, from pieces of text with their places.

#: Gaps between pieces, in heights of the font: from the first on two cells, from the second on two words. Least distance of two lines.
CELL_GAP, WORD_GAP, LINE_M = 1.0, 0.15, 2.0


def placed_cells(pieces: DataFrame, page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, line, cell, x0, x1, text): pieces (page, x0, x1, y, height, text) joined into the cells they were printed as; y grows upwards.

    A line ends where the next piece down lies LINE_M or half its height lower. In a line a piece goes on the cell before
    unless the gap to all before it is over CELL_GAP heights, and stands apart as a word from WORD_GAP on. Blank pieces
    are passed over. Lines count from 1 at the top of the page, cells from 1 at the left.
    """
    page = list(page)
    down = Window.partitionBy(*page).orderBy(F.desc("y"), "x0", "x1", "text")
    across = Window.partitionBy(*page, "line").orderBy("x0", "x1", "text")
    shown = pieces.where(F.trim("text") != "")
    drop = F.lag("y").over(down) - F.col("y")
    lines = shown.withColumn("_new", F.coalesce((drop >= F.greatest(F.lit(LINE_M), F.col("height") / 2)).cast("int"), F.lit(1))).withColumn("line", F.sum("_new").over(down))
    gap = F.col("x0") - F.max("x1").over(across.rowsBetween(Window.unboundedPreceding, -1))
    cells = lines.withColumn("_gap", gap / F.col("height")).withColumn("cell", F.sum(F.coalesce((F.col("_gap") > CELL_GAP).cast("int"), F.lit(1))).over(across))
    part = F.struct("x0", "x1", F.when(F.col("_gap") > WORD_GAP, F.concat(F.lit(" "), F.trim("text"))).otherwise(F.trim("text")).alias("t"))
    joined = F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["t"]), ""))
    return cells.groupBy(*page, "line", "cell").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), joined.alias("text"))


def placed_grid(cells: DataFrame, header: str, page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, label, column_index, text): values of a printed grid, from placed_cells().

    The first line whose first cell reads `header` says where the columns are: its further cells' centres, in order from
    0. In the lines below it the first cell is the label, and each further one belongs to the nearest centre, if that is
    nearer than half the distance between two columns; of several the leftmost counts. Pages without the header give none.
    """
    page = list(page)
    plain = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    first = cells.where((F.col("cell") == 1) & (plain(F.col("text")) == header.lower())).groupBy(*page).agg(F.min("line").alias("_top"))
    below = cells.join(first, page)
    centre = (F.col("x0") + F.col("x1")) / 2
    columns = below.where((F.col("line") == F.col("_top")) & (F.col("cell") > 1)).groupBy(*page).agg(F.array_sort(F.collect_list(centre)).alias("_centres"))
    apart = F.array_min(F.transform(F.slice("_centres", F.lit(2), F.size("_centres")), lambda c, k: c - F.get("_centres", k)))
    labels = below.where((F.col("line") > F.col("_top")) & (F.col("cell") == 1)).select(*page, "line", F.col("text").alias("label"))
    values = below.where((F.col("line") > F.col("_top")) & (F.col("cell") > 1)).join(columns, page)
    near = F.array_min(F.transform("_centres", lambda c, k: F.struct(F.abs(c - centre).alias("d"), k.alias("k"))))
    placed = values.withColumn("_near", near).where(F.col("_near.d") < F.coalesce(apart / 2, F.lit(float("inf"))))
    best = placed.groupBy(*page, "line", F.col("_near.k").alias("column_index")).agg(F.min(F.struct("x0", "text")).alias("_v"))
    return best.join(labels, [*page, "line"]).select(*page, "label", "column_index", F.col("_v.text").alias("text"))


# Columns from all rows of a page instead of one header, and grids that sections drive.

#: How far a cell's centre may lie from a column's, and how many anchor cells a column needs.
COLUMN_REACH, COLUMN_SUPPORT = 20.0, 2


def plain_label(c: Column) -> Column:
    """A label without accents, in lower case, single-spaced, for comparison."""
    return F.trim(F.regexp_replace(F.lower(F.translate(c, ACCENTS, PLAIN)), r"\s+", " "))


def column_centres(cells: DataFrame, anchors: Sequence[str], reach: float = COLUMN_REACH, support: int = COLUMN_SUPPORT, page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, column_index, centre): where the columns of a page are, from the cells of all lines whose label is an anchor.

    Centres in order are one cluster as long as each lies within `reach` of the one before; a cluster of fewer than `support` cells
    is no column. A column's centre is the middle one of its cells (the upper of two), so a header that lacks a column, or a
    stray cell in one line, moves nothing.
    """
    page = list(page)
    labels = cells.where((F.col("cell") == 1) & plain_label(F.col("text")).isin(*anchors)).select(*page, "line")
    centres = cells.where("cell > 1").join(labels, [*page, "line"], "left_semi").select(*page, ((F.col("x0") + F.col("x1")) / 2).alias("centre"))
    w = Window.partitionBy(*page).orderBy("centre")
    new = F.coalesce((F.col("centre") - F.lag("centre").over(w) > reach).cast("int"), F.lit(1))
    clusters = centres.withColumn("_new", new).withColumn("_cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = clusters.groupBy(*page, "_cluster").agg(F.array_sort(F.collect_list("centre")).alias("_all")).where(F.size("_all") >= support)
    found = found.select(*page, F.get("_all", F.floor(F.size("_all") / 2).cast("int")).alias("centre"))
    return found.select(*page, (F.row_number().over(w) - 1).alias("column_index"), "centre")


def by_column(cells: DataFrame, centres: DataFrame, reach: float = COLUMN_REACH, page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, line, column_index, text): each cell behind a line's label in the column whose centre is nearest, within `reach`; of several the rightmost, as captions stand left of values."""
    page = list(page)
    columns = centres.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("column_index", "centre"))).alias("_columns"))
    centre = (F.col("x0") + F.col("x1")) / 2
    near = F.array_min(F.transform("_columns", lambda c: F.struct(F.abs(c["centre"] - centre).alias("d"), c["column_index"].alias("k"))))
    placed = cells.where("cell > 1").join(columns, page).withColumn("_near", near).where(F.col("_near.d") <= reach)
    return placed.groupBy(*page, "line", F.col("_near.k").alias("column_index")).agg(F.max(F.struct("x0", "text")).alias("_v")).select(*page, "line", "column_index", F.col("_v.text").alias("text"))


def clustered_grid(cells: DataFrame, anchors: Sequence[str], reach: float = COLUMN_REACH, support: int = COLUMN_SUPPORT, page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, line, label, column_index, text): the values of a printed grid, from placed_cells(), by column_centres() of its anchor lines. Pages without a column give none. Cells are staged, as several joins read them."""
    page, cells = list(page), stage(cells, "grid-cells")
    labels = cells.where("cell = 1").select(*page, "line", F.col("text").alias("label"))
    values = by_column(cells, column_centres(cells, anchors, reach, support, page), reach, page)
    return values.join(labels, [*page, "line"]).select(*page, "line", "label", "column_index", "text")


def sectioned_grid(cells: DataFrame, sections: Mapping[str, str], anchors: Sequence[str], reach: float = COLUMN_REACH, support: int = COLUMN_SUPPORT, page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, line, section, label, column_index, text): clustered_grid() with the section that each line lies in.

    sections are the first words of a section's heading (as plain_label() gives them) and its name. A heading opens its
    section for the lines below, down to the next; lines above the first heading and headings themselves are left out.
    """
    page, cells = list(page), stage(cells, "grid-cells")
    label = plain_label(F.col("text"))
    opened = F.coalesce(*[F.when(label.startswith(head), name) for head, name in sections.items()])
    down = Window.partitionBy(*page).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    heads = cells.where("cell = 1").select(*page, "line", opened.alias("_opens")).withColumn("section", F.last("_opens", ignorenulls=True).over(down))
    rows = clustered_grid(cells, anchors, reach, support, page)
    return rows.join(heads.where("_opens IS NULL AND section IS NOT NULL").drop("_opens"), [*page, "line"]).select(*page, "line", "section", "label", "column_index", "text")


def grid_norms(rows: DataFrame, usages: str, numbers: Mapping[tuple[str, str], str], sides: tuple[str, Sequence[str]], storeys: tuple[str, str], page: Sequence[str] = ("page",)) -> DataFrame:
    """(page, column_index, usages, a column for each of numbers, side_margin_m, floors_min, floors_max, notes): what each column of a sectioned_grid() rules.

    usages is the section whose values are codes; a column without any rules nothing and goes, and the rest are numbered
    anew. numbers are (section, label) and the name of the figure there. sides are a section and its labels of side
    margins, whose mean counts where a by-law prints two, with a note where they differ or one is missing. storeys are
    the section and label of '2', '1-3' or '2 à 4'. Labels are as plain_label() gives them.
    """
    page = list(page)
    label, figure = plain_label(F.col("label")), F.replace(F.regexp_extract("text", r"[0-9]+(?:[.,][0-9]+)?", 0), F.lit(","), F.lit(".")).try_cast("double")
    of = lambda section, name: (F.col("section") == section) & (label == name)
    floors = pair(F.col("text"))
    side = (F.col("section") == sides[0]) & label.isin(*sides[1])
    out = rows.groupBy(*page, "column_index").agg(
        F.array_sort(F.collect_set(F.when(F.col("section") == usages, F.col("text")))).alias("usages"),
        *[F.max(F.when(of(*key), figure)).alias(name) for key, name in numbers.items()],
        F.avg(F.when(side, figure)).alias("side_margin_m"),
        F.count(F.when(side, figure)).alias("_n"),
        (F.max(F.when(side, figure)) - F.min(F.when(side, figure))).alias("_apart"),
        F.max(F.when(of(*storeys), floors)).alias("_floors"),
    )
    out = out.where(F.size("usages") > 0).withColumn("column_index", F.row_number().over(Window.partitionBy(*page).orderBy("column_index")) - 1)
    notes = F.array_compact(F.array(F.when(F.col("_apart") > 0, "mean of two side margins"), F.when((F.col("_n") > 0) & (F.col("_n") < len(sides[1])), "one side margin printed"), F.when(F.col("_floors").isNull(), "no storeys stated")))
    return out.select(*page, "column_index", "usages", *numbers.values(), "side_margin_m", F.col("_floors.low").cast("int").alias("floors_min"), F.col("_floors.high").cast("int").alias("floors_max"), notes.alias("notes"))


def coverage_max(green_min_pct: Column) -> Column:
    """The largest share of a lot that may be covered where only the least green share is ruled."""
    return F.greatest(100 - green_min_pct, F.lit(0.0))

"""Embeddings: near-duplicates by an exact metric range join, and approximate nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import forest, named_groups, stage, task_rows

# Shared: which vectors count, and distinct ones.


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    fine = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors as rows in double precision, each times a power of two so that no square overflows or vanishes; cosines stay as they are."""
    if not len(column):
        return np.zeros((0, 1))
    x = np.stack(column.to_numpy()).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row. The same for (a, b) and (b, a), and whatever rows stand beside them."""
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def share_of(key: str, n: float, salt: str) -> Column:
    """True for the share n (0 to 1) of rows, by a hash of the key."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 52)) < F.lit(min(1.0, n) * (1 << 52))


# Near-duplicates.

#: Vectors of a cell that one task holds against one another.
CHUNK = 4096
#: Vectors for each pivot; pivots of one split; vectors of a cell that its pivots are chosen from.
PER_PIVOT, MOST_PIVOTS, PIVOT_SAMPLE = 2000, 256, 8192
#: Rows of a cell that one task deals out.
DEAL = 50_000
CELL = ["label", "dim", "cell"]


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the sample's vector that is farthest from those before."""
    chosen = [0] if len(sample) else []
    near = ((sample - sample[:1]) ** 2).sum(1) if len(sample) else np.zeros(0)
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def cells_of(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, whether it is the row's home) for unit vectors x.

    Home is the nearest pivot. A vector within `radius` of x has a home j with d(x, j) <= d(x, home) + 2 radius, by the
    triangle inequality, and x is then no farther than `radius` from the plane between the two pivots; x is copied to the
    cells where both hold, so each vector meets all within the radius in its home cell.
    """
    square = np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T, 0)
    home = square.argmin(1)
    best = square[np.arange(len(x)), home]
    apart = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(2), 1e-300))
    slack = 1e-9
    near = (np.sqrt(square) <= np.sqrt(best)[:, None] + 2 * radius + slack) & ((square - best[:, None]) <= 2 * apart[home] * (radius + slack))
    near[np.arange(len(x)), home] = True
    row, cell = np.nonzero(near)
    return row, cell, home[row] == cell


def split_cells(rows: DataFrame, big: DataFrame, radius: float) -> DataFrame:
    """The rows of the cells of `big` (CELL, n) dealt to cells of their own pivots, as cells_of says.

    A cell's pivots are chosen in one task from about PIVOT_SAMPLE of its vectors; its rows are dealt out by tasks of
    about DEAL rows. A row is at home where its copy was at home before and the new cell is its home.
    """
    schema = rows.schema
    wanted = rows.join(big, CELL)
    sample = wanted.where(F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(1 << 52)) / (1 << 52) * F.col("n") < PIVOT_SAMPLE).select(*CELL, "n", "node", "vector")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        count = int(np.clip(-(-int(pdf["n"].iloc[0]) // PER_PIVOT), 2, MOST_PIVOTS))
        pivots = spread_pivots(unit(matrix(pdf["vector"])), count)
        return pdf[[*CELL, "n"]].iloc[:1].assign(pivots=[pivots.ravel()])

    label = schema["label"].dataType.simpleString()
    pivots = sample.groupBy(*CELL).applyInPandas(choose, f"label {label}, dim int, cell string, n long, pivots array<double>")
    salts = F.greatest(F.ceil(F.col("n") / DEAL), F.lit(1)).cast("int")
    spread = stage(pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))), "vectors-pivots")
    dealt = wanted.withColumn("salt", F.pmod(F.xxhash64("node", F.lit("deal")), salts).cast("int")).drop("n")
    names = [f.name for f in schema]

    def deal(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return left[names].iloc[:0]
        x = unit(matrix(left["vector"]))
        row, cell, home = cells_of(x, np.asarray(right["pivots"].iloc[0]).reshape(-1, x.shape[1]), radius)
        out = left.iloc[row].copy()
        out["cell"] = [f"{a}.{b}" for a, b in zip(out["cell"], cell.tolist(), strict=True)]
        out["home"] = out["home"].to_numpy(bool) & home
        return out[names]

    keys = [*CELL, "salt"]
    return dealt.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(deal, schema)


def cells(rows: DataFrame, radius: float) -> list[DataFrame]:
    """Tables that together hold every row in cells: split again while a cell holds more than CHUNK vectors and splitting helps.

    A split helps where its cells together have at most half as many pairs as the cell had; other cells, such as balls of
    near copies within the radius, stay whole. Each round is a few joins; one row is collected.
    """
    done, open_ = [], rows
    while True:
        sizes = stage(open_.groupBy(*CELL).agg(F.count("*").alias("n")), "vectors-sizes")
        big = sizes.where(F.col("n") > CHUNK)
        if not big.limit(1).count():
            return [*done, open_]
        parts = stage(split_cells(open_, big, radius), "vectors-split")
        pairs = parts.groupBy("label", "dim", F.regexp_replace("cell", r"\.\d+$", "").alias("cell"), F.col("cell").alias("part")).agg(F.count("*").cast("double").alias("n"))
        pairs = pairs.groupBy(*CELL).agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
        helped = stage(big.join(pairs, CELL).where(F.col("pairs") <= 0.5 * F.col("n").cast("double") * F.col("n")).select(*CELL), "vectors-helped")
        done.append(open_.join(helped, CELL, "left_anti"))
        parent = parts.withColumn("part", F.col("cell")).withColumn("cell", F.regexp_replace("cell", r"\.\d+$", ""))
        open_ = stage(parent.join(helped, CELL, "left_semi").withColumn("cell", F.col("part")).select(rows.columns), "vectors-cells")


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component, kept): vectors of equal label link at a cosine of `threshold` or more.

    n_links counts the other rows linked directly, component is the smallest id reachable, kept is id = component. Equal
    vectors of a label are one node with a weight, so copies are never paired. Vectors that are null, zero, or hold null
    or non-finite components, those with a null label or a null id, and vectors of unequal length never link: n_links 0,
    component the id itself. Rows with a repeated id stay rows of their own, with the links of their own vectors, and
    count as links. Norms may be as large or small as doubles go. threshold lies in (0, 1]. An empty table gives an empty
    result. Other columns are not read, so their names clash with nothing.
    """
    all_rows = stage(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label")), "vectors")
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    rows = all_rows.where(fit)
    distinct = stage(rows.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("weight")).withColumn("node", F.monotonically_increasing_id()), "vectors-distinct")
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    start = distinct.select("label", F.size("vector").alias("dim"), F.lit("0").alias("cell"), F.lit(True).alias("home"), "node", "weight", "vector")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        x = matrix(pdf["vector"])
        u = unit(x)
        node, weight, own, home = (pdf[c].to_numpy() for c in ("node", "weight", "_own", "home"))
        across = pdf["_i"].iloc[0] != pdf["_j"].iloc[0]
        links, bits = np.zeros(len(x), np.int64), []
        for k in range(0, len(x), 512):
            value = u[k : k + 512] @ u.T
            hit = value >= threshold
            for a, b in zip(*np.nonzero(np.abs(value - threshold) < 1e-9), strict=True):  # too near to tell from a product of matrices
                hit[a, b] = cosine(x[k + a], x[b]) >= threshold
            hit[np.arange(len(hit)), np.arange(k, k + len(hit))] = False
            # Pairs within a chunk are counted in the chunk's own task.
            links[k : k + 512] = (hit & (own[k : k + 512, None] != own[None]) if across else hit) @ weight
            bits.append(np.packbits(hit, axis=1))
        bits = np.concatenate(bits)
        at = np.flatnonzero(bits.any(1))
        edges = forest(len(at), lambda i, rest: np.unpackbits(bits[at[i]], count=len(x))[at[rest]].astype(bool))
        some = home & (links > 0)
        a, b = node[at[[i for i, _ in edges]]] if edges else np.zeros(0, np.int64), node[at[[k for _, k in edges]]] if edges else np.zeros(0, np.int64)
        return pd.DataFrame({"a": np.concatenate([node[some], a]), "b": np.concatenate([np.full(some.sum(), -1), b]), "links": np.concatenate([links[some], np.full(len(edges), -1)])}).astype(np.int64)

    found = None
    for part in cells(start, radius):
        some = task_rows(part, CELL, "node", CHUNK).groupBy(*CELL, "_i", "_j").applyInPandas(join, "a long, b long, links long")
        found = some if found is None else found.union(some)
    found = stage(found, "vectors-links")
    named = named_groups(distinct.select("node", "least"), found.where("links < 0").select("a", "b")).select("node", "component")
    direct = found.where("links >= 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = distinct.join(named, "node").join(direct, "node", "left")
    named = stage(named.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component"), "vectors-named")
    out = rows.join(named, ["label", "vector"]).select("id", "n_links", "component")
    rest = all_rows.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return out.union(rest).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))


def op5_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_vectors over all embeddings, at a cosine of 0.98."""
    out = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x != 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a, count(*) AS n_links FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN component c ON v.vec_id = c.a LEFT JOIN n ON v.vec_id = n.a
"""


# Nearest neighbours.

#: Vectors that the coarse centroids and codebooks are fitted on, vectors that each finer centroid is fitted on, and cells as a multiple of the square root of the table.
FIT_SAMPLE, PER_CELL, CELLS = 16_384, 48, 4
#: Queries that cells read and shortlists are set by, and the share of their true neighbours that cells and shortlist must hold.
TUNE_QUERIES, CELL_RECALL, LIST_RECALL = 192, 0.955, 0.99
PARTS_OF, CODES = 4, 256
#: Groups of cells of a small table; coded vectors, and queries, that one task scans at most. A query gets a shortlist from each
#: group, so a small table has a fixed number of them; a large one is split further.
GROUPS, SCAN, ASK = 5, 1 << 20, 20_000


def k_means(x: np.ndarray, k: int, rounds: int, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, x[:, d], len(centres)) for d in range(x.shape[1])], 1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([((centres**2).sum(1)[None] - 2 * x[k : k + 4096] @ centres.T).argmin(1) for k in range(0, max(1, len(x)), 4096)])


class Index:
    """Centroids of the cells, and for what is left of vectors a codebook for each group of PARTS_OF components."""

    def __init__(self, centres: np.ndarray, sample: np.ndarray):
        self.centres, self.dim = centres, sample.shape[1]
        rest = sample - centres[nearest(sample, centres)]
        self.cuts = list(range(0, self.dim, PARTS_OF))
        self.books = [k_means(rest[:8192, c : c + PARTS_OF], CODES, 8) for c in self.cuts]

    def ranked(self, q: np.ndarray) -> np.ndarray:
        """Cells in the order in which unit queries look at them."""
        return np.argsort((self.centres**2).sum(1)[None] - 2 * q @ self.centres.T, 1, kind="stable")

    def codes(self, x: np.ndarray, home: np.ndarray) -> np.ndarray:
        rest = x - self.centres[home]
        return np.stack([nearest(rest[:, c : c + PARTS_OF], b) for c, b in zip(self.cuts, self.books, strict=True)], 1).astype(np.uint8)

    def distances(self, q: np.ndarray, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Asymmetric: squared distances of whole unit queries to coded vectors, by tables.

        A coded vector is its cell's centroid c and an entry b for each part, so the distance is |q - c|^2, plus the sum
        over the parts of b^2 + 2 b c, which no query changes, minus twice that of q b, which is one table for each query.
        """
        near = 1 + (self.centres**2).sum(1)[None] - 2 * q @ self.centres.T
        out = near[:, cell] + self.fixed(cell, codes)
        for p, table in enumerate(self.tables(q)):
            out -= 2 * table[:, codes[:, p]]
        return out

    def fixed(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The part of coded vectors' distances that no query changes."""
        out = np.zeros(len(codes))
        for p, (c, b) in enumerate(zip(self.cuts, self.books, strict=True)):
            entry = b[codes[:, p]]
            out += (entry**2).sum(1) + 2 * (entry * self.centres[cell, c : c + PARTS_OF]).sum(1)
        return out

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """For each part what queries have in common with each entry."""
        return [q[:, c : c + PARTS_OF] @ b.T for c, b in zip(self.cuts, self.books, strict=True)]


class Cells:
    """The coded vectors of a group of cells, sorted by cell, so that a query meets those of the cells it reads and no others."""

    def __init__(self, index: Index, cell: np.ndarray, codes: np.ndarray):
        self.index, self.here, self.starts = index, *np.unique(cell, return_index=True)
        self.ends = np.append(self.starts[1:], len(cell))
        self.own = np.repeat(np.arange(len(self.here)), self.ends - self.starts)
        # Places in the tables of all parts, one behind the other.
        self.codes = codes.astype(np.int64) + CODES * np.arange(codes.shape[1])[None]
        self.fixed, self.scored = index.fixed(cell, codes), 0

    def read(self, q: np.ndarray, cells: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, squared distances) of the coded vectors in the cells of each unit query."""
        centres = self.index.centres[self.here]
        near = 1 + (centres**2).sum(1)[None] - 2 * q @ centres.T
        tables = [np.pad(t, ((0, 0), (0, CODES - t.shape[1]))) for t in self.index.tables(q)]
        lines = np.concatenate(tables, 1)
        for i, read in enumerate(cells):
            at = np.searchsorted(self.here, read)
            at = at[(at < len(self.here)) & (self.here[np.minimum(at, len(self.here) - 1)] == read)]
            sizes = self.ends[at] - self.starts[at]
            places = np.repeat(self.starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            self.scored += len(places)
            yield places, near[i, self.own[places]] + self.fixed[places] - 2 * lines[i][self.codes[places]].sum(1)


def cell_centres(distinct: DataFrame, sample: np.ndarray, total: int) -> np.ndarray:
    """About CELLS * sqrt(total) centroids in two levels.

    The coarse ones, their square root, come from the driver's sample. Each coarse cell's finer ones are fitted in a task
    on its part of a sample of PER_CELL vectors for each, as many as its share of that sample says. So centroids grow
    with the square root of the table, and no task fits more than its coarse cell.
    """
    wanted = max(1, min(round(CELLS * total**0.5), total // PER_CELL))
    coarse = k_means(sample, max(1, round(wanted**0.5)), 10)
    shared = distinct.sparkSession.sparkContext.broadcast(coarse)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"coarse": nearest(unit(matrix(b["vector"])), shared.value), "node": b["node"], "vector": b["vector"]})

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(matrix(pdf.sort_values("node")["vector"]))
        centres = k_means(x, max(1, round(len(x) / PER_CELL)), 10)
        return pd.DataFrame({"coarse": pdf["coarse"].iloc[0], "k": np.arange(len(centres)), "centre": list(centres)})

    some = distinct.where(share_of("node", wanted * PER_CELL / total, "cells")).select("node", "vector")
    found = some.mapInPandas(part, "coarse int, node long, vector array<double>").groupBy("coarse").applyInPandas(fit, "coarse int, k int, centre array<double>").toPandas()
    return np.stack(found.sort_values(["coarse", "k"])["centre"].to_numpy()) if len(found) else coarse


def tuned(distinct: DataFrame, entries: DataFrame, index, total: int, k: int) -> tuple[int, int]:
    """(cells to read, length of the shortlist) that hold CELL_RECALL and LIST_RECALL of the true neighbours of some asked vectors.

    About TUNE_QUERIES asked vectors are held against every row: once for their k nearest others, and once for how many
    coded vectors seem nearer than those.
    """
    spark = distinct.sparkSession
    asked = distinct.where("asked")
    n = max(1, asked.count())
    queries = asked.where(share_of("node", TUNE_QUERIES / n, "tune")).select("node", "vector").toPandas().sort_values("node")
    if not len(queries):
        queries = asked.select("node", "vector").orderBy("node").limit(TUNE_QUERIES).toPandas()
    if not len(queries) or total <= k + 1:
        return len(index.value.centres), total
    q, own = unit(matrix(queries["vector"])), queries["node"].to_numpy()
    shared = spark.sparkContext.broadcast((q, own))  # about TUNE_QUERIES vectors

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, own = shared.value
        for b in batches:
            if len(b):
                x, node, home = unit(matrix(b["vector"])), b["node"].to_numpy(), b["cell"].to_numpy()
                score = q @ x.T
                score[own[:, None] == node[None]] = -9
                near = np.argsort(-score, 1, kind="stable")[:, : min(k, len(x))]
                yield pd.DataFrame({"query": np.repeat(np.arange(len(q)), near.shape[1]), "node": node[near].ravel(), "cell": home[near].ravel(), "code": b["code"].to_numpy()[near].ravel(), "score": np.take_along_axis(score, near, 1).ravel()})

    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    true = entries.mapInPandas(best, "query int, node long, cell int, code binary, score double").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).toPandas()
    true = true[true["score"] > -2]
    ranked = index.value.ranked(q)
    rank = np.empty_like(ranked)
    rank[np.arange(len(q))[:, None], ranked] = np.arange(ranked.shape[1])[None]
    probes = np.sort(rank[true["query"], true["cell"]])
    limits = np.array([index.value.distances(q[[i]], np.array([c]), np.frombuffer(code, np.uint8)[None])[0, 0] for i, c, code in zip(true["query"], true["cell"], true["code"], strict=True)])
    bounds = spark.sparkContext.broadcast((true["query"].to_numpy(), limits))

    def nearer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (q, _), (of, limit) = shared.value, bounds.value
        counts = np.zeros(len(limit), np.int64)
        for b in batches:
            if len(b):
                d = np.sort(index.value.distances(q, b["cell"].to_numpy(), np.frombuffer(b"".join(b["code"]), np.uint8).reshape(len(b), -1)), 1)
                counts += np.array([np.searchsorted(d[i], x - 1e-9) for i, x in zip(of, limit, strict=True)], np.int64)
        yield pd.DataFrame({"at": np.arange(len(limit)), "n": counts})

    places = np.sort(entries.select("cell", "code").mapInPandas(nearer, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()["n"].to_numpy())
    cells, most = (int(x[min(len(x) - 1, int(np.ceil(share * len(x))))]) + 1 for x, share in ((probes, CELL_RECALL), (places, LIST_RECALL)))
    return cells, max(4 * k, most)


def cells_needed(ranked: np.ndarray, held: np.ndarray, probes: int, ids: int) -> np.ndarray:
    """How many of its ranked cells each query reads: `probes`, or more until they hold so many ids, at most all."""
    enough = held[ranked].cumsum(1) >= ids
    return np.maximum(probes, np.where(enough.any(1), enough.argmax(1) + 1, ranked.shape[1]))


def shortlist(order: np.ndarray, least: np.ndarray, most: int, ids: int) -> np.ndarray:
    """Of entries in order the first `most`, and the first of each id until there are `ids` ids: an id of many vectors fills no list alone."""
    first = np.sort(np.unique(least[order], return_index=True)[1])[:ids]
    return order[np.union1d(np.arange(min(most, len(order))), first)]


def totals(df: DataFrame, key: str, n: int) -> np.ndarray:
    """The column n of df (key, n) as an array by key; df has a row for each cell or group of cells at most."""
    got = df.collect()
    return np.bincount([r[key] for r in got], [r["n"] for r in got], n).astype(np.int64) if got else np.zeros(n, np.int64)


def groups_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, first group) of each cell: cells share a group up to a GROUPS-th of all coded vectors, SCAN at most, and a larger cell has several of its own."""
    most = max(1, min(SCAN, -(-int(sizes.sum()) // GROUPS)))
    parts, base, group, room = np.maximum(1, -(-sizes // most)), np.zeros(len(sizes), np.int64), -1, 0
    for cell, (n, size) in enumerate(zip(parts.tolist(), sizes.tolist(), strict=True)):
        if n > 1 or size > room:
            group, room = group + 1, most
        base[cell], room = group, room - size
        if n > 1:
            group, room = group + n - 1, 0
    return parts, base


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row where is_query holds, the k nearest other rows found, by cosine.

    The index holds every row: equal vectors are one entry that keeps their k + 1 smallest ids, as no query can return
    more of them. Queries meet coded vectors only; the vectors of a query's shortlist are fetched and scored exactly, and
    ties go to the smaller id. Cells read and shortlist are set by what some queries' true neighbours need (tuned()).
    Vectors that are null, zero or hold null or non-finite components, null ids, and vectors of another length than the
    most frequent one take no part. A query reads on past the tuned number of cells until those read hold k + 1 ids, so
    fewer rows are returned only where there are fewer candidates. Rows with a repeated id count once, with their best
    score; a query id of several vectors has the best of their neighbours. An empty table gives an empty result. Other
    columns are not read, so their names clash with nothing.
    """
    spark = vectors.sparkSession
    query = F.coalesce(is_query, F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), query.alias("query"))
    rows = stage(rows.where(F.col("id").isNotNull() & usable(F.col("vector"))), "ann-rows")
    dims = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if not dims:
        return empty
    rows = rows.where(F.size("vector") == dims[0]["dim"])
    few = rows.groupBy("vector", "id").agg(F.max("query").alias("query"))
    few = few.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("place") <= k + 1)
    held = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.where("query").select("vector", F.lit(True).alias("asked")).distinct()
    distinct = held.join(asked, "vector", "left").select("ids", "vector", F.coalesce("asked", F.lit(False)).alias("asked"))
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "ann-distinct")
    total = distinct.count()
    some = distinct.where(share_of("node", FIT_SAMPLE / total, "sample")).select("node", "vector").toPandas().sort_values("node")
    if not len(some):
        some = distinct.select("node", "vector").limit(FIT_SAMPLE).toPandas().sort_values("node")
    sample = unit(matrix(some["vector"]))
    index = spark.sparkContext.broadcast(Index(cell_centres(distinct, sample, total), sample))  # about CELLS * sqrt(total) centroids and a codebook
    cells = len(index.value.centres)

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = unit(matrix(b["vector"]))
                home = nearest(x, index.value.centres)
                yield pd.DataFrame({"cell": home, "node": b["node"], "ids": b["ids"], "vector": b["vector"], "code": [c.tobytes() for c in index.value.codes(x, home)]})

    entries = stage(distinct.select("node", "ids", "vector").mapInPandas(enter, "cell int, node long, ids array<long>, vector array<double>, code binary"), "ann-index")
    probes, most = tuned(distinct, entries, index, total, k)
    first_cells = entries.select(F.explode("ids").alias("id"), "cell").groupBy("id").agg(F.min("cell").alias("cell"))  # an id in several cells counts in one
    held_ids = spark.sparkContext.broadcast(totals(first_cells.groupBy("cell").agg(F.count("*").alias("n")), "cell", cells))  # a number for each cell
    parts, base = groups_of(totals(entries.groupBy("cell").agg(F.count("*").alias("n")), "cell", cells))
    last = int((base + parts).max())

    def reads(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        q, rows, read = unit(matrix(b["vector"])), [], []
        step = max(1, (1 << 22) // cells)  # queries ranked at once: all cells in order for each
        for s in range(0, len(q), step):
            ranked = index.value.ranked(q[s : s + step])
            row, rank = np.nonzero(np.arange(cells)[None] < cells_needed(ranked, held_ids.value, probes, k + 1)[:, None])
            rows.append(row + s)
            read.append(ranked[row, rank])
        return np.concatenate(rows), np.concatenate(read)

    def asked_groups(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(row, group, cells read there) for each group of cells that a query reads."""
        row, cell = reads(b)
        at = np.repeat(np.arange(len(row)), parts[cell])
        group = base[cell[at]] + np.arange(len(at)) - np.repeat(np.cumsum(parts[cell]) - parts[cell], parts[cell])
        both = row[at] * last + group
        order = np.argsort(both, kind="stable")
        starts = np.flatnonzero(np.diff(both[order], prepend=-1))
        return both[order][starts] // last, both[order][starts] % last, np.split(cell[at][order], starts[1:])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(last, np.int64)
        for b in batches:
            if len(b):
                n += np.bincount(asked_groups(b)[1], minlength=last)
        yield pd.DataFrame({"group": np.flatnonzero(n), "n": n[n > 0]})

    asked = distinct.where("asked").select("node", "vector").repartition(max(12, total // 100_000))
    crowd = totals(asked.mapInPandas(count, "group int, n long").groupBy("group").agg(F.sum("n").alias("n")), "group", last)
    salts = np.maximum(1, -(-crowd // ASK))  # for each group of cells

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                row, group, read = asked_groups(b)
                node = b["node"].to_numpy()[row]
                yield pd.DataFrame({"group": group, "salt": node % salts[group], "node": node, "vector": b["vector"].to_numpy()[row], "cells": read})

    def offer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                cell, node = b["cell"].to_numpy(), b["node"].to_numpy()
                group = base[cell] + node % parts[cell]
                n = salts[group]
                at = np.repeat(np.arange(len(b)), n)
                yield pd.DataFrame({"group": group[at], "salt": np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n), "cell": cell[at], "node": node[at], "least": b["least"].to_numpy()[at], "code": b["code"].to_numpy()[at]})

    asks = asked.mapInPandas(ask, "group int, salt int, node long, vector array<double>, cells array<int>")
    offers = entries.select("cell", "node", F.col("ids")[0].alias("least"), "code").mapInPandas(offer, "group int, salt int, cell int, node long, least long, code binary")

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values(["cell", "node"], kind="stable")
            codes = np.frombuffer(b"".join(right["code"]), np.uint8).reshape(len(right), -1)
            node, least, own = right["node"].to_numpy(), right["least"].to_numpy(), left["node"].to_numpy()
            held = Cells(index.value, right["cell"].to_numpy(), codes)
            for s in range(0, len(left), 256):
                some = left.iloc[s : s + 256]
                for i, (at, line) in enumerate(held.read(unit(matrix(some["vector"])), list(some["cells"]))):
                    order = np.lexsort((node[at], line))
                    chosen = shortlist(order, least[at], most, k + 1)
                    near = at[chosen]
                    out.append(pd.DataFrame({"query": own[s + i], "node": node[near], "least": least[near], "d": line[chosen]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "node": [], "least": [], "d": []})

    keys = ["group", "salt"]
    found = asks.groupBy(*keys).cogroup(offers.groupBy(*keys)).applyInPandas(scan, "query long, node long, least long, d double")
    near = Window.partitionBy("query").orderBy("d", "node")
    found = found.withColumn("place", F.row_number().over(near)).withColumn("first", (F.row_number().over(Window.partitionBy("query", "least").orderBy("d", "node")) == 1).cast("int"))
    found = found.withColumn("ids", F.sum("first").over(near.rowsBetween(Window.unboundedPreceding, 0))).where((F.col("place") <= most) | ((F.col("first") == 1) & (F.col("ids") <= k + 1)))
    short = stage(found.select("query", "node"), "ann-shortlist")
    pairs = short.join(entries.select("node", "ids", "vector"), "node").join(distinct.where("asked").select(F.col("node").alias("query"), F.col("vector").alias("q")), "query")

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(cosine(matrix(a), matrix(b)) if len(a) else [], dtype=float)

    scored = pairs.select("query", exact("q", "vector").alias("score"), F.explode("ids").alias("id")).groupBy("query", "id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")
    queries = rows.where("query").select(F.col("id").alias("query_id"), "vector").distinct().join(distinct.where("asked").select("vector", F.col("node").alias("query")), "vector").select("query_id", "query")
    wanted = queries.join(top, "query").where("id != query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = wanted.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """search over all embeddings for those whose vec_id is divisible by 50."""
    out = search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
    return out.withColumnRenamed("id", "vec_id")

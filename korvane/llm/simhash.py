"""SimHash near-duplicate detection with pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, forest, named_groups, stage, task_rows

BITS = 64
#: A block key may gather this many fingerprints before it is dealt out as pairs of chunks.
CHUNK = 8192
#: Fingerprints and keys that one Python call handles.
PER_CALL = 100_000


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, seed)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(words) - width + 1].tolist()
    ends = np.concatenate((gaps, [len(line)]))[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for k in range(0, len(starts), 65536):
        h = np.array([digest(line[s:e], seed) for s, e in zip(starts[k : k + 65536], ends[k : k + 65536], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, digest: bool = False) -> DataFrame:
    """(id, fp[, digest]): one row per row of docs, fp the fingerprint as a signed long, digest the text's md5.

    A null or blank text has fingerprint 0; repeated rows give repeated rows; other columns are not read.
    """

    more = ["digest"] * digest

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in b.column("t").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps, pa.int64()), *[b.column(c) for c in more]], ["id", "fp", *more])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), *[F.md5(text_col).alias("digest")] * digest)
    return rows.mapInArrow(run, "id long, fp long" + ", digest string" * digest)


def block_keys(n: int, distance: int) -> list[list[tuple[int, int]]]:
    """The keys to join on, each a list of (first bit, number of bits).

    The 64 bits are cut into `blocks` blocks; fingerprints that differ in `distance` bits agree on `blocks` - `distance`
    blocks at least, so each choice of so many blocks is a key. More blocks make longer keys: the fewest are taken whose
    keys leave about 64 of n evenly spread fingerprints together. The links found are the same for every number.
    """
    for blocks in range(distance + 1, 2 * distance + 1):
        cuts = [round(k * BITS / blocks) for k in range(blocks + 1)]
        same = blocks - distance
        if same * (BITS // blocks) >= 62 or 64 * 2 ** (same * (BITS // blocks)) >= n or blocks == 2 * distance:
            return [[(cuts[k], cuts[k + 1] - cuts[k]) for k in chosen] for chosen in combinations(range(blocks), same)]
    return [[(0, BITS)]]


def key_forest(keys: np.ndarray, fps: np.ndarray, reps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges between fingerprints of equal key that are within the distance: a spanning forest for each key."""
    order = np.argsort(keys, kind="stable")
    keys, fps, reps = keys[order], fps[order], reps[order]
    bounds = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    edges: list[tuple[int, int]] = []
    sizes = np.diff(bounds)
    small = np.repeat(sizes <= 48, sizes)
    for step in range(1, 48):  # keys with few fingerprints, all of them at once
        ok = small[step:] & (keys[step:] == keys[:-step])
        if not ok.any():
            break
        at = np.flatnonzero(ok)
        at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= distance]
        edges += zip(reps[at].tolist(), reps[at + step].tolist(), strict=True)
    for k in np.flatnonzero(sizes > 48):
        f, r = fps[bounds[k] : bounds[k + 1]], reps[bounds[k] : bounds[k + 1]].tolist()
        edges += [(r[a], r[b]) for a, b in forest(len(f), lambda i, rest, f=f: np.bitwise_count(f[i] ^ f[rest]) <= distance)]
    return edges


def finer(rows: DataFrame, keys: list[list[tuple[int, int]]], distance: int) -> DataFrame:
    """rows (fp, rep, block, key) with each key of more than CHUNK fingerprints cut up by the bits outside its blocks.

    Those bits are cut into distance + 1 stretches, of which a close pair shares one: each stretch with its bits is a key.
    """
    masks = []
    for k, chosen in enumerate(keys):
        free = [b for b in range(BITS) if not any(first <= b < first + bits for first, bits in chosen)]
        fixed = sum(1 << b for b in range(BITS)) - sum(1 << b for b in free)
        for j, part in enumerate(np.array_split(free, distance + 1)):
            mask = fixed | sum(1 << int(b) for b in part)
            masks.append((k, len(keys) + k * (distance + 1) + j, mask - (1 << 64) if mask >> 63 else mask))
    hot = rows.groupBy("block", "key").count().where(F.col("count") > CHUNK).select("block", "key", F.lit(True).alias("hot"))
    options = F.array(*[F.struct(F.lit(k).alias("of"), F.lit(b).alias("block"), F.lit(m).cast("long").alias("mask")) for k, b, m in masks])
    own = F.array(F.struct(F.col("block"), F.col("key")))
    cut = F.transform(F.filter(options, lambda o: o["of"] == F.col("block")), lambda o: F.struct(o["block"].alias("block"), F.col("fp").bitwiseAND(o["mask"]).alias("key")))
    marked = rows.join(hot, ["block", "key"], "left").withColumn("k", F.explode(F.when(F.col("hot"), cut).otherwise(own)))
    return marked.select("fp", "rep", F.col("k.block").alias("block"), F.col("k.key").alias("key"))


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): edges between the representatives of distinct fingerprints (fp, rep) that connect all within `distance`.

    Every pair within the distance is joined by a path of edges; all pairs of a dense group are not listed.
    """
    n = distinct.count()
    keys = block_keys(n, distance)

    def key(parts):
        value = F.lit(0).cast("long")
        for first, bits in parts:
            value = F.shiftleft(value, bits) + F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1))
        return value

    rows = stage(finer(distinct.select("fp", "rep", F.posexplode(F.array(*[key(k) for k in keys])).alias("block", "key")), keys, distance), "simhash-keys")
    tasks = task_rows(rows, ["block", "key"], "fp", CHUNK)
    # Rows of the tasks: a key of more than CHUNK is copied once for each of its chunks.
    sizes = rows.groupBy("block", "key").count().agg(F.sum(F.col("count") * F.ceil(F.col("count") / CHUNK)).alias("n")).first()
    calls = max(12, -(-int(sizes["n"] or 0) // PER_CALL))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        task = pd.util.hash_pandas_object(pdf[["block", "key", "i", "j"]], index=False).to_numpy()
        edges = key_forest(task, pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["rep"].to_numpy(np.int64), distance)
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    tasks = tasks.select(F.pmod(F.xxhash64("block", "key", "_i", "_j"), F.lit(calls)).alias("call"), "block", "key", F.col("_i").alias("i"), F.col("_j").alias("j"), "fp", "rep")
    return tasks.groupBy("call").applyInPandas(run, "a long, b long")


def groups(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root, component): for each fingerprint of rows (id, fp) its group, named by the smallest fingerprint, and the group's smallest id.

    Fingerprints are the nodes, whatever ids their rows have: null and repeated ids neither drop nor merge any.
    """
    distinct = stage(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    named = named_groups(distinct.select(F.col("fp").alias("node"), "least"), links(distinct.select("fp", F.col("fp").alias("rep")), distance))
    return named.withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """(id, fp, component): the fingerprint and the smallest id reachable over links of at most `distance` bits.

    Equal fingerprints are one node, so exact copies cost one row. Blank and null texts share fingerprint 0 and link as
    any others. Repeated ids keep all their rows, and link nothing by themselves; a null id never names a component (null
    if there is no other). An empty table gives an empty result.
    """
    fps = stage(fingerprints(docs, id_col, text_col, width), "simhash")
    return fps.join(groups(fps, distance).select("fp", "component"), "fp").select("id", "fp", "component")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_duplicates over all documents, 4-word shingles, 4 differing bits."""
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the document with the smallest id stays, one without an id only where none has one.

    Rows are told apart by id and text, so rows of one id with unrelated texts all stay, as do clean rows without an id.
    """
    columns = docs.columns
    fps = stage(fingerprints(docs, digest=True), "simhash")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.coalesce("digest", F.lit("")).alias("digest"))
    kept = fps.join(groups(fps).select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("k"))
    # One key, of id and text, for the join and for repeated rows, so that texts are shuffled once.
    key = lambda i, digest: F.md5(F.concat_ws("/", F.coalesce(i.cast("string"), F.lit("none")), digest)).alias("_key")
    kept = kept.select(key(F.col("k.id"), F.col("k.digest")))
    marked = docs.withColumn("_key", key(F.col("doc_id").cast("long"), F.coalesce(F.md5("text"), F.lit(""))))
    return marked.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select(columns)

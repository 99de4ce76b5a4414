"""Quality classifier by compression: two zstandard dictionaries, one of good and one of bad labelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, stage

#: Texts are compressed in pieces of so many bytes, each on its own, so that the dictionary and not the text's own history decides.
PIECE = 2048
LEVEL = 3
DICT_BYTES = 112_640


def pieces(text: str | None) -> list[bytes]:
    """The whole text, cut."""
    raw = (text or "").encode("utf-8", "replace")
    return [raw[k : k + PIECE] for k in range(0, len(raw), PIECE)]


def fit_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary. Where there are too few samples to train on, pieces drawn from them, up to its size."""
    samples = [p for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        drawn = [samples[k] for k in np.random.default_rng(1).permutation(len(samples))]
        fits = np.cumsum([len(p) for p in drawn]) <= DICT_BYTES
        return b"".join(p for p, ok in zip(drawn, fits, strict=True) if ok)


def sizer(good: bytes, bad: bytes):
    """A function from text to (bytes, compressed with the good dictionary, compressed with the bad one)."""

    def compressor(raw: bytes) -> zstandard.ZstdCompressor:
        kind = zstandard.DICT_TYPE_AUTO if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        d = zstandard.ZstdCompressionDict(raw, dict_type=kind)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)

    by_good, by_bad = compressor(good), compressor(bad)

    def sizes(text: str | None) -> tuple[int, int, int]:
        n = g = b = 0
        for p in pieces(text):
            n, g, b = n + len(p), g + len(by_good.compress(p)), b + len(by_bad.compress(p))
        return n, g, b

    return sizes


def features(sizes: np.ndarray) -> np.ndarray:
    """Of (bytes, good, bad): 1, and the difference of the compressed sizes for each byte of the text.

    It is positive where the good dictionary is the better one. Bytes of the text, not compressed ones, are the norm: text
    that repeats itself, which either dictionary shrinks to little, has then a small difference and no great one.
    """
    n, g, b = sizes.astype(float).T
    return np.stack([np.ones(len(n)), 10 * (b - g) / np.maximum(n, 1.0)], 1)


def calibrate(x: np.ndarray, y: np.ndarray, share: float, rounds: int = 60, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps. The rows are weighted to the share of good labels, so that the score is a probability."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -10, 10)
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, most_bytes: int = 64 << 20) -> tuple[pd.DataFrame, float]:
    """(text, y), and the share of good rows among all labelled ones, of labelled training rows, about `most` of each class, with about `most_bytes` of text, at most.

    Training rows are those whose crc32(doc_id as text) mod 3 is not 1; a document with several labels has the largest.
    The bounds are kept by a hash of the id: each class keeps the share most / (rows of the class), so the same rows come
    back each time, and of these ids in the order of the hash those before its bytes are used up. Texts are whole.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(crc_mod("doc_id", 3) != 1).groupBy("doc_id").agg(F.max("quality").alias("y"))
    n = {r["y"]: r["count"] for r in good.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, most / max(1, n.get(1, 0))).otherwise(most / max(1, n.get(0, 0)))
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 52))
    # About 2 * most rows, whatever the size of the tables: they are broadcast.
    chosen = good.withColumn("place", place).where(F.col("place") < share * (1 << 52))
    texts = docs.select("doc_id", "text").where("text IS NOT NULL AND text != ''")
    sample = stage(texts.join(F.broadcast(chosen), "doc_id"), "quality-sample")
    sizes = sample.select("doc_id", "y", "place", F.octet_length("text").alias("size")).toPandas().sort_values(["y", "place", "doc_id"], kind="stable")
    before = sizes.groupby("y")["size"].cumsum() - sizes["size"]
    kept = sizes[before < most_bytes].drop_duplicates("doc_id")
    ids = docs.sparkSession.createDataFrame(list(zip(kept["doc_id"].tolist(), kept["y"].tolist(), strict=True)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int")
    rows = sample.drop("y").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y").toPandas().sort_values("doc_id", kind="stable")
    return rows, n.get(1, 0) / max(1, sum(n.values())) if n else 0.5


def fit(docs: DataFrame, labels: DataFrame, most: int = 2500, most_bytes: int = 64 << 20) -> dict:
    """Dictionaries from three quarters of the labelled sample, calibration on the rest.

    `most` bounds the labelled rows of each class that are gathered to the driver, `most_bytes` their text. Without rows of both classes the score
    is the share of good rows (0.5 without any).
    """
    rows, share = labelled_sample(docs, labels, most, most_bytes)
    y = rows["y"].to_numpy(int) if len(rows) else np.zeros(0, int)
    rest = np.arange(len(rows)) % 4 == 3
    a, b = (rows["text"][~rest & (y == c)].tolist() if len(rows) else [] for c in (1, 0))
    if not a or not b:
        return {"prior": share}
    good, bad = fit_dictionary(a), fit_dictionary(b)
    held = rows[rest] if len(set(y[rest])) == 2 else rows
    sizes = sizer(good, bad)
    x = features(np.array([sizes(t) for t in held["text"]]))
    keep = held["y"].to_numpy(int)
    w = calibrate(x, keep, share)
    scores = np.sort((1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))[keep == 1])
    return {"good": good, "bad": bad, "w": w, "keep_from": float(scores[int(0.005 * len(scores))])}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bytes, good_bytes, bad_bytes, score) for each row of docs.

    Null and empty texts compress to nothing and get the score at difference 0. Texts of any length are read whole, piece
    by piece. Repeated rows and null ids keep their rows. An empty table gives an empty result. Other columns are not read,
    so their names clash with nothing.
    """

    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICT_BYTES

    def run(batches):
        model = shared.value
        sizes = sizer(model["good"], model["bad"]) if "w" in model else None
        for b in batches:
            s = np.array([sizes(t) if sizes else (len((t or "").encode("utf-8", "replace")), 0, 0) for t in b["t"]]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(features(s) @ model["w"], -30, 30))) if sizes else np.full(len(s), model["prior"])
            yield pd.DataFrame({"id": b["id"], "bytes": s[:, 0], "good_bytes": s[:, 1], "bad_bytes": s[:, 2], "score": p})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "id long, bytes long, good_bytes long, bad_bytes long, score double")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """score over all documents; those whose crc32(doc_id as text) mod 3 is 1 are held out. A null id is not."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "bytes", "good_bytes", "bad_bytes")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go. The cut keeps 99.5 % of the good calibration rows, and never exceeds 0.5.

    Each row is judged by its own text, so repeated rows and null ids stay or go with it; a null text counts as empty.
    Without labels of both classes every row stays. An empty table gives an empty result.
    """
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if "w" not in model:
        return docs
    cut = min(0.5, model["keep_from"])
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of DICT_BYTES

    @F.arrow_udf("double")
    def quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        sizes = sizer(m["good"], m["bad"])
        for texts in batches:  # one text at a time is a Python object
            x = features(np.array([sizes(t.as_py()) for t in texts]).reshape(-1, 3))
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ m["w"], -30, 30))))

    return docs.where(quality(F.col("text")) >= cut).select(docs.columns)

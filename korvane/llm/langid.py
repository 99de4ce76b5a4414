"""Language identification: averaged hashed subword embeddings with a linear softmax."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod

BUCKETS, DIM, SIZES = 1 << 16, 16, (2, 3, 4, 5)
#: ASCII letters are lower-cased, other ASCII bytes part words, all other bytes stay.
TO_WORDS = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32) for c in range(256))
LETTER = r"\p{L}"
NONE = "und"
#: Words whose sums a worker keeps.
KEPT_WORDS = 200_000
#: Numbers that summing a part of the unseen words takes at once: some for each subword, and one for each language.
AT_ONCE = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TO_WORDS).split()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of the word) of every byte n-gram of <word>, for all words at once."""
    line = b"".join(b"<" + w + b">" for w in words)
    raw = np.frombuffer(line, np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
    h, buckets, owners = np.full(len(raw), 14695981039346656037, np.uint64), [], []
    for n in range(1, max(SIZES) + 1):
        m = len(raw) - n + 1
        if m <= 0:
            break
        h = (h[:m] ^ raw[n - 1 :]) * np.uint64(1099511628211)
        if n in SIZES:
            ok = left[:m] >= n
            x = h[ok]
            buckets.append(((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[:m][ok])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def labelled_sample(docs: DataFrame, most: int, most_bytes: int, total_bytes: int = 256 << 20, most_langs: int = 1000) -> pd.DataFrame:
    """(text, lang) of documents whose crc32(doc_id as text) mod 4 is not 2.

    Of each of the `most_langs` most frequent languages about `most` rows, and `most_bytes` or its even share of `total_bytes`
    of text, at most. The bounds are kept by a hash of the id, and texts are whole. Rare languages are learnt from all their rows.
    """
    rows = docs.select("doc_id", "text", "lang").where("doc_id IS NOT NULL AND text IS NOT NULL AND text != '' AND lang IS NOT NULL").where(crc_mod("doc_id", 4) != 2)
    held = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).orderBy(F.desc("n"), "lang").limit(most_langs).toPandas()
    each = float(min(most_bytes, total_bytes / max(1, len(held))))
    shares = [(x, float(min(most / n, each / size))) for x, n, size in zip(held["lang"], held["n"], held["size"], strict=True)]
    share = docs.sparkSession.createDataFrame(shares, f"lang {rows.schema['lang'].dataType.simpleString()}, share double")
    # At most most_langs rows, for each of which the model holds BUCKETS numbers; the hash keeps about `most` rows of each.
    chosen = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 52)) < F.col("share") * (1 << 52))
    return chosen.select("doc_id", "text", "lang").toPandas().sort_values("doc_id", kind="stable")


def train(samples: list[tuple[list[bytes], int]], classes: int, epochs: int = 3, rate: float = 0.3, seed: int = 1, span: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent, one span of a text at a time. Spans have 2 to `span` words, so that short texts are learnt too."""
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    w, b = np.zeros((DIM, classes)), np.zeros(classes)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            words, y = samples[k]
            n = int(min(len(words), rng.integers(2, span + 1)))
            at = int(rng.integers(0, len(words) - n + 1))
            grams, _ = subwords(words[at : at + n])
            step, done = rate * (1 - done / steps), done + 1
            ids, counts = np.unique(grams, return_counts=True)
            share = counts / len(grams)
            mean = share @ e[ids]
            z = mean @ w + b
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y] -= 1
            back = w @ g
            w -= step * np.outer(mean, g)
            b -= step * g
            e[ids] -= step * len(ids) ** 0.5 * share[:, None] * back[None, :]
    return e, w, b


def fit(docs: DataFrame, most: int = 800, reject: float = 0.5, most_bytes: int = 8 << 20, total_bytes: int = 256 << 20, most_langs: int = 1000, span: int = 60) -> dict:
    """Train on four fifths of the labelled sample; the temperature comes from the rest.

    Whole texts are calibrated, as whole texts are scored. `most` and `most_bytes` bound what of each language is gathered
    to the driver, `total_bytes` what of all, and `most_langs` how many languages are learnt, the most frequent first. A
    step of training reads a random span of a text, of `span` words at most. The temperature makes the scores probabilities, so that a document under `reject` is one whose language
    is more likely wrong than right. A language's first four rows are always trained on.
    """
    rows = labelled_sample(docs, most, most_bytes, total_bytes, most_langs)
    langs = sorted(rows["lang"].unique().tolist())
    index = {x: k for k, x in enumerate(langs)}
    all_of = [(words_of(t), index[x], t) for t, x in zip(rows["text"], rows["lang"], strict=True)]
    all_of = [x for x in all_of if x[0]]
    if not all_of:
        return {"langs": langs, "scores": np.zeros((BUCKETS, len(langs)), np.float32), "bias": np.zeros(len(langs)), "heat": 1.0, "reject": 0.0}
    seen, held, kept = Counter(), [], []
    for x in all_of:
        seen[x[1]] += 1
        (kept if seen[x[1]] % 5 else held).append(x)
    held = held or kept
    e, w, b = train([x[:2] for x in kept], len(langs), span=span)
    model = {"langs": langs, "scores": (e @ w).astype(np.float32), "bias": b, "heat": 1.0, "reject": reject}
    logits = logits_of(pa.array([t for _, _, t in held], pa.string()), model, Sums(model))
    y = np.array([k for _, k, _ in held])
    grid = 2.0 ** np.arange(-4, 4.25, 0.25)
    model["heat"] = float(min(grid, key=lambda h: -np.log(np.maximum(softmax(logits / h)[np.arange(len(y)), y], 1e-9)).mean()))
    return model


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


class Sums(dict):
    """word -> row of the table of sums over its subwords; unseen words queue up and are summed in parts, a very long word alone."""

    def __init__(self, model: dict):
        self.model, self.rows, self.new = model, np.zeros((0, len(model["langs"]) + 1)), []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = at = len(self.rows) + len(self.new) - 1
        return at

    def table(self) -> np.ndarray:
        if self.new:
            self.rows, self.new = np.concatenate([self.rows, *map(self.sums_of, self.parts())]), []
        return self.rows

    def parts(self) -> Iterator[list[bytes]]:
        """The queued words, about AT_ONCE numbers at a time."""
        most = AT_ONCE // (len(SIZES) * (len(self.model["langs"]) + 2))
        ends = np.cumsum(np.fromiter(map(len, self.new), np.int64, len(self.new)) + 2)
        for start, stop in stretches(ends, most):
            yield self.new[start:stop]

    def sums_of(self, words: list[bytes]) -> np.ndarray:
        grams, owner = subwords(words)
        return np.stack([np.bincount(owner, s, len(words)) for s in (*self.model["scores"][grams].T, None)], 1)


def logits_of(texts: pa.Array, model: dict, sums: Sums) -> np.ndarray:
    """A row of logits for each whole text. Each distinct word of a slice is looked up once."""
    texts = texts.cast(pa.string())
    totals = np.zeros((len(texts), len(model["langs"]) + 1))
    for start, stop in slices(texts):
        add_up(pc.fill_null(texts.slice(start, stop - start), ""), sums, totals[start:stop])
        if len(sums) > KEPT_WORDS:
            sums.clear()
            sums.rows = sums.rows[:0].copy()  # a view would keep the table
    return totals[:, :-1] / np.maximum(totals[:, -1:], 1) + model["bias"]


def add_up(texts: pa.Array, sums: Sums, totals: np.ndarray) -> None:
    """Put the sums over each text's words into totals. What this takes is freed before the next slice."""
    lists = pc.ascii_split_whitespace(plain(texts))
    words = lists.flatten().cast(pa.binary()).dictionary_encode()
    if not len(words):
        return
    distinct = words.dictionary.to_pylist()
    at = np.fromiter(map(sums.__getitem__, distinct), np.int64, len(distinct))
    which = words.indices.to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    table = sums.table()[at]
    table[[not w for w in distinct]] = 0  # white space at either end of a text gives an empty word
    for c in range(table.shape[1]):
        totals[:, c] = np.bincount(owner, table[which, c], len(sizes))


def plain(texts: pa.Array) -> pa.Array:
    """The texts under TO_WORDS. Only the bytes of this slice are copied, not those of the batch it lies in."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset) if offsets and len(texts) else np.zeros(len(texts) + 1, np.int32)
    raw = memoryview(data)[ends[0] : ends[-1]].tobytes() if data else b""
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(raw.translate(TO_WORDS))])


def slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about `most` bytes; a longer text is one of its own."""
    return stretches(np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)), most)


def stretches(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of stretches of items of `most` together, or of one larger item; ends: the running sums of their sizes."""
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield start, stop
        start = stop


def predict_batch(texts: pa.Array, model: dict, sums: Sums) -> tuple[np.ndarray, np.ndarray]:
    """The language and calibrated score of each whole text. `und`, score 0: null, or without a letter."""
    if not model["langs"]:
        return np.full(len(texts), NONE, object), np.zeros(len(texts))
    p = softmax(logits_of(texts, model, sums) / model["heat"])
    known = with_letter(texts)
    pa.default_memory_pool().release_unused()  # else the worker holds what its largest slice took, in later stages too
    return np.where(known, np.array(model["langs"], object)[p.argmax(1)], NONE), np.where(known, p.max(1), 0.0)


def with_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, LETTER), False).to_numpy(zero_copy_only=False)


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) for each row of docs; accepted is false for `und` and below the rejection score.

    Null texts and texts without a letter: `und`, 0. Repeated rows and null ids keep their rows. An empty table gives an
    empty result. Other columns, a language label among them, are never read, so their names clash with nothing.
    """

    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        sums = Sums(model)
        for b in batches:
            lang, p = predict_batch(b.column("t"), model, sums)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(lang, pa.string()), pa.array(p), pa.array((lang != NONE) & (p >= model["reject"]), pa.bool_())], ["id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double, accepted boolean")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """predict over all documents; those whose crc32(doc_id as text) mod 4 is 2 are held out. A null id is not."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs, fit(docs)).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language is rejected go.

    Those are the ones under the rejection score, and null texts and texts without a letter. Each row is judged by its own
    text, so repeated rows and null ids stay or go with it. Where no language can be learnt, only texts without a letter
    go. An empty table gives an empty result.
    """
    model = fit(docs)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    @F.arrow_udf("boolean")
    def accepted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        sums = Sums(model)
        for texts in batches:
            if model["langs"]:
                lang, p = predict_batch(texts, model, sums)
                yield pa.array((lang != NONE) & (p >= model["reject"]), pa.bool_())
            else:
                yield pa.array(with_letter(texts), pa.bool_())

    return docs.where(accepted(F.col("text"))).select(docs.columns)

"""A byte-level language model by context-tree weighting.

A byte is eight binary decisions; each of the 255 places in the tree of a byte's leading bits has a context tree of its
own over the bytes before. A node mixes its Krichevsky-Trofimov estimate with what its children say, half and half a
priori; the weights that the training text gives the two sides are exact.

How the work is dealt out: rows are packed into blocks of some megabytes. A block counts its (DEPTH + 1)-grams and sends
them, once each, to the part that holds their three latest context bytes, so each subtree from depth three on lies in
one part, and the grams after a frequent pair of bytes are spread over many. The parts' sums for the nodes of depth two
(one for each pair of bytes and leading bits that occurs, at most 256 * 256 * 255 whatever the corpus) go to the driver,
which weighs depths 0 to 2; the parts then answer each block's grams with their log probability. No other count passes
the driver, and the counts grow with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, crc_mod, stage

#: Bytes of context.
DEPTH = 5
#: Stands before, between and after texts, and for the end of a text; UTF-8 has no such byte.
END = 0xFF
BLOCK_BYTES, PART_BYTES, CHUNK_BYTES = 16 << 20, 32 << 20, 2 << 20
#: Texts of one chunk.
MOST_TEXTS = 65_000
#: Depth from which on a subtree lies in one part.
TOP = 3
HALF = np.log(0.5)


def lowered(text: str | None) -> bytes:
    """The bytes of the whole text, white space and all, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(LOWER)


# Sorted arrays as small blobs.


def squeeze(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x)
    return zstandard.ZstdCompressor(level=1).compress(raw.view(np.uint8).reshape(-1, raw.dtype.itemsize).T.tobytes())


def unsqueeze(raw: bytes, dtype) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(raw, np.uint64), dtype=np.uint64)


def sums_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts[order], starts)


# Grams of texts.


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(key, index of the text, first such index) at every byte and at the end of each text, some CHUNK_BYTES at a time.

    A key holds the context, latest byte first, then the byte. A long text is cut anywhere: contexts reach back over the
    cut. Indexes count from the first text of the chunk and stay below 2 ** 16.
    """
    gap = bytes([END]) * DEPTH
    raw = np.frombuffer(gap + b"".join(chain.from_iterable((t, gap) for t in texts)), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + DEPTH) - sizes
    at = DEPTH
    while at < len(raw):
        first = max(0, int(np.searchsorted(starts, at, "right")) - 1)
        end = min(at + CHUNK_BYTES, len(raw), *starts[first + MOST_TEXTS : first + MOST_TEXTS + 1].tolist())
        text = np.searchsorted(starts, np.arange(at, end), "right") - 1
        inside = np.arange(at, end) - starts[text] <= sizes[text]
        key = np.zeros(end - at, np.uint64)
        for back in range(1, DEPTH + 1):
            np.left_shift(key, np.uint64(8), out=key)
            key |= raw[at - back : end - back]
        np.left_shift(key, np.uint64(8), out=key)
        key |= raw[at:end]
        if inside.any():
            yield key[inside], text[inside] - first, first
        at = end


def count_grams(texts: list[bytes], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all texts, and how often each is in the training ones."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for key, text, first in grams(texts):
        key = np.sort(key << np.uint64(1) | train[first:].astype(np.uint64)[text])
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.diff(np.append(starts, len(key)))
        key = key[starts]
        more = np.where(key & np.uint64(1), n, 0)
        keys, counts = sums_by(np.concatenate([keys, key >> np.uint64(1)]), np.concatenate([counts, more]))
    return keys, counts


# The tree.

_small = np.arange(1 << 16, dtype=float)
#: log gamma of n + 1/2 and of n + 1 for small n.
_LG_HALF = np.concatenate(([0.5 * np.log(np.pi)], 0.5 * np.log(np.pi) + np.cumsum(np.log(_small[:-1] + 0.5))))
_LG_ONE = np.concatenate(([0.0], np.cumsum(np.log(_small[1:]))))


def log_gamma(n: np.ndarray, table: np.ndarray, add: float) -> np.ndarray:
    if not len(n) or n.max() < len(table):
        return table[n]
    x = np.maximum(n, 1) + add
    return np.where(n < len(table), table[np.minimum(n, len(table) - 1)], (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x))


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence of n0 zeros and n1 ones."""
    return log_gamma(n0, _LG_HALF, 0.5) + log_gamma(n1, _LG_HALF, 0.5) - np.log(np.pi) - log_gamma(n0 + n1, _LG_ONE, 1.0)


class Tree:
    """The nodes of depth `top` to DEPTH above sorted distinct grams with positive counts.

    at[d][j]: of the nodes of depth d whose byte has j bits decided, in order: id (context, then those bits), the estimate
    of a one, the weight of that estimate against the children, and the log of the weighted probability.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, top: int):
        self.at: dict[int, list[tuple]] = {}
        self.totals: dict[int, list[tuple]] = {}
        for d in range(DEPTH, top - 1, -1):
            if d < DEPTH:
                keys, counts = sums_by(keys >> np.uint64(16) << np.uint64(8) | keys & np.uint64(255), counts)
            self.at[d], self.totals[d] = [], []
            for j in range(8):
                ids = keys >> np.uint64(8 - j)
                starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
                ids = ids[starts]
                ones = np.where(keys >> np.uint64(7 - j) & np.uint64(1), counts, 0)
                n = np.add.reduceat(counts, starts) if len(starts) else counts
                n1 = np.add.reduceat(ones, starts) if len(starts) else counts
                own = log_kt(n - n1, n1)
                weighted, weight = own, np.ones(len(ids))
                if d < DEPTH:
                    below, _, _, log_below = self.at[d + 1][j]
                    bits = np.uint64((1 << j) - 1)
                    parent = np.searchsorted(ids, below >> np.uint64(j + 8) << np.uint64(j) | below & bits)
                    weighted = np.logaddexp(HALF + own, HALF + np.bincount(parent, log_below, len(ids)))
                    weight = np.exp(HALF + own - weighted)
                self.at[d].append((ids, (n1 + 0.5) / (n + 1), weight, weighted))
                self.totals[d].append((n - n1, n1))

    def ones(self, keys: np.ndarray, j: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The mixed probability that bit j is one, by nodes of depth `top` and deeper, and where there is such a node.

        A context that the training text never showed has no node: the path ends at the last one seen.
        """
        p, seen = np.zeros(len(keys)), np.zeros(len(keys), bool)
        bits = (keys & np.uint64(255)) >> np.uint64(8 - j)
        for d in range(DEPTH, top - 1, -1):
            ids, kt, weight, _ = self.at[d][j]
            if not len(ids):
                continue
            wanted = keys >> np.uint64(8 * (DEPTH - d + 1)) << np.uint64(j) | bits
            k = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            found = ids[k] == wanted
            p = np.where(found, np.where(seen, weight[k] * kt[k] + (1 - weight[k]) * p, kt[k]), p)
            seen = found
        return p, seen


def upper(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """Depths 0 to 2, from the sums of depth 2 (node = two latest bytes and leading bits, n0, n1, log probability below).

    The probability of a one is a + b * (what depth two says), or `end` where no such node is; depth two says
    w2 * kt2 + (1 - w2) * (what depth three says), or kt2 where nothing deeper was seen.
    """

    def weigh(n0, n1, below):
        own = log_kt(n0, n1)
        weighted = np.logaddexp(HALF + own, HALF + below)
        return (n1 + 0.5) / (n0 + n1 + 1), np.exp(HALF + own - weighted), weighted

    nodes = nodes.sort_values("node")
    node, n0, n1 = (nodes[c].to_numpy(np.int64) for c in ("node", "n0", "n1"))
    kt2, w2, log2 = weigh(n0, n1, nodes["below"].to_numpy(float))
    parent = node >> 16 << 8 | node & 255
    n0, n1, below = (np.bincount(parent, x, 1 << 16) for x in (n0, n1, log2))
    n0, n1 = n0.astype(np.int64), n1.astype(np.int64)
    kt1, w1, log1 = weigh(n0, n1, below)
    seen = n0 + n1 > 0
    log1 = np.where(seen, log1, 0.0)
    kt0, w0, _ = (np.tile(x, 256) for x in weigh(n0.reshape(256, 256).sum(0), n1.reshape(256, 256).sum(0), log1.reshape(256, 256).sum(0)))
    return {
        "node": node.astype(np.uint64),
        "kt2": kt2,
        "w2": w2,
        "a": np.where(seen, w0 * kt0 + (1 - w0) * w1 * kt1, kt0),
        "b": np.where(seen, (1 - w0) * (1 - w1), 0.0),
        "end": np.where(seen, w0 * kt0 + (1 - w0) * kt1, kt0),
    }


def log10_of(keys: np.ndarray, tree: Tree, above: dict[str, np.ndarray]) -> np.ndarray:
    """Log10 of the model's probability of each gram's byte after its context."""
    total = np.zeros(len(keys))
    pair = keys >> np.uint64(8 * (DEPTH - 1)) << np.uint64(8)
    latest = (keys >> np.uint64(8 * DEPTH)).astype(np.int64) * 256
    byte = (keys & np.uint64(255)).astype(np.int64)
    nodes = above["node"]
    for j in range(8):
        p, deeper = tree.ones(keys, j, TOP)
        bits = 1 << j | byte >> (8 - j)
        if len(nodes):
            wanted = pair | bits.astype(np.uint64)
            k = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
            seen = nodes[k] == wanted
            p = np.where(deeper, above["w2"][k] * above["kt2"][k] + (1 - above["w2"][k]) * p, above["kt2"][k])
        else:
            seen = np.zeros(len(keys), bool)
        at = latest + bits
        p = np.where(seen, above["a"][at] + above["b"][at] * p, above["end"][at])
        total += np.log10(np.where(byte >> (7 - j) & 1, p, 1 - p))
    return total


# The jobs.


def packed_blocks(docs: DataFrame, blocks: int, id_col: str, text_col: str, held_out) -> DataFrame:
    """Rows of docs in turn to the blocks, some hundreds packed together: (block, ids, train, sizes, payload)."""

    def run(batches):
        pack, k = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() * 7919
        for b in batches:
            texts = [lowered(t) for t in b["t"]]
            ids = [None if pd.isna(i) else int(i) for i in b["id"]]
            train = (~b["held"].astype(bool)).tolist()
            rows = []
            for block in range(min(blocks, len(texts))):
                own = range(block, len(texts), blocks)
                rows.append(((k + block) % blocks, [ids[x] for x in own], [train[x] for x in own], [len(texts[x]) for x in own], pack.compress(b"".join(texts[x] for x in own))))
            k += len(texts)
            yield pd.DataFrame(rows, columns=["block", "ids", "train", "sizes", "payload"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "block int, ids array<long>, train array<boolean>, sizes array<int>, payload binary")


def unpack(pdf: pd.DataFrame) -> tuple[list, np.ndarray, list[bytes]]:
    ids, train, texts = [], [], []
    for i, t, sizes, raw in zip(pdf["ids"], pdf["train"], pdf["sizes"], pdf["payload"], strict=True):
        ids += list(i)
        train += list(t)
        raw, at = zstandard.decompress(raw), 0
        for n in sizes:
            texts.append(raw[at : at + n])
            at += n
    return ids, np.array(train, bool), texts


def word_parts(words, parts: int) -> dict[int, list[bytes]]:
    from zlib import crc32

    out: dict[int, list[bytes]] = {}
    for w in words:
        out.setdefault(crc32(w) % parts, []).append(w)
    return out


def gathered(packs: DataFrame, parts: int) -> DataFrame:
    """(block, part, kind, keys, counts): each block's distinct grams (kind 0) and words (kind 1) with their training counts."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, train, texts = unpack(pdf)
        known, every = Counter(), set()
        for t, own in zip(texts, train, strict=True):
            known.update(t.split()) if own else every.update(t.split())
        rows = []
        for part, words in word_parts(every.union(known), parts).items():
            rows.append((key[0], part, 1, zstandard.compress(b"\n".join(words), 3), squeeze(np.array([known[w] for w in words], np.uint64))))
        del known, every
        keys, counts = count_grams(texts, train)
        part = ((keys >> np.uint64(8 * (DEPTH + 1 - TOP))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            own = order[cuts[p] : cuts[p + 1]]
            rows.append((key[0], p, 0, squeeze_sorted(keys[own]), squeeze(counts[own].astype(np.uint64))))
        return pd.DataFrame(rows, columns=["block", "part", "kind", "keys", "counts"])

    return packs.groupBy("block").applyInPandas(run, "block int, part int, kind int, keys binary, counts binary")


def merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[int]]:
    """All grams of a part with their counts, and each block's own keys."""
    own = [unsqueeze_sorted(raw) for raw in pdf["keys"]]
    keys, counts = sums_by(np.concatenate([np.zeros(0, np.uint64), *own]), np.concatenate([np.zeros(0, np.uint64), *[unsqueeze(raw, np.uint64) for raw in pdf["counts"]]]).astype(np.int64))
    return keys, counts, own, pdf["block"].tolist()


def word_totals(pdf: pd.DataFrame) -> tuple[Counter, list[list[bytes]]]:
    total, own = Counter(), []
    for raw, n in zip(pdf["keys"], pdf["counts"], strict=True):
        own.append(zstandard.decompress(raw).split(b"\n"))
        for w, c in zip(own[-1], unsqueeze(n, np.uint64).tolist(), strict=True):
            total[w] += c
    return total, own


def sums_of_part(pdf: pd.DataFrame) -> pd.DataFrame:
    """What the driver needs of a part: the sums of depth 2 (kind 0); of words (kind 1) tokens and distinct words."""
    kind = int(pdf["kind"].iloc[0])
    if kind == 1:
        counts = np.fromiter(word_totals(pdf)[0].values(), np.int64)
        return pd.DataFrame({"kind": [1], "node": [0], "n0": [int(counts.sum())], "n1": [int((counts > 0).sum())], "below": [0.0]})
    keys, counts, _, _ = merged(pdf)
    keys, counts = keys[counts > 0], counts[counts > 0]
    tree, out = Tree(keys, counts, TOP), []
    for j in range(8):
        ids, _, _, log_below = tree.at[TOP][j]
        n0, n1 = tree.totals[TOP][j]
        node = (ids >> np.uint64(j + 8)).astype(np.int64) << 8 | (1 << j | (ids & np.uint64((1 << j) - 1)).astype(np.int64))
        distinct, at = np.unique(node, return_inverse=True)
        out.append(pd.DataFrame({"kind": 0, "node": distinct, "n0": np.bincount(at, n0, len(distinct)).astype(np.int64), "n1": np.bincount(at, n1, len(distinct)).astype(np.int64), "below": np.bincount(at, log_below, len(distinct))}))
    return pd.concat(out)


def answers(table: DataFrame, above) -> DataFrame:
    """(block, kind, keys, values): each block's grams with their log10 probability, and words with their training counts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if int(pdf["kind"].iloc[0]) == 1:
            total, own = word_totals(pdf)
            for block, raw, words in zip(pdf["block"], pdf["keys"], own, strict=True):
                rows.append((block, 1, raw, squeeze(np.array([total[w] for w in words], np.uint64))))
        else:
            keys, counts, own, blocks = merged(pdf)
            held = counts > 0
            value = log10_of(keys, Tree(keys[held], counts[held], TOP), above.value)
            for block, raw, k in zip(blocks, pdf["keys"], own, strict=True):
                rows.append((block, 0, raw, squeeze(value[np.searchsorted(keys, k)])))
        return pd.DataFrame(rows, columns=["block", "kind", "keys", "values"])

    return table.groupBy("part", "kind").applyInPandas(run, "block int, kind int, keys binary, values binary")


def scored(packs: DataFrame, replies: DataFrame, tokens: int, distinct: int, ends: int) -> DataFrame:
    floor = tokens + 0.5 * (distinct + 1)

    def run(pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        ids, train, texts = unpack(pdf)
        unknown, end = float(np.log10(0.5 / floor)), float(np.log10((ends + 0.5) / floor))
        words, keys, values = {}, [np.zeros(0, np.uint64)], [np.zeros(0)]
        for kind, raw, v in zip(got["kind"], got["keys"], got["values"], strict=True):
            if kind == 1:
                n = unsqueeze(v, np.uint64)
                words.update(zip(zstandard.decompress(raw).split(b"\n"), np.where(n > 0, np.log10((n + 0.5) / floor), unknown).tolist(), strict=True))
            else:
                keys.append(unsqueeze_sorted(raw))
                values.append(unsqueeze(v, np.float64))
        keys, values = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        total = np.zeros(len(texts))
        for key, text, first in grams(texts):
            both = np.sort(key << np.uint64(16) | text.astype(np.uint64))
            key = both >> np.uint64(16)
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            value = np.repeat(values[np.searchsorted(keys, key[starts])], np.diff(np.append(starts, len(key))))
            sums = np.bincount((both & np.uint64(0xFFFF)).astype(np.int64), value)
            total[first : first + len(sums)] += sums
        rows = []
        for i, own, t, s in zip(ids, train.tolist(), texts, total.tolist(), strict=True):
            logs = list(map(words.__getitem__, t.split()))
            rows.append((i, not own, len(logs) + 1, len(logs) - logs.count(unknown) + (ends > 0), tokens, sum(logs) + end, s, len(t)))
        return pd.DataFrame(rows, columns=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]).astype({"id": "Int64"})

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    return packs.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(run, schema)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
    """Train on the rows that are not held out and score all rows.

    Returns (id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes): score is the log10 probability
    of the text's bytes as they stand, white space too, A-Z lower-cased, and of its end; -score / log10(2) / (n_bytes + 1)
    is the code length per byte. base_score is that of single words, as smoothed counts. Null and blank texts are an end
    alone. held_out is a condition (null: none, and a null value is false); repeated rows count and are scored as often
    as they occur. Without training rows every bit has probability one half. An empty table gives an empty result.
    """
    held = F.lit(False) if held_out is None else held_out
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)), F.count(F.when(~F.coalesce(held, F.lit(False)), 1))).first()
    blocks, parts = max(1, -(-int(size[0]) // BLOCK_BYTES)), max(4, -(-int(size[0]) // PART_BYTES))
    packs = stage(packed_blocks(docs, blocks, id_col, text_col, held), "ctw-packs")
    table = stage(gathered(packs, parts), "ctw-grams")
    sums = table.groupBy("part", "kind").applyInPandas(sums_of_part, "kind int, node int, n0 long, n1 long, below double")
    nodes = sums.groupBy("kind", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).toPandas()
    words = nodes[nodes["kind"] == 1]
    above = docs.sparkSession.sparkContext.broadcast(upper(nodes[nodes["kind"] == 0]))  # 256 * 256 * 255 nodes at most
    ends = int(size[1])
    return scored(packs, answers(table, above), int(words["n0"].sum()) + ends, int(words["n1"].sum()) + (ends > 0), ends)


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """score_texts over all documents; those whose crc32(doc_id as text) mod 5 is 1 are held out. A null id is not."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs, held_out=crc_mod("doc_id", 5) == 1).withColumnRenamed("id", "doc_id")

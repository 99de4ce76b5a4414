"""Packing documents into training windows with the lexical neighbours of a seed document."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

WINDOW = 4096
END = 2
K1, B = 1.2, 0.75
#: Documents and tokens of one shard of the index; a shard ends at whichever comes first.
SHARD_DOCS, SHARD_TOKENS = 512, 2_000_000
#: Tokens of one task.
TASK_TOKENS = 3_000_000
#: Neighbours in rank order among which whole ones are sought before one is cut.
LOOK = 64
#: Most words, pieces of words and bytes of words that a worker keeps between two slices of texts.
KEPT_WORDS, KEPT_PIECES, KEPT_BYTES = 600_000, 300_000, 64 << 20

#: What the table of words assumes of a tokenizer; others encode texts themselves.
ASSUMED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}
#: Words of the letters of Latin-1 and Latin Extended-A, in which the tokenizer's normalisation does no more than lower-case.
#: Left out are the letter that becomes two when lower-cased, and white space beyond ASCII.
LATIN = re.compile("[!-~\u00a1-\u012f\u0131-\u017f]+")
#: How the tokenizer parts such a word once it is in lower case.
_L, _N = "a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_L}{_N}]+")
#: Byte-level BPE writes each byte as a character: printable ones as they are, the others from 256 on.
_printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
_others = [b for b in range(256) if b not in _printable]
BYTE_CHARS = {b: chr(b) for b in _printable} | {b: chr(256 + k) for k, b in enumerate(_others)}
AS_CHARS = str.maketrans({chr(b): c for b, c in BYTE_CHARS.items()})
_tables: dict[str, Words] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Words:
    """Ids of texts by a tokenizer file, from a table of words without white space, A-Z lower-cased, and their ids.

    This holds for tokenizers of the kind ASSUMED describes: they drop white space and never join what they part, so a
    text's ids are its words' ids in turn. Words of Latin letters are parted here, and only their pieces go to the
    tokenizer's model; all others go to it whole. Tokenizers of any other kind encode whole texts, without the table.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        self.whole = Tokenizer.from_file(path)
        self.model, self.pieces = self.whole.model, {}
        config = json.loads(self.whole.to_str())
        added = [t["content"] for t in config["added_tokens"]]
        self.plain = all(config[k] == v for k, v in ASSUMED.items()) and config["model"]["type"] == "BPE" and not config["model"].get("dropout") and all(t.startswith("<|") for t in added)
        self.size = max([END, *self.whole.get_vocab(with_added_tokens=True).values()]) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        #: The table: words, the ids of all of them end to end, how many each has, and how often it was met.
        self.known, self.flat, self.sizes, self.met = pa.array([], pa.string()), np.zeros(0, self.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids_of(self, word: str) -> bytes:
        """A word's ids as little-endian numbers."""
        plain = word.isascii() and word.isprintable()
        if plain and word.isalpha():
            return self.pieces.get(word) or self.piece(word)
        if (plain or LATIN.fullmatch(word)) and "<|" not in word:
            return b"".join([self.pieces.get(p) or self.piece(p) for p in PIECES.findall(word.lower())])
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()

    def piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(AS_CHARS))]
        self.pieces[piece] = found = np.array(ids, self.dtype).tobytes()
        return found

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids end. Words are numbered behind the table's own, and only those it lacks are encoded."""
        if not self.plain:
            lists = [self.whole.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, self.dtype), *[np.array(x, self.dtype) for x in lists]]), np.cumsum([len(x) for x in lists], dtype=np.int64)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words = lists.flatten()
        if not len(words):
            return np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        words = pa.chunked_array([self.known.cast(words.type), words]).dictionary_encode().chunks[-1]
        which, known = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        new = [self.ids_of(w) for w in known[len(self.known) :].to_pylist()]
        sizes = np.concatenate([self.sizes, np.fromiter(map(len, new), np.int64, len(new)) // self.dtype.itemsize])
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(new), self.dtype)])
        met = np.bincount(which, minlength=len(known))
        met[: len(self.met)] += self.met
        self.known, self.flat, self.sizes, self.met = known, flat, sizes, met
        n = sizes[which]
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = flat[spans((np.cumsum(sizes) - sizes)[which], n)]
        offsets = lists.offsets.to_numpy()
        self.forget()
        return ids, ends[offsets[1:] - offsets[0]]

    def forget(self) -> None:
        """Keep the table within its bounds: counts of how often words were met are halved, and words whose count ends go."""
        if len(self.pieces) > KEPT_PIECES:
            self.pieces.clear()
        while len(self.known) > KEPT_WORDS or self.known.nbytes + self.flat.nbytes > KEPT_BYTES and len(self.known):
            self.met >>= 1
            stay = self.met > 0
            self.known, self.flat = self.known.filter(pa.array(stay)), self.flat[np.repeat(stay, self.sizes)]
            self.sizes, self.met = self.sizes[stay], self.met[stay]


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... to sizes[0] numbers, then the same of starts[1], and so on."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    kind = np.int32 if ends[-1] + starts.max() < 1 << 31 else np.int64  # half the memory, where it will do
    at = np.repeat((starts - ends + sizes).astype(kind), sizes)
    at += np.arange(len(at), dtype=kind)
    return at


def distinct_of(ids: np.ndarray) -> np.ndarray:
    """The distinct ids of some, ascending. Sorting numbers this short takes less time than np.unique's hash table."""
    ids = np.sort(ids)
    return ids[np.concatenate(([True], ids[1:] != ids[:-1]))]


def words_table(path: str | None) -> Words:
    """One table for each tokenizer in a worker."""
    path = path or tokenizer_path()
    if path not in _tables:
        _tables[path] = Words(path)
    return _tables[path]


def weights(salt: int, size: int) -> np.ndarray:
    """A number for each id whose minimum over a set is a weighted minimum hash. Later ids of a BPE vocabulary are rarer and weigh more."""
    t = np.arange(size, dtype=np.uint64)
    h = (t + np.uint64(1)) * np.uint64(salt)
    h ^= h >> np.uint64(29)
    u = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(11)).astype(float) / (1 << 53)
    return -np.log(u + 1e-18) / (t + np.uint64(64)).astype(float)


#: Rows of the tokenized table: what is left of a document to be packed, a task's document frequencies, full windows of a document.
REST, COUNTS, FULL = 0, 1, 2


def tokenized(docs: DataFrame, id_col: str, text_col: str, path: str | None, window: int) -> DataFrame:
    """The rows of all documents: (kind, uid, id, n, skip, s1, s2, ids), n being a document's tokens and ids compressed.

    A document of a window or more is cut into full windows where it is read (FULL: its first ids, s1 the task's number of
    the first window). What is left, less than a window, is REST: skip ids come before it, s1 and s2 are its signatures.
    Each task gives one row of COUNTS: n documents with a rest, of skip tokens together, and how many of them hold each token.
    """
    schema = pa.schema([("kind", pa.int32()), ("uid", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("skip", pa.int64()), ("s1", pa.int32()), ("s2", pa.int32()), ("ids", pa.binary())])

    def run(batches):
        words, pack, part = words_table(path), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId()
        hashes = [weights(salt, words.size) for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
        end, df, k, sequence, rests, tokens = np.array([END], words.dtype), np.zeros(words.size, np.uint32), 0, 0, 0, 0
        for b in batches:
            for some in slices(b):
                ids, ends = words.encode_all(some.column(1))
                rows, start = [], 0
                for i, stop in zip(some.column(0).to_pylist(), ends.tolist(), strict=True):
                    own = np.concatenate([ids[start:stop], end])
                    uid, full = part << 36 | k, len(own) // window * window
                    if full:
                        rows.append((FULL, uid, i, len(own), 0, sequence, 0, pack.compress(own[:full].tobytes())))
                        sequence += full // window
                    if full < len(own):
                        distinct = distinct_of(own[full:])
                        df[distinct] += 1
                        rests, tokens = rests + 1, tokens + len(own) - full
                        s1, s2 = (int(distinct[h[distinct].argmin()]) for h in hashes)
                        rows.append((REST, uid, i, len(own), full, s1, s2, pack.compress(own[full:].tobytes())))
                    start, k = stop, k + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            pa.default_memory_pool().release_unused()  # else the worker holds what its largest slice took, in later stages too
        yield pa.RecordBatch.from_pylist([{"kind": COUNTS, "uid": part, "id": None, "n": rests, "skip": tokens, "s1": 0, "s2": 0, "ids": pack.compress(df.tobytes())}], schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "kind int, uid long, id long, n long, skip long, s1 int, s2 int, ids binary")


def slices(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about `most` bytes of text; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for k, n in enumerate(sizes.tolist()):
        if k > start and size + n > most:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += n
    if start < len(sizes):
        yield batch.slice(start)


def document_frequencies(table: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(rests holding each token, rests, their tokens) over the whole table. The vocabulary bounds what is collected."""

    def run(batches):
        for b in batches:
            for raw in b["ids"]:
                df = np.frombuffer(zstandard.decompress(raw), np.uint32)
                held = np.flatnonzero(df)
                yield pd.DataFrame({"token": held, "df": df[held].astype(np.int64)})

    counts = table.where(F.col("kind") == COUNTS)
    sums = counts.select("ids").mapInPandas(run, "token int, df long").groupBy("token").agg(F.sum("df").alias("df")).toPandas()
    all_of = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("docs"), F.coalesce(F.sum("skip"), F.lit(0)).alias("tokens")).first()
    df = np.zeros(size, np.int64)
    df[sums["token"]] = sums["df"]
    return df, int(all_of["docs"]), int(all_of["tokens"])


class Doc:
    """What is left of a document of n tokens: ids, of which `skip` come before; ids[start:] are not used up."""

    __slots__ = ("id", "ids", "n", "skip", "start", "terms", "tf", "uid")

    def __init__(self, uid: int, id, ids: np.ndarray, n: int | None = None, skip: int = 0):
        self.uid, self.id, self.ids, self.start, self.terms, self.tf = uid, id, ids, 0, None, None
        self.n, self.skip = len(ids) if n is None else n, skip

    def left(self) -> int:
        return len(self.ids) - self.start


class Index:
    """A BM25 inverted index of one shard; weights use the statistics of all documents."""

    def __init__(self, docs: list[Doc], idf: np.ndarray, mean: float):
        for d in docs:
            if d.terms is None:
                terms, counts = np.unique(d.ids, return_counts=True)
                told = idf[terms] > 0
                d.terms, d.tf = terms[told].astype(np.int64), counts[told].astype(np.float32)
        sizes = [len(d.terms) for d in docs]
        terms = np.concatenate([d.terms for d in docs])
        tf = np.concatenate([d.tf for d in docs])
        doc = np.repeat(np.arange(len(docs)), sizes)
        length = np.array([len(d.ids) for d in docs], np.float32)[doc]
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        order = np.argsort(terms, kind="stable")
        self.doc, self.weight, self.n = doc[order], weight[order], len(docs)
        self.starts = np.searchsorted(terms[order], np.arange(len(idf) + 1))

    def scores(self, terms: np.ndarray) -> np.ndarray:
        a, n = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill(docs: list[Doc], idf: np.ndarray, mean: float, last: bool, window: int = WINDOW) -> Iterator[list[tuple[Doc, int, int]]]:
    """Full windows of pieces (document, start, length) from one shard; what is left stays in the documents.

    A document of a window or more first gives windows of its own. Then the longest with anything left is the seed: its
    neighbours by BM25 follow in rank order, whole ones first; the best that does not fit is cut to fill the rest, and
    what is left of it waits, unused. The last call of a task also parts the remaining tokens into windows of powers of two.
    """
    for d in docs:
        while d.left() >= window:
            yield [(d, d.start, window)]
            d.start += window
    docs = [d for d in docs if d.left()]
    left = np.array([d.left() for d in docs], np.int64)
    total = int(left.sum())
    index = Index(docs, idf, mean) if total >= window else None
    order = np.argsort(-left, kind="stable").tolist()
    at = 0
    while total >= window:
        while not left[order[at]]:
            at += 1
        seed, room, pieces = order[at], window, []

        def put(k: int, n: int, pieces=pieces) -> None:
            d = docs[k]
            pieces.append((d, d.start, n))
            d.start += n
            left[k] -= n

        n = int(left[seed])
        room -= n
        put(seed, n)
        scores = np.where(left > 0, index.scores(docs[seed].terms), -1.0)
        near = np.argpartition(-scores, min(LOOK, len(docs) - 1))[:LOOK]
        near = near[np.lexsort((near, -scores[near]))]
        for k in near.tolist():
            if 0 < left[k] <= room:
                room -= (n := int(left[k]))
                put(k, n)
        while room:
            near = near[left[near] > 0]
            if not len(near):  # all looked at are used up: the next ones
                near = np.argsort(-np.where(left > 0, scores, -2.0), kind="stable")[: int((left > 0).sum())]
            k = int(near[0])
            room -= (n := min(room, int(left[k])))
            put(k, n)
        total -= window
        yield pieces
    if last:
        rest = [d for d in docs if d.left()]
        for bit in reversed(range(window.bit_length())):
            if total >> bit & 1:
                room, pieces = 1 << bit, []
                while room:
                    d = rest[0]
                    n = min(room, d.left())
                    pieces.append((d, d.start, n))
                    d.start, room = d.start + n, room - n
                    if not d.left():
                        rest.pop(0)
                yield pieces


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_uid, id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) that cover every id of every row once.

    A document's ids are its text's by the tokenizer file, then END; null and blank texts are END alone. Rows of one id are documents of their
    own, told apart by doc_uid. A document of a window or more first fills windows of its own, where it is read, and only
    what is left, less than a window, is indexed and shuffled. Shards of the index are neighbours by lexical signature:
    rows are range-partitioned by it and then by row, so a group of copies of any size is parted too. All windows are
    full, but for the ends of tasks, which are parted into powers of two: nothing is padded. An empty table gives an
    empty result.
    """
    table = stage(tokenized(docs, id_col, text_col, tokenizer, window), "tokens")
    words = words_table(tokenizer)
    dtype = words.dtype
    df, n_docs, n_tokens = document_frequencies(table, words.size)
    idf = np.maximum(0, np.log((n_docs - df + 0.5) / (df + 0.5))).astype(np.float32)
    mean = n_tokens / max(1, n_docs)

    names = ["doc_uid", "id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def whole(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for uid, i, n, first, raw in zip(b["uid"], b["id"], b["n"], b["s1"], b["ids"], strict=True):
                ids = np.frombuffer(unpack.decompress(raw), dtype).astype("<u4").reshape(-1, window)
                for k, own in enumerate(ids):
                    rows.append((uid, None if pd.isna(i) else int(i), k * window, window, zlib.crc32(own), n, 1 << 62 | uid >> 36 << 36 | first + k, 0, *[own] * with_ids))
            yield pd.DataFrame(rows, columns=names).astype({"id": "Int64"})

    def run(batches):
        unpack, part, sequence = zstandard.ZstdDecompressor(), TaskContext.get().partitionId(), 0
        pool: list[Doc] = []

        def windows(last: bool):
            nonlocal sequence, pool
            rows = []
            for pieces in fill(pool, idf, mean, last, window):
                offset = 0
                for d, start, n in pieces:
                    ids = d.ids[start : start + n].astype("<u4")
                    rows.append((d.uid, d.id, d.skip + start, n, zlib.crc32(ids), d.n, part << 36 | sequence, offset, *[ids] * with_ids))
                    offset += n
                sequence += 1
            pool = [d for d in pool if d.left()]
            return pd.DataFrame(rows, columns=names).astype({"id": "Int64"})

        waiting = 0
        for b in batches:
            for uid, i, n, skip, raw in zip(b["uid"], b["id"], b["n"], b["skip"], b["ids"], strict=True):
                pool.append(Doc(uid, None if pd.isna(i) else int(i), np.frombuffer(unpack.decompress(raw), dtype), n, skip))
                waiting += len(pool[-1].ids)
                if len(pool) >= SHARD_DOCS or waiting >= SHARD_TOKENS:
                    yield windows(False)
                    waiting = sum(d.left() for d in pool)
        yield windows(True)

    schema = "doc_uid long, id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    full = table.where(F.col("kind") == FULL).select("uid", "id", "n", "s1", "ids").mapInPandas(whole, schema)
    dealt = table.where(F.col("kind") == REST).select("uid", "id", "n", "skip", "s1", "s2", "ids").repartitionByRange(max(12, -(-n_tokens // TASK_TOKENS)), "s1", "s2", "uid")
    return full.union(dealt.sortWithinPartitions("s1", "s2", "uid").mapInPandas(run, schema))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pack over all documents with the contract's tokenizer, as pieces without their ids."""
    return pieces_of(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def pieces_of(packed_rows: DataFrame) -> DataFrame:
    return packed_rows.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "doc_uid")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of every row, null and empty texts too; repeated rows are packed as often as they occur."""
    return pieces_of(pack(docs))

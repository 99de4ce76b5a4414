"""Whitening, line dedup and Lloyd clustering, against brute force and on awkward rows."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from korvane.llm import clustering, lines, whitening
from pyspark.sql import functions as F

NAN, INF = float("nan"), float("inf")


# Whitening.


def exact_covariance(x):
    """x: integers. The covariance with exact sums, as doubles."""
    n = len(x)
    y = np.array(x, dtype=object) * n - np.array(x, dtype=object).sum(0)
    return (y.T @ y).astype(np.float64) / n**3, [int(v) for v in (y * y).sum(1)], (y / n).astype(np.float64)


def hold_whitened(rows, vectors, components=32):
    """rows of whiten() over vectors {id: floats}."""
    ids = sorted(vectors)
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in vectors[i]] for i in ids]
    v, deviation, y = exact_covariance(x)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > values[0] * 1e-10).sum()))
    got = {r["id"]: r for r in rows}
    assert sorted(got) == ids and {r["n"] for r in rows} == {len(ids)}
    assert [int(got[i]["deviation"]) for i in ids] == deviation
    assert all(len(r["whitened"]) == k for r in rows)
    z = np.array([got[i]["whitened"] for i in ids])
    want = y @ axes[:, :k] / np.sqrt(values[:k])
    sign = np.sign((z * want).sum(0))
    assert np.abs(z * sign - want).max() < 1e-6
    assert np.allclose(rows[0]["explained"], values[:k] / np.trace(v), rtol=1e-10)
    error = np.abs(z.T @ z / len(z) - np.outer(z.mean(0), z.mean(0)) - np.eye(k)).max()
    assert rows[0]["identity_error"] <= 1e-9 and error <= 1e-9


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n string, whitened int, x double, id string")


def row(k, v):
    return (k, None if v is None else [None if c is None else float(c) for c in v], 1, "clash", 7, 2.5, "z")


def test_whitening_equals_the_full_eigenproblem(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in df.collect()}
    hold_whitened(whitening.whiten(df).collect(), vectors)
    out = whitening.op11_whitening(spark, sf_dir)
    assert out.count() == 32 * len(vectors) and dict(out.dtypes)["component"] == "int" and dict(out.dtypes)["deviation"] == "bigint"


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(1)
    good = {k: [float(c) for c in rng.standard_normal(6) * [9, 5, 3, 1, 0.5, 0.2]] for k in range(40)}
    good[1] = good[0]
    bad = [row(100, None), row(101, [1.0, None, 0, 0, 0, 0]), row(102, [NAN] * 6), row(103, [INF, 0, 0, 0, 0, 0]), row(104, [1.0, 2.0]), row(105, []), row(106, [1e38, 0, 0, 0, 0, 0])]
    rows = whitening.whiten(frame(spark, [row(k, v) for k, v in good.items()] + bad), block=2).collect()
    hold_whitened(rows, {k: np.float32(v) for k, v in good.items()})
    assert whitening.whiten(frame(spark, [])).collect() == [] == whitening.whiten(frame(spark, bad[:4])).collect()
    same = whitening.whiten(frame(spark, [row(None, [1.0, 2.0]), row(5, [1.0, 2.0]), row(5, [1.0, 2.0])])).collect()
    assert [(r["id"], r["n"], int(r["deviation"]), r["whitened"]) for r in sorted(same, key=str)] == [(5, 3, 0, []), (5, 3, 0, []), (None, 3, 0, [])]
    # Entries so large that no sum of squares fits a long: exact all the same.
    large = {k: [float(2**40 * (k % 3)), float(k)] for k in range(9)}
    hold_whitened(whitening.whiten(frame(spark, [row(k, v) for k, v in large.items()])).collect(), {k: np.float32(v) for k, v in large.items()}, 1)


@pytest.mark.parametrize(("dim", "rank", "wanted", "block", "most"), [(200, 200, 12, 4, 32), (60, 9, 12, 4, 24), (50, 50, 50, 7, None), (30, 30, 5, 30, None), (120, 120, 10, 8, 30)])
def test_block_lanczos_restarts_and_breaks_down_well(dim, rank, wanted, block, most):
    rng = np.random.default_rng(dim)
    values = np.concatenate([np.repeat(2.0, 3), np.geomspace(1, 0.01, rank - 3)]) if rank > 3 else np.ones(rank)
    axes = np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, :rank]
    a, calls = (axes * values) @ axes.T, []

    def apply(q):
        calls.append(q.shape[1])
        return a @ q

    found, vectors, residuals = whitening.eigenpairs(apply, dim, wanted, block, most)
    want = np.sort(np.concatenate([values, np.zeros(dim - rank)]))[::-1][:wanted]
    assert np.abs(found - want).max() < 1e-12 and residuals.max() < 1e-11 and max(calls) <= block
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12


# Line dedup.


def slow_lines(rows, min_chars=20, min_docs=3):
    blanks = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blanks))
    held = defaultdict(set)
    name = lambda i, t: (i is not None, i if i is not None else hashlib.md5((t or "").encode()).digest())
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(name(i, t))
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(held[key(x)]) < min_docs or max(held[key(x)]) == name(i, t)]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


SHARED = "This line stands in many documents"


def line_rows():
    rng = np.random.default_rng(5)
    pool = [f"  Shared line number {k} of the pool, öÖ\t" if k % 2 else f"shared LINE number {k} of the pool, öÖ" for k in range(12)]
    rows = [(k, "\n".join(rng.choice([*pool, "short", "", f"a line that only document {k} holds"], int(rng.integers(0, 9))))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, f"{SHARED}\r\n{SHARED.upper()}\x0b\n x \n"), (104, f"\t {SHARED}"), (105, f"{SHARED}\n{SHARED}"), (106, SHARED + " "), (105, "another text of one id\n" + SHARED), (105, "another text of one id\n" + SHARED)]
    rows += [(None, SHARED + "\nwithout an id"), (None, SHARED), (None, None), (None, "only those without an id hold this")]
    rows += [(None, f"only those without an id hold this\n{k}") for k in range(3)]
    rows += [(107, "two documents are too few for it\n" * 3), (108, "two documents are too few for it"), (109, "exactly 20 characters"[:20]), (110, "exactly 20 characters"[:20]), (111, "Exactly 20 Characters"[:20]), (112, "e" * 19), (113, "e" * 19), (114, "e" * 19)]
    rows.append((115, "\n".join(f"{SHARED} {k % 40}" if k % 3 else SHARED for k in range(30_000))))
    return rows


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    df = spark.createDataFrame([(i, t, "x", 1, "clash", 2.5) for i, t in rows], "doc_id long, text string, pos string, n_lines int, key string, last double").repartition(7)
    out = lines.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "pos", "n_lines_input", "key", "last", "n_lines", "n_dropped"]
    got = out.collect()
    assert {(r["pos"], r["n_lines_input"], r["key"], r["last"]) for r in got} == {("x", 1, "clash", 2.5)}
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got], key=repr) == slow_lines(rows)
    got = lines.dedup_lines(df, min_chars=1, min_docs=2).collect()
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got], key=repr) == slow_lines(rows, 1, 2)


def test_lines_of_an_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_line_of_all_documents(spark):
    """A third of all lines is one line, and every document holds it."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(SHARED + "\n"), F.col("id").cast("string"), F.lit("\nshort")).alias("text"))
    out = lines.dedup_lines(df)
    assert out.where("n_dropped = 1").count() == 2999 and [r["doc_id"] for r in out.where("n_dropped = 0").collect()] == [2999]


# Lloyd.


def slow_lloyd(rows, k=8, rounds=10, dim=64, seed="3"):
    kept = [(i, [math.floor(1024 * c) for c in map(float, v)]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        for j, vs in members.items():
            centroids[j] = [sum(column) // len(vs) for column in zip(*vs, strict=True)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    per = defaultdict(int)
    for _, c, d in out:
        per[c] += d
    return sorted([(i, c, d, per[c], sum(per.values()), centroids[c]) for i, c, d in out], key=repr)


def told(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_lloyd_equals_brute_force_on_awkward_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(c) for c in np.float32(rng.standard_normal(4) + 3 * (k % 3))]) for k in range(90)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, [0.0] * 4), (200, [0.0] * 4), (201, [-0.5, 0.5, 1 / 1024, -1 / 1024])]
    rows += [(300 + k, rows[0][1]) for k in range(40)]
    bad = [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [NAN] * 4), (403, [INF, 0.0, 0.0, 0.0]), (404, [1.0] * 3), (405, [])]
    df = spark.createDataFrame([(i, v, 1, 2.0, "c") for i, v in rows + bad], "vec_id long, embedding array<float>, cluster int, distance double, x string").repartition(5)
    for k, rounds in [(8, 10), (3, 1), (8, 0), (500, 2)]:
        assert told(clustering.lloyd(df, k, rounds, dim=4)) == slow_lloyd(rows, k, rounds, 4)
    huge = spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0]), (2, [1.0] * 4)], "vec_id long, embedding array<double>")
    assert told(clustering.lloyd(huge, dim=4)) == [(2, 0, 0, 0, 0, [1024] * 4)]


def test_lloyd_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert clustering.lloyd(spark.createDataFrame([], schema)).collect() == []
    assert clustering.lloyd(spark.createDataFrame([(1, [1.0])], schema)).collect() == []
    copies = spark.createDataFrame([(k, [0.5] * 64) for k in range(20)], schema)
    assert {tuple(r)[1:5] for r in clustering.lloyd(copies).collect()} == {(0, 0, 0, 0)}


def test_lloyd_keeps_an_empty_centroid(spark):
    """Equal first centroids: the second one has no vectors and stays where it is."""
    rows = [(k, [float(k // 10)] * 2) for k in range(20)]
    got = told(clustering.lloyd(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 6, 3, 2))
    assert got == slow_lloyd(rows, 6, 3, 2)

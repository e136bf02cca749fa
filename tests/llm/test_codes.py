import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(vec_id, code, error, label_error, sha) by plain loops over vectors whose length 8 divides."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))
    w = len(whole[0]) // 8
    cut = [[tuple(v[p * w : (p + 1) * w]) for p in range(8)] for v in whole]
    books = [[cut[i][p] for i in order[:16]] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            groups = {}
            for v in cut:
                groups.setdefault(near(v[p], books[p])[1], []).append(v[p])
            books[p] = [
                tuple(sum(c) // len(groups[k]) for c in zip(*groups[k])) if k in groups else e for k, e in enumerate(books[p])
            ]
    out, by_label = [], {}
    for r, v in zip(kept, cut):
        found = [near(v[p], books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], "".join(f"{k:02x}" for _, k in found), error, r[2]))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[l], sha) for i, c, e, l in out), key=str)


def vectors(rng, n=150, dims=16):
    rows = []
    for i in range(n):
        v = [rng.choice([0.0, -0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(dims)]
        rows.append((i * 3 % 101 + 100 * (i % 2), v, rng.choice([1, 2, None])))
    rows += [(7, rows[0][1], 1)] * 60  # a common vector
    bad = [(1, None, 1), (2, [None] * dims, 1), (3, [float("nan")] * dims, 2), (4, [float("inf")] * dims, 2), (None, rows[5][1], 2)]
    return rows + bad


def got(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = vectors(random.Random(seed))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("code", "place", "whole", "n")})
    assert got(codes.compress(df)) == brute(rows)


def test_small_blocks_walk_the_same_trie(monkeypatch):
    rng = np.random.default_rng(3)
    parts = rng.integers(-3, 3, (500, 4))
    book = rng.integers(-3, 3, (16, 4))
    distance = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    for block in (4096, 7, 1):
        monkeypatch.setattr(codes, "BLOCK", block)
        entry, far = codes.assign(parts, book)
        assert (entry == distance.argmin(axis=1)).all() and (far == distance.min(axis=1)).all()


def test_other_lengths_few_rows_and_none(spark):
    rows = [(1, [0.5] * 9, 1), (2, [0.25] * 9, 1), (3, [0.1] * 4, 1), (4, [], 1), (5, [1e30] * 9, 1)]
    found = codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in found) == [(1, "00" * 4 + "00" * 4, 0), (2, "01" * 4 + "01" + "00" * 3, 0)]
    empty = codes.compress(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and set(empty.columns) == set(codes.compress(spark.createDataFrame(rows, SCHEMA)).columns)
    assert codes.compress(spark.createDataFrame([(1, None, 1), (2, [], 2)], SCHEMA)).collect() == []


def test_doubles_and_large_components(spark):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.StringType())])
    rows = [(i, [float((-1) ** i * 8000 + i)] * 8, "a") for i in range(20)]
    found = {r.vec_id: r.error for r in codes.compress(spark.createDataFrame(rows, schema)).collect()}
    assert len(found) == 20 and min(found.values()) >= 0


def test_twin(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    expected = con.execute(codes.compress_sql()).fetchall()
    assert got(codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))) == sorted(map(tuple, expected), key=str)

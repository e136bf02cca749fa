"""Approximate nearest neighbours with a permutation index: pivot orders, inverted files, footrule, rerank."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import stage

#: Bound of the sample that the index is fitted on: the different vectors first by hash of their id.
PIVOTS = 128
#: Length of the pivot order kept of a vector; pivots further off count as one place after its end.
ORDER = 64
#: A vector is posted under its nearest pivots; a query looks under more of its own.
POSTED = 8
PROBED = 24
#: Share of the vectors met under a pivot that are reranked, by footrule.
RERANKED = 0.3
#: Vectors and queries that a task compares at a time.
VECTOR_BLOCK = 8192
QUERY_BLOCK = 512

_POSTING = "pivot int, rep long, ids array<long>, ranks binary, vector binary"
_FOUND = "query long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part, one per vec_id.

    Left out: null ids, null and zero vectors, null and non-finite components, and vectors of another length
    than the most common one. Of rows that repeat an id, the smallest vector counts.
    """
    doubles = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = doubles.filter(F.col("vec_id").isNotNull() & sound & F.exists("embedding", lambda x: x != 0))
    length = some.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    length = length.collect()  # one row
    some = some.filter(F.size("embedding") == (length[0]["n"] if length else 0))
    # 0.0 and -0.0 are one value
    return some.groupBy("vec_id").agg(F.min(F.transform("embedding", lambda x: x + F.lit(0.0))).alias("embedding"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivot_orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    return np.argsort(-(unit(x) @ pivots.T), axis=1, kind="stable")[:, :ORDER]


def pivot_ranks(order: np.ndarray, n_pivots: int) -> np.ndarray:
    """Place of each pivot in each order; one place after its end if it is not in it."""
    ranks = np.full((len(order), n_pivots), order.shape[1], np.uint8)
    np.put_along_axis(ranks, order, np.arange(order.shape[1], dtype=np.uint8)[None, :], 1)
    return ranks


def footrule(query: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return np.abs(ranks.astype(np.int16) - query.astype(np.int16)).sum(axis=1, dtype=np.int64)


def _postings(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            x = _matrix(part.column("embedding"))
            order = pivot_orders(x, pivots)
            ranks = pa.array([r.tobytes() for r in pivot_ranks(order, len(pivots))], pa.binary())
            data = pa.array([v.tobytes() for v in x], pa.binary())
            posted = order[:, :n]
            row = pa.array(np.repeat(np.arange(len(x)), posted.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(posted.ravel().astype(np.int32)), *(c.take(row) for c in (part.column("rep"), part.column("ids"), ranks, data))],
                ["pivot", "rep", "ids", "ranks", "vector"],
            )


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with the vector y, the same whatever rows come along."""
    scale = np.abs(x).max(axis=1), np.abs(y).max()
    x, y = x / scale[0][:, None], y / scale[1]
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum()))


def _meet(vectors: pa.Table, queries: pa.Table, k: int, share: float) -> pa.Table:
    """The k best (and ties by id) of each query among the vectors of one block."""
    out: list[list] = [[], [], []]
    if vectors.num_rows and queries.num_rows:
        ranks = np.frombuffer(b"".join(vectors.column("ranks").to_pylist()), np.uint8).reshape(vectors.num_rows, -1)
        x = np.frombuffer(b"".join(vectors.column("vector").to_pylist())).reshape(vectors.num_rows, -1)
        ids = vectors.column("ids").to_pylist()
        n = max(min(len(x), 8 * k), int(np.ceil(share * len(x))))
        for rep, rank, vector in zip(*(queries.column(c).to_pylist() for c in ("rep", "ranks", "vector"))):
            near = np.arange(len(x))
            if n < len(x):
                away = footrule(np.frombuffer(rank, np.uint8), ranks)
                near = np.argpartition(away, n - 1)[:n]
                near = np.flatnonzero(away <= away[near].max())  # ties, too
            score = cosines(x[near], np.frombuffer(vector))
            least = np.partition(score, -min(k, len(score)))[-min(k, len(score))]
            best = [(-score[i], v) for i in np.flatnonzero(score >= least) for v in ids[near[i]]]
            for s, v in sorted(best)[:k]:
                out[0].append(rep)
                out[1].append(v)
                out[2].append(-float(s))
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query", "vec_id", "score"])


def _search(nodes: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int, probed: int, share: float) -> DataFrame:
    """(query, vec_id, score): the best ``k`` found for each query node."""
    posted = nodes.mapInArrow(partial(_postings, pivots=pivots, n=POSTED), _POSTING)
    asked = queries.mapInArrow(partial(_postings, pivots=pivots, n=probed), _POSTING).drop("ids")
    # lists of any length are dealt to blocks: one row per pivot tells how many
    counted = posted.groupBy("pivot").agg(F.count(F.lit(1)).alias("vectors")).join(
        asked.groupBy("pivot").agg(F.count(F.lit(1)).alias("queries")), "pivot"
    )
    n_blocks = {r["pivot"]: (-(-r["vectors"] // VECTOR_BLOCK), -(-r["queries"] // QUERY_BLOCK)) for r in counted.collect()}
    if not n_blocks:
        return nodes.sparkSession.createDataFrame([], _FOUND)
    blocks = [F.create_map(*[F.lit(x) for p, n in n_blocks.items() for x in (p, n[side])])[F.col("pivot")] for side in (0, 1)]
    listed = F.col("pivot").isin(list(n_blocks))
    left = posted.filter(listed).withColumns(
        {"v": F.pmod(F.xxhash64("rep"), blocks[0]).cast("int"), "q": F.explode(F.sequence(F.lit(0), blocks[1].cast("int") - 1))}
    )
    right = asked.filter(listed).withColumn("q", F.pmod(F.xxhash64("rep"), blocks[1]).cast("int"))
    right = right.withColumn("v", F.explode(F.sequence(F.lit(0), blocks[0].cast("int") - 1)))

    def meet(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        return _meet(vectors, queries, k, share)

    met = left.groupBy("pivot", "v", "q").cogroup(right.groupBy("pivot", "v", "q")).applyInArrow(meet, _FOUND).distinct()
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")


def nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, n_pivots: int = PIVOTS, probed: int = PROBED, share: float = RERANKED
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by cosine of every vector whose id is a multiple of ``every``.

    Vectors are compared by the order of their nearest pivots: a vector is posted under its first POSTED pivots,
    a query looks under its first ``probed``, the ``share`` of a list with the smallest footrule distance is
    reranked by exact cosine. Equal vectors are one entry with their k + 1 smallest ids, and equal queries one
    query, so copies of any number make no long lists. A query for which fewer than k are found looks under all
    pivots at everything. Ties go to the smaller vec_id; a vector is no neighbour of itself.

    Unusable vectors (see ``usable``) take no part; extra columns are ignored; an empty table, or one of a
    single vector, gives an empty result.
    """
    rows = stage(usable(vectors), "vectors")
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    nodes = first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
    nodes = stage(nodes.select(F.col("ids")[0].alias("rep"), "ids", "embedding"), "nodes")
    sample = nodes.orderBy(F.xxhash64("rep"), "rep").limit(n_pivots).select("embedding").collect()
    pivots = unit(np.array([r["embedding"] for r in sample])) if sample else np.zeros((0, 0))
    members = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).join(nodes.select("rep", "embedding"), "embedding")
    members = stage(members.select("vec_id", "rep"), "queries")
    asked = nodes.join(members.select("rep").distinct(), "rep", "left_semi")
    found = stage(_search(nodes, asked, pivots, k + 1, probed, share), "found")

    def named(some: DataFrame) -> DataFrame:
        own = members.select(F.col("vec_id").alias("query_id"), "rep").join(some, F.col("rep") == F.col("query"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        own = own.filter("vec_id <> query_id").withColumn("rank", rank).filter(F.col("rank") <= k)
        return own.select("query_id", "rank", "vec_id", "score")

    out = named(found)
    full = out.filter(F.col("rank") == k).select("query_id")
    few = stage(members.join(full, members["vec_id"] == full["query_id"], "left_anti").select("rep").distinct(), "few")
    if few.isEmpty():
        return out
    again = _search(nodes, nodes.join(few, "rep", "left_semi"), pivots, k + 1, len(pivots), 1.0)
    return named(found.join(few.withColumnRenamed("rep", "query"), "query", "left_anti").unionByName(again))

"""Vector code compression: product codes whose assignments walk a lexicographic trie of distinct parts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Trie nodes whose children are made together; the depth-first stack holds at most so many a level.
BLOCK = 4096


def _limit(dims: int) -> int:
    """Largest component for which no error of a vector can pass a long."""
    return math.isqrt(2**62 // max(dims, 1)) // 2


def leaves(parts: np.ndarray, book: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, entry, squared distance) for stretches of the distinct ``parts``, which are sorted as words.

    Depth first over the trie of the rows: a node is a run of rows that agree in their first components and
    carries the distance of that prefix to every entry, so rows below it share the sum. The stack holds
    blocks of neighbouring nodes, and a block's children are made by one array operation. Ties take the lowest entry.
    """
    n, width = parts.shape
    # first component in which a row differs from the row before
    differs = np.zeros(n, np.int64)
    if n > 1:
        unequal = parts[1:] != parts[:-1]
        differs[1:] = np.where(unequal.any(axis=1), unequal.argmax(axis=1), width)
    stack = [(0, np.array([0, n]), np.zeros((1, len(book)), np.int64))] if n else []
    while stack:
        depth, bounds, sums = stack.pop()
        if depth == width:
            yield int(bounds[0]), sums.argmin(axis=1), sums.min(axis=1)
            continue
        low, high = int(bounds[0]), int(bounds[-1])
        starts = low + np.flatnonzero((differs[low:high] <= depth) | (np.arange(low, high) == low))
        parent = np.searchsorted(bounds, starts, "right") - 1
        blocks = range(0, len(starts), BLOCK)
        for at in reversed(blocks):
            mine = slice(at, at + BLOCK)
            step = parts[starts[mine], depth][:, None] - book[:, depth][None, :]
            end = starts[at + BLOCK] if at + BLOCK < len(starts) else high
            stack.append((depth + 1, np.append(starts[mine], end), sums[parent[mine]] + step * step))


def assign(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every row of ``parts``, in any order and with repeats."""
    distinct, where = np.unique(parts, axis=0, return_inverse=True)
    entry, distance = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
    for first, found, far in leaves(distinct, book):
        entry[first : first + len(found)], distance[first : first + len(found)] = found, far
    return entry[where.ravel()], distance[where.ravel()]


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each part position and entry that the task's distinct parts fall to: their number and sums."""
    width = books.shape[2]
    counts = np.zeros(books.shape[:2], np.int64)
    totals = np.zeros(books.shape, np.int64)
    for batch in batches:
        places = batch.column("place").to_numpy()
        copies = batch.column("n").to_numpy()
        parts = _matrix(batch.column("part"))
        for place in np.unique(places):
            mine = np.flatnonzero(places == place)
            rows, weight = parts[mine], copies[mine]
            for first, found, _ in leaves(rows, books[place]):
                at = slice(first, first + len(found))
                np.add.at(counts[place], found, weight[at])
                np.add.at(totals[place], found, rows[at] * weight[at, None])
    place, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(place.astype(np.int32)),
            pa.array(entry.astype(np.int32)),
            pa.array(counts[place, entry]),
            pa.FixedSizeListArray.from_arrays(pa.array(totals[place, entry].ravel()), width).cast(pa.list_(pa.int64()))
            if width
            else pa.array([[] for _ in place], pa.list_(pa.int64())),
        ],
        ["place", "entry", "n", "total"],
    )


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    places, _, width = books.shape
    for batch in batches:
        vectors = _matrix(batch.column("whole")).reshape(batch.num_rows, places, width)
        entries = np.empty((batch.num_rows, places), np.int64)
        error = np.zeros(batch.num_rows, np.int64)
        for place in range(places):
            entries[:, place], distance = assign(vectors[:, place, :], books[place])
            error += distance
        code = [bytes(row).hex() for row in entries.astype(np.uint8)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)],
            ["vec_id", "label", "code", "error"],
        )


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, whole): components as floor(4096 x), vectors of the most common length only."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE <= F.lit(2.0**31))
    )
    kept = vectors.select("vec_id", "label", "embedding").filter(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = stage(kept.select("vec_id", "label", scaled.alias("whole")), "whole")
    sizes = whole.groupBy(F.size("whole").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = common[0]["dims"] if common else 0
    # no dims of zeros are added where the parts are equal already
    zeros = F.array_repeat(F.lit(0).cast("long"), -dims % PARTS)
    small = F.forall("whole", lambda x: F.abs(x) <= _limit(dims))
    return whole.filter((F.size("whole") == dims) & small).withColumn("whole", F.concat("whole", zeros))


def fit_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after all rounds.

    Equal parts are one row with their number, range-sorted, so that every task walks the trie of its own
    stretch. A round brings parts x entries rows to the driver.
    """
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).collect()
    width = len(first[0]["whole"]) // parts
    books = np.array([r["whole"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    cut = F.array(*[F.slice("whole", 1 + p * width, width) for p in range(parts)])
    rows = whole.select(F.posexplode(cut).alias("place", "part")).groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"))
    rows = stage(rows.repartitionByRange("place", "part").sortWithinPartitions("place", "part"), "parts")
    for _ in range(rounds):
        sums = rows.mapInArrow(partial(_sums, books=books), "place int, entry int, n long, total array<long>")
        added = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
        for r in sums.groupBy("place", "entry").agg(F.sum("n").alias("n"), *added).collect():
            books[r["place"], r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(width)]
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every vector that takes part.

    Vectors that are null or hold null or non-finite components go. So do vectors of another length than the
    most common one (ties: the longer), and those with a component so large that the error could pass a long. A
    length that the parts do not divide is filled up with zeros. Rows that repeat a vec_id are vectors of
    their own, of which the smaller vector comes first; a null vec_id sorts last. With fewer vectors than
    entries each is an entry. Null labels are one label. Extra columns are ignored; an empty table, or one in which
    all vectors go or are of length 0, gives an empty result.
    """
    whole = whole_vectors(vectors)
    schema = "vec_id long, label string, code string, error long"
    whole = whole.filter(F.size("whole") > 0).select("vec_id", F.col("label").cast("string").alias("label"), "whole")
    if whole.isEmpty():
        empty = vectors.sparkSession.createDataFrame([], schema).drop("label")
        return empty.withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
    books = fit_codebooks(whole, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stage(whole.mapInArrow(partial(_coded, books=books), schema), "codes")
    totals = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels").withColumnRenamed("label", "of")
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def compress_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the rows of ``compress`` where all vectors have one length that the parts divide."""
    near = """
    select place, part, n, arg_min(entry, (distance, entry)) as entry, min(distance) as distance from (
      select p.place, p.part, p.n, b.entry,
        list_sum(list_transform(list_zip(p.part, b.value), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as distance
      from parts p join {books} b on b.place = p.place)
    group by place, part, n"""
    steps = []
    for i in range(1, rounds + 1):
        steps.append(
            f"""near{i} as ({near.format(books=f"books{i - 1}")}),
  sums{i} as (
    select place, entry, list(((total - ((total % n) + n) % n) // n)::bigint order by k) as value from (
      select place, entry, k, sum(n)::bigint as n, sum(part[k] * n)::bigint as total
      from (select place, entry, part, n, unnest(range(1, len(part) + 1)) as k from near{i})
      group by place, entry, k)
    group by place, entry),
  books{i} as (
    select b.place, b.entry, coalesce(s.value, b.value) as value
    from books{i - 1} b left join sums{i} s on s.place = b.place and s.entry = b.entry)"""
        )
    return f"""
with kept as (
    select vec_id, label, list_transform(embedding, lambda x: floor(x::double * {SCALE})::bigint) as whole
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  cut as (
    select vec_id, label, place, whole[place * (len(whole) // {parts}) + 1 : (place + 1) * (len(whole) // {parts})] as part
    from (select *, unnest(range({parts})) as place from kept)),
  parts as materialized (select place, part, count(*) as n from cut group by place, part),
  books0 as (
    select place, row_number() over (partition by place order by vec_id) - 1 as entry, part as value
    from cut where vec_id in (select vec_id from kept order by vec_id limit {entries})),
  {", ".join(steps)},
  final as ({near.format(books=f"books{rounds}")}),
  coded as (
    select vec_id, label, string_agg(printf('%02x', entry), '' order by c.place) as code, sum(distance)::bigint as error
    from cut c join final f on f.place = c.place and f.part = c.part
    group by vec_id, label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(x, ',' order by place, entry)) from (
    select place, entry, array_to_string(value, ',') as x from books{rounds})) as codebooks_sha256
from coded"""

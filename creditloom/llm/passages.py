"""Suffix-array dedup: passages that documents share, by sparse suffix arrays at minimiser positions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import in_filter, key_filter, runs, slices, stage, whole_text, words_of

#: Shortest passage. Any run of so many words has a minimiser: one of its MIN_WORDS - GRAM + 1 grams.
MIN_WORDS = 50
GRAM = 25
FILTER_BITS = 1 << 25
#: Documents are hashed together up to so many words.
_CHUNK_WORDS = 1 << 18
#: Rows of a batch that a task makes Python objects or arrays of at a time.
_SLICE = 256
#: Words kept of a suffix beyond the shortest passage.
_BEYOND = 14
_PLACE_BITS = np.uint64(24)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)

_DOCS = "doc_id long, text_key long, c1 long, c2 long, n_words int, grams array<long>"
_SUFFIXES = "doc_id long, text_key long, pos int, gram long, right binary, left binary"
_MATCHES = "doc_id long, text_key long, first int, end int, other long"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def grams_of(words: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` words: differences of one running sum."""
    n = len(words)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_P, n), dtype=np.uint64)))
    x = (total[gram:] - total[:-gram]) * _powers(_P_INVERSE, n)[: n - gram + 1]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def minimisers(chunk: list[np.ndarray], min_words: int, gram: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and hashes of the smallest gram (ties: the leftmost) of every run of ``min_words`` words."""
    window = min_words - gram + 1
    lengths = np.array([len(c) for c in chunk])
    none = (np.empty(0, np.int64), np.empty(0, np.uint64))
    if lengths.sum() < min_words:
        return [none] * len(chunk)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    hashes = grams_of(np.concatenate(chunk), gram)
    low = np.uint64((1 << int(_PLACE_BITS)) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < window:
        least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
    out = []
    for start, n in zip(starts, lengths):
        if n < min_words:
            out.append(none)
        else:
            at = np.unique(least[start : start + n - min_words + 1] & low).astype(np.int64)
            out.append((at - start, hashes[at]))
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[list[bytes]]]]:
    for batch in slices(batches, _SLICE):
        texts = batch.column("text").cast(pa.binary())
        at, held, chunk = 0, 0, []
        for i in range(batch.num_rows):
            chunk.append(words_of(texts[i].as_py()))
            held += len(chunk[-1])
            if held >= _CHUNK_WORDS or i + 1 == batch.num_rows:
                yield batch, at, chunk
                at, held, chunk = i + 1, 0, []


def _hashed(chunk: list[list[bytes]]) -> list[np.ndarray]:
    return [np.fromiter(map(zlib.crc32, w), np.uint64, len(w)) for w in chunk]


def _minimisers(hashed: list[np.ndarray], min_words: int, gram: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of a chunk; a text too long for the places' bits goes by overlapping parts."""
    if sum(map(len, hashed)) < 1 << int(_PLACE_BITS):
        return minimisers(hashed, min_words, gram)
    out, step = [], 1 << 22
    for words in hashed:
        parts = [
            (at, minimisers([words[at : at + step + min_words - 1]], min_words, gram)[0]) for at in range(0, max(1, len(words)), step)
        ]
        places = np.concatenate([x + at for at, (x, _) in parts])
        places, first = np.unique(places, return_index=True)
        out.append((places, np.concatenate([h for _, (_, h) in parts])[first]))
    return out


def _documents(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch, at, chunk in _chunks(batches):
        part = batch.slice(at, len(chunk))
        pairs = [np.frombuffer(xxhash.xxh3_128_digest(b" ".join(w)), np.int64) for w in chunk]
        grams = [h.view(np.int64) for _, h in _minimisers(_hashed(chunk), min_words, gram)]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_key"), pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64()),
             pa.array([len(w) for w in chunk], pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "c1", "c2", "n_words", "grams"],
        )


def _suffixes(batches: Iterator[pa.RecordBatch], shared: Broadcast, min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Suffixes at the minimisers whose gram the filter lets through: words on the right, words on the left backwards."""
    table = np.frombuffer(shared.value, np.uint8)
    back = min_words - gram + 1
    for batch, at, chunk in _chunks(batches):
        hashed = _hashed(chunk)
        row, pos, grams, right, left = [], [], [], [], []
        for i, (words, (places, hashes)) in enumerate(zip(hashed, _minimisers(hashed, min_words, gram))):
            keep = in_filter(table, hashes)
            if keep.any():
                data = words.astype(">u4").tobytes()
                mirrored = words[::-1].astype(">u4").tobytes()
                n = len(words)
                for p in places[keep].tolist():
                    right.append(data[4 * p : 4 * (p + min_words + _BEYOND)])
                    left.append(mirrored[4 * (n - p) : 4 * (n - p + back)])
                row += [at + i] * int(keep.sum())
                pos += places[keep].tolist()
                grams += hashes[keep].view(np.int64).tolist()
        index = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(index), batch.column("text_key").take(index), pa.array(pos, pa.int32()),
             pa.array(grams, pa.int64()), pa.array(right, pa.binary()), pa.array(left, pa.binary())],
            ["doc_id", "text_key", "pos", "gram", "right", "left"],
        )


class _Rows:
    """Neighbouring suffixes in sorted order."""

    def __init__(self, table: pa.Table, width: int, back: int):
        self.table = table
        self.key = table.column("text_key").to_numpy()
        ids = table.column("doc_id")
        self.id = ids.fill_null(0).to_numpy()
        self.null = ids.is_null().to_numpy()
        self.pos = table.column("pos").to_numpy()
        self.right, self.n_right = self._matrix("right", width)
        self.left, self.n_left = self._matrix("left", back)

    def _matrix(self, name: str, width: int) -> tuple[np.ndarray, np.ndarray]:
        data = self.table.column(name).to_pylist()
        lengths = np.array([len(x) for x in data]) // 4
        return np.frombuffer(b"".join(x.ljust(4 * width, b"\0") for x in data), np.uint32).reshape(len(data), width), lengths

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Of neighbours from one document."""
        new = (self.key[1:] != self.key[:-1]) | (self.id[1:] != self.id[:-1]) | (self.null[1:] != self.null[:-1])
        return runs(np.concatenate(([0], np.cumsum(new))))

    def common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words to the left and to the right of the rows ``a`` and ``b``."""
        out = []
        for words, lengths in ((self.left, self.n_left), (self.right, self.n_right)):
            differ = words[a] != words[b]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), words.shape[1])
            out.append(np.minimum(first, np.minimum(lengths[a], lengths[b])))
        return out[0], out[1]


def _with_neighbours(rows: _Rows, start: int, end: int, min_words: int, gram: int) -> tuple[np.ndarray, ...]:
    """Matches of rows start to end with the next rows, before and after, of another document; which have one."""
    starts, ends = rows.runs()
    of = np.repeat(np.arange(len(starts)), ends - starts)[start:end]
    mine = np.arange(start, end)
    matched = np.zeros(end - start, bool)
    parts = []
    for other in (starts[of] - 1, ends[of]):
        there = (other >= 0) & (other < len(rows.pos))
        a, b = mine[there], other[there]
        left, right = rows.common(a, b)
        good = (right >= gram) & (left + right >= min_words)
        matched[np.flatnonzero(there)[good]] = True
        parts.append((a[good], b[good], left[good], right[good]))
    a, b, left, right = (np.concatenate(x) for x in zip(*parts))
    return a, b, left, right, matched


_NEIGHBOURS = _MATCHES + ", kind int, part int, pos int, gram long, right binary, left binary"
_MATCH, _OPEN, _HEAD, _TAIL = 0, 1, 2, 3


def _out(rows: _Rows, at: np.ndarray, kind: int, part: int, first=None, end=None, other=None) -> pa.RecordBatch:
    """Result rows of the rows ``at``; contexts only for those that are met again."""
    table = rows.table.take(pa.array(at))
    n = len(at)
    whole = kind != _MATCH
    empty = pa.nulls(n, pa.int32())
    columns = [table.column("doc_id"), table.column("text_key")]
    columns += [empty, empty, pa.nulls(n, pa.int64())] if whole else [pa.array(first, pa.int32()), pa.array(end, pa.int32()), rows.table.column("doc_id").take(pa.array(other))]
    columns += [pa.array(np.full(n, kind), pa.int32()), pa.array(np.full(n, part), pa.int32())]
    columns += [table.column("pos"), table.column("gram")]
    columns += [table.column("right"), table.column("left")] if kind in (_HEAD, _TAIL) else [pa.nulls(n, pa.binary())] * 2
    names = ["doc_id", "text_key", "first", "end", "other", "kind", "part", "pos", "gram", "right", "left"]
    combined = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in combined], names)


def _report(rows: _Rows, start: int, end: int, part: int, min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    a, b, left, right, matched = _with_neighbours(rows, start, end, min_words, gram)
    if len(a):
        yield _out(rows, a, _MATCH, part, (rows.pos[a] - left).astype(np.int32), (rows.pos[a] + right).astype(np.int32), b)
    if not matched.all():
        yield _out(rows, start + np.flatnonzero(~matched), _OPEN, part)


def _neighbours(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted. The first and the last document's rows, each with one row beyond, go out for their other side."""
    part, width, back = TaskContext.get().partitionId(), min_words + _BEYOND, min_words - gram + 1
    held: pa.Table | None = None
    first = True  # the run at the start of the held rows is the partition's first
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        rows = _Rows(held, width, back)
        starts, ends = rows.runs()
        if len(starts) < 3:
            continue  # one document's suffixes, and its neighbour's
        if first:
            yield _out(rows, np.arange(ends[0] + 1), _HEAD, part)
            first = False
            done = 0
        else:
            done = ends[0]  # one row of a run that is reported
        yield from _report(rows, done, starts[-1], part, min_words, gram)
        held = held.slice(starts[-1] - 1)
    if held is None:
        return
    rows = _Rows(held, width, back)
    starts, ends = rows.runs()
    if first:
        yield _out(rows, np.arange(min(ends[0] + 1, len(rows.pos))), _HEAD, part)
        yield from _report(rows, 0, len(rows.pos), part, min_words, gram)
    else:
        yield from _report(rows, ends[0] if len(starts) > 1 else 0, len(rows.pos), part, min_words, gram)
    yield _out(rows, np.arange(max(starts[-1] - 1, 0), len(rows.pos)), _TAIL, part)


def _windows(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Every run of ``min_words`` words about a minimiser that holds its gram, as a hash."""
    for batch in slices(batches, _SLICE):
        row, begin, keys = [], [], []
        for i, (pos, right, left) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("pos", "right", "left")))):
            before = np.frombuffer(left, ">u4")[::-1].tobytes()
            context, n = before + right, len(left) // 4
            for back in range(min(n, min_words - gram) + 1):
                window = context[4 * (n - back) : 4 * (n - back + min_words)]
                if len(window) == 4 * min_words:
                    row.append(i)
                    begin.append(pos - back)
                    keys.append(xxhash.xxh3_128_digest(window))
        index = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(index), batch.column("text_key").take(index), pa.array(begin, pa.int32()), pa.array(keys, pa.binary())],
            ["doc_id", "text_key", "first", "window"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping or touching spans of a document become one; the other document is that of the longest."""
    for batch in slices(batches, _SLICE):
        spans = batch.column("spans")
        parts = spans.flatten()
        first, end = (parts.field(c).to_numpy().astype(np.int64) for c in ("first", "end"))
        other = parts.field("other").fill_null(-1).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(spans).to_numpy(zero_copy_only=False))
        order = np.lexsort((other, -end, first, row))
        first, end, row = first[order], end[order], row[order]
        # documents apart by more than any place, so that one running maximum serves all
        apart = row * (end.max(initial=0) + 1)
        reach = np.maximum.accumulate(apart + end)
        new = np.ones(len(row), bool)
        new[1:] = (apart + first)[1:] > reach[:-1]
        starts = np.flatnonzero(new)
        span = np.cumsum(new) - 1
        longest = np.lexsort((first - end, span))[starts]  # stable: the first of the longest
        columns = [batch.column(c).take(pa.array(row[starts])) for c in ("doc_id", "text_key")]
        last = np.append(starts[1:], len(row))[: len(starts)] - 1
        columns += [pa.array(first[starts], pa.int32()), pa.array((reach - apart)[last], pa.int32())]
        columns += [parts.field("other").take(pa.array(order[longest]))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "first", "end", "other"])


def shared_passages(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text_key, first_word, end_word, n_words, other_id): runs of ``min_words`` words or more that another document has.

    Texts of equal words are one class: every member's span is its whole text, and the member with the smallest
    doc_id stands for them. Of each run of ``min_words`` words the smallest gram is a minimiser, so a shared
    passage has a shared minimiser. Only suffixes at minimisers whose gram two documents have are kept; they are
    sorted by their words over all tasks, each is compared with the next ones of other documents, and matches are
    extended left and right. Sorting cuts a gram with any number of suffixes over tasks; the suffixes at the ends
    of partitions are compared once more with those of the next.

    A suffix with no such match can still share a passage, mostly on its left, with a suffix further off. So for
    all suffixes of its gram the runs of ``min_words`` words about the minimiser are hashed and counted: no
    document with a shared passage is lost. A span's left end can be up to min_words - gram words late, where
    only a document further off has them, too.

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters; words from 0, end excluded.
    Null, empty and shorter texts have no spans; a repeated row (doc_id and text) is one document; documents
    without an id differ by their texts. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_key"), whole_text().alias("text"))
    hashed = texts.mapInArrow(partial(_documents, min_words=min_words, gram=gram), _DOCS)
    hashed = stage(hashed.filter(F.col("n_words") >= min_words), "minimisers")

    # classes of equal texts
    one = F.struct("doc_id", "text_key")
    members = hashed.select("doc_id", "text_key", "c1", "c2", "n_words").distinct()
    classes = members.groupBy("c1", "c2").agg(F.min(one).alias("least"), F.max(one).alias("most"), F.count(F.lit(1)).alias("n"))
    classes = stage(classes, "classes")
    copies = members.join(classes.filter("n > 1"), ["c1", "c2"])
    other = F.when(one == F.col("least"), F.col("most.doc_id")).otherwise(F.col("least.doc_id"))
    whole = copies.select("doc_id", "text_key", F.lit(0).alias("first"), F.col("n_words").alias("end"), other.alias("other"))

    stands = classes.select(F.col("least").alias("one"))
    grams = hashed.withColumn("one", one).join(stands, "one", "left_semi").select("one", F.explode("grams").alias("gram"))
    shared = grams.groupBy("gram").agg(F.min("one").alias("a"), F.max("one").alias("b")).filter("a <> b").select("gram")
    shared = stage(shared, "shared-grams")
    bits = spark.sparkContext.broadcast(key_filter(shared, filter_bits))
    suffixes = texts.mapInArrow(partial(_suffixes, shared=bits, min_words=min_words, gram=gram), _SUFFIXES)
    suffixes = suffixes.withColumn("one", one).join(stands, "one", "left_semi").drop("one")
    suffixes = stage(suffixes.join(shared, "gram", "left_semi").dropDuplicates(["doc_id", "text_key", "pos"]), "suffixes")

    order = ["right", "doc_id", "text_key", "pos"]
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = suffixes.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    found = stage(ordered.mapInArrow(partial(_neighbours, min_words=min_words, gram=gram), _NEIGHBOURS), "neighbours")
    matches = found.filter(F.col("kind") == _MATCH).select("doc_id", "text_key", "first", "end", "other")
    edges = _across_partitions(found, min_words, gram)

    open_grams = found.filter(F.col("kind") == _OPEN).select("gram").distinct()
    windows = suffixes.join(open_grams, "gram", "left_semi").mapInArrow(
        partial(_windows, min_words=min_words, gram=gram), "doc_id long, text_key long, first int, window binary"
    )
    windows = stage(windows, "windows")
    common = windows.groupBy("window").agg(F.min(one).alias("a"), F.max(one).alias("b")).filter("a <> b")
    met = windows.join(stage(common, "shared-windows"), "window")
    other = F.when(one == F.col("a"), F.col("b.doc_id")).otherwise(F.col("a.doc_id"))
    near = met.select("doc_id", "text_key", "first", (F.col("first") + min_words).alias("end"), other.alias("other"))

    spans = whole.unionByName(matches).unionByName(edges).unionByName(near).distinct()
    spans = spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "end", "other")).alias("spans"))  # of one document
    return spans.mapInArrow(_merged, _MATCHES).select(
        "doc_id",
        "text_key",
        F.col("first").alias("first_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("first")).alias("n_words"),
        F.col("other").alias("other_id"),
    )


def _across_partitions(found: DataFrame, min_words: int, gram: int) -> DataFrame:
    """Matches between the last document's suffixes of a partition and the first one's of the next."""
    ends = found.filter(F.col("kind").isin(_HEAD, _TAIL))
    parts = sorted(r["part"] for r in ends.select("part").distinct().collect())  # numbers of partitions
    if len(parts) < 2:
        return found.limit(0).select("doc_id", "text_key", "first", "end", "other")
    before = F.create_map(*[F.lit(x) for pair in zip(parts[1:], parts) for x in pair])
    seam = F.when(F.col("kind") == _TAIL, F.col("part")).otherwise(before[F.col("part")])

    def compare(table: pa.Table) -> pa.Table:
        names = ["right", "doc_id", "text_key", "pos"]
        # tails (kind 3) stand before heads (kind 2); each side is sorted as its partition was
        sides = []
        for kind in (_TAIL, _HEAD):
            side = table.filter(pc.equal(table.column("kind"), kind))
            keys = list(zip(*(side.column(n).to_pylist() for n in names)))
            order = sorted(range(len(keys)), key=lambda i: (keys[i][0], keys[i][1] is not None, keys[i][1] or 0, *keys[i][2:]))
            sides.append(side.take(pa.array(order, pa.int64())))
        rows = _Rows(pa.concat_tables(sides).combine_chunks(), min_words + _BEYOND, min_words - gram + 1)
        a, b, left, right, _ = _with_neighbours(rows, 0, len(rows.pos), min_words, gram)
        ids = rows.table.column("doc_id")
        return pa.table(
            {
                "doc_id": ids.take(pa.array(a)),
                "text_key": rows.table.column("text_key").take(pa.array(a)),
                "first": pa.array((rows.pos[a] - left).astype(np.int32)),
                "end": pa.array((rows.pos[a] + right).astype(np.int32)),
                "other": ids.take(pa.array(b)),
            }
        )

    seams = ends.withColumn("seam", seam).filter("seam is not null")
    columns = ["seam", "kind", "doc_id", "text_key", "pos", "gram", "right", "left"]
    return seams.select(*columns).groupBy("seam").applyInArrow(compare, _MATCHES)

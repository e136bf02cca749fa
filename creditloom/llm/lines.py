"""Line dedup: repeated and nearly repeated lines, by a join of deletion neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import in_filter, key_filter, slices, stage, whole_text

#: Lines of fewer words are only compared for equality: one word is too large a part of them.
MIN_WORDS = 8
#: Size of the filter that saves shuffling lines without a partner, whatever their number.
FILTER_BITS = 1 << 25

#: Documents whose lines a task holds as Python objects at once.
DOCS_AT_ONCE = 256

_POSITION = ["doc_id", "text_key", "line"]
_HALVES = ["head", "tail", "head_shorter", "tail_shorter"]
_LINES = "doc_id long, text_key long, line int, h1 long, h2 long, n int, " + ", ".join(f"{c} long" for c in _HALVES)


def words_of_line(line: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs without ASCII white space; lines with equal words are equal."""
    return line.lower().split()


def _hash(words: list[bytes], seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words), seed)


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether inserting, deleting or replacing at most one word makes the lines equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _as_long(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _lines(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, DOCS_AT_ONCE):
        row, line, h1, h2, n, halves = [], [], [], [], [], [[], [], [], []]
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            for number, raw in enumerate(text.as_py().split(b"\n")):
                words = words_of_line(raw)
                if not words:
                    continue
                digest = xxhash.xxh3_128_intdigest(b" ".join(words))
                row.append(i)
                line.append(number)
                h1.append(digest & (2**64 - 1))
                h2.append(digest >> 64)
                n.append(len(words))
                cuts = (0, 0, 0, 0)
                if len(words) >= min_words:
                    m, k = len(words) // 2, (len(words) - 1) // 2
                    cuts = _hash(words[:m]), _hash(words[-m:], 1)
                    cuts += cuts if k == m else (_hash(words[:k]), _hash(words[-k:], 1))
                for values, cut in zip(halves, cuts):
                    values.append(cut)
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(line, pa.int32()), _as_long(h1), _as_long(h2),
             pa.array(n, pa.int32()), *map(_as_long, halves)],
            ["doc_id", "text_key", "line", "h1", "h2", "n", *_HALVES],
        )


def _wanted(batches: Iterator[pa.RecordBatch], filters: Broadcast, min_words: int) -> Iterator[pa.RecordBatch]:
    """The words of lines that the filter lets through."""
    table = np.frombuffer(filters.value, np.uint8)
    for batch in slices(batches, DOCS_AT_ONCE):
        row, line, hashes, words = [], [], [], []
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            for number, raw in enumerate(text.as_py().split(b"\n")):
                parts = words_of_line(raw)
                if len(parts) >= min_words:
                    row.append(i)
                    line.append(number)
                    words.append(b" ".join(parts))
                    hashes.append(xxhash.xxh3_128_intdigest(words[-1]) & (2**64 - 1))
        keep = np.flatnonzero(in_filter(table, np.array(hashes, np.uint64)))
        at = pa.array(np.array(row, np.int64)[keep])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(np.array(line, np.int32)[keep]),
             pa.array([words[k] for k in keep], pa.binary())],
            ["doc_id", "text_key", "line", "words"],
        )


def _sharing(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """Lines with a half that the filter lets through, and which halves."""
    table = np.frombuffer(shared.value, np.uint8)
    for batch in batches:
        keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        hit = in_filter(table, keys).reshape(batch.num_rows, -1)
        shares = (hit * (1 << np.arange(hit.shape[1]))).sum(axis=1).astype(np.int32)
        columns = [batch.column(c) for c in ("h1", "h2", "at")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(shares)], ["h1", "h2", "at", "shares"]).filter(pa.array(shares > 0))


#: What a row of a variant key is: one of equally long lines that differ in one place, a line that the key
#: is the hash of, a line that gives it by a deletion.
_SAME, _SHORTER, _LONGER = 0, 1, 2
#: Halves that a line shares with another: as one of equal length, as the shorter, as the longer; head, tail.
_SAME_HEAD, _SAME_TAIL, _SHORT_HEAD, _SHORT_TAIL, _LONG_HEAD, _LONG_TAIL = (1 << i for i in range(6))


def variants_of(words: list[bytes], shares: int) -> list[tuple[int, int]]:
    """(role, 128-bit key) of the line's variants within one edit, but for those inside a half that is shared."""
    n = len(words)
    half, shorter_half = n // 2, (n - 1) // 2
    same = range(half if not shares & _SAME_TAIL else 0, n if shares & _SAME_HEAD else n - half)
    longer = range(shorter_half if not shares & _LONG_TAIL else 0, n if shares & _LONG_HEAD else n - shorter_half)
    if not shares & (_SAME_HEAD | _SAME_TAIL):
        same = range(0)
    if not shares & (_LONG_HEAD | _LONG_TAIL):
        longer = range(0)
    digest = xxhash.xxh3_128_intdigest
    left = {j: b" ".join(words[:j] + words[j + 1 :]) for j in {*same, *longer}}
    out = [(_SAME, digest(b"%d of %d:" % (j, n) + left[j])) for j in same]
    out += [(_LONGER, digest(v)) for v in dict.fromkeys(left[j] for j in longer)]  # equal neighbours give equal variants
    if shares & (_SHORT_HEAD | _SHORT_TAIL):
        out.append((_SHORTER, digest(b" ".join(words))))
    return out


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row: list[int] = []
        role: list[int] = []
        keys: list[int] = []
        lines = list(zip(batch.column("words").to_pylist(), batch.column("shares").to_pylist()))
        for i, (line, shares) in enumerate(lines):
            for kind, key in variants_of(line.split(), shares):
                row.append(i)
                role.append(kind)
                keys.append(key)
            if len(row) >= 1 << 17 or i + 1 == len(lines):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("at").take(pa.array(row, pa.int64())), pa.array(role, pa.int32()),
                     _as_long([k & (2**64 - 1) for k in keys]), _as_long([k >> 64 for k in keys])],
                    ["at", "role", "k1", "k2"],
                )
                row, role, keys = [], [], []


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("words").to_pylist(), batch.column("first_words").to_pylist())
        near = pa.array([within_one_edit(a.split(), b.split()) for a, b in pairs], pa.bool_())
        yield batch.select(["at"]).filter(near)


def _near_dropped(docs: DataFrame, distinct: DataFrame, min_words: int, filter_bits: int) -> DataFrame:
    """(h1, h2) of the different lines that an earlier line is within one edit of.

    Two lines of at least n and at most n + 1 words within one edit share their first or their last n // 2
    words. Only lines that share such a half with another go on (nothing is lost: halves are compared at the
    shorter line's n), and only with the variants outside that half. Variants meet as equal keys. Lines that
    give one key by replacing one place are within one edit of one another; a line and those that give it by a
    deletion, too. So each needs only the earliest of its key: an aggregate, not pairs.
    """
    long = distinct.filter(F.col("n") >= min_words)
    kinds = [
        (_SAME_HEAD, "n", "head"), (_SAME_TAIL, "n", "tail"), (_SHORT_HEAD, "n", "head"), (_SHORT_TAIL, "n", "tail"),
        (_LONG_HEAD, F.col("n") - 1, "head_shorter"), (_LONG_TAIL, F.col("n") - 1, "tail_shorter"),
    ]
    same = _SAME_HEAD | _SAME_TAIL
    keys = [F.xxhash64(F.lit(kind & same > 0), n, F.lit("head" in c), c) for kind, n, c in kinds]
    halves = F.array(*[F.struct(key.alias("key"), F.lit(kind).alias("kind")) for key, (kind, _, _) in zip(keys, kinds)])
    keyed = long.select(F.explode(halves).alias("half")).select("half.key", "half.kind")
    of = [F.count_if(F.col("kind").bitwiseAND(mask) > 0) for mask in (same, _SHORT_HEAD | _SHORT_TAIL, _LONG_HEAD | _LONG_TAIL)]
    shared = keyed.groupBy("key").agg(*[n.alias(f"n{i}") for i, n in enumerate(of)])
    shared = shared.filter("n0 > 1 or (n1 > 0 and n2 > 0)").select("key")
    context = docs.sparkSession.sparkContext
    # a line that only the filter's collisions let through has variants that meet nothing
    hits = context.broadcast(key_filter(shared, filter_bits))
    candidates = long.select("h1", "h2", "at", F.array(*keys).alias("keys")).mapInArrow(
        partial(_sharing, shared=hits), f"h1 long, h2 long, at {_type_of_position()}, shares int"
    )
    candidates = stage(candidates, "candidates")
    bits = context.broadcast(key_filter(candidates.select("h1"), filter_bits))
    found = _keyed(docs).mapInArrow(
        partial(_wanted, filters=bits, min_words=min_words), "doc_id long, text_key long, line int, words binary"
    )
    found = found.select(F.struct(*_POSITION).alias("at"), "words")
    lines = stage(found.join(candidates, "at").dropDuplicates(["at"]), "lines")

    variants = lines.mapInArrow(_variants, f"at {_type_of_position()}, role int, k1 long, k2 long")
    firsts = variants.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("times"),
        *[F.min(F.when(F.col("role") == role, F.col("at"))).alias(f"first{role}") for role in (_SAME, _SHORTER, _LONGER)],
    )
    firsts = stage(firsts.filter("times > 1").drop("times"), "firsts")
    first = F.when(F.col("role") == _SAME, F.col("first0")).when(F.col("role") == _LONGER, F.col("first1")).otherwise(F.col("first2"))
    pairs = variants.join(firsts, ["k1", "k2"]).withColumn("first", first).filter("first < at")
    pairs = stage(pairs.select("at", "first").distinct(), "pairs")
    texts = lines.select("at", "words")
    both = pairs.join(texts, "at").join(texts.select(F.col("at").alias("first"), F.col("words").alias("first_words")), "first")
    near = both.select("at", "words", "first_words").mapInArrow(_verify, f"at {_type_of_position()}").distinct()
    return near.join(lines.select("at", "h1", "h2"), "at").select("h1", "h2")


def _type_of_position() -> str:
    return "struct<doc_id: long, text_key: long, line: int>"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(whole_text()).alias("text_key"), whole_text().alias("text"))


def dropped_lines(docs: DataFrame, near: bool = True, min_words: int = MIN_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text_key, line) of every line that goes; lines count from 0.

    Lines are compared by their words, A-Z lower-cased. A line goes if a line before it has the same words or,
    both having ``min_words`` words at least and ``near`` set, is within one inserted, deleted or replaced
    word. Before: by doc_id (null first), then the text's hash, then the line number. Lines without words stay.
    """
    lines = stage(_keyed(docs).mapInArrow(partial(_lines, min_words=min_words), _LINES), "line-hashes")
    distinct = lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*_POSITION)).alias("at"), F.count(F.lit(1)).alias("times"), F.max("n").alias("n"),
        *[F.max(c).alias(c) for c in _HALVES],
    )
    distinct = stage(distinct, "distinct-lines")
    repeated = distinct.filter("times > 1").select("h1", "h2", "at")
    if near:
        none = F.lit(None).cast(_type_of_position())
        gone = stage(_near_dropped(docs, distinct, min_words, filter_bits), "near-lines").withColumn("at", none)
        repeated = repeated.join(gone.select("h1", "h2"), ["h1", "h2"], "left_anti").union(gone)
    repeated = stage(repeated.withColumnRenamed("at", "stays"), "repeated")
    met = lines.select("h1", "h2", *_POSITION).join(repeated, ["h1", "h2"])
    return met.filter(F.col("stays").isNull() | (F.struct(*_POSITION) != F.col("stays"))).select(*_POSITION)


def _cut(batches: Iterator[pa.RecordBatch], counts: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Take the lines numbered in __gone out of the texts."""
    for batch in slices(batches, DOCS_AT_ONCE):
        texts, n_lines, n_dropped = [], [], []
        for text, gone in zip(batch.column("text"), batch.column("__gone").to_pylist()):
            text = text.as_py()
            lines, skip = [] if text is None else text.split("\n"), set(gone or ())
            texts.append("\n".join(x for i, x in enumerate(lines) if i not in skip) if skip else text)
            n_lines.append(len(lines))
            n_dropped.append(len(skip))
        names = [n for n in batch.schema.names if n != "__gone"]
        columns = [pa.array(texts, batch.column(n).type) if n == "text" else batch.column(n) for n in names]
        columns += [pa.array(n_lines, pa.int32()), pa.array(n_dropped, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, [*names, *counts])


def dedup_lines(
    docs: DataFrame,
    near: bool = True,
    min_words: int = MIN_WORDS,
    filter_bits: int = FILTER_BITS,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with the columns ``counts``, numbers of lines and of those dropped, and without ``dropped_lines`` in their texts.

    Rows stay, also those whose lines all go (their text is empty then); texts without a dropped line are
    unchanged, nulls stay null. Rows that repeat a doc_id and its text are one document: they keep the same
    lines. Extra columns go through (those named as ``counts`` are replaced); an empty table gives an
    empty result.
    """
    gone = dropped_lines(docs, near, min_words, filter_bits).distinct()
    gone = gone.groupBy(F.struct("doc_id", "text_key").alias("__row")).agg(F.collect_list("line").alias("__gone"))  # of one text
    rows = docs.withColumn("__row", F.struct("doc_id", F.xxhash64(whole_text()).alias("text_key"))).join(gone, "__row", "left")
    rows = rows.drop("__row", *counts)
    schema = T.StructType(rows.drop("__gone").schema.fields)
    for name in counts:
        schema = schema.add(name, T.IntegerType())
    return rows.mapInArrow(partial(_cut, counts=counts), schema)

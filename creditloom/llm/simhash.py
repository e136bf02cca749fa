"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import runs, stage, whole_text
from creditloom.llm.components import components

SHINGLE = 3
MAX_BITS = 3
#: Members of one signature bucket that a task compares with one another; larger ones go by centres.
BUCKET = 2048
_BITS = 64


def fingerprint(text: str | bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the whole text: bit b is 1 if set in over half of the shingles' XXH64 (seed 42).

    A-Z is lower-cased; words are runs without ASCII white space; a text of fewer words than a shingle
    is one shingle; a text without words has fingerprint 0.
    """
    words = (text if isinstance(text, bytes) else text.encode()).lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)))
    digest = xxhash.xxh64_intdigest
    total = np.zeros(_BITS, np.int64)
    n = len(words) - shingle + 1
    for at in range(0, n, 1 << 15):  # bounded memory for any length
        to = min(n, at + (1 << 15))
        cuts = zip(starts[at:to].tolist(), (starts[at + shingle : to + shingle] - 1).tolist())
        hashes = np.fromiter((digest(line[a:b], 42) for a, b in cuts), np.uint64, to - at)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        values = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, batch.num_rows)
        columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(values.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])


def text_key() -> Column:
    """Tells rows apart that share a doc_id or have none."""
    return F.xxhash64(whole_text())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp): one row for each row of ``docs``; a null text counts as empty."""
    return docs.select("doc_id", whole_text().alias("text"), text_key().alias("text_key")).mapInArrow(
        partial(_fingerprints, shingle=shingle), "doc_id long, text_key long, fp long"
    )


def _spanning(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the same members as all links of at most ``max_bits`` do: one fewer than members at most."""
    left, links = members, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(left ^ node) <= max_bits
            if near.any():
                found = left[near]
                links += [(node, x) for x in found]
                queue += list(found)
                left = left[~near]
    return links


def _bucket_links(frames: Iterator[pd.DataFrame], max_bits: int, bucket: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (key, fp). Links within each bucket; members of a larger one as (fp, null)."""
    held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)
    over: int | None = None  # key of a large bucket whose first members have gone out

    def emit(keys: np.ndarray, fps: np.ndarray) -> tuple[list, list]:
        a, b = [], []
        for start, end in zip(*runs(keys)):
            if end - start < 2:
                continue
            members = fps[start:end]
            if end - start > bucket:
                a += members.tolist()
                b += [None] * len(members)
            elif end - start == 2:
                if int(members[0] ^ members[1]).bit_count() <= max_bits:
                    a.append(members[0])
                    b.append(members[1])
            else:
                for x, y in _spanning(members, max_bits):
                    a.append(x)
                    b.append(y)
        return a, b

    def frame(a: list, b: list) -> pd.DataFrame:
        hot = np.array([x is None for x in b], bool)
        right = np.array([0 if x is None else x for x in b], np.uint64).view(np.int64)
        return pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": right, "hot": hot})

    for batch in frames:
        keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
        if over is not None:  # the rest of a large bucket goes straight out
            n = int(np.searchsorted(keys, over, "right")) if len(keys) and keys[0] == over else 0
            if n:
                yield frame(fps[:n].tolist(), [None] * n)
            if n < len(keys):
                over = None
            keys, fps = keys[n:], fps[n:]
        if not len(keys):
            continue
        keys, fps = np.concatenate((held_key, keys)), np.concatenate((held, fps))
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if len(keys) - last > bucket:
            over = keys[-1]
            yield frame(fps[last:].tolist(), [None] * (len(keys) - last))
            held_key, held = keys[:0], fps[:0]
        else:
            held_key, held = keys[last:], fps[last:]
        a, b = emit(keys[:last], fps[:last])
        if a:
            yield frame(a, b)
    a, b = emit(held_key, held)
    if a:
        yield frame(a, b)


def _centres(frames: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Every value within max_bits - max_bits // 2 bits of each fingerprint; near: within max_bits // 2."""
    near_bits = max_bits // 2
    flips, near = [], []
    for k in range(max_bits - near_bits + 1):
        for bits in combinations(range(_BITS), k):
            flips.append(sum(1 << b for b in bits))
            near.append(k <= near_bits)
    flips, near = np.array(flips, np.uint64), np.array(near)
    for batch in frames:
        fps = batch["fp"].to_numpy().view(np.uint64)
        for at in range(0, len(fps), 64):
            part = fps[at : at + 64]
            yield pd.DataFrame(
                {
                    "centre": (part[:, None] ^ flips[None, :]).ravel().view(np.int64),
                    "fp": np.repeat(part, len(flips)).view(np.int64),
                    "near": np.tile(near, len(part)),
                }
            )


def centre_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect exactly what all pairs of at most ``max_bits`` bits connect, without pairs.

    Two values differ by at most d bits just if some centre is within d // 2 bits of one and d - d // 2 of
    the other. All values within d // 2 of a centre are linked with one another, so each value within
    d - d // 2 is linked to the smallest of them. The work is in proportion to the rows.
    """
    around = fps.mapInPandas(partial(_centres, max_bits=max_bits), "centre long, fp long, near boolean")
    hubs = around.filter("near").groupBy("centre").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n"))
    return around.join(hubs, "centre").filter("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between different fingerprints (column fp, distinct) with the components of all links.

    The 64 bits are cut into ceil((max_bits + 1) / 2) segments, so of two linked values one segment differs
    by at most one bit. Every segment goes out once for each of its bits with that bit wild; equal
    variants meet and are verified on all 64 bits.
    """
    n_segments = (max_bits + 2) // 2
    width = -(-_BITS // n_segments)
    masks = []
    for s in range(n_segments):
        bits = range(s * width, min(_BITS, (s + 1) * width))
        whole = sum(1 << b for b in bits)
        masks += [whole & ~(1 << b) for b in bits]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    table = F.array(*[F.lit(m).cast("long") for m in signed])
    variants = fps.select("fp", F.posexplode(table).alias("variant", "mask"))
    keyed = variants.select(F.xxhash64("variant", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp")
    met = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = stage(
        met.mapInPandas(partial(_bucket_links, max_bits=max_bits, bucket=bucket), "a long, b long, hot boolean"), "links"
    )
    links = found.filter("not hot").select("a", "b").distinct()
    hot = stage(found.filter("hot").select(F.col("a").alias("fp")).distinct(), "hot")
    return links if hot.isEmpty() else links.union(centre_links(hot, max_bits))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for each row of ``docs``.

    Documents whose fingerprints differ by at most ``max_bits`` bits are linked; component_id is the smallest
    doc_id reachable. Equal fingerprints are one node, so exact copies make no pairs. Null and empty texts have
    fingerprint 0 and are linked with one another; rows that repeat a doc_id are documents of their own; a
    null doc_id takes no part in the smallest (null if the component has no other). Extra columns are
    ignored; an empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    labels = components(fingerprint_links(nodes.select("fp"), max_bits, bucket))
    labelled = stage(
        nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp")), "labelled"
    )
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_node = stage(labelled.join(smallest, "label").select("fp", "component_id"), "components")
    return prints.join(of_node, "fp").select("doc_id", "text_key", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; columns unchanged.

    Rows that repeat a doc_id and its text are one document. Documents without a doc_id go if their component
    has a document with one; else each of their texts stays once.
    """
    rows = docs.withColumn("__row", F.struct(F.col("doc_id").alias("id"), text_key().alias("text")))
    first = near_duplicates(docs, shingle, max_bits, bucket).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.struct(F.col("doc_id").alias("id"), F.col("text_key").alias("text")).alias("__row")).distinct()
    return rows.join(first, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")

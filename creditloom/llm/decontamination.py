"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import in_filter, key_filter, stage, whole_text, words_of

SHINGLE = 5
CONTAINMENT = 0.8
HASHES = 32
#: Size of the filter of item keys that every task holds, whatever the number of items.
FILTER_BITS = 1 << 24
#: Documents are hashed together up to so many words.
_CHUNK_WORDS = 1 << 18
_SHORT = -1  # partition of sequences of fewer words than a shingle
_ANYWHERE = -2  # partition of items that repeat shingles, found by shingles at any place
_TOP = np.uint64(2**64 - 1)
_ODD = (np.random.default_rng(1).integers(0, 2**63, 512, np.uint64) << np.uint64(1)) | np.uint64(1)

_CANDIDATES = "doc_id long, text_key long, keys array<long>, words binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingle_hashes(crc: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of all runs of ``shingle`` consecutive words, from the words' hashes."""
    total = crc[: len(crc) - shingle + 1].copy()
    for j in range(1, shingle):
        total = total * np.uint64(0x9E3779B97F4A7C15) + crc[j : len(crc) - shingle + 1 + j]
    return _mixed(total)


def _crc(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _key(smallest: np.ndarray, part: int, i: int) -> np.ndarray:
    return _mixed(smallest + np.uint64((part + 2) * 4096 + i))


def _nth_hash(hashes: np.ndarray, i: int) -> np.ndarray:
    x = hashes * _ODD[i]
    return x ^ (x >> np.uint64(32))


def _short_key(words: list[bytes]) -> np.ndarray:
    return _key(np.array([zlib.crc32(b" ".join(words))], np.uint64), _SHORT, 0)


def shingles(words: list[bytes], shingle: int) -> set[tuple[bytes, ...]]:
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return set(zip(*[words[j:] for j in range(shingle)]))


def part_of(n_shingles: int) -> int:
    """Partition p holds sets of 2^p to 2^(p+1) - 1 shingles."""
    return n_shingles.bit_length() - 1


def _needed(hashes: np.ndarray, least: float) -> np.ndarray:
    """So many of the different shingles that a document with the share ``least`` of them has one of these."""
    different = np.unique(hashes)
    return different[: len(different) - math.ceil(least * len(different) - 1e-9) + 1]


def _item_keys(batches: Iterator[pa.RecordBatch], shingle: int, n_hashes: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        classes, keys, parts = [], [], []
        for item, data in zip(batch.column("item_class").to_pylist(), batch.column("words").to_pylist()):
            words = data.split()
            if len(words) < shingle:
                own, part = _short_key(words), _SHORT
            else:
                hashes, different = _shingle_hashes(_crc(words), shingle), len(shingles(words, shingle))
                if len(hashes) > different:
                    own, part = _key(_needed(hashes, least), _ANYWHERE, 0), _ANYWHERE
                else:
                    part = part_of(different)
                    own = np.concatenate([_key(_nth_hash(hashes, i).min(keepdims=True), part, i) for i in range(n_hashes)])
            classes += [item] * len(own)
            keys += own.view(np.int64).tolist()
            parts += [part] * len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes, pa.int64()), pa.array(keys, pa.int64()), pa.array(parts, pa.int32())], ["item_class", "key", "part"]
        )


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [b" ".join(words_of(t)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words, pa.binary())], ["item_id", "words"])


class _Blocks:
    """Blocks of 2^part shingles of each document of a chunk, and which neighbours share a document."""

    def __init__(self, place: np.ndarray, doc: np.ndarray, part: int, below: "_Blocks | None"):
        self.part = part
        self.starts = np.flatnonzero(place % (1 << part) == 0)
        self.inner = self.starts if below is None else np.searchsorted(below.starts, self.starts)
        self.doc, self.place = doc[self.starts], place[self.starts]
        self.apart = [self.doc[j:] != self.doc[:-j] for j in (1, 2)]

    def windows(self, smallest: np.ndarray) -> np.ndarray:
        """Minimum over each block and the two after it in its document."""
        out = smallest.copy()
        for j, apart in zip((1, 2), self.apart):
            if len(out) > j:
                out[:-j] = np.minimum(out[:-j], np.where(apart, _TOP, smallest[j:]))
        return out


def _chunk_hits(chunk: list[list[bytes]], parts: list[int], bits: np.ndarray, shingle: int, n_hashes: int) -> list[tuple]:
    """(document in the chunk, its different keys in the filter) of the documents with one."""
    lengths = np.array([len(w) for w in chunk])
    docs, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]

    def meet(of: np.ndarray, keys: np.ndarray) -> None:
        at = np.flatnonzero(in_filter(bits, keys))
        docs.append(of[at])
        found.append(keys[at])

    if _SHORT in parts:
        for d in np.flatnonzero((lengths < shingle) & (lengths > 0)):
            meet(np.array([d]), _short_key(chunk[d]))
    long = np.flatnonzero(lengths >= shingle)
    if len(long) and set(parts) - {_SHORT}:
        n = lengths[long] - shingle + 1
        crc = _crc([w for d in long for w in chunk[d]])
        word_starts = np.concatenate(([0], np.cumsum(lengths[long])[:-1]))
        place = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
        doc = np.repeat(long, n)
        hashes = _shingle_hashes(crc, shingle)[np.repeat(word_starts, n) + place]
        if _ANYWHERE in parts:
            meet(doc, _key(hashes, _ANYWHERE, 0))
        levels: list[_Blocks] = []
        for part in sorted(p for p in parts if p >= 0):
            levels.append(_Blocks(place, doc, part, levels[-1] if levels else None))
        for i in range(n_hashes if levels else 0):
            smallest = _nth_hash(hashes, i)
            for level in levels:
                smallest = np.minimum.reduceat(smallest, level.inner)
                meet(level.doc, _key(level.windows(smallest), level.part, i))
    docs, found = np.concatenate(docs), np.concatenate(found)
    order = np.argsort(docs, kind="stable")
    cuts = np.flatnonzero(np.diff(docs[order])) + 1
    return [(int(docs[own[0]]), np.unique(found[own])) for own in np.split(order, cuts) if len(own)]


def _candidates(
    batches: Iterator[pa.RecordBatch], parts: list[int], bits: Broadcast, shingle: int, n_hashes: int
) -> Iterator[pa.RecordBatch]:
    table = np.frombuffer(bits.value, np.uint8)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        at, held, chunk = 0, 0, []
        rows: list[tuple] = []
        for i in range(batch.num_rows + 1):
            if i < batch.num_rows:
                chunk.append(words_of(texts[i].as_py()))
                held += len(chunk[-1])
            if chunk and (held >= _CHUNK_WORDS or i == batch.num_rows):
                for d, keys in _chunk_hits(chunk, parts, table, shingle, n_hashes):
                    rows.append((at + d, keys.view(np.int64).tolist(), b" ".join(chunk[d])))
                at, held, chunk = at + len(chunk), 0, []
        if rows:
            row, keys, words = zip(*rows)
            index = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(index),
                    batch.column("text_key").take(index),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(words, pa.binary()),
                ],
                ["doc_id", "text_key", "keys", "words"],
            )


def _verified(batches: Iterator[pa.RecordBatch], shingle: int, least: float) -> Iterator[pa.RecordBatch]:
    """The pairs whose document has enough of the item's different shingles, wherever they are."""
    last, places = None, {}
    for batch in batches:
        share, first = [], []
        cache: dict[bytes, set] = {}
        for text, item in zip(batch.column("words").to_pylist(), batch.column("item_words").to_pylist()):
            want = cache.get(item)
            if want is None:
                want = cache[item] = shingles(item.split(), shingle)
            if text != last:
                last, words = text, text.split()
                size = min(shingle, len(words))
                places = {}
                for i, s in enumerate(zip(*[words[j:] for j in range(size)])):
                    places.setdefault(s, i)
            at = [places[s] for s in want if s in places]
            share.append(len(at) / len(want) if len(at) >= least * len(want) - 1e-9 else None)
            first.append(min(at, default=0))
        share = pa.array(share, pa.float64())
        columns = [batch.column("doc_id"), batch.column("text_key"), batch.column("item_class"), share, pa.array(first, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "item_class", "containment", "first_word"]).filter(pc.is_valid(share))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    containment: float = CONTAINMENT,
    n_hashes: int = HASHES,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, text_key, item_id, n_items, containment, first_word): the items that each document holds.

    A document holds an item if it has at least ``containment`` of the item's different shingles, wherever they
    are; first_word is the place of the first of these. Candidates are found by windows. Items are partitioned by
    size: partition p has items of 2^p to 2^(p+1) - 1 shingles, and for it windows are three blocks of 2^p
    shingles, one from every block on, so any run of an item's length lies in one. An item that repeats shingles
    is longer than its number of different ones says: it goes without windows, by so many of its shingles that
    no document can hold the item without one of them, found at any place. A window holding the whole item has a Jaccard similarity of a third at least, whatever the document's
    length; it is a candidate if one of ``n_hashes`` minima equals the item's (32: all but about 2 in a million
    verbatim items, 1 in 10,000 at the limit). Candidates are verified on the words of the whole document. Keys of items go to every
    task as a filter of fixed size, which only saves shuffling; the equality join decides.

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. Items of equal words are one,
    under the smallest item_id, ``n_items`` of them (null ids count, too). An item of fewer words than a shingle
    is held by a document that consists of these words; empty items and null texts are held by none. Rows that
    repeat a doc_id with other text are documents of their own. Extra columns are ignored; an empty table on
    either side gives an empty result.
    """
    spark = docs.sparkSession
    normal = benchmark.select("item_id", whole_text().alias("text")).mapInArrow(_normal, "item_id long, words binary")
    items = stage(
        normal.filter("length(words) > 0").groupBy("words").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"))
        .withColumn("item_class", F.xxhash64("words")),
        "items",
    )
    keys = items.select("item_class", "words").mapInArrow(
        partial(_item_keys, shingle=shingle, n_hashes=n_hashes, least=containment), "item_class long, key long, part int"
    )
    keys = stage(keys, "item-keys")
    parts = sorted(r["part"] for r in keys.select("part").distinct().collect())  # at most one for each power of two
    bits = spark.sparkContext.broadcast(key_filter(keys.select("key"), filter_bits))
    rows = docs.select("doc_id", whole_text().alias("text"), F.xxhash64(whole_text()).alias("text_key"))
    found = rows.mapInArrow(
        partial(_candidates, parts=parts, bits=bits, shingle=shingle, n_hashes=n_hashes), _CANDIDATES
    )
    found = stage(found.withColumn("document", F.struct("doc_id", "text_key")), "candidates")
    met = found.select("document", F.explode("keys").alias("key")).join(keys.select("key", "item_class"), "key")
    pairs = stage(met.select("document", "item_class").distinct(), "pairs")
    texts = pairs.join(items.select("item_class", F.col("words").alias("item_words")), "item_class")
    checked = texts.join(found.drop("keys").dropDuplicates(["document"]), "document").select(
        "doc_id", "text_key", "item_class", "words", "item_words"
    )
    held = checked.mapInArrow(
        partial(_verified, shingle=shingle, least=containment),
        "doc_id long, text_key long, item_class long, containment double, first_word long",
    )
    held = held.groupBy("doc_id", "text_key", "item_class").agg(
        F.max("containment").alias("containment"), F.min("first_word").alias("first_word")
    )
    names = items.select("item_class", "item_id", "n_items")
    return held.join(names, "item_class").select("doc_id", "text_key", "item_id", "n_items", "containment", "first_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold an item of ``benchmark``; columns and repeated rows unchanged."""
    held = contaminated(docs, benchmark, **options).select(F.struct("doc_id", "text_key").alias("__row"))
    rows = docs.withColumn("__row", F.struct("doc_id", F.xxhash64(whole_text()).alias("text_key")))
    return rows.join(held, "__row", "left_anti").drop("__row")

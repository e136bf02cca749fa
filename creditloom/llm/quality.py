"""Quality classifier: a modified Kneser-Ney model of trusted text, perplexity by sharded joins of word n-gram counts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import in_filter, key_filter, slices, stage, whole_text
from creditloom.sources.staging import fresh_path, temporary_tables

#: Words that the uniform distribution below the lower order spreads over; nothing is counted by it.
CLASSES = 1 << 20
#: Counts are dealt by hash to so many shards at least, and to more where a shard would hold more than so many
#: pairs, or the requests of more than so many documents.
SHARDS = 64
SHARD_COUNTS = 1 << 19
SHARD_DOCS = 1 << 13
#: Documents are scored in blocks of about so many words, and their counts dealt in parts of so many keys.
BLOCK_WORDS = 1 << 20
#: Documents are counted in parts of about so many words; Spark sums a task's parts before the shuffle.
PART_WORDS = 1 << 18
#: Pairs are counted in so many rounds by key, documents scored in so many rounds by id and text.
#: A round's shuffle files go at its end, so they take their share of the disk only.
COUNT_ROUNDS = 2
ROUNDS = 4
#: A document's mean is taken together with so many words at its language's mean.
PRIOR_WORDS = 50
QUANTILE = 0.998
FILTER_BITS = 1 << 24
#: Log-probabilities are whole multiples of 1 / SCALE nats, so sums are the same in any order.
SCALE = 1000

#: Documents that are split into words at once, and pairs whose keys or costs are worked out at once.
_SLICE = 256
_STRETCH = 1 << 16
_PAIRS = "context long, word long, n long"
_COUNTS = ["n", "after", "ones", "twos", "more"]
_DEALT = "shard int, words binary, counts binary, pairs binary, times binary"
_ASKED = (
    "block long, shard int, vocabulary binary, pairs binary, tokens binary, doc_id array<long>, text_key array<long>, "
    "lang array<string>, words array<long>"
)
_ANSWERED = (
    "block long, shard int, vocabulary binary, counts binary, times binary, tokens binary, doc_id array<long>, "
    "text_key array<long>, lang array<string>, words array<long>"
)
_SCORED = "doc_id long, text_key long, lang string, words long, cost long"
_CARRIED = ("tokens", "doc_id", "text_key", "lang", "words")


class Scale(NamedTuple):
    """What all words of a model share: discounts of both orders, number of different pairs, mass below the lower order."""

    pair: tuple[float, float, float]
    word: tuple[float, float, float]
    pairs: int
    spread: float


def _give_back() -> None:
    """Memory that Arrow does not use goes to the system: Spark keeps a task's Python process for later tasks."""
    pa.default_memory_pool().release_unused()


def _hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.maximum(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), np.uint64(1))


def word_classes(text: bytes) -> np.ndarray:
    """64-bit hash, never 0, of every word, a run without ASCII white space as it stands; 0 is a text's start and end."""
    return _hashes(text.split())


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts, one after the other, and the number of each text."""
    lists = pc.ascii_split_whitespace(texts)
    words, lengths = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty word
    of = np.repeat(np.arange(len(lengths)), lengths)[some.to_numpy(zero_copy_only=False)]
    return words.filter(some), np.bincount(of, minlength=len(lengths))


def _stream(words: list[pa.Array], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words as places in their ascending different hashes, with a 0 before, between and after the texts; the hashes."""
    coded = pa.chunked_array(words, pa.string()).dictionary_encode().combine_chunks()
    if isinstance(coded, pa.ChunkedArray):
        coded = pa.concat_arrays(coded.chunks)
    known = _hashes(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False))
    vocabulary, places = np.unique(np.append(np.uint64(0), known), return_inverse=True)
    tokens = np.zeros(lengths.sum() + len(lengths) + 1, np.int32)
    is_word = np.ones(len(tokens), bool)
    is_word[np.append(0, np.cumsum(lengths + 1))] = False
    tokens[is_word] = places[1:].astype(np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
    return tokens, vocabulary


def _pair_keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    # the constant keeps the pair of an empty text, (0, 0), apart from the key of the word 0
    x = contexts >> np.uint64(29)
    x ^= contexts
    x *= np.uint64(0x9E3779B97F4A7C15)
    x += words
    x += np.uint64(0x632BE59BD9B4E019)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _loosened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, so that high bytes of zero take no room."""
    return _squeezed(np.ascontiguousarray(values.reshape(-1)).view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unpacked(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(_loosened(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def _ascending(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _from_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _texts(batches: Iterator[pa.RecordBatch], ids: Broadcast) -> Iterator[pa.RecordBatch]:
    """Documents whose id may be one of the trusted ids."""
    table = np.frombuffer(ids.value, np.uint8)
    for batch in batches:
        batch = batch.filter(pa.array(in_filter(table, batch.column("doc_id").to_numpy(zero_copy_only=False).view(np.uint64))))
        texts = pa.array([_squeezed(t.as_py()) for t in batch.column("text").cast(pa.binary())], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "packed"])


def _counts(batches: Iterator[pa.RecordBatch], number: int, rounds: int) -> Iterator[pa.RecordBatch]:
    """(context, word, n) of a task's documents, in parts of a bounded number of pairs; only those of one round."""
    held, lengths = [], []

    def out() -> pa.RecordBatch:
        # a text's 0 at its end is the start of the next one's first pair
        tokens, vocabulary = _stream(held, np.array(lengths, np.int64))
        stream = vocabulary[tokens]
        keys = _pair_keys(stream[:-1], stream[1:])
        mine = np.flatnonzero(keys % np.uint64(rounds) == number)
        _, first, n = np.unique(keys[mine], return_index=True, return_counts=True)
        at = mine[first]
        columns = [pa.array(stream[at].view(np.int64)), pa.array(stream[at + 1].view(np.int64)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["context", "word", "n"])

    size = 0
    for batch in slices(batches, _SLICE):
        texts = pa.array([_loosened(value.as_py()) for value in batch.column("packed")], pa.binary())
        words, n = _split(texts.view(pa.string()))
        held.append(words)
        lengths += n.tolist()
        size += n.sum() + len(n)
        if size >= PART_WORDS:
            yield out()
            held, lengths, size = [], [], 0
            _give_back()
    if held:
        yield out()


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        context, word = (batch.column(c).to_numpy().view(np.uint64) for c in ("context", "word"))
        yield pa.RecordBatch.from_arrays([pa.array(_pair_keys(context, word).view(np.int64)), batch.column("n")], ["key", "n"])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the numbers of counts 1 to 4.

    Each stays within (0, its count); where the numbers give no estimate (a zero among them, as on very
    small or saturated tables), it is half its count.
    """
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def _of(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.choose(np.minimum(counts, 3), (0.0, *d))


def _below(continuations: np.ndarray, d: tuple[float, float, float], total: int, spread: float) -> np.ndarray:
    if not total:
        return np.full(len(continuations), 1 / CLASSES)
    return (continuations - _of(continuations, d)) / total + spread / total / CLASSES


def _costs(n: np.ndarray, total: np.ndarray, left: np.ndarray, below: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Negative log-probability of pairs of count n in contexts of this total, of which ``left`` is discounted."""
    some = np.maximum(total, 1)
    p = (n - _of(n, d)) / some + np.where(total > 0, left / some, 1.0) * below
    return np.round(-np.log(p) * SCALE).astype(np.int64)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the rows with quality 1; ids that any row marks otherwise, and null ids, are left out."""
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("least"))
    return known.filter("least = 1").select("doc_id")


def held_out() -> Column:
    """One trusted document in five sets the thresholds and is not trained on."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def _by_rounds(frames: list[DataFrame], path: str) -> DataFrame:
    """The rows of all frames, written one frame after the other."""
    for frame in frames:
        frame.write.mode("append").parquet(path)
    return frames[0].sparkSession.read.schema(frames[0].schema).parquet(path)


def train(docs: DataFrame, trusted: DataFrame) -> tuple[DataFrame, Scale]:
    """The counts of the documents whose ids are in ``trusted``, one row per word and per pair of words, and what they share.

    A pair's row has its ``n``; a word's has ``n`` as a context, the number of different contexts before it
    (``after``) and of different words after it that come once, twice and more often. Words are 64-bit hashes;
    pairs are counted in every task, then summed over all tasks, and nothing bounds their number.
    """
    spark = docs.sparkSession
    ids = spark.sparkContext.broadcast(key_filter(trusted.select("doc_id"), FILTER_BITS))
    texts = docs.filter("doc_id is not null").select("doc_id", whole_text().alias("text"))
    some = texts.mapInArrow(partial(_texts, ids=ids), "doc_id long, packed binary")
    texts = some.join(trusted.select("doc_id"), "doc_id", "left_semi").select("packed")
    rounds = [texts.mapInArrow(partial(_counts, number=k, rounds=COUNT_ROUNDS), _PAIRS) for k in range(COUNT_ROUNDS)]
    counts = _by_rounds([r.groupBy("context", "word").agg(F.sum("n").alias("n")) for r in rounds], fresh_path(spark, "pair-counts"))
    none = F.lit(0).cast("long")
    kinds = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2)]
    contexts = counts.groupBy(F.col("context").alias("key")).agg(
        F.sum("n").alias("n"), none.alias("after"), *(k.alias(c) for k, c in zip(kinds, ("ones", "twos", "more")))
    )
    after = counts.groupBy(F.col("word").alias("key")).agg(F.count(F.lit(1)).alias("after"))
    words = contexts.unionByName(after.select("key", none.alias("n"), "after", *(none.alias(c) for c in ("ones", "twos", "more"))))
    words = stage(words.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n", "after", "ones", "twos", "more"))), "word-counts")

    def times(df: DataFrame, column: str) -> dict[int, int]:
        rows = df.filter(f"{column} > 0").groupBy(F.least(F.col(column), F.lit(5)).alias("n")).agg(F.count(F.lit(1)).alias("times"))
        return {r["n"]: r["times"] for r in rows.collect()}  # at most five rows

    of, of_after = times(counts, "n"), times(words, "after")
    d, d1 = (discounts(*(o.get(k, 0) for k in (1, 2, 3, 4))) for o in (of, of_after))
    spread = sum(d1[min(k, 3) - 1] * n for k, n in sorted(of_after.items()))
    pairs = counts.mapInArrow(_keyed, "key long, n long").select("key", "n", *(none.alias(c) for c in ("after", "ones", "twos", "more")))
    return words.unionByName(pairs), Scale(d, d1, sum(of.values()), spread)


def _different(keys: np.ndarray) -> np.ndarray:
    """The different keys, ascending; ``keys`` are sorted in place."""
    keys.sort()
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _cut_by_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard begins among ascending keys; they are dealt by their first bits."""
    return np.searchsorted(keys >> np.uint64(64 - int(math.log2(shards))), np.arange(shards + 1, dtype=np.uint64))


def _dealt(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """A task's counts, in parts of a bounded number of keys, in one row a shard: all counts of words, of pairs their number."""
    words, pairs, size = [], [], 0

    def out() -> pa.RecordBatch:
        columns = {"shard": pa.array(range(shards), pa.int32())}
        for name, values, held in (("words", "counts", words), ("pairs", "times", pairs)):
            rows = np.concatenate(held, axis=1)
            held.clear()
            rows = rows[:, np.argsort(rows[0].view(np.uint64))]
            keys, counts = rows[0].view(np.uint64), rows[1:]
            cuts = _cut_by_shard(keys, shards)
            columns[name] = pa.array([_ascending(keys[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
            columns[values] = pa.array([_packed(counts[:, a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in ("key", *_COUNTS)])
        is_word = rows[2:].any(axis=0)
        words.append(rows[:, is_word])
        pairs.append(rows[:2, ~is_word])
        size += batch.num_rows
        if size >= BLOCK_WORDS:
            yield out()
            size = 0
            _give_back()
    if size:
        yield out()


def _merged(parts: pa.Table) -> pa.Table:
    """The rows of one shard in one, keys ascending."""
    columns = {"shard": pa.array([parts.column("shard")[0].as_py()], pa.int32())}
    for name, values, k in (("words", "counts", len(_COUNTS)), ("pairs", "times", 1)):
        keys = np.concatenate([_from_ascending(x.as_py()) for x in parts.column(name)])
        counts = np.concatenate([_unpacked(x.as_py(), np.int64).reshape(k, -1) for x in parts.column(values)], axis=1)
        order = np.argsort(keys)
        columns |= {name: pa.array([_ascending(keys[order])], pa.binary()), values: pa.array([_packed(counts[:, order])], pa.binary())}
    return pa.table(columns)


def deal(model: DataFrame, shards: int, path: str) -> DataFrame:
    """The counts that ``train`` gives, one row for each shard, written at ``path``."""
    parts = model.select("key", *_COUNTS).mapInArrow(partial(_dealt, shards=shards), _DEALT)
    return _by_rounds([parts.groupBy("shard").applyInArrow(_merged, _DEALT)], path)


def _asked(tokens: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """The key of each pair as it stands."""
    keys = np.empty(len(tokens) - 1, np.uint64)
    for at in range(0, len(keys), _STRETCH):
        words = vocabulary[tokens[at : at + _STRETCH + 1]]
        keys[at : at + _STRETCH] = _pair_keys(words[:-1], words[1:])
    return keys


def _carrier(number: int, shards: int) -> int:
    """The shard whose row carries a block's documents: a task's blocks are dealt from its own place on."""
    return ((number >> 32) + number) % shards


def _block(rows: list[pa.RecordBatch], words: list[pa.Array], lengths: np.ndarray, number: int, shards: int) -> pa.RecordBatch:
    """One row for each shard, with the block's different keys in it; one of them carries the block's documents."""
    tokens, vocabulary = _stream(words, lengths)

    def by_shard(keys: np.ndarray) -> pa.Array:
        cuts = _cut_by_shard(keys, shards)
        return pa.array([_ascending(keys[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())

    def once(value, kind: pa.DataType) -> pa.Array:
        return pa.array([value if i == _carrier(number, shards) else None for i in range(shards)], kind)

    def column(name: str) -> list:
        return [x for r in rows for x in r.column(name).to_pylist()]

    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * shards, pa.int64()),
            pa.array(range(shards), pa.int32()),
            by_shard(vocabulary),
            by_shard(_different(_asked(tokens, vocabulary))),
            once(_packed(tokens), pa.binary()),
            once(column("doc_id"), pa.list_(pa.int64())),
            once(column("text_key"), pa.list_(pa.int64())),
            once(column("lang"), pa.list_(pa.string())),
            once(lengths.tolist(), pa.list_(pa.int64())),
        ],
        ["block", "shard", "vocabulary", "pairs", *_CARRIED],
    )


def _blocks(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    number, held, rows, words, lengths = TaskContext.get().partitionId() << 32, 0, [], [], []
    for batch in slices(batches, _SLICE):
        split, n = _split(batch.column("text"))
        rows.append(batch.select(["doc_id", "text_key", "lang"]))
        words.append(split)
        lengths.append(n)
        held += len(split) + len(n)
        if held >= BLOCK_WORDS:
            yield _block(rows, words, np.concatenate(lengths), number, shards)
            number, held, rows, words, lengths = number + 1, 0, [], [], []
            _give_back()
    if rows:
        yield _block(rows, words, np.concatenate(lengths), number, shards)


def _looked_up(want: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The counts of the wanted keys, 0 where there are none."""
    found = np.zeros((len(counts), len(want)), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        known = keys[at] == want
        found[:, known] = counts[:, at[known]]
    return found


def _answers(asked: pa.Table, model: pa.Table) -> pa.Table:
    """The counts of every key that the blocks ask one shard for, 0 where the model has none."""
    none = np.empty(0, np.uint64)
    words, counts, pairs, times = none, np.empty((len(_COUNTS), 0), np.int64), none, np.empty((1, 0), np.int64)
    if model.num_rows:
        of = {c: model.column(c)[0].as_py() for c in ("words", "counts", "pairs", "times")}
        words, pairs = _from_ascending(of["words"]), _from_ascending(of["pairs"])
        counts, times = (_unpacked(of[c], np.int64).reshape(k, -1) for c, k in (("counts", len(_COUNTS)), ("times", 1)))
    found = [_packed(_looked_up(_from_ascending(x.as_py()), words, counts)) for x in asked.column("vocabulary")]
    met = [_packed(_looked_up(_from_ascending(x.as_py()), pairs, times)) for x in asked.column("pairs")]
    kept = {c: asked.column(c) for c in ("block", "shard", "vocabulary")}
    return pa.table(kept | {"counts": pa.array(found, pa.binary()), "times": pa.array(met, pa.binary())} | {c: asked.column(c) for c in _CARRIED})


def _of_block(table: pa.Table, scale: Scale) -> pa.Table:
    """Cost of each document of one block, from the counts of its words and pairs."""
    order = [int(i) for i in np.argsort(table.column("shard").to_numpy())]
    first = next(i for i in order if table.column("words")[i].is_valid)
    vocabulary = np.concatenate([_from_ascending(table.column("vocabulary")[i].as_py()) for i in order])
    found = np.concatenate([_unpacked(table.column("counts")[i].as_py(), np.int64).reshape(len(_COUNTS), -1) for i in order], axis=1)
    times = np.concatenate([_unpacked(table.column("times")[i].as_py(), np.int64) for i in order])
    tokens = _unpacked(table.column("tokens")[first].as_py(), np.int32)
    total, after, *kinds = found
    below = _below(after, scale.word, scale.pairs, scale.spread)
    left = sum(d * k for d, k in zip(scale.pair, kinds))
    # the pairs' keys, ascending, are what was asked for
    _, places = np.unique(_asked(tokens, vocabulary), return_inverse=True)
    costs = np.empty(len(places), np.int64)
    for at in range(0, len(costs), _STRETCH):
        some = slice(at, at + _STRETCH)
        contexts, following = tokens[:-1][some], tokens[1:][some]
        costs[some] = _costs(times[places[some]], total[contexts], left[contexts], below[following], scale.pair)
    words = np.array(table.column("words")[first].as_py(), np.int64)
    _give_back()
    run = np.concatenate(([0], np.cumsum(costs)))
    ends = np.cumsum(words + 1)
    kept = (("doc_id", pa.int64()), ("text_key", pa.int64()), ("lang", pa.string()))
    out = {c: pa.array(table.column(c)[first].as_py(), t) for c, t in kept}
    return pa.table({**out, "words": pa.array(words), "cost": pa.array(run[ends] - run[ends - words - 1], pa.int64())})


def shards_for(docs: DataFrame, scale: Scale) -> int:
    """The number of shards, a power of two, grows with the counts and with the documents."""
    least = max(SHARDS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    least = max(least, scale.pairs / SHARD_COUNTS, docs.count() / SHARD_DOCS)
    return 1 << math.ceil(math.log2(least))


def score(docs: DataFrame, dealt: DataFrame, scale: Scale, shards: int) -> DataFrame:
    """(doc_id, text_key, lang, words, cost) of every row: cost is the text's negative log-probability in 1 / SCALE nats.

    A block of documents asks every shard of the counts (``deal``) once for its different words and pairs there, and
    gets their counts back in the same order.
    """
    rows = docs.select(
        "doc_id", F.xxhash64(whole_text()).alias("text_key"), F.col("lang").cast("string").alias("lang"), whole_text().alias("text")
    )
    number = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(ROUNDS))

    def of_block(table: pa.Table) -> pa.Table:
        return _of_block(table, scale)

    def scored(some: DataFrame) -> DataFrame:
        blocks = some.mapInArrow(partial(_blocks, shards=shards), _ASKED)
        answers = blocks.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(_answers, _ANSWERED)
        return answers.groupBy("block").applyInArrow(of_block, _SCORED)

    return _by_rounds([scored(rows.filter(number == k)) for k in range(ROUNDS)], fresh_path(docs.sparkSession, "costs"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, prior_words: int = PRIOR_WORDS) -> DataFrame:
    """(doc_id, text_key, lang, n_words, perplexity, threshold, kept) for each row of ``docs``.

    The model, word pairs of modified Kneser-Ney, is trained on four fifths of the documents that ``labels`` marks quality 1, all of them. A
    document's score is its cost per word, taken together with ``prior_words`` words at the mean of its
    language, so that a short text is judged with little weight. The threshold of a language is the
    ``quantile`` of its held-out trusted documents, exact to 1 / SCALE nats; a document above it is rejected.
    A language without such documents, null included, goes by those of all languages; without any, all is kept.

    Null and empty texts score their language's mean and are kept. Rows that repeat an id are rows of their own;
    a null doc_id is scored and is never trusted. Extra columns are ignored; empty tables give empty results.
    """
    trusted = stage(trusted_ids(labels), "trusted")
    path = fresh_path(docs.sparkSession, "model")
    with temporary_tables(docs.sparkSession):  # the counts by pair and by word are read no more when they are dealt
        counts, scale = train(docs, trusted.filter(~held_out()))
        shards = shards_for(docs, scale)
        dealt = deal(counts, shards, path)
    costs = score(docs, dealt, scale, shards)
    known = costs.join(trusted.filter(held_out()), "doc_id", "left_semi")
    grouping = known.filter("lang is not null").groupBy("lang")
    means = grouping.agg(F.sum("cost").alias("all_cost"), F.sum(F.col("words") + 1).alias("all_words"))
    pooled = known.agg(F.sum("cost").alias("cost"), F.sum(F.col("words") + 1).alias("words")).first()
    pooled_mean = pooled["cost"] / pooled["words"] if pooled["words"] else 0.0
    means = stage(means.select("lang", (F.col("all_cost") / F.col("all_words")).alias("mean")), "means")

    def scored(df: DataFrame) -> DataFrame:
        mean = F.coalesce("mean", F.lit(pooled_mean))
        value = F.floor((F.col("cost") + prior_words * mean) / (F.col("words") + 1 + prior_words))
        value = F.when(F.col("words") == 0, F.floor(mean)).otherwise(value)
        return df.join(means, "lang", "left").withColumn("value", value.cast("long"))

    held = stage(scored(known).groupBy("lang", "value").agg(F.count(F.lit(1)).alias("n")), "values")

    def limit(counts: DataFrame, *by: str) -> DataFrame:
        # a row for each value, whole numbers that the corpus bounds by its logarithm only
        upto = Window.partitionBy(*by).orderBy("value")
        total = F.sum("n").over(Window.partitionBy(*by))
        reached = counts.withColumn("share", F.sum("n").over(upto) / total).filter(F.col("share") >= quantile)
        return reached.groupBy(*by).agg(F.min("value").alias("limit"))

    limits = limit(held.filter("lang is not null"), "lang").withColumnRenamed("limit", "own")
    pooled_limit = limit(held.groupBy("value").agg(F.sum("n").alias("n"))).first()["limit"]
    every = F.lit(pooled_limit).cast("long")
    out = scored(costs).join(limits, "lang", "left").withColumn("limit", F.coalesce("own", every))
    return out.select(
        "doc_id",
        "text_key",
        "lang",
        F.col("words").alias("n_words"),
        F.exp(F.col("value") / SCALE).alias("perplexity"),
        F.exp(F.col("limit") / SCALE).alias("threshold"),
        (F.col("limit").isNull() | (F.col("value") <= F.col("limit")) | (F.col("words") == 0)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that ``classify`` rejects; columns and repeated rows unchanged."""
    key = F.struct("doc_id", "text_key", "lang").alias("__row")
    rejected = classify(docs, labels, **options).filter("not kept").select(key)
    rows = docs.withColumn("__row", F.struct("doc_id", F.xxhash64(whole_text()).alias("text_key"), F.col("lang").cast("string").alias("lang")))
    return rows.join(rejected, "__row", "left_anti").drop("__row")

"""Toxicity: nearest labelled examples by TF-IDF cosine, found exactly with a block-max inverted index."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stage, whole_text, words_of

#: Bound of the labelled rows that the classifier is fitted on: so many of each label, those first by hash of their doc_id.
MAX_LABELLED = 2_048
#: A term's weight is TF-IDF times (this + its chi-square with the label over the labelled rows' number).
RELEVANCE_FLOOR = 0.003
NEIGHBOURS = 15
BLOCK = 64
#: Lists of so many terms, the longest, are kept as rows of one dense matrix, which meets queries in parts of so many.
HEAD = 1_024
TOGETHER = 64
#: Blocks of largest bound that are read before the rest is held against the bound they set.
FIRST_BLOCKS = 4
#: A vote counts 1 / (distance + this).
NEAREST = 0.05
#: Documents a scoring task takes, and how many tasks copies of one text are spread over.
TASK_ROWS = 4_096
SPREAD = 16
_BINS = 25
_REMEMBERED = 8_192


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is a multiple of 5."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def _known_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(words_of(t.as_py())) for t in batch.column("text").cast(pa.binary())]
        words = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
        times = pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), words, times], ["doc_id", "words", "times"])


def packed(terms: np.ndarray, times: np.ndarray) -> bytes:
    """A vector's ascending term numbers, as differences, and times, by byte planes, so that high bytes of zero take no room."""
    both = np.concatenate((np.diff(terms, prepend=0), times)).astype(np.int32)
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1) if len(terms) else b""


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view(np.int32).reshape(2, -1).astype(np.int64)
    return np.cumsum(both[0]), both[1]


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast) -> Iterator[pa.RecordBatch]:
    """Numbers and times of the terms that an example has; ``other`` is the sum of (1 + ln tf)^2 over the rest."""
    numbers = {word: i for i, word in enumerate(vocabulary.value.to_pylist())}
    for batch in batches:
        vectors, other = [], []
        for text in batch.column("text").cast(pa.binary()):
            found, rest = [], Counter()
            for word, n in Counter(words_of(text.as_py())).items():
                i = numbers.get(word)
                if i is None:
                    rest[n] += 1
                else:
                    found.append((i, n))
            found.sort()
            vectors.append(packed(*np.array(found, np.int64).reshape(-1, 2).T))
            other.append(sum(k * (1 + math.log(n)) ** 2 for n, k in sorted(rest.items())))
        columns = [batch.column("doc_id"), pa.array(vectors, pa.binary()), pa.array(other, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "vector", "other"])


def _documents_of_terms(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        for vector in batch.column("vector"):
            total[unpacked(vector.as_py())[0]] += 1
    terms = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(total[terms])], ["term", "df"])


def relevance(with_term: np.ndarray, toxic_with_term: np.ndarray, total: int, toxic: int) -> np.ndarray:
    """What a term's TF-IDF is multiplied by: a floor and its squared correlation with the label, of either sign."""
    n, a = with_term.astype(np.float64), toxic_with_term.astype(np.float64)
    spread = n * (total - n) * toxic * (total - toxic)
    cross = a * (total - toxic - (n - a)) - (n - a) * (toxic - a)
    return RELEVANCE_FLOOR + np.divide(cross * cross, spread, out=np.zeros(len(n)), where=spread > 0)


def examples_of(known: pa.Table) -> tuple[pa.Array, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The sorted words of (doc_id, words, times) rows, and for each row its id, ascending term numbers and their times.

    Words stay Arrow's and numbers numpy's: the driver makes no Python object of a word.
    """
    known = known.combine_chunks()
    words, times = (known.column(c).combine_chunks() for c in ("words", "times"))
    flat = words.flatten()
    vocabulary = flat.unique()
    vocabulary = vocabulary.take(pc.array_sort_indices(vocabulary))
    terms = pc.index_in(flat, value_set=vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)
    out = []
    for doc_id, end, n in zip(known.column("doc_id").to_pylist(), ends.tolist(), np.diff(ends, prepend=0).tolist()):
        order = np.argsort(terms[end - n : end])
        out.append((doc_id, terms[end - n : end][order], counts[end - n : end][order]))
    return vocabulary, out


def unit_vector(terms: np.ndarray | list[int], times: np.ndarray | list[int], weight: np.ndarray, other: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and weights, (1 + ln tf) times the term's, over the length that the weights and ``other`` have."""
    at = np.array(terms, np.int64)
    weights = (1 + np.log(np.array(times, np.float64))) * weight[at]
    return at, weights / np.sqrt((weights * weights).sum() + other) if len(at) else weights


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, one after the other, and how long each range is."""
    n = ends - starts
    return np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()), n


class Index:
    """Posting lists of the examples' unit vectors, cut into blocks of examples with each block's largest weight.

    Equal vectors are one entry with its documents. Entries stand by the nearest of about sqrt(n) of them, so that
    those with common terms share blocks. The longest lists are rows of a dense matrix, zeros included; it is made
    where it is first read, in the tasks, and does not travel.
    """

    def __init__(self, examples: list[tuple], weight: np.ndarray):
        """examples: (doc_id, label, terms, times) of vectors with a term, terms ascending."""
        equal: dict[bytes, list[tuple[int, int]]] = {}
        vectors = []
        for d, y, terms, times in sorted(examples, key=lambda e: e[:2]):
            members = equal.setdefault(np.array([terms, times], np.int64).tobytes(), [])
            if not members:
                vectors.append(unit_vector(terms, times, weight))
            members.append((d, y))
        self.members, self.size = list(equal.values()), len(equal)
        entry = np.repeat(np.arange(self.size), [len(t) for t, _ in vectors]) if vectors else np.empty(0, np.int64)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.empty(0, np.int64)
        value = np.concatenate([w for _, w in vectors]) if vectors else np.empty(0)
        place = self._places(vectors, entry, term, value, len(weight))
        by_place = np.argsort(place)
        self.members = [self.members[i] for i in by_place.tolist()]
        self.blocks = max(1, -(-self.size // BLOCK))
        length = np.bincount(term, minlength=len(weight))
        head = np.argsort(-length, kind="stable")[:HEAD]
        self.row = np.full(len(weight), -1)
        self.row[head] = np.arange(len(head))
        dense = self.row[term] >= 0
        self.heads = len(head), self.row[term[dense]], place[entry[dense]], value[dense]
        entry, term, value = place[entry[~dense]], term[~dense], value[~dense]
        order = np.lexsort((entry, term))
        self.entry, self.value, term = entry[order], value[order], term[order]
        run = term * self.blocks + self.entry // BLOCK
        self.start = np.flatnonzero(np.concatenate((np.ones(min(1, len(run)), bool), run[1:] != run[:-1])))
        self.end = np.append(self.start[1:], len(run)) if len(run) else self.start
        self.block = self.entry[self.start] // BLOCK
        self.most = np.maximum.reduceat(self.value, self.start) if len(run) else np.empty(0)
        self.runs = np.searchsorted(term[self.start], np.arange(len(weight) + 1))

    @cached_property
    def dense(self) -> np.ndarray:
        rows, row, entry, value = self.heads
        out = np.zeros((rows, self.blocks * BLOCK))
        out[row, entry] = value
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "dense"}

    def _places(self, vectors: list, entry: np.ndarray, term: np.ndarray, value: np.ndarray, n_terms: int) -> np.ndarray:
        pivots = list(range(0, self.size, max(1, math.isqrt(self.size))))
        nearest, best = np.zeros(self.size, np.int64), np.full(self.size, -1.0)
        dense = np.zeros(n_terms)
        for p in pivots:
            dense[vectors[p][0]] = vectors[p][1]
            cosine = np.bincount(entry, value * dense[term], minlength=self.size)
            dense[vectors[p][0]] = 0
            closer = cosine > best
            nearest[closer], best[closer] = p, cosine[closer]
        place = np.empty(self.size, np.int64)
        place[np.lexsort((-best, nearest))] = np.arange(self.size)
        return place

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int, int]]]:
        """For each (terms, weights) the k examples of largest positive cosine as (cosine, doc_id, label), ties to
        the smaller doc_id."""
        out = []
        for start in range(0, len(queries), TOGETHER):
            some = queries[start : start + TOGETHER]
            heads = np.zeros((len(some), len(self.dense)))
            rows = [self.row[terms] for terms, _ in some]
            for head, row, (_, weights) in zip(heads, rows, some):
                head[row[row >= 0]] = weights[row >= 0]
            cosines = (heads @ self.dense).reshape(len(some), self.blocks, BLOCK)
            peaks = cosines.max(axis=2)
            for cosine, peak, row, (terms, weights) in zip(cosines, peaks, rows, some):
                out.append(self._nearest(cosine, peak, terms[row < 0], weights[row < 0], k))
        return out

    def _nearest(
        self, cosine: np.ndarray, peak: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int
    ) -> list[tuple[float, int, int]]:
        """Add the posting lists of ``terms`` to the cosines of blocks that may hold one of the k nearest.

        A block's bound is its largest cosine so far and the sum of its largest weights times the query's. The blocks
        of largest bound are read first; a block whose bound is below their k-th cosine cannot hold a nearer example.
        """
        runs, n = _ranges(self.runs[terms], self.runs[terms + 1])
        by_run = np.repeat(weights, n)
        of_run = self.block[runs]
        bound = peak + np.bincount(of_run, self.most[runs] * by_run, minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        flat = cosine.reshape(-1)

        def read(blocks: np.ndarray) -> None:
            taken = np.zeros(self.blocks, bool)
            taken[blocks] = True
            mine = taken[of_run]
            at, n = _ranges(self.start[runs[mine]], self.end[runs[mine]])
            flat[:] += np.bincount(self.entry[at], self.value[at] * np.repeat(by_run[mine], n), minlength=len(flat))

        def kth(values: np.ndarray) -> float:
            return max(0.0, float(np.partition(values, len(values) - k)[len(values) - k])) if len(values) > k else 0.0

        first, rest = order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]
        read(first)
        least = kth(cosine[first].reshape(-1))
        rest = rest[bound[rest] >= least - 1e-9]
        if len(rest):
            read(rest)
            least = max(least, kth(cosine[rest].reshape(-1)))
        blocks = np.concatenate((first, rest))
        values = np.round(cosine[blocks].reshape(-1), 12)
        places = (blocks[:, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
        found = (values > 0) & (values >= least - 1e-9)
        near = [(-c, d, y) for c, i in zip(values[found].tolist(), places[found].tolist()) for d, y in self.members[i][:k]]
        return [(-c, d, y) for c, d, y in sorted(near)[:k]]


def vote(near: list[tuple[float, int, int]]) -> float | None:
    """Share of the neighbours' weight that is toxic; null without neighbours."""
    if not near:
        return None
    weights = [1 / (max(0.0, 1 - c) + NEAREST) for c, _, _ in near]
    return sum(w * y for w, (_, _, y) in zip(weights, near)) / sum(weights)


def _votes(batches: Iterator[pa.RecordBatch], index: Broadcast, rarest: float, k: int) -> Iterator[pa.RecordBatch]:
    table, weight = index.value
    seen: dict[tuple, list] = {}  # copies of a text are looked up once
    for batch in batches:
        votes, evidence, cosines = [], [], []
        ids, *keys = (batch.column(c).to_pylist() for c in ("doc_id", "vector", "other"))
        keys = list(zip(*keys))
        if len(seen) > _REMEMBERED:
            seen = {}
        new = [key for key in dict.fromkeys(keys) if key not in seen]
        queries = [unit_vector(*unpacked(vector), weight, other * rarest * rarest) for vector, other in new]
        seen |= zip(new, table.nearest(queries, k + 1))
        for doc_id, key in zip(ids, keys):
            near = [x for x in seen[key] if x[1] != doc_id][:k]
            votes.append(vote(near))
            evidence.append([d for _, d, _ in near])
            cosines.append([c for c, _, _ in near])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(votes, pa.float64()), pa.array(evidence, pa.list_(pa.int64())),
             pa.array(cosines, pa.list_(pa.float64()))],
            ["doc_id", "vote", "evidence", "cosines"],
        )


def calibration(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[list[float], list[float]]:
    """Votes and the shares of label 1 at them, rising: pooled neighbours of bins of the votes, rows counted by weight."""
    weights = np.ones(len(votes)) if weights is None else weights
    bins = np.minimum((votes * _BINS).astype(int), _BINS - 1)
    pools: list[list[float]] = []  # sum of votes, number, sum of labels (with half a row of each label)
    for b in np.unique(bins):
        own = bins == b
        pools.append([(x[own] * weights[own]).sum() for x in (votes, np.ones(len(votes)), labels)])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return [s / n for s, n, _ in pools], [(y + 0.5) / (n + 1) for _, n, y in pools]


def _calibrated(
    batches: Iterator[pa.RecordBatch], at: list[float], share: list[float], without: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes = batch.column("vote").to_numpy(zero_copy_only=False).astype(np.float64)
        score = np.interp(votes, at, share) if at else np.full(len(votes), without)
        score = np.clip(np.where(np.isnan(votes), without, score), 0.0, 1.0)
        columns = [batch.column("doc_id"), pa.array(score), batch.column("evidence"), batch.column("cosines")]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "evidence", "cosines"])


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[dict[int, int], dict[int, float]]:
    """Label of at most ``max_labelled`` documents of each label that are not held out, first by hash of their doc_id,
    and how many labelled documents each of them stands for, by label.

    Ids and labels that are null are left out; of rows that repeat an id, the largest label counts.
    """
    rows = labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
    rows = stage(rows.groupBy("doc_id").agg(F.max((F.col("toxic").cast("int") > 0).cast("int")).alias("toxic")), "labelled")
    marks, stands_for = {}, {}
    for label in (0, 1):
        own = rows.filter(F.col("toxic") == label)
        first = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).collect()
        marks |= {r["doc_id"]: label for r in first}
        stands_for[label] = own.count() / len(first) if first else 0.0
    return marks, stands_for


def classify(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, cosines) for each row of ``docs``.

    The examples are the labelled sample, at most ``max_labelled`` documents of each label, so that the index and its
    vocabulary have a fixed bound and every task holds them. All words of a text are terms of its vector:
    (1 + ln tf) times idf times ``relevance``. idf is ln((documents + 1) / (documents with the term + 1)) + 1 over all
    documents; a term that no example has meets nothing, and counts in the vector's length with the idf of a term
    of no document and the floor of relevance. A text's nearest examples (itself left out) vote by distance;
    the votes of the sample itself, and its labels by what they stand for, give the score's calibration. evidence
    and cosines are the neighbours, nearest first.

    A text that shares no word with an example, empty and null ones too, scores the sample's share of label 1 among
    such texts, or among all where the sample has none; without labelled rows every score is 0. Of rows that repeat a
    labelled id, the least text is the example. Repeated rows are rows of their own; a null doc_id is not held
    out. Only texts go into a score: extra columns are ignored; empty tables give empty results.
    """
    spark = docs.sparkSession
    marks, stands_for = labelled_sample(labels, max_labelled)
    texts = docs.select("doc_id", whole_text().alias("text"))
    sample = spark.createDataFrame(sorted(marks.items()), "doc_id long, toxic int")
    known = texts.join(F.broadcast(sample.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    known = known.mapInArrow(_known_terms, "doc_id long, words array<binary>, times array<int>").toArrow()  # the sample
    vocabulary, known = examples_of(known)
    vectors = stage(
        texts.mapInArrow(
            partial(_vectors, vocabulary=spark.sparkContext.broadcast(vocabulary)),
            "doc_id long, vector binary, other double",
        ),
        "vectors",
    )
    n = vectors.count()
    df, with_term, toxic = (np.zeros(len(vocabulary), np.int64) for _ in range(3))
    found = vectors.select("vector").mapInArrow(partial(_documents_of_terms, size=len(vocabulary)), "term int, df long")
    found = found.groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # one row per term of the sample
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    examples = [(d, marks[d], terms, times) for d, terms, times in known]
    for _, label, terms, _ in examples:
        with_term[terms] += 1
        toxic[terms] += label
    positive = sum(y for _, y, _, _ in examples)
    weight = (np.log((n + 1) / (df + 1)) + 1) * relevance(with_term, toxic, len(examples), positive)
    index = Index([e for e in examples if len(e[2])], weight)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_ROWS))
    dealt = vectors.repartition(parts, F.xxhash64("vector"), F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    votes = dealt.mapInArrow(
        partial(
            _votes,
            index=spark.sparkContext.broadcast((index, weight)),
            rarest=(math.log(n + 1) + 1) * RELEVANCE_FLOOR,
            k=neighbours,
        ),
        "doc_id long, vote double, evidence array<long>, cosines array<double>",
    )
    votes = stage(votes, "votes")
    own = votes.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("vote").alias("vote"), F.max("toxic").alias("toxic"))
    own = own.collect()  # at most the sample
    with_vote = [(r["vote"], r["toxic"], stands_for[r["toxic"]]) for r in own if r["vote"] is not None]
    at, share = calibration(*(np.array(x, float) for x in zip(*with_vote))) if with_vote else ([], [])
    bare = [r["toxic"] for r in own if r["vote"] is None] or list(marks.values())
    weights = [stands_for[y] for y in bare]
    without = sum(w for w, y in zip(weights, bare) if y) / sum(weights) if weights else 0.0
    scored = votes.mapInArrow(
        partial(_calibrated, at=at, share=share, without=without),
        "doc_id long, score double, evidence array<long>, cosines array<double>",
    )
    out = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    return scored.select("doc_id", out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "cosines")

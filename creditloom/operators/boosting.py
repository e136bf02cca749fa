"""Many boosted-tree fits grown side by side, a Spark job a tree level for all of them.

Spark ML fits one model at a time, and a fit is some hundred short jobs: rounds times levels. A search has hundreds of
fits over the same rows, so its time is that of its jobs, whatever the rows. Here a level of all fits is one job: tasks
return the sums of every bin that any fit asks for, the driver picks the splits. The trees are those of
``GBTClassifier``: its candidate splits (taken from its own code), its draws of rows and features, its gain and its
leaves, with sums in its order within a partition. Fits whose trees are still the same are grown once.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from creditloom.sources.staging import stage

#: Parameters that may differ between the fits.
SHARED = {
    "maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "minInfoGain", "minInstancesPerNode",
}
#: Bytes of the sums of one level of all fits, at most: they are brought to the driver.
MAX_SUMS = 256 << 20
#: Bytes of all partitions' sums that the driver adds up itself; tasks add up more.
DRIVER_SUMS = 64 << 20
#: Rows of one block: what a task holds at a time, with one number for each fit.
BLOCK_ROWS = 32_768
#: Rounds after which the margins are kept; in between they are worked out from the trees since.
KEEP_EVERY = 5
#: Smallest impurity of a node that is split.
EPSILON = 2.0**-52
INVALID = -1.7976931348623157e308

BLOCKS = "part int, fold int, known boolean, offset long, data binary"
SCORES = "score_id int, score double, label int, n long"


# --- random numbers of Spark and Java -----------------------------------------------


MASK = (1 << 64) - 1
#: Rows that one lane of ``uniforms`` draws.
LANE = 64


def _murmur3(data: bytes, seed: int) -> int:
    """Scala's MurmurHash3 of eight bytes, signed."""
    h = seed & 0xFFFFFFFF
    for i in (0, 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def xorshift_start(seed: int) -> int:
    """State of Spark's XORShiftRandom for a seed."""
    data = (seed & MASK).to_bytes(8, "big")
    low = _murmur3(data, 0x3C074A61)
    return _murmur3(data, low) << 32 | low


def _step(x):
    x = x ^ x << 21
    x = x & MASK if isinstance(x, int) else x
    x = x ^ x >> 35
    x = x ^ x << 4
    return x & MASK if isinstance(x, int) else x


def xorshift_doubles(seed: int) -> Iterator[float]:
    x = xorshift_start(seed)
    while True:
        x = _step(x)
        high = x & (1 << 26) - 1
        x = _step(x)
        yield ((high << 27) + (x & (1 << 27) - 1)) * 2.0**-53


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = table[0][(x & np.uint64(255)).astype(np.intp)]
    for i in range(1, 8):
        out = out ^ table[i][(x >> np.uint64(8 * i) & np.uint64(255)).astype(np.intp)]
    return out


@functools.cache
def _jump(k: int) -> np.ndarray:
    """The linear map of 2^k steps, as the images of every value of every byte."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    images = _step(bits) if k == 0 else _apply(_jump(k - 1), _apply(_jump(k - 1), bits))
    table = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for bit in range(8):
            table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ images[8 * byte + bit]
    return table


@functools.lru_cache(maxsize=8)
def uniforms(seed: int, start: int, n: int) -> np.ndarray:
    """Numbers ``start`` to ``start + n`` that XORShiftRandom(seed).nextDouble() gives, without drawing those before.

    Kept for the next levels and sets of lines of the same rows.
    """
    first = np.array([xorshift_start(seed)], np.uint64)
    for k in range((2 * start).bit_length()):
        if 2 * start >> k & 1:
            first = _apply(_jump(k), first)
    lanes, states, k = -(-n // LANE), first, (2 * LANE).bit_length() - 1
    while len(states) < lanes:
        states = np.concatenate([states, _apply(_jump(k), states)])
        k += 1
    states, out = states[:lanes], np.empty((LANE, lanes))
    for i in range(LANE):
        states = _step(states)
        high = (states & np.uint64((1 << 26) - 1)) << np.uint64(27)
        states = _step(states)
        out[i] = high + (states & np.uint64((1 << 27) - 1))
    return out.T.ravel()[:n] * 2.0**-53


class JavaRandom:
    """java.util.Random, as far as it is asked for."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def copy(self) -> JavaRandom:
        other = JavaRandom(0)
        other.state = self.state
        return other

    def _next32(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        x = self.state >> 16
        return x - (1 << 32) if x >> 31 else x

    def next_long(self) -> int:
        return (self._next32() << 32) + self._next32()


def reservoir(n: int, k: int, seed: int) -> list[int]:
    """Spark's reservoir sample of k of the numbers below n."""
    chosen, draws = list(range(min(n, k))), xorshift_doubles(seed)
    for item in range(k, n):
        at = int(next(draws) * (item + 1))
        if at < k:
            chosen[at] = item
    return chosen


# --- what the driver knows ----------------------------------------------------------


@dataclass(frozen=True)
class Variant:
    """A fit: the parameters that decide where its trees end, and its number."""

    max_depth: int
    min_gain: float
    min_rows: int
    rounds: int
    fit: int


@dataclass
class Line:
    """Fits of one fold whose trees have been the same so far. Tasks know its margins by ``number``."""

    number: int | None
    group: Group
    members: list[Variant]


@dataclass(frozen=True)
class Group:
    """What fits must have in common to be able to share trees."""

    fold: int
    rate: float
    step: float
    n_features: int  # features a node looks at


@dataclass
class Growing:
    """A tree that is being grown for some members of a line."""

    line: Line
    members: list[Variant]
    rng: JavaRandom
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    #: Nodes to split, in Spark's order: number, sums (none for the root, before its first sums), impurity.
    open: list[tuple[int, np.ndarray | None, float]] = field(default_factory=lambda: [(1, None, 0.0)])
    features: list[list[int]] = field(default_factory=list)

    def tree(self, node: int = 1) -> tuple | float:
        """(feature, last bin on the left, left, right), or the value of a leaf."""
        if node not in self.splits:
            return self.values[node]
        return (*self.splits[node], self.tree(2 * node), self.tree(2 * node + 1))

    def open_tree(self, node: int = 1) -> tuple | int:
        """Like ``tree``, with the place of an open node among the open ones, -1 for leaves."""
        if node in self.splits:
            return (*self.splits[node], self.open_tree(2 * node), self.open_tree(2 * node + 1))
        return next((i for i, (number, _, _) in enumerate(self.open) if number == node), -1)


def _impurity(count, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - total * total / count) / count)


@dataclass
class Gains:
    """Every split of one node, by feature in the order drawn and bin."""

    features: list[int]
    sums: np.ndarray | None
    impurity: float
    left: np.ndarray
    right: np.ndarray
    impurities: tuple[np.ndarray, np.ndarray]
    gain: np.ndarray

    def best(self, min_gain: float, min_rows: int) -> tuple[int, int] | None:
        """Place of the first best split; None for a leaf."""
        if not self.gain.size:
            return None
        small = (self.left[..., 0] < min_rows) | (self.right[..., 0] < min_rows)
        gain = np.where(small | (self.gain < min_gain), INVALID, self.gain)
        at = np.unravel_index(np.argmax(gain), gain.shape)
        return (int(at[0]), int(at[1])) if gain[at] > 0 else None


def _gains(hist: np.ndarray, features: list[int], n_splits: list[int], sums: np.ndarray | None, impurity: float) -> Gains:
    """hist: (feature, bin, [rows, sum, sum of squares])."""
    valid = [i for i, f in enumerate(features) if n_splits[f]]
    features = [features[i] for i in valid]
    if not valid:
        sums = hist[0].sum(0) if sums is None else sums
        none = np.empty((0, 0))
        return Gains(features, sums, impurity, none, none, (none, none), none)
    running = np.cumsum(hist[valid], axis=1)
    left = running[:, :-1]
    right = running[:, -1:] - left
    if sums is None:
        sums = left[0, 0] + right[0, 0]
        impurity = float(_impurity(*sums))
    li, ri = (_impurity(*np.moveaxis(x, -1, 0)) for x in (left, right))
    total = left[..., 0] + right[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = impurity - left[..., 0] / total * li - right[..., 0] / total * ri
    no_split = np.arange(left.shape[1])[None, :] >= np.array([n_splits[f] for f in features])[:, None]
    return Gains(features, sums, impurity, left, right, (li, ri), np.where(no_split | np.isnan(gain), INVALID, gain))


def _mean(sums: np.ndarray) -> float:
    return float(sums[1] / sums[0]) if sums[0] else 0.0


def _next_level(tree: Growing, hist: np.ndarray, n_splits: list[int], level: int) -> tuple[list[Growing], list[Growing]]:
    """What becomes of a tree when its open nodes are split: trees that grow on, and trees that are done."""
    gains = [
        _gains(hist[i], tree.features[i], n_splits, sums, impurity) for i, (_, sums, impurity) in enumerate(tree.open)
    ]
    rules: dict[tuple, tuple] = {}
    by_choice: dict[tuple, list[Variant]] = {}
    for v in tree.members:
        rule = (v.min_gain, v.min_rows, v.max_depth > level)
        if rule not in rules:
            rules[rule] = tuple(g.best(*rule[:2]) if rule[2] else None for g in gains)
        by_choice.setdefault(rules[rule], []).append(v)
    growing, done = [], []
    for choice, members in by_choice.items():
        splits, values, children = dict(tree.splits), dict(tree.values), []
        for (node, _, _), g, at in zip(tree.open, gains, choice):
            if at is None:
                values[node] = _mean(g.sums)
                continue
            splits[node] = (g.features[at[0]], at[1])
            for child, sums, impurity in ((2 * node, g.left[at], g.impurities[0][at]), (2 * node + 1, g.right[at], g.impurities[1][at])):
                values[child] = _mean(sums)
                if abs(impurity) >= EPSILON:
                    # each child goes before all that wait, so the last one is the first to draw its features
                    children.insert(0, (child, sums, float(impurity)))
        ended = [v for v in members if v.max_depth <= level + 1 or not children]
        going = [v for v in members if v.max_depth > level + 1 and children]
        if ended:
            done.append(Growing(tree.line, ended, tree.rng, splits, values, []))
        if going:
            growing.append(Growing(tree.line, going, tree.rng.copy(), dict(splits), dict(values), children))
    return growing, done


# --- what the tasks do --------------------------------------------------------------


def evaluate(tree: tuple | float, bins: np.ndarray):
    """The tree's value for every row: an array, or one number for a tree without a split."""
    if not isinstance(tree, tuple):
        return tree
    feature, last, left, right = tree
    return np.where(bins[feature] <= last, evaluate(left, bins), evaluate(right, bins))


def places(tree: tuple | int, bins: np.ndarray):
    """Like ``evaluate`` for an open tree."""
    if not isinstance(tree, tuple):
        return np.int16(tree)
    feature, last, left, right = tree
    return np.where(bins[feature] <= last, places(left, bins), places(right, bins))


def advance(margins: dict, rounds: list[list[tuple]], bins: np.ndarray) -> dict:
    """Margins by line after some more rounds. A round: (line, line before or None, tree, weight)."""
    for steps in rounds:
        margins = {
            line: (np.zeros(bins.shape[1]) if before is None else margins[before]) + weight * evaluate(tree, bins)
            for line, before, tree, weight in steps
        }
    return margins


def make_blocks(
    batches: Iterable[pa.RecordBatch], thresholds: list[list[np.ndarray]], folds: int, block_rows: int
) -> Iterator[pa.RecordBatch]:
    """Rows (x, label, fold, part) as blocks: for each fold its rows and the others, binned by the splits of the fold's
    fits. ``part``, the number of the rows' partition, is a column, as a task may read the partitions of another's."""
    before = [0] * folds
    widest = max((len(t) for of in thresholds for t in of), default=0)
    kind = np.uint8 if widest < 256 else np.uint16
    for x, label, fold, part in _in_blocks(batches, block_rows):
        y = label * 2.0 - 1.0
        for f in range(folds):
            bins = np.stack([np.searchsorted(t, x[:, i]).astype(kind) for i, t in enumerate(thresholds[f])])
            for known, rows in ((True, fold != f), (False, fold == f)):
                if rows.any():
                    data = pickle.dumps((np.ascontiguousarray(bins[:, rows]), y[rows]), 5)
                    row = {"part": int(part[0]), "fold": f, "known": known, "offset": before[f] if known else 0, "data": data}
                    yield pa.RecordBatch.from_pylist([row], _arrow(BLOCKS))
            before[f] += int((fold != f).sum())


def _in_blocks(batches: Iterable[pa.RecordBatch], block_rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The batches, which Spark makes smaller or larger, as arrays of so many rows."""

    def arrays(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        x = np.concatenate([b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for b in held])
        return x, *(np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (1, 2, 3))

    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, block_rows - n))
            n += held[-1].num_rows
            batch = batch.slice(held[-1].num_rows)
            if n == block_rows:
                yield arrays(held)
                held, n = [], 0
    if held:
        yield arrays(held)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


@dataclass
class Block:
    """Rows that some lines of a fold are fitted to, and their margins as far as they are kept."""

    group: tuple[int, int]  # fold, number of the set of lines
    part: int
    offset: int  # of the fold's rows in the partition
    bins: np.ndarray
    y: np.ndarray
    margins: dict[int, np.ndarray]


def blocks_of(rows: Iterable[Row], group: tuple[int, int]) -> Iterator[Block]:
    for row in rows:
        if row.fold == group[0]:
            yield Block(group, row.part, row.offset, *pickle.loads(row.data), {})


def histograms(blocks: Iterable[Block], rounds: dict, wanted: dict, seed: int, n_bins: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of a tree, sums by open node, feature and bin) of a partition's rows.

    rounds: by set of lines, what to add to the kept margins; wanted: by set, (number, line, rate, open tree, features
    of each open node).
    """
    found: dict[int, np.ndarray] = {}
    for block in blocks:
        margins = advance(block.margins, rounds[block.group], block.bins)
        n, residuals, bags = len(block.y), {}, {}
        draws, wide, taken = None, block.bins.astype(np.intp), np.empty(len(block.y), np.intp)
        for number, line, rate, tree, nodes in wanted[block.group]:
            if rate not in bags:
                if rate < 1.0 and draws is None:
                    draws = uniforms(seed + block.part + 1, block.offset, n)
                bags[rate] = np.flatnonzero(draws < rate) if rate < 1.0 else np.arange(n)
            if line not in residuals:
                y = block.y
                residuals[line] = y if line is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margins[line]))
            bag, residual = bags[rate], residuals[line]
            place = places(tree, block.bins)
            place = None if np.ndim(place) == 0 else place[bag]
            sums = found.get(number)
            if sums is None:
                sums = found[number] = np.zeros((len(nodes), len(nodes[0]), n_bins, 3))
            for i, features in enumerate(nodes):
                rows = bag if place is None else bag[place == i]
                r = residual[rows]
                squares, b = r * r, taken[: len(rows)]
                for j, f in enumerate(features):
                    np.take(wide[f], rows, out=b, mode="clip")  # no row is out of range; "raise" would copy
                    sums[i, j, :, 0] += np.bincount(b, minlength=n_bins)
                    sums[i, j, :, 1] += np.bincount(b, r, n_bins)
                    sums[i, j, :, 2] += np.bincount(b, squares, n_bins)
    yield from found.items()


def keep(blocks: Iterable[Block], rounds: dict) -> Iterator[Block]:
    for b in blocks:
        yield Block(b.group, b.part, b.offset, b.bins, b.y, advance(b.margins, rounds[b.group], b.bins))


def score(batches: Iterable[pa.RecordBatch], rounds: dict, wanted: dict) -> Iterator[pa.RecordBatch]:
    """Different margins of the held rows with their label and number. wanted: lines by fold and round."""
    for batch in batches:
        for row in batch.to_pylist():
            bins, y = pickle.loads(row["data"])
            margins: dict = {}
            for i, steps in enumerate(rounds[row["fold"]]):
                margins = advance(margins, [steps], bins)
                for line in wanted.get((row["fold"], i + 1), []):
                    for label, of in ((0, y < 0), (1, y > 0)):
                        values, n = np.unique(margins[line][of], return_counts=True)
                        same = [np.full(len(values), v, np.int32) for v in (line, label)]
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (same[0], values, same[1], n)], schema=_arrow(SCORES))


# --- the fits -----------------------------------------------------------------------


def can_share(estimator, points: list[dict]) -> bool:
    """Whether fits of these points are what is grown here; others are left to the estimator."""
    if type(estimator) is not GBTClassifier or any(set(p) - SHARED for p in points):
        return False
    plain = GBTClassifier()
    taken = {*SHARED, "seed", "maxBins", "featuresCol", "labelCol", "cacheNodeIds", "checkpointInterval"}
    settings = {p.name: v for p, v in estimator.extractParamMap().items() if p.name not in taken}
    return all(plain.hasDefault(name) and plain.getOrDefault(name) == v for name, v in settings.items())


def _object(spark: SparkSession, name: str):
    at = spark._jvm.org.apache.spark
    for part in name.split(".")[:-1]:
        at = getattr(at, part)
    return getattr(getattr(at, name.split(".")[-1] + "$"), "MODULE$")


def candidate_splits(estimator: GBTClassifier, known: DataFrame, strategies: set[str]) -> tuple[list[np.ndarray], dict[str, int]] | None:
    """The thresholds of every feature, and the features a node looks at by strategy, by Spark's own code; its checks of
    rows and labels too. None where a feature is a category."""
    spark = known.sparkSession
    estimator._transfer_params_to_java()
    java, jvm = estimator._java_obj, spark._jvm
    features = known._jdf.schema().apply(estimator.getFeaturesCol())
    categories = _object(spark, "ml.util.MetadataUtils").getCategoricalFeatures(features)
    if categories.size():
        return None
    regression = _object(spark, "mllib.tree.configuration.Algo").Regression()
    strategy = java.getOldBoostingStrategy(categories, regression).treeStrategy()
    rows = _object(spark, "ml.util.DatasetUtils").extractInstances(java, known._jdf, jvm.scala.Some(2))
    about = {s: _object(spark, "ml.tree.impl.DecisionTreeMetadata").buildMetadata(rows, strategy, 1, s) for s in sorted(strategies)}
    splits = _object(spark, "ml.tree.impl.RandomForest").findSplits(rows, next(iter(about.values())), estimator.getSeed())
    thresholds = [np.array([s.threshold() for s in of]) for of in splits]
    return thresholds, {s: m.numFeaturesPerNode() for s, m in about.items()}


def held_out_scores(rows: DataFrame, estimator: GBTClassifier, points: list[dict], folds: int) -> tuple[DataFrame, dict[tuple[int, int], int]] | None:
    """Every point fitted to the rows outside each fold: (score_id, score, label, n) of the fold's rows, staged, and the
    score_id of (point, fold). None if the features have categories, or a level's sums would be too large for the driver.

    rows: (features, label, fold), which are read several times in the same partitions and order. Points are the same
    score where their trees are. Rows are dealt to tasks by partition, fold and, where these are few, by sets of lines.
    """
    spark, sc = rows.sparkSession, rows.sparkSession.sparkContext

    def value(point: dict, name: str):
        return point.get(name, estimator.getOrDefault(name))

    strategies = {value(p, "featureSubsetStrategy") for p in points}
    thresholds, per_node = [], {}
    for f in range(folds):
        known = rows.where(F.col("fold") != f).select(estimator.getFeaturesCol(), estimator.getLabelCol())
        found = candidate_splits(estimator, known, strategies if f == 0 else {min(strategies)})
        if found is None:
            return None
        thresholds.append(found[0])
        per_node = per_node or found[1]
    n_splits = [[len(t) for t in of] for of in thresholds]
    n_features, n_bins = len(thresholds[0]), 1 + max(max(of, default=0) for of in n_splits)
    deepest = max(value(p, "maxDepth") for p in points)
    if len(points) * folds * 2 ** max(0, deepest - 1) * max(per_node.values()) * n_bins * 24 > MAX_SUMS:
        return None

    lines: dict[Group, Line] = {}
    for i, p in enumerate(points):
        for f in range(folds):
            group = Group(f, value(p, "subsamplingRate"), value(p, "stepSize"), per_node[value(p, "featureSubsetStrategy")])
            fit = Variant(value(p, "maxDepth"), value(p, "minInfoGain"), value(p, "minInstancesPerNode"), value(p, "maxIter"), i)
            lines.setdefault(group, Line(None, group, [])).members.append(fit)

    label = F.col(estimator.getLabelCol()).cast("double")
    vectors = rows.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), label.alias("label"), "fold", F.spark_partition_id().alias("part"))
    n_parts = vectors.rdd.getNumPartitions()
    blocks = vectors.mapInArrow(functools.partial(make_blocks, thresholds=thresholds, folds=folds, block_rows=BLOCK_ROWS), BLOCKS)
    held = stage(blocks.where("not known"), "held")

    # few partitions: the lines of a fold are dealt to several tasks, each with its copy of the rows
    slots = sc.defaultParallelism
    by_fold = [[g for g in lines if g.fold == f] for f in range(folds)]
    n_sets = max(1, min(-(-2 * slots // (n_parts * folds)), max(map(len, by_fold))))
    set_of = {g: (f, i % n_sets) for f, groups in enumerate(by_fold) for i, g in enumerate(groups)}
    sets = sorted(set(set_of.values()))
    store = StorageLevel.MEMORY_AND_DISK
    known = blocks.where("known").rdd.persist(store)
    copies = sc.union([known.mapPartitions(functools.partial(blocks_of, group=s)) for s in sets])
    state = copies.coalesce(max(4 * slots, len(sets))).persist(store)
    old, seed, numbers = known, estimator.getSeed(), iter(range(1 << 62))
    since: list[dict] = []  # rounds that the kept margins lack, by set
    rounds: dict[int, list] = {f: [] for f in range(folds)}
    score_ids: dict[tuple[int, int], int] = {}
    wanted_scores: dict[tuple[int, int], list[int]] = {}
    alive = list(lines.values())
    try:
        for m in range(max(v.rounds for line in alive for v in line.members)):
            growing, done = [Growing(line, line.members, JavaRandom(seed + m)) for line in alive], []
            level, missing = 0, {s: [r[s] for r in since] for s in sets}
            while growing:
                wanted: dict[tuple, list] = {s: [] for s in sets}
                for k, t in enumerate(growing):
                    g = t.line.group
                    t.features = [reservoir(n_features, g.n_features, t.rng.next_long()) if g.n_features < n_features else list(range(n_features)) for _ in t.open]
                    wanted[set_of[g]].append((k, t.line.number, g.rate, t.open_tree(), t.features))
                work = functools.partial(histograms, rounds=missing, wanted=wanted, seed=seed + m, n_bins=n_bins)
                sums = state.mapPartitions(work)
                if n_parts * sum(len(t.open) for t in growing) * max(per_node.values()) * n_bins * 24 > DRIVER_SUMS:
                    sums = sums.reduceByKey(np.add, 2 * slots)
                total: dict[int, np.ndarray] = {}
                for k, values in sums.collect():
                    total[k] = total[k] + values if k in total else values
                if old is not None:
                    old.unpersist()
                    old = None
                grown = []
                for k, t in enumerate(growing):
                    more, ended = _next_level(t, total[k], n_splits[t.line.group.fold], level)
                    grown += more
                    done += ended
                growing, level = grown, level + 1
            # members of a line whose trees have the same splits stay together
            alive, steps = [], {s: [] for s in sets}
            for f in range(folds):
                rounds[f].append([])
            together: dict[tuple, list[Growing]] = {}
            for t in done:
                together.setdefault((t.line.number, t.line.group, tuple(sorted(t.splits.items()))), []).append(t)
            for same in together.values():
                line = Line(next(numbers), same[0].line.group, [v for t in same for v in t.members])
                step = (line.number, same[0].line.number, same[0].tree(), 1.0 if m == 0 else line.group.step)
                rounds[line.group.fold][m].append(step)
                if any(v.rounds == m + 1 for v in line.members):
                    wanted_scores.setdefault((line.group.fold, m + 1), []).append(line.number)
                    score_ids |= {(v.fit, line.group.fold): line.number for v in line.members if v.rounds == m + 1}
                line.members = [v for v in line.members if v.rounds > m + 1]
                if line.members:
                    alive.append(line)
                    steps[set_of[line.group]].append(step)
            since.append(steps)
            if len(since) == KEEP_EVERY:
                missing = {s: [r[s] for r in since] for s in sets}
                old, state, since = state, state.mapPartitions(functools.partial(keep, rounds=missing)).persist(store), []
    finally:
        state.unpersist()
        if old is not None:
            old.unpersist()
    scores = held.repartition(max(slots, n_parts)).mapInArrow(functools.partial(score, rounds=rounds, wanted=wanted_scores), SCORES)
    return stage(scores, "scores"), score_ids

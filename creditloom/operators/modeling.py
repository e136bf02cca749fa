"""Training, evaluation and scoring on Spark ML, with exact AUC and a portable hash split."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from creditloom import constants as K
from creditloom.operators import boosting
from creditloom.operators.ordering import SLICE, slice_by_range, total_before, with_total_before
from creditloom.sources import writers
from creditloom.sources.staging import fresh_path, stage

SCALED = "__scaled"
FEATURES = "features"


# --- splits -----------------------------------------------------------------------


def in_sample(key: Column, frac: float, seed: int = 42) -> Column:
    """True for a fixed pseudo-random share of the keys, without any shuffle.

    The first 32 bits of md5(seed, key) are compared with frac * 2^32, so the choice depends on
    the key alone and any engine with md5 reproduces it.
    """
    bound = f"{min(int(frac * 2**32), 2**32 - 1):08x}"
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")).cast("binary")) < bound


def stratified_split(df: DataFrame, key: str, frac: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` (train / test). The hash ignores the label, so every class keeps the share
    ``frac`` in expectation however the classes are sized."""
    return df.withColumn("split", F.when(in_sample(F.col(key), frac, seed), "test").otherwise("train"))


def exact_stratified_split(
    df: DataFrame, key: str, label: str = "label", frac: float = 0.2, seed: int = 42
) -> DataFrame:
    """Like ``stratified_split``, with exactly ceil(frac * n) test rows in each class found in the data.

    Rows are ranked by the hash of their key (unique keys are the caller's promise; equal keys stand in any
    order) within the class, in range slices, so no class is sorted by one task or collected. Rows without a
    label are a class of their own.
    """
    digest = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    placed = df.withColumn("__place", digest)
    ranked = with_total_before(placed, [label], ["__place"], F.lit(1), "__before", "__class")
    in_test = F.col("__before") < F.ceil(F.lit(Decimal(repr(frac))) * F.col("__class"))
    return ranked.withColumn("split", F.when(in_test, "test").otherwise("train")).select(*df.columns, "split")


def time_split(df: DataFrame, windows: dict[str, Column], date_col: str = "snapshot_date") -> DataFrame:
    """Add ``period``: train_test, oot, or null outside both windows."""
    d = F.col(date_col)
    in_train = d.between(windows["train_test_start_date"], windows["train_test_end_date"])
    in_oot = d.between(windows["oot_start_date"], windows["oot_end_date"])
    return df.withColumn("period", F.when(in_oot, "oot").when(in_train, "train_test"))


def label_classes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(label).alias("n_classes"))


def split_stats(df: DataFrame, by: str = "split", label: str = "label") -> DataFrame:
    mean = F.round(F.avg(F.col(label).cast("double")), 2)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), mean.alias("label_mean"))


# --- scaling and assembly ---------------------------------------------------------


def fit_scaler(df: DataFrame, cols: list[str], weight: str | None = None) -> DataFrame:
    """One row of (mean, std) structs per column: population std, 1 where it is 0 or missing. NaN counts
    as missing, like null.

    With ``weight`` each row counts that many times; the squared deviations are then taken in a
    second pass around the weighted means.
    """

    def params(c: str, mean: Column, std: Column) -> Column:
        return F.struct(mean.alias("mean"), F.when(std > 0, std).otherwise(1.0).alias("std")).alias(c)

    types = dict(df.dtypes)
    real = {c: F.nanvl(F.col(c), F.lit(None)) for c in cols if types[c] in ("float", "double")}
    df = df.withColumns(real) if real else df
    if weight is None:
        return df.agg(*[params(c, F.avg(c), F.stddev_pop(c)) for c in cols])

    def share(c: str, values: Column) -> Column:
        counted = F.when(F.col(c).isNotNull(), F.col(weight))
        return F.try_divide(F.sum(values * F.col(weight)), F.sum(counted).cast("double"))

    means = df.agg(F.struct(*[share(c, F.col(c)).alias(c) for c in cols]).alias("means")).scalar()
    centred = df.withColumn("__m", means)
    spreads = [
        params(c, F.max(F.col(f"__m.{c}")), F.sqrt(share(c, F.pow(F.col(c) - F.col(f"__m.{c}"), 2)))) for c in cols
    ]
    return centred.agg(*spreads)


def scaler_table(params: DataFrame) -> DataFrame:
    """Scaler parameters as (feature, mean, std) rows."""
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"))
        for c in params.columns
    ]
    return params.select(F.inline(F.array(*entries)))


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    cols = params.columns
    row = params.select(F.struct(*cols).alias("params")).scalar()
    return (
        df.withColumn("__p", row)
        .withColumns({c: (F.col(c) - F.col(f"__p.{c}.mean")) / F.col(f"__p.{c}.std") for c in cols})
        .drop("__p")
    )


def scaler_stage(df: DataFrame, cols: list[str], weight: str | None = None) -> SQLTransformer:
    """Fitted scaler as a savable pipeline stage. Only its one parameter row is read back."""
    row = fit_scaler(df, cols, weight).first()
    scaled = ", ".join(
        f"(`{c}` - {row[c]['mean'] or 0.0!r}D) / {row[c]['std']!r}D AS `{SCALED}_{i}`"
        for i, c in enumerate(cols)
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def assembler(cols: list[str], output: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep")


def assemble(df: DataFrame, cols: list[str], output: str = FEATURES) -> DataFrame:
    return assembler(cols, output).transform(df)


# --- training ---------------------------------------------------------------------


def logistic_regression(n_rows: float, C: float = 1.0, **options) -> LogisticRegression:
    """L2 logistic regression with the inverse strength ``C`` of a summed (not averaged) loss."""
    defaults = dict(
        featuresCol=FEATURES,
        labelCol="label",
        regParam=1.0 / (C * n_rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
    )
    return LogisticRegression(**{**defaults, **options})


def boosted_trees(**options) -> GBTClassifier:
    """Boosted trees with 100 rounds, depth 6 and learning rate 0.3 unless given otherwise."""
    defaults = dict(
        featuresCol=FEATURES, labelCol="label", maxIter=100, maxDepth=6, stepSize=0.3, seed=42
    )
    return GBTClassifier(**{**defaults, **options})


def _fit(df: DataFrame, cols: list[str], estimator: Estimator, weight: str | None) -> PipelineModel:
    scaler = scaler_stage(df, cols, weight)
    vector = assembler([f"{SCALED}_{i}" for i in range(len(cols))])
    prepared = vector.transform(scaler.transform(df)).select(FEATURES, "label", *([weight] if weight else []))
    if weight:
        estimator = estimator.setWeightCol(weight)
    return PipelineModel(stages=[scaler, vector, estimator.fit(prepared)])


def train_lr(
    df: DataFrame, cols: list[str], C: float = 1.0, weight: str | None = None, **options
) -> PipelineModel:
    """Scaler and logistic regression; ``weight`` names a column of row multiplicities."""
    n_rows = df.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    return _fit(df, cols, logistic_regression(n_rows, C, **options), weight)


def train_gbt(df: DataFrame, cols: list[str], weight: str | None = None, **options) -> PipelineModel:
    return _fit(df, cols, boosted_trees(**options), weight)


TRAINERS = {"logistic_regression": train_lr, "gbt": train_gbt}


def search_candidates(space: dict[str, list] = K.SEARCH_SPACE, n: int = 100, seed: int = 42) -> list[dict]:
    """``n`` distinct random points of a grid, or the whole grid when it is smaller."""
    grid = [dict(zip(space, point)) for point in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(n, len(grid)))


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` boosting rounds: what a fit with maxIter=rounds gives."""
    if rounds >= model.getNumTrees:
        return model
    jvm, whole = SparkSession.active()._jvm, model._java_obj
    trees = SparkContext._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = SparkContext._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = whole.trees()[i], whole.treeWeights()[i]
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        whole.uid(), trees, weights, whole.numFeatures(), whole.numClasses()
    )
    return model._copyValues(GBTClassificationModel(cut))


@dataclass
class Search:
    """The points tried, their mean AUC over the folds, the best point's model of all rows, and the number of fits."""

    points: list[dict]
    scores: list[float]
    best_model: Model
    n_fits: int

    @property
    def best(self) -> dict:
        return max(zip(self.scores, range(len(self.points)), self.points), key=lambda t: (t[0], -t[1]))[2]


def side_by_side(spark: SparkSession, work: Callable, items: Iterable, threads: int) -> Iterator:
    """``work`` of every item, in their order, so many at a time in threads of their own.

    Each call has its own copy of the caller's local properties: Spark keeps the number of a running query there, so
    calls that share one copy take each other's numbers away.
    """
    calls = [inheritable_thread_target(spark)(partial(work, item)) for item in items]
    with ThreadPool(max(1, min(threads, len(calls)))) as pool:
        yield from pool.imap(lambda call: call(), calls)


#: Rows of one partition of the fitting rows.
ROWS_PER_TASK = 100_000


def random_search(
    df: DataFrame,
    space: dict[str, list] = K.SEARCH_SPACE,
    n: int = 100,
    folds: int = 3,
    seed: int = 42,
    parallelism: int | None = None,
    estimator: Estimator | None = None,
    max_rows: int | None = None,
) -> Search:
    """Random search by cross-validated AUC (unbinned) over rows with ``features`` and ``label``.

    Boosting rounds are nested: points that differ in maxIter only are one fit of the most rounds, of which the
    others are the beginning. The fits of boosted trees share their jobs (``boosting``). Those of other estimators, or of
    parameters that it does not know, run side by side, three for each task the session has room for or ``parallelism``,
    as a fit's short jobs leave gaps. Partitions follow the number of rows. ``max_rows`` bounds the rows that are
    searched by a random share of about so many; the default is all rows.
    """
    estimator = estimator or boosted_trees(seed=seed)
    spark = df.sparkSession
    rows = df.select(FEATURES, "label")
    total = rows.count()
    if max_rows is not None and total > max_rows:
        rows, total = rows.sample(fraction=max_rows / total, seed=seed), max_rows
    n_tasks = max(1, -(-total // ROWS_PER_TASK))
    # the folds are written, so that every fit sees the same ones
    rows = stage(rows.repartition(n_tasks).withColumn("fold", F.floor(F.rand(seed) * folds).cast("int")), "folds").coalesce(n_tasks)
    points = search_candidates(space, n, seed)
    nested = isinstance(estimator, GBTClassifier)
    fits: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        fits.setdefault(tuple((k, v) for k, v in point.items() if not (nested and k == "maxIter")), []).append(i)
    rounds = [point.get("maxIter", estimator.getOrDefault("maxIter")) if nested else 0 for point in points]
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    held = [rows.where(F.col("fold") == f).select(FEATURES, "label") for f in range(folds)]
    known = [rows.where(F.col("fold") != f).select(FEATURES, "label") for f in range(folds)]

    def fit(data: DataFrame, mine: list[int]) -> Model:
        point = {k: v for k, v in points[mine[0]].items()}
        if nested:
            point["maxIter"] = max(rounds[i] for i in mine)
        return estimator.copy({estimator.getParam(k): v for k, v in point.items()}).fit(data)

    def aucs(task: tuple[list[int], int]) -> list[tuple[int, float]]:
        mine, fold = task
        model = fit(known[fold], mine)
        cut = {r: first_rounds(model, r) if nested else model for r in {rounds[i] for i in mine}}
        by_rounds = {r: evaluator.evaluate(m.transform(held[fold])) for r, m in cut.items()}
        return [(i, by_rounds[rounds[i]]) for i in mine]

    threads = parallelism or max(1, 3 * spark.sparkContext.defaultParallelism // n_tasks)
    found: dict[int, list[float]] = {i: [] for i in range(len(points))}
    tasks = [(mine, fold) for mine in fits.values() for fold in range(folds)]
    shared = boosting.held_out_scores(rows, estimator, points, folds) if boosting.can_share(estimator, points) else None
    if shared is not None:
        values = _areas(rows, shared[0], {number: fold for (_, fold), number in shared[1].items()})
        found = {i: [values[shared[1][i, fold]] for fold in range(folds)] for i in found}
    else:
        for part in (*held, *known):
            part.cache()
        try:
            for scores in side_by_side(spark, aucs, tasks, threads):
                for i, value in scores:
                    found[i].append(value)
        finally:
            for part in (*held, *known):
                part.unpersist()
    scores = [sum(found[i]) / folds for i in range(len(points))]
    search = Search(points, scores, None, len(tasks))
    mine = [points.index(search.best)]
    search.best_model = fit(rows.select(FEATURES, "label"), mine)
    return search


def _areas(rows: DataFrame, scores: DataFrame, fold_of: dict[int, int]) -> dict[int, float]:
    """AUC by score_id, with the evaluator's values where a fold has one class only: 1 without a negative row, 0
    without a positive one, a half without rows."""
    one_class = {(True, False): 1.0, (False, True): 0.0, (False, False): 0.5}
    there = {(r["fold"], r["label"] == 1) for r in rows.select("fold", "label").distinct().collect()}
    found = {r["score_id"]: r["auc"] for r in auc(scores, "score", by=["score_id"], weight="n").collect()}
    return {
        number: one_class.get(((fold, True) in there, (fold, False) in there), found.get(number))
        for number, fold in fold_of.items()
    }


def search_results(search: Search) -> DataFrame:
    """(candidate, params, mean_auc) of every point tried."""
    rows = [
        (i, {name: str(v) for name, v in point.items()}, float(score))
        for i, (point, score) in enumerate(zip(search.points, search.scores))
    ]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "candidate int, params map<string,string>, mean_auc double")


# --- evaluation -------------------------------------------------------------------


def auc(
    df: DataFrame,
    score: str = "prediction",
    label: str = "label",
    by: list[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Exact ROC AUC per group, ties counting half; null for a single class.

    Rows are first reduced to distinct scores with class counts. Scores are then ranked in
    range slices, so the ranks of a group holding most rows are worked out by many tasks.
    """
    by = by or []
    copies = F.col(weight) if weight else F.lit(1)

    def class_count(is_class: Column) -> Column:
        return F.sum(F.when(is_class, copies).otherwise(0)).cast("bigint")

    scores = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("__score"))
        .agg(class_count(F.col(label) == 1).alias("pos"), class_count(F.col(label) != 1).alias("neg"))
    )
    below = total_before(F.col("neg"), *by, SLICE, order=["__score"])
    ranked = slice_by_range(scores, by, ["__score"]).withColumn("__below", below)
    wins = F.sum(F.col("pos") * (F.col("__below") + F.col("neg") / 2))
    slices = ranked.groupBy(*by, SLICE).agg(
        wins.alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    before = total_before(F.col("neg"), *by, order=[SLICE])
    totals = slices.withColumn("__before", before).groupBy(*by).agg(
        F.sum(F.col("wins") + F.col("pos").cast("double") * F.col("__before")).alias("wins"),
        F.sum("pos").cast("double").alias("pos"),
        F.sum("neg").cast("double").alias("neg"),
    )
    return totals.select(*by, F.try_divide(F.col("wins"), F.col("pos") * F.col("neg")).alias("auc"))


def gini(auc_col: Column) -> Column:
    return F.round(2 * auc_col - 1, 3)


def evaluate(df: DataFrame, score: str = "prediction", label: str = "label", by: str = "split") -> DataFrame:
    """AUC and Gini per split."""
    return auc(df, score, label, [by]).withColumn("gini", gini(F.col("auc")))


def prediction_stats(df: DataFrame, by: list[str] | None = None, score: str = "prediction") -> DataFrame:
    """Mean and population standard deviation of the predictions."""
    return df.groupBy(*(by or [])).agg(
        F.avg(score).alias("pred_mean"), F.stddev_pop(score).alias("pred_std")
    )


# --- scoring ----------------------------------------------------------------------


def score(
    df: DataFrame,
    model: PipelineModel,
    model_name: str,
    keys: tuple[str, ...] = ("Customer_ID", "snapshot_date"),
) -> DataFrame:
    """(keys, model_name, prediction): probability of class 1 for every row."""
    probability = vector_to_array("probability")[1]
    return model.transform(df).select(
        *keys, F.lit(model_name).alias("model_name"), probability.alias("prediction")
    )


def saved_nodes(model: GBTClassificationModel) -> DataFrame:
    """(tree, node, feature, threshold, low, high, prediction, n): the nodes of a fitted model as it is saved.

    Rows with features[feature] <= threshold go to node ``low``, others to ``high``; leaves have no feature.
    ``n`` and ``prediction`` are the training rows of a node and the mean of what they were fitted to.
    """
    path = fresh_path(SparkSession.active(), "trees")
    model.write().save(path)
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    nodes = SparkSession.active().read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("low"),
        F.when(inner, node["rightChild"]).alias("high"),
        node["prediction"].alias("prediction"),
        node["rawCount"].alias("n"),
    )
    return nodes


def tree_expressions(nodes: list[Row], cols: list[str], leaf: str = "prediction") -> list[str]:
    """SQL text of every tree, one nested CASE each, that gives a row's ``leaf`` (its prediction, or its number).

    A missing value counts as NaN, which is above every threshold.
    """
    trees: dict[int, dict[int, Row]] = {}
    for r in nodes:
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def text(tree: dict[int, Row], number: int) -> str:
        r = tree[number]
        if r["feature"] is None:
            return f"{r['prediction']!r}D" if leaf == "prediction" else str(number)
        low, high = text(tree, r["low"]), text(tree, r["high"])
        return f"CASE WHEN nvl(`{cols[r['feature']]}`, double('NaN')) <= {r['threshold']!r}D THEN {low} ELSE {high} END"

    return [text(trees[t], 0) for t in sorted(trees)]


def tree_margin(df: DataFrame, model: PipelineModel, name: str = "margin") -> DataFrame:
    """Add the margin of a boosted-tree pipeline as plain expressions: the scaled features, one value for each tree, their
    weighted sum. Neither vectors nor the fitted objects take part."""
    scaler, vector, boosted = model.stages
    # nodes of one model: bounded by its rounds and depth
    trees = tree_expressions(saved_nodes(boosted).collect(), vector.getInputCols())
    scaled = scaler.transform(df).withColumn("__trees", F.expr(f"array({', '.join(trees)})"))
    weights = F.array(*[F.lit(float(w)) for w in boosted.treeWeights])
    products = F.zip_with("__trees", weights, lambda p, w: p * w)
    margin = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    return scaled.withColumn(name, margin).drop("__trees", *[c for c in vector.getInputCols()])


def tree_score(
    df: DataFrame, model: PipelineModel, model_name: str, keys: tuple[str, ...] = ("Customer_ID", "snapshot_date")
) -> DataFrame:
    """What ``score`` gives for boosted trees, as a native expression: (keys, model_name, prediction)."""
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("margin") * -2.0))
    return tree_margin(df, model).select(*keys, F.lit(model_name).alias("model_name"), probability.alias("prediction"))


def leaf_statistics(train: DataFrame, model: PipelineModel, label: str = "label") -> DataFrame:
    """(tree, node, n, prediction, n_rows, mean_residual): every leaf as saved, and recomputed from its training rows.

    The first tree is fitted to the labels as -1 and 1, each other one to 4y / (1 + exp(2 y margin)) for the
    margin that the trees before it give. Holds for fits of all rows (subsamplingRate 1) without weights.
    """
    scaler, vector, boosted = model.stages
    saved = saved_nodes(boosted)
    nodes = saved.collect()
    values, leaves = (", ".join(tree_expressions(nodes, vector.getInputCols(), leaf)) for leaf in ("prediction", "node"))
    weights = ", ".join(f"{float(w)!r}D" for w in boosted.treeWeights)
    y = F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
    rows = scaler.transform(train).select(
        y.alias("y"),
        F.expr(f"array({leaves})").alias("nodes"),
        F.expr(f"zip_with(array({values}), array({weights}), (p, w) -> p * w)").alias("steps"),
    )
    before = F.aggregate(F.slice("steps", 1, F.col("tree")), F.lit(0.0), lambda total, x: total + x)
    long = rows.select("y", "steps", F.posexplode("nodes").alias("tree", "node")).withColumn("before", before)
    target = F.when(F.col("tree") == 0, F.col("y")).otherwise(4.0 * F.col("y") / (1.0 + F.exp(2.0 * F.col("y") * F.col("before"))))
    found = long.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(target).alias("mean_residual"))
    leaf_rows = saved.where(F.col("feature").isNull()).select("tree", "node", "n", "prediction")
    return leaf_rows.join(found, ["tree", "node"], "full")


def linear_score(df: DataFrame, weights: dict[str, float], intercept: float = 0.0) -> DataFrame:
    """Logistic score of fixed weights as a plain expression."""
    margin = sum((F.col(c) * F.lit(float(w)) for c, w in weights.items()), F.lit(float(intercept)))
    return df.withColumn("prediction", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


# --- persistence ------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class RunRecord:
    """One run: identifiers, tags, parameters and metrics."""

    run_id: str
    start_time: dt.datetime
    tags: dict[str, str]
    metrics: dict[str, float]
    params: dict[str, str]

    def row(self) -> Row:
        metrics = {k: float(v) for k, v in self.metrics.items() if v is not None}
        return Row(self.run_id, self.start_time, self.tags, self.params, metrics)


def log_run(spark: SparkSession, path: str, *records: RunRecord) -> DataFrame:
    """Append run records to the run log: one file a call and day, see ``writers.compact_runs``."""
    rows = spark.createDataFrame([r.row() for r in records], K.RUNS_SCHEMA)
    writers.append_runs(rows.coalesce(1), path)
    return rows


def model_card(
    version: str,
    windows: dict[str, Column],
    stats: DataFrame,
    results: DataFrame,
    params: dict[str, str],
    by: str = "split",
) -> DataFrame:
    """One row describing a model: dates, rows and label mean, AUC and Gini per split, parameters."""
    per_split = stats.join(results, by, "left").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col(by), F.struct("n_rows", "label_mean", "auc", "gini")))
        ).alias("splits")
    )
    settings = F.create_map(*[F.lit(x) for kv in params.items() for x in kv]) if params else F.create_map()
    return per_split.select(
        F.lit(version).alias("model_version"),
        F.struct(*[c.alias(name) for name, c in windows.items()]).alias("data_dates"),
        "splits",
        settings.alias("hp_params"),
    )



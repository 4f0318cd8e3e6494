"""Splits, folds, model fits, searches and evaluation.

Samples are rows in a named total order.  Searches work on ``in_blocks``: only the
sort key is sorted, the wide rows are tagged with their block where they are and
written once; folds and hold-out are filters on that tag.  Learning curves need
arbitrary prefixes and work on ``positioned`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.errors import ape, log_loss_term
from clickloom.operators.boosting import BoostedModel, GradientBoosting
from clickloom.operators.joins import flag_members
from clickloom.operators.ordered import tag_blocks, with_row_index
from clickloom.session import pin, together

POSITION = "position"
BLOCK = "block"
FIT_ROWS = 250_000      # rows that one task of a tree fit holds


# --- splits and folds -------------------------------------------------------------

def ordered_split(df: DataFrame, order: Sequence[str], share: float = 0.8, name: str = "is_train") -> DataFrame:
    """Mark the first ``floor(share * n)`` rows of the order."""
    tagged = tag_blocks(df, order, lambda n: [int(n * share)], "_block")
    return tagged.withColumn(name, F.col("_block") == 0).drop("_block")


def positioned(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return with_row_index(df, order, POSITION)


def fold_starts(n: int, folds: int) -> list[int]:
    """First positions of the validation blocks of an expanding-window split of ``n`` rows."""
    size = n // (folds + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    return [n - (folds - i) * size for i in range(folds)]


def expanding_folds(df: DataFrame, order: Sequence[str], folds: int, name: str = "block") -> DataFrame:
    """Block number per row: fold i validates on block i and trains on all blocks before."""
    return tag_blocks(df, order, lambda n: fold_starts(n, folds), name)


def kfold_starts(n: int, folds: int) -> list[int]:
    """First positions of contiguous folds; the first ``n % folds`` hold one row more."""
    if n < folds:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    size, extra = divmod(n, folds)
    return [i * size + min(i, extra) for i in range(folds)]


def in_blocks(df: DataFrame, order: Sequence[str], folds: int, scheme: str = "expanding",
              share: float = 1.0, write: bool = True) -> DataFrame:
    """Samples with their fold number in ``block``, written once (``write=False`` for a table that is written already).

    Folds are 1 to ``folds`` over the first ``floor(share * n)`` rows; 0 is what lies
    before the first expanding fold, and ``folds + 1`` the hold-out.
    """
    def starts(n: int) -> list[int]:
        size = int(n * share)
        inner = fold_starts(size, folds) if scheme == "expanding" else kfold_starts(size, folds)[1:]
        return [*inner, size]

    if scheme not in ("expanding", "blocked"):
        raise ValueError(f"unknown scheme {scheme!r}")
    tagged = tag_blocks(df, order, starts, BLOCK)
    if scheme == "blocked":
        tagged = tagged.withColumn(BLOCK, F.col(BLOCK) + 1)
    return pin(tagged, "samples") if write else tagged


# --- estimators ----------------------------------------------------------------------

def logistic(alpha: float = 1e-4, iterations: int = 100, tolerance: float = 1e-6) -> LogisticRegression:
    """L2 logistic model with penalty ``alpha`` on the raw coefficients."""
    return LogisticRegression(regParam=alpha, elasticNetParam=0.0, standardization=False,
                              maxIter=int(iterations), tol=tolerance)


def linear(alpha: float = 0.0, l1_share: float = 0.0) -> LinearRegression:
    """Least squares (``alpha=0``), ridge (``l1_share=0``), lasso (``1``) or elastic net."""
    return LinearRegression(regParam=alpha, elasticNetParam=l1_share, standardization=False)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, over tasks of at most about ``FIT_ROWS`` rows each: tree fits keep every row as an object, and narrow rows lie in few files."""
    rows = df.select(*columns)
    n = rows.count()
    return rows.repartition(-(-n // FIT_ROWS)) if n > FIT_ROWS else rows


class DealtGBTRegressor(GBTRegressor):
    def _fit(self, dataset: DataFrame) -> Model:
        return super()._fit(dealt(dataset, self.getLabelCol(), self.getFeaturesCol()))


class DealtRandomForestRegressor(RandomForestRegressor):
    def _fit(self, dataset: DataFrame) -> Model:
        return super()._fit(dealt(dataset, self.getLabelCol(), self.getFeaturesCol()))


def boosted_trees(depth: int = 2, trees: int = 20, rate: float = 0.1, subsample: float = 0.6,
                  min_rows: int = 1, min_gain: float = 0.0, seed: int = 7) -> GBTRegressor:
    return DealtGBTRegressor(maxDepth=int(depth), maxIter=int(trees), stepSize=rate, subsamplingRate=subsample,
                             minInstancesPerNode=int(min_rows), minInfoGain=min_gain, seed=seed)


def random_forest(trees: int = 20, depth: int = 5, seed: int = 7) -> RandomForestRegressor:
    return DealtRandomForestRegressor(numTrees=int(trees), maxDepth=int(depth), seed=seed)


# --- scoring and evaluation ---------------------------------------------------------------

def positive_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def score(model: Model, df: DataFrame, name: str = "prob") -> DataFrame:
    """Add the probability of the positive class."""
    scored = model.transform(df).withColumn(name, positive_probability())
    return scored.drop("rawPrediction", "probability", "prediction")


def zero_installed(scored: DataFrame, pairs: DataFrame, on: Sequence[str] = ("userID", "appID"),
                   probability: str = "prob", unique: bool = False) -> DataFrame:
    """Probability 0 for (user, app) pairs that are already installed."""
    flagged = flag_members(scored, pairs, list(on), "_installed", unique)
    value = F.when(F.col("_installed"), F.lit(0.0)).otherwise(F.col(probability))
    return flagged.withColumn(probability, value).drop("_installed")


def mean_log_loss(df: DataFrame, label: str = "label", probability: str = "prob") -> DataFrame:
    return df.agg(F.avg(log_loss_term(F.col(label), F.col(probability))).alias("log_loss"))


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg(ape(F.col(actual), F.col(predicted))).alias("mape"))


def mape_of_targets(df: DataFrame, actual: Sequence[str], predicted: Sequence[str]) -> DataFrame:
    """MAPE over all targets of all rows, as if they were one long column."""
    terms = F.array(*[ape(F.col(a), F.col(p)) for a, p in zip(actual, predicted, strict=True)])
    return df.select(F.explode(terms).alias("e")).agg(F.avg("e").alias("mape"))


def log_loss_measure() -> Column:
    """Per-row loss of a fitted classifier's output."""
    return log_loss_term(F.col("label"), positive_probability())


def mape_measure() -> Column:
    """Per-row loss of a fitted regressor's output."""
    return ape(F.col("label"), F.col("prediction"))


def squared_measure() -> Column:
    """Per-row squared error of a fitted regressor's output."""
    return F.pow(F.col("label") - F.col("prediction"), 2)


# --- searches --------------------------------------------------------------------------------

CURVE = "param double, fold int, train_loss double, valid_loss double"


def _fold_loss(samples: DataFrame, train: Column, valid: Column, estimator: Estimator,
               measure: Callable[[], Column]) -> tuple[float, float]:
    """Fit on the ``train`` rows; mean loss there and on the ``valid`` rows, in one pass."""
    model = estimator.fit(samples.filter(train))
    scored = model.transform(samples.filter(train | valid)).withColumn("_loss", measure())
    row = scored.agg(F.avg(F.when(train, F.col("_loss"))).alias("train"),
                     F.avg(F.when(valid, F.col("_loss"))).alias("valid")).first()
    return row.train, row.valid


def _curve(samples: DataFrame, tasks: list[tuple], run: Callable[[tuple], tuple], parallel: int) -> DataFrame:
    """Run independent fits, a few side by side, so that small folds do not leave the cluster idle."""
    spark = samples.sparkSession
    with ThreadPool(min(parallel, len(tasks))) as pool:
        rows = pool.map(inheritable_thread_target(spark)(run), tasks)
    return spark.createDataFrame(rows, CURVE)


def validation_curve(samples: DataFrame, make: Callable[[float], Estimator], params: Sequence[float],
                     folds: int, measure: Callable[[], Column] = log_loss_measure, parallel: int = 4,
                     scheme: str = "expanding") -> DataFrame:
    """Training and validation loss per parameter and fold of ``in_blocks`` samples.

    ``expanding`` trains on everything before a fold, ``blocked`` on all other folds.
    """
    block = F.col(BLOCK)

    def run(task):
        p, fold = task
        train = block < fold if scheme == "expanding" else (block != fold) & (block <= folds)
        return (p, fold, *_fold_loss(samples, train, block == fold, make(p), measure))

    return _curve(samples, [(float(p), fold) for p in params for fold in range(1, folds + 1)], run, parallel)


def _stages(model: Model, df: DataFrame, counts: Sequence[int]) -> tuple[DataFrame, dict[int, str]]:
    """Predictions of the first trees of a boosted ensemble, in one pass: a column for each number of trees."""
    names = {n: f"_stage_{n}" for n in counts}
    if isinstance(model, BoostedModel):
        return model.staged(df, {names[n]: n for n in counts}), names
    total, out = F.lit(0.0), {}
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights), 1):
        df = tree.copy().setPredictionCol(f"_tree_{i}").transform(df)
        total = total + F.col(f"_tree_{i}") * F.lit(float(weight))
        if i in names:
            out[names[i]] = total
    return df.withColumns(out).drop(*[f"_tree_{i + 1}" for i in range(len(model.trees))]), names


def staged_curve(samples: DataFrame, make: Callable[[int], Estimator], counts: Sequence[int], folds: int,
                 measure: Callable[[], Column] = mape_measure, parallel: int = 4, scheme: str = "expanding") -> DataFrame:
    """``validation_curve`` over numbers of boosted trees with one fit per fold.

    The first k trees of a boosted ensemble are those of a fit with k trees and the same seed, so the largest ensemble
    is fitted and its beginnings are evaluated, all in one pass.  (This does not hold for forests, whose trees are
    drawn together.)
    """
    block, counts = F.col(BLOCK), sorted({int(n) for n in counts})

    def run(fold: int) -> list[tuple]:
        train = block < fold if scheme == "expanding" else (block != fold) & (block <= folds)
        valid = block == fold
        model = make(counts[-1]).fit(samples.filter(train))
        staged, names = _stages(model, samples.filter(train | valid), counts)
        losses = staged.select(train.alias("_train"), "label", *names.values())
        for name in names.values():
            losses = losses.withColumn("prediction", F.col(name)).withColumn(name, measure())
        row = losses.agg(*[F.avg(F.when(F.col("_train") == side, F.col(name))).alias(f"{name}_{side}")
                           for name in names.values() for side in (True, False)]).first()
        return [(float(n), fold, row[f"{names[n]}_True"], row[f"{names[n]}_False"]) for n in counts]

    spark = samples.sparkSession
    with ThreadPool(min(parallel, folds)) as pool:
        found = pool.map(inheritable_thread_target(spark)(run), range(1, folds + 1))
    return spark.createDataFrame([row for rows in found for row in rows], CURVE)


def rank_params(curve: DataFrame) -> DataFrame:
    """Mean losses per parameter and their rank, best first (one row per parameter)."""
    means = curve.groupBy("param").agg(F.avg("train_loss").alias("mean_train_loss"),
                                       F.avg("valid_loss").alias("mean_val_loss"))
    return means.withColumn("rank_val_loss", F.rank().over(Window.orderBy("mean_val_loss")))


def grid_search(samples: DataFrame, make: Callable[[float], Estimator], params: Sequence[float],
                folds: int, measure: Callable[[], Column] = log_loss_measure, parallel: int = 4,
                scheme: str = "expanding") -> tuple[Model, float, DataFrame]:
    """Refit of the parameter with the lowest mean validation loss, that parameter, and the ranking.

    The refit uses all folds; a hold-out block stays out.
    """
    ranking = rank_params(validation_curve(samples, make, params, folds, measure, parallel, scheme))
    best = ranking.orderBy("rank_val_loss", "param").first().param
    return make(best).fit(samples.filter(F.col(BLOCK) <= folds)), best, ranking


def learning_curve(samples: DataFrame, make: Callable[[], Estimator], sizes: Sequence[int], folds: int,
                   measure: Callable[[], Column] = log_loss_measure, parallel: int = 4,
                   scheme: str = "expanding") -> DataFrame:
    """Losses per fold of ``positioned`` samples for growing sizes; ``param`` is the size.

    ``expanding`` folds the first ``size`` samples; ``blocked`` folds all samples and
    trains on the first ``size`` rows outside the fold.
    """
    n, at = samples.count(), F.col(POSITION)

    def run(task):
        size, i = task
        total = size if scheme == "expanding" else n
        starts = [*(fold_starts(total, folds) if scheme == "expanding" else kfold_starts(total, folds)), total]
        lo, hi = starts[i], starts[i + 1]
        valid = (at >= lo) & (at < hi)
        # the first ``size`` rows outside the fold end further on if they span it
        train = at < lo if scheme == "expanding" else ~valid & (at < (size if size <= lo else size + hi - lo))
        return (float(size), i + 1, *_fold_loss(samples, train, valid, make(), measure))

    return _curve(samples, [(int(size), i) for size in sizes for i in range(folds)], run, parallel)


class PerTarget:
    """Estimator of several targets: one independent model per target column."""

    def __init__(self, make: Callable[[], Estimator], targets: Sequence[str]):
        self.make, self.targets = make, list(targets)

    def fit(self, df: DataFrame) -> PerTargetModel:
        return PerTargetModel(fit_targets(df, self.make, self.targets))


class PerTargetModel:
    def __init__(self, models: Sequence[Model]):
        self.models = list(models)

    def transform(self, df: DataFrame) -> DataFrame:
        return predict_targets(self.models, df)


def mape_of_targets_measure(targets: Sequence[str]) -> Column:
    """Per-row loss of a ``PerTarget`` model: the mean error of its targets."""
    errors = F.filter(F.array(*[ape(F.col(t), F.col(f"pred_{t}")) for t in targets]), lambda e: e.isNotNull())
    return F.try_divide(F.aggregate(errors, F.lit(0.0), lambda a, e: a + e), F.size(errors))


def fit_targets(df: DataFrame, make: Callable[[], Estimator], targets: Sequence[str]) -> list[Model]:
    """One independent model per target column, fitted side by side."""
    names = [f"pred_{t}" for t in targets]
    if isinstance(make(), GradientBoosting):
        return make().fit_many(df, targets, names)

    def fit(target: str) -> Model:
        return make().setLabelCol(target).setPredictionCol(f"pred_{target}").fit(df.dropna(subset=[target]))

    return together(df.sparkSession, *[lambda t=t: fit(t) for t in targets])


def predict_targets(models: Sequence[Model], df: DataFrame) -> DataFrame:
    for model in models:
        df = model.transform(df)
    return df


def least_squares(df: DataFrame, feature: str, target: str, *by: str) -> DataFrame:
    """Slope and intercept of one feature, optionally per group: a plain aggregate."""
    return df.groupBy(*by).agg(F.regr_slope(target, feature).alias("slope"),
                               F.regr_intercept(target, feature).alias("intercept"))

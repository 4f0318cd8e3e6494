"""Linear models from sums of products: one scan for any number of penalties, folds and sample sizes.

The sums of products of (1, features, label) over the rows of a block are all that least squares, ridge, lasso and
elastic net need, and so are they for squared errors.  Sums of blocks add up, so folds and growing samples are sums of
the blocks of one aggregate.  With p features a block is a matrix of (p + 2)^2 numbers: these are solved on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.modelling import BLOCK, CURVE, POSITION, ape, fold_starts, kfold_starts

MOST_FEATURES = 1000        # a block of that many takes 4 MB in the aggregate


@dataclass
class Line:
    """Intercept and coefficients."""

    intercept: float
    weights: np.ndarray


def moments(samples: DataFrame, by: str | Column = BLOCK, features: str = "features", label: str = "label") -> dict[int, np.ndarray]:
    """Sums of products of (1, features, label) for each value of ``by``, in one scan that collapses in the map task.

    Rows without label or features are left out.  At most ``MOST_FEATURES`` features.
    """
    by = F.col(by) if isinstance(by, str) else by
    rows = samples.filter(F.col(label).isNotNull() & F.col(features).isNotNull())
    z = F.concat(F.array(F.lit(1.0)), vector_to_array(F.col(features)), F.array(F.col(label).cast("double")))
    size = F.size("z")
    products = F.flatten(F.transform("z", lambda v, i: F.transform(F.slice("z", i + 1, size - i), lambda w: v * w)))
    checked = F.when(size > MOST_FEATURES + 2, F.raise_error(F.lit(f"over {MOST_FEATURES} features"))).otherwise(products)
    table = rows.select(by.alias("by"), z.alias("z")).select("by", array_to_vector(checked).alias("products"))
    out = {}
    for row in table.groupBy("by").agg(Summarizer.sum(F.col("products")).alias("sums")).collect():
        upper = row.sums.toArray()
        p = int((np.sqrt(8 * len(upper) + 1) - 1) / 2)
        full = np.zeros((p, p))
        full[np.triu_indices(p)] = upper
        out[row.by] = full + np.triu(full, 1).T
    return out


def solve(sums: np.ndarray, penalty: float = 0.0, l1_share: float = 0.0, normalise: bool = False,
          rounds: int = 10_000, tolerance: float = 1e-10) -> Line:
    """The linear model of a matrix of sums.

    ``l1_share=0``: least squares with ``penalty`` times the squared coefficients (ridge).  Otherwise half the mean squared error plus
    ``penalty`` times (``l1_share`` times their sizes + half the rest times their squares): lasso, elastic net, by coordinate
    descent.  ``normalise`` applies the penalty to features of unit length about their mean.  The intercept is free.
    """
    n = sums[0, 0]
    mean = sums[0] / n
    about = sums - n * np.outer(mean, mean)
    a, b = about[1:-1, 1:-1], about[1:-1, -1]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0)) if normalise else np.ones(len(b))
    a, b = a / np.outer(scale, scale), b / scale
    if l1_share == 0.0:
        w = np.linalg.lstsq(a + penalty * np.eye(len(b)), b, rcond=None)[0]
    else:
        a, b, w = a / n, b / n, np.zeros(len(b))
        for _ in range(rounds):
            before = w.copy()
            for j in range(len(b)):
                if a[j, j] > 0:
                    pull = b[j] - a[j] @ w + a[j, j] * w[j]
                    w[j] = np.sign(pull) * max(abs(pull) - penalty * l1_share, 0.0) / (a[j, j] + penalty * (1 - l1_share))
            if np.abs(w - before).max(initial=0.0) <= tolerance * max(1.0, np.abs(w).max(initial=0.0)):
                break
    w = w / scale
    return Line(float(mean[-1] - mean[1:-1] @ w), w)


def squared_error(sums: np.ndarray, line: Line) -> float:
    """Mean squared error of a line on the rows behind the sums."""
    beta = np.concatenate(([-line.intercept], -line.weights, [1.0]))
    return float(beta @ sums @ beta / sums[0, 0])


def _total(found: dict[int, np.ndarray], blocks) -> np.ndarray | None:
    some = [m for b, m in found.items() if blocks(b)]
    return sum(some) if some else None


def penalty_curve(samples: DataFrame, penalties: Sequence[float], folds: int, l1_share: float = 0.0, scheme: str = "expanding",
                  normalise: bool = False, measure: str = "squared") -> DataFrame:
    """Losses per penalty and fold of ``in_blocks`` samples, as ``validation_curve`` gives them.

    ``squared``: mean squared errors, all from one scan.  ``relative``: mean relative errors, from one more scan for
    all penalties and folds together.
    """
    found = moments(samples.filter(F.col(BLOCK) <= folds))
    fits = []
    for fold in range(1, folds + 1):
        train = _total(found, (lambda b: b < fold) if scheme == "expanding" else (lambda b: b != fold))
        fits += [(float(p), fold, train, found[fold], solve(train, p, l1_share, normalise)) for p in penalties]
    spark = samples.sparkSession
    if measure == "squared":
        return spark.createDataFrame([(p, fold, squared_error(t, line), squared_error(v, line)) for p, fold, t, v, line in fits], CURVE)
    table = F.array(*[F.struct(F.lit(p).alias("param"), F.lit(fold).alias("fold"), F.lit(line.intercept).alias("a"),
                               F.array(*[F.lit(float(w)) for w in line.weights]).alias("w")) for p, fold, _, _, line in fits])
    x = vector_to_array(F.col("features"))
    each = (samples.filter(F.col(BLOCK) <= folds).select(BLOCK, "label", x.alias("x"), F.explode(table).alias("fit"))
            .select(BLOCK, "label", "x", "fit.*"))
    predicted = F.col("a") + F.aggregate(F.zip_with("x", "w", lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    train = F.col(BLOCK) < F.col("fold") if scheme == "expanding" else F.col(BLOCK) != F.col("fold")
    loss = ape(F.col("label"), predicted)
    return each.groupBy("param", "fold").agg(F.avg(F.when(train, loss)).alias("train_loss"),
                                             F.avg(F.when(F.col(BLOCK) == F.col("fold"), loss)).alias("valid_loss"))


def size_curve(samples: DataFrame, sizes: Sequence[int], folds: int, penalty: float = 0.0, l1_share: float = 0.0,
               scheme: str = "expanding") -> DataFrame:
    """``learning_curve`` of a linear model by mean squared error: all sizes and folds of ``positioned`` samples from one scan.

    The rows are cut wherever a training part or a fold begins or ends; each part is a sum of cuts.
    """
    n, parts = samples.count(), []
    for size in sizes:
        total = int(size) if scheme == "expanding" else n
        starts = [*(fold_starts(total, folds) if scheme == "expanding" else kfold_starts(total, folds)), total]
        for i, (lo, hi) in enumerate(zip(starts, starts[1:]), 1):
            if scheme == "expanding":
                train = [(0, lo)]
            else:       # the first ``size`` rows outside the fold end further on if they span it
                end = int(size) if size <= lo else int(size) + hi - lo
                train = [(0, min(lo, end)), (hi, end)]
            parts.append((float(size), i, [(a, b) for a, b in train if b > a], (lo, hi)))
    ends = sorted({x for _, _, train, valid in parts for a, b in [*train, valid] for x in (a, b)})
    cut = sum((F.col(POSITION) >= x).cast("int") for x in ends)
    found = moments(samples, cut)
    at = {x: i + 1 for i, x in enumerate(ends)}        # the cut that begins at x

    def sums(ranges: list[tuple[int, int]]) -> np.ndarray:
        return _total(found, lambda c: any(at[a] <= c < at[b] for a, b in ranges))

    rows = []
    for size, fold, train, valid in parts:
        line = solve(sums(train), penalty, l1_share)
        rows.append((size, fold, squared_error(sums(train), line), squared_error(sums([valid]), line)))
    return samples.sparkSession.createDataFrame(rows, CURVE)

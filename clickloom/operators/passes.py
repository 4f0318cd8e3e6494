"""Logistic models by shared passes over the rows: many fits in one scan, and stochastic descent pass by pass.

Sparse rows times many coefficient vectors at once is a matrix product that column expressions cannot state, so tasks
do it with numpy on Arrow batches.  The sums that leave a task are by feature, and collapse before the driver sees them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.modelling import BLOCK, CURVE, POSITION
from clickloom.session import pin, ship_package, together

MEMORY = 5              # steps a quasi-Newton fit remembers
SHARD_ROWS = 20_000     # rows of a shard that one task goes through in order
HELD_WEIGHTS = 1 << 22  # weights of all shards that a task goes through side by side


class Rows(NamedTuple):
    label: np.ndarray
    block: np.ndarray
    row: np.ndarray         # row of each entry
    index: np.ndarray
    value: np.ndarray


def entries(features: str) -> tuple[Column, Column]:
    """Places and values of a vector column, sparse or dense."""
    stored = F.unwrap_udt(F.col(features))
    places = F.when(stored["type"] == 0, stored["indices"]).otherwise(F.sequence(F.lit(0), F.size(stored["values"]) - 1))
    return places.alias("places"), stored["values"].alias("values")


def _rows(batch: pa.RecordBatch) -> Rows:
    label, block, places, values = (batch.column(i) for i in range(4))
    many = np.diff(places.offsets.to_numpy()) if len(places) else np.zeros(0, dtype=np.int64)
    return Rows(label.to_numpy(zero_copy_only=False).astype(float), block.to_numpy(zero_copy_only=False).astype(np.int64),
                np.repeat(np.arange(len(label)), many), places.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy())


def _log_loss(label: np.ndarray, margin: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, margin) - label * margin


def _margin(rows: Rows, weights: np.ndarray) -> np.ndarray:
    """Margins of all rows; the last weight is the intercept."""
    return np.bincount(rows.row, weights=weights[rows.index] * rows.value, minlength=len(rows.label)) + weights[-1]


def width(samples: DataFrame, features: str = "features") -> int:
    stored = F.unwrap_udt(F.col(features))
    row = samples.select(F.coalesce(stored["size"], F.size(stored["values"])).alias("n")).first()
    return row.n if row else 0


def _input(samples: DataFrame) -> DataFrame:
    ship_package(samples.sparkSession)
    return samples.select(F.col("label").cast("double").alias("label"), F.col(BLOCK).cast("int").alias("block"), *entries("features"))


def gradients(rows: DataFrame, weights: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss sum, row count and gradient sum of many models in one scan.

    ``weights``: (model, feature + intercept); ``train``: (model, block), which blocks a model learns from.  A task hands on one
    row for each feature it has met, with the sums of all models.
    """
    context = rows.sparkSession.sparkContext
    held, models = context.broadcast((weights, train)), len(weights)       # the models themselves: their size is the result's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, train = held.value
        total, loss, count = np.zeros_like(weights), np.zeros(models), np.zeros(models)
        for batch in batches:
            if not batch.num_rows:
                continue
            r = _rows(batch)
            for k in range(models):
                mine = train[k][r.block]
                if not mine.any():
                    continue
                margin = _margin(r, weights[k])
                loss[k] += _log_loss(r.label, margin)[mine].sum()
                count[k] += mine.sum()
                pull = np.where(mine, 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - r.label, 0.0)
                total[k, :-1] += np.bincount(r.index, weights=pull[r.row] * r.value, minlength=weights.shape[1] - 1)
                total[k, -1] += pull.sum()
        some = np.flatnonzero(total.any(axis=0))
        sums = np.concatenate((total[:, some].T, loss[None], count[None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((some, [-1, -2]))), pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), models)
             .cast(pa.list_(pa.float64()))], names=["feature", "sums"])

    found = (rows.mapInArrow(run, "feature long, sums array<double>").groupBy("feature")
             .agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect())
    held.destroy()
    gradient, loss, count = np.zeros_like(weights), np.zeros(models), np.zeros(models)
    for r in found:
        if r.feature >= 0:
            gradient[:, r.feature] = r.sums.toArray()
        elif r.feature == -1:
            loss = r.sums.toArray()
        else:
            count = r.sums.toArray()
    return loss, count, gradient


class _Descent:
    """Quasi-Newton descent of one model that asks for one evaluation at a time."""

    def __init__(self, size: int, penalty: float, tolerance: float):
        self.penalty, self.tolerance = penalty, tolerance
        self.at, self.value, self.slope = np.zeros(size), None, None
        self.asked, self.step, self.way = self.at, 1.0, None
        self.moves: list[tuple[np.ndarray, np.ndarray]] = []
        self.done, self.still = False, 0

    def answer(self, loss: float, count: float, gradient: np.ndarray) -> None:
        """Take the sums at ``asked`` and choose the next point."""
        count = max(count, 1.0)
        free = np.append(np.ones(len(self.at) - 1), 0.0) * self.penalty          # the intercept is free
        value = loss / count + 0.5 * float(free @ (self.asked * self.asked))
        slope = gradient / count + free * self.asked
        if self.value is not None and not value <= self.value + 1e-4 * self.step * float(self.slope @ self.way):
            self.step *= 0.5
            if self.step < 1e-10:
                self.done = True
            self.asked = self.at + self.step * self.way
            return
        if self.value is not None:
            moved, turned = self.asked - self.at, slope - self.slope
            if moved @ turned > 1e-14:
                self.moves = [*self.moves, (moved, turned)][-MEMORY:]
            self.still = self.still + 1 if self.value - value <= self.tolerance * max(abs(value), 1e-12) else 0
            self.done = self.still == 3 or np.abs(slope).max() < self.tolerance     # one short step is no sign yet
        self.at, self.value, self.slope = self.asked, value, slope
        q, kept = slope.copy(), []
        for moved, turned in reversed(self.moves):
            a = (moved @ q) / (moved @ turned)
            q -= a * turned
            kept.append(a)
        if self.moves:
            moved, turned = self.moves[-1]
            q *= (moved @ turned) / (turned @ turned)
        for (moved, turned), a in zip(self.moves, reversed(kept)):
            q += moved * (a - (turned @ q) / (moved @ turned))
        self.way = -q if q @ slope > 0 else -slope
        self.step = 1.0 if self.moves else min(1.0, 1.0 / max(np.abs(slope).sum(), 1e-12))
        self.asked = self.at + self.step * self.way


def fit_many(samples: DataFrame, penalties: Sequence[float], train: np.ndarray, iterations: int = 100,
             tolerance: float = 1e-10) -> np.ndarray:
    """Coefficients (model, feature + intercept) of L2 logistic models; a pass over the rows serves all that still descend.

    ``train`` tells the blocks of each model.  The scans are as many as the slowest model needs, whatever their number.
    The objective is the mean loss plus ``penalty`` / 2 times the squared coefficients, as in ``logistic``.
    """
    rows, size = _input(samples), width(samples) + 1
    found = [_Descent(size, float(p), tolerance) for p in penalties]
    for _ in range(iterations):
        open_ = [i for i, d in enumerate(found) if not d.done]
        if not open_:
            break
        loss, count, gradient = gradients(rows, np.stack([found[i].asked for i in open_]), train[open_])
        for j, i in enumerate(open_):
            found[i].answer(loss[j], count[j], gradient[j])
    return np.stack([d.at for d in found])


def losses(samples: DataFrame, weights: np.ndarray, parts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Mean log-loss of each model on its blocks of each of ``parts`` (model, block), all in one scan; NaN without rows."""
    context, models = samples.sparkSession.sparkContext, len(weights)
    held = context.broadcast((weights, list(parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, parts = held.value
        sums = np.zeros((len(parts), 2, models))
        for batch in batches:
            r = _rows(batch)
            for k in range(models if len(r.label) else 0):
                loss = _log_loss(r.label, _margin(r, weights[k]))
                for p, part in enumerate(parts):
                    mine = part[k][r.block]
                    sums[p, 0, k] += loss[mine].sum()
                    sums[p, 1, k] += mine.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["place", "total"])

    out = np.zeros((len(parts), 2, models))
    for r in _input(samples).mapInArrow(run, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        out.ravel()[r.place] = r.total
    with np.errstate(invalid="ignore"):
        return [part[0] / part[1] for part in out]


def _folds(n_params: int, folds: int, scheme: str) -> tuple[np.ndarray, np.ndarray]:
    """(train, valid) blocks of each (parameter, fold), folds running fastest; the hold-out block is in neither."""
    blocks = np.arange(folds + 2)
    fold = np.tile(np.arange(1, folds + 1), n_params)[:, None]
    train = blocks < fold if scheme == "expanding" else (blocks != fold) & (blocks <= folds)
    return train, blocks == fold


def shared_curve(samples: DataFrame, penalties: Sequence[float], folds: int, iterations: int = 100, scheme: str = "expanding",
                 tolerance: float = 1e-10) -> DataFrame:
    """``validation_curve`` of the penalties of a logistic model with all fits in the same scans of ``in_blocks`` samples."""
    train, valid = _folds(len(penalties), folds, scheme)
    weights = fit_many(samples, np.repeat(np.asarray(penalties, dtype=float), folds), train, iterations, tolerance)
    on_train, on_valid = losses(samples, weights, [train, valid])
    rows = [(float(p), fold + 1, float(on_train[i * folds + fold]), float(on_valid[i * folds + fold]))
            for i, p in enumerate(penalties) for fold in range(folds)]
    return samples.sparkSession.createDataFrame(rows, CURVE)


# --- stochastic descent ---------------------------------------------------------------------------------

def first_step(penalty: float) -> float:
    """Steps the schedule 1 / (penalty * (steps + this)) starts after, so that the first is in proportion to a typical weight."""
    typical = np.sqrt(1.0 / np.sqrt(penalty))
    return 1.0 / (typical / max(1.0, 1.0 / (1.0 + np.exp(-typical))) * penalty)


def descend(weights: np.ndarray, label: np.ndarray, starts: np.ndarray, index: np.ndarray, value: np.ndarray,
            penalty: float, done: int) -> np.ndarray:
    """One pass of stochastic gradient descent over the rows in order, ``done`` steps into the schedule; the weights after it."""
    w, scale, intercept, offset = weights[:-1].copy(), 1.0, weights[-1], first_step(penalty)
    for i in range(len(label)):
        at, x = index[starts[i]:starts[i + 1]], value[starts[i]:starts[i + 1]]
        margin = scale * float(w[at] @ x) + intercept
        pull = 1.0 / (1.0 + np.exp(-min(max(margin, -500.0), 500.0))) - label[i]
        rate = 1.0 / (penalty * (done + i + offset))
        scale *= 1.0 - rate * penalty
        if scale < 1e-9:
            w *= scale
            scale = 1.0
        w[at] -= rate * pull / scale * x
        intercept -= rate * pull
    return np.append(w * scale, intercept)


def descend_together(weights: np.ndarray, many: np.ndarray, label: np.ndarray, starts: np.ndarray, index: np.ndarray, value: np.ndarray,
                     penalty: float, number: int) -> np.ndarray:
    """``descend`` of shards of ``many`` rows each, which lie one after the other, side by side: (shard, weights) after pass ``number``.

    Step i takes row i of every shard that has one, so numpy is called once a step and not once a row.  The longest shards come first.
    """
    size, shards = len(weights) - 1, len(many)
    ranked = np.argsort(-many, kind="stable")
    place = np.empty(shards, dtype=np.int64)
    place[ranked] = np.arange(shards)
    at, step = np.repeat(place, many), np.arange(len(label)) - np.repeat(np.cumsum(many) - many, many)
    taken = np.lexsort((at, step))
    lengths = np.diff(starts)[taken]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    entry = np.repeat(starts[:-1][taken] - ends[:-1], lengths) + np.arange(ends[-1])
    label, who, value = label[taken], np.repeat(at[taken], lengths), value[entry]
    flat = who * size + index[entry]
    rows = np.concatenate(([0], np.cumsum(np.bincount(step))))
    bounds = ends[rows]
    w, scales, intercepts = np.tile(weights[:-1], shards), np.ones(shards), np.full(shards, weights[-1])
    each, done, offset = w.reshape(shards, size), number * many[ranked], first_step(penalty)
    for i in range(len(rows) - 1):
        n, here = rows[i + 1] - rows[i], slice(bounds[i], bounds[i + 1])
        f, x, k, scale = flat[here], value[here], who[here], scales[:n]
        margin = scale * np.bincount(k, w[f] * x, n) + intercepts[:n]
        pull = 1.0 / (1.0 + np.exp(-np.clip(margin, -500.0, 500.0))) - label[rows[i]:rows[i + 1]]
        rate = 1.0 / (penalty * (done[:n] + i + offset))
        scale *= 1.0 - rate * penalty
        if scale.min() < 1e-9:
            low = np.flatnonzero(scale < 1e-9)
            each[low] *= scale[low, None]
            scale[low] = 1.0
        w[f] -= (rate * pull / scale)[k] * x
        intercepts[:n] -= rate * pull
    return np.column_stack((each * scales[:, None], intercepts))[place]


def in_shards(samples: DataFrame, rows: int = SHARD_ROWS) -> DataFrame:
    """Written table of ``positioned`` samples with one row for each ``rows`` consecutive ones, so that passes move no rows."""
    ship_package(samples.sparkSession)
    places, values = entries("features")
    each = samples.select(F.floor(F.col(POSITION) / rows).cast("long").alias("shard"), F.struct(
        F.col(POSITION), F.col("label").cast("double").alias("label"), places, values).alias("one"))
    return pin(each.groupBy("shard").agg(F.array_sort(F.collect_list("one")).alias("ones")), "shards")


def passes(samples: DataFrame, penalty: float, n: int, shard_rows: int = SHARD_ROWS, where: Callable[[], Column] | None = None) -> np.ndarray:
    """Weights (pass, feature + intercept) of a logistic model after each of ``n`` passes of stochastic gradient descent.

    ``samples`` have positions.  Every pass starts each shard of ``shard_rows`` consecutive rows from the same weights, goes through it in
    order, and averages the shards' weights by their rows; with one shard this is the plain sequential method.
    """
    chosen = samples if where is None else samples.filter(where())
    shards, size = in_shards(chosen, shard_rows), width(chosen) + 1
    context, weights, out = samples.sparkSession.sparkContext, np.zeros(size), []
    for number in range(n):
        held = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], held=held, number=number) -> Iterator[pa.RecordBatch]:
            most = max(1, HELD_WEIGHTS // size)
            for batch in batches:
                for first in range(0, batch.num_rows, most):
                    ones = batch.column(0).slice(first, most)
                    flat, many = ones.flatten(), np.diff(ones.offsets.to_numpy())
                    label, places, values = (flat.field(name) for name in ("label", "places", "values"))
                    starts = places.offsets.to_numpy().astype(np.int64)
                    after = descend_together(held.value, many, label.to_numpy(), starts - starts[0], places.flatten().to_numpy(),
                                             values.flatten().to_numpy(), penalty, number)
                    yield pa.RecordBatch.from_arrays(
                        [pa.FixedSizeListArray.from_arrays(pa.array(after.ravel()), size).cast(pa.list_(pa.float64())),
                         pa.array(many.astype(float))], names=["weights", "rows"])

        moved = shards.select("ones").mapInArrow(run, "weights array<double>, rows double")
        mean = moved.select(Summarizer.mean(array_to_vector("weights"), F.col("rows")).alias("mean")).first().mean
        weights = mean.toArray() if mean is not None and mean.size == size else weights
        held.destroy()
        out.append(weights)
    return np.stack(out)


def pass_curve(samples: DataFrame, penalty: float, counts: Sequence[int], folds: int, scheme: str = "expanding",
               shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Losses for numbers of passes and folds of samples with ``position`` and ``block``; ``param`` is the number of passes.

    One descent per fold gives all its numbers of passes, and one scan all losses.
    """
    train, valid = _folds(len(counts), folds, scheme)
    block, most = F.col(BLOCK), max(int(c) for c in counts)

    def run(fold: int) -> np.ndarray:
        of_fold = (lambda: block < fold) if scheme == "expanding" else (lambda: (block != fold) & (block <= folds))
        return passes(samples, penalty, most, shard_rows, of_fold)

    by_fold = together(samples.sparkSession, *[lambda f=f: run(f) for f in range(1, folds + 1)])
    weights = np.stack([by_fold[fold][int(c) - 1] for c in counts for fold in range(folds)])
    on_train, on_valid = losses(samples, weights, [train, valid])
    rows = [(float(c), fold + 1, float(on_train[i * folds + fold]), float(on_valid[i * folds + fold]))
            for i, c in enumerate(counts) for fold in range(folds)]
    return samples.sparkSession.createDataFrame(rows, CURVE)

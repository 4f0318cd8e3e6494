"""Encode, split, tune and score the click data sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators.aggregates import fold_summary
from clickloom.operators.encode import add_crosses, dictionary, encode_rows, tasks_of, truncated
from clickloom.operators.modelling import (
    BLOCK,
    in_blocks,
    logistic,
    mean_log_loss,
    positioned,
    rank_params,
    score,
    zero_installed,
)
from clickloom.operators.passes import pass_curve, shared_curve
from clickloom.sources.sinks import submission

# Searched penalties, penalty of the quick fit, folds, training share.
ALPHAS = [0.0001, 0.001, 0.01, 0.1]
QUICK_ALPHA = 0.01
FOLDS = 5
TRAIN_SHARE = 0.8
INSTALLED = "is_installed"
RATIOS = ["conversion_ratio_connectionType", "conversion_ratio_telecomsOperator",
          "hour_conversion_ratio", "conversion_ratio_click"]


@dataclass
class Encoded:
    """Dictionary of the one-hot columns and the encoded sets, all written tables, and the columns they come from."""

    dictionary: DataFrame
    train: DataFrame
    score: DataFrame | None
    features: list[str]
    numeric: list[str]


def categorical_columns(df: DataFrame, numeric: Sequence[str] = RATIOS,
                        ignore: Sequence[str] = ("label", "instanceID")) -> list[str]:
    return [c for c in df.columns if c not in numeric and c not in ignore and not c.startswith("_")]


def encode(train: DataFrame, scoring: DataFrame | None = None, keep: Sequence[str] = (),
           compat_int: bool = False, unseen: str = "keep") -> Encoded:
    """One-hot encode all columns but the ratios, fitted on ``train`` only.

    Columns whose name starts with ``_`` (such as ordering columns) are no features.
    ``compat_int`` treats the ratios as truncated whole numbers and encodes them too.  ``keep`` columns must be in
    the training set; the scoring set passes on those it has.
    """
    absent = [c for c in keep if c not in train.columns]
    if absent:
        raise ValueError(f"columns to keep are not in the training set: {absent}")
    numeric = [c for c in RATIOS if c in train.columns]
    if compat_int:
        train = truncated(train, numeric)
        scoring = truncated(scoring, numeric) if scoring is not None else None
        numeric = []
    features = categorical_columns(train, numeric, ("label", "instanceID", *keep))
    words = dictionary(train, features)

    held = [c for c in ("label", "instanceID", *keep) if c in train.columns]
    fitted = encode_rows(train, words, features, numeric, held, unseen)
    scored = encode_scoring(scoring, words, features, numeric, keep, unseen) if scoring is not None else None
    return Encoded(words, fitted, scored, features, numeric)


def encode_scoring(scoring: DataFrame, words: DataFrame, features: Sequence[str], numeric: Sequence[str],
                   keep: Sequence[str] = (), unseen: str = "keep") -> DataFrame:
    """Rows to score in the columns of a fitted encoding; the flag of installed pairs is passed on, as the submission needs it."""
    held = dict.fromkeys(c for c in ("label", "instanceID", INSTALLED, *keep) if c in scoring.columns)
    return encode_rows(scoring, words, features, numeric, list(held), unseen)


def linear_terms(train: DataFrame, crosses: bool = False, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Dictionary and encoded rows of the ad, context and user groups of a written table, optionally with all pairwise crosses."""
    groups = [schemas.AD_FEATURES, schemas.CONTEXT_FEATURES, schemas.USER_FEATURES]
    features = [f for g in groups for f in g]
    if crosses:
        pairs = ((groups[0], groups[1]), (groups[0], groups[2]), (groups[1], groups[2]))
        train = train.repartition(tasks_of(train.count(), len(features) + sum(len(a) * len(b) for a, b in pairs)))
        for a, b in pairs:
            train, made = add_crosses(train, a, b)
            features = features + made
    words = dictionary(train, features)
    return words, encode_rows(train, words, features, keep=keep)


def tune(encoded: DataFrame, order: Sequence[str], share: float = TRAIN_SHARE, folds: int = FOLDS,
         alphas: Sequence[float] = tuple(ALPHAS), iterations: int = 100) -> tuple[Model, float, DataFrame, float]:
    """Hold out the end of the order, search the penalty on the rest, refit the best.

    All penalties and folds are fitted in the same scans.  Returns the model, its penalty, the ranking and the held-out log-loss.
    """
    samples = in_blocks(encoded.select(*order, "label", "features"), order, folds, share=share, write=False)
    ranking = rank_params(shared_curve(samples, alphas, folds, iterations))
    best = ranking.orderBy("rank_val_loss", "param").first().param
    model = logistic(best, iterations).fit(samples.filter(F.col(BLOCK) <= folds))
    held_out = samples.filter(F.col(BLOCK) > folds)
    return model, best, ranking, mean_log_loss(score(model, held_out)).first().log_loss


def penalty_curve(encoded: DataFrame, order: Sequence[str], alphas: Sequence[float], folds: int,
                  iterations: int = 100) -> DataFrame:
    """Mean and spread of the losses per penalty."""
    samples = in_blocks(encoded.select(*order, "label", "features"), order, folds, write=False)
    return fold_summary(shared_curve(samples, alphas, folds, iterations), "param", "train_loss", "valid_loss")


def iteration_curve(encoded: DataFrame, order: Sequence[str], iterations: Sequence[int], folds: int,
                    alpha: float = 0.0001) -> DataFrame:
    """Mean and spread of the losses per number of passes of stochastic gradient descent."""
    samples = in_blocks(positioned(encoded.select(*order, "label", "features"), order), order, folds)
    return fold_summary(pass_curve(samples, alpha, iterations, folds), "param", "train_loss", "valid_loss")


def quick_fit(encoded: DataFrame, alpha: float = QUICK_ALPHA, iterations: int = 100) -> tuple[Model, float]:
    """Fit on all rows; the model and its log-loss on those rows."""
    model = logistic(alpha, iterations).fit(encoded)
    return model, mean_log_loss(score(model, encoded)).first().log_loss


def predict(model: Model, scoring: DataFrame, pairs: DataFrame | None = None, installed: bool = False) -> DataFrame:
    """Submission table.

    Installed (user, app) pairs get probability 0: those among ``pairs``, or with ``installed`` those that carry the flag.
    """
    scored = score(model, scoring)
    if pairs is not None:
        scored = zero_installed(scored, pairs)
    if installed:
        scored = scored.withColumn("prob", F.when(F.col(INSTALLED).cast("int") == 1, F.lit(0.0)).otherwise(F.col("prob")))
    return submission(scored)

"""Per-row error terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1.
PROBABILITY_FLOOR = 1e-15


def ape(actual: Column, predicted: Column) -> Column:
    """Absolute error as a share of the actual value; null where that is 0."""
    return F.abs(F.try_divide(actual - predicted, actual))


def log_loss_term(label: Column, probability: Column, floor: float = PROBABILITY_FLOOR) -> Column:
    p = F.least(F.greatest(probability, F.lit(floor)), F.lit(1 - floor))
    return F.when(label == 1, -F.log(p)).otherwise(-F.log1p(-p))

"""Scalar expressions on predictions, scores and pixel arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(name: str) -> Column:
    """Column as DOUBLE, with NaN as NULL: both mean that the value is missing."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def relu(value: Column) -> Column:
    """Negative values become 0; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def threshold(value: Column, cut: float = 0.5) -> Column:
    """1 from `cut` on, else 0; NULL and NaN give NULL."""
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    return F.when(known, F.when(value >= F.lit(float(cut)), 1).otherwise(0)).cast("int")


def argmax(scores: Column) -> Column:
    """Zero-based position of the largest score; the first one wins a tie. A missing score, NULL or NaN, gives NULL, as no scores do."""
    whole = F.forall(scores, lambda s: s.isNotNull() & ~F.isnan(s.cast("double")))
    return F.when(whole & (F.size(scores) > 0), F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def log_sum_exp(scores: Column) -> Column:
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s.cast("double") - top))
    return top + F.log(total)


def cross_entropy(scores: Column, label: Column) -> Column:
    """Negative log softmax of the labelled class, shifted by the maximum against overflow."""
    return log_sum_exp(scores) - F.element_at(scores, label.cast("int") + 1).cast("double")


def softmax(scores: Column) -> Column:
    total = log_sum_exp(scores)
    return F.transform(scores, lambda s: F.exp(s.cast("double") - total))


def normalize_pixels(pixels: Column, mean: float, sd: float, full_scale: float = 1.0) -> Column:
    """(pixel / full_scale - mean) / sd for every element."""
    return F.transform(
        pixels, lambda p: (p.cast("double") / F.lit(float(full_scale)) - F.lit(mean)) / F.lit(sd)
    )


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def affine(inputs: list[Column], weights: list[float], bias: float) -> Column:
    """bias + sum of weight * input, with the numbers as literals."""
    return total([F.lit(float(bias))] + [F.lit(float(w)) * x for w, x in zip(weights, inputs)])


def squared_distance(left: list[Column], right: list[Column]) -> Column:
    return total([(a - b) * (a - b) for a, b in zip(left, right)])

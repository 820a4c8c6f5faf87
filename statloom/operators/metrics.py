"""Regression and classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cross_entropy, number


def residuals(df: DataFrame, y: str, prediction: str, keep: list[str]) -> DataFrame:
    """One row per sample: the ends of the residual segment and its signed length."""
    a, b = F.col(y).cast("double"), F.col(prediction).cast("double")
    return df.select(*keep, b.alias("predicted"), a.alias("actual"), (a - b).alias("residual"))


def regression_metrics(
    df: DataFrame, y: str, prediction: str, n_features: int, group: list[str] = ()
) -> DataFrame:
    """MSE, residual sum of squares, R squared and residual standard error in one aggregate.

    Pairs with a NULL or NaN on either side count nowhere. R squared of a constant target is 1 for a perfect fit and 0 otherwise; the standard error is
    NULL where no degree of freedom is left.
    """
    a, b = number(y), number(prediction)
    whole = a.isNotNull() & b.isNotNull()
    a, b = F.when(whole, a), F.when(whole, b)
    sums = df.groupBy(*group).agg(
        F.count(a).alias("n"),
        F.sum((a - b) * (a - b)).alias("rss"),
        (F.var_pop(a) * F.count(a)).alias("tss"),
    )
    freedom = F.col("n") - F.lit(n_features + 1)
    r2 = F.when(F.col("tss") > 0, 1 - F.col("rss") / F.col("tss")).otherwise(
        F.when(F.col("rss") == 0, 1.0).when(F.col("n") > 0, 0.0)
    )
    return sums.select(
        *group,
        "n",
        F.when(F.col("n") > 0, F.col("rss") / F.col("n")).alias("mse"),
        "rss",
        r2.alias("r2"),
        F.when(freedom > 0, F.sqrt(F.col("rss") / freedom)).alias("rse"),
    )


def accuracy(df: DataFrame, label: str, prediction: str, group: list[str] = ()) -> DataFrame:
    """Percentage of equal labels, to two decimals."""
    hit = F.when(F.col(label) == F.col(prediction), 1).otherwise(0)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(hit) * 100.0 / F.count(F.lit(1)), 2).alias("accuracy")
    )


def mean_cross_entropy(df: DataFrame, scores: str, label: str, group: list[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(F.avg(cross_entropy(F.col(scores), F.col(label))).alias("loss"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    """Accuracy, precision, recall and F1 of a positive class; 0 where a ratio has no rows."""

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    is_pos, said_pos = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        count(is_pos & said_pos).alias("tp"),
        count(~is_pos & said_pos).alias("fp"),
        count(is_pos & ~said_pos).alias("fn"),
        count(F.col(label) == F.col(prediction)).alias("hits"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "n",
        ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def disagreements(left: DataFrame, right: DataFrame, id_col: str, label: str) -> DataFrame:
    """Rows for which two scored tables predict different labels."""
    a = left.select(id_col, label, F.col("prediction").alias("prediction_a"))
    b = right.select(id_col, F.col("prediction").alias("prediction_b"))
    return a.join(b, id_col).where(F.col("prediction_a") != F.col("prediction_b"))


def batch_loss(df: DataFrame, epoch: str, batch: str, loss: Column) -> DataFrame:
    """Mean of batch means per epoch, over the true number of batches."""
    per_batch = df.groupBy(epoch, batch).agg(F.avg(loss).alias("loss"))
    return per_batch.groupBy(epoch).agg(F.count(F.lit(1)).alias("batches"), F.avg("loss").alias("loss"))

"""Evaluation of predictions, each metric one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.operators.ranks import exact_quantiles
from rowsmith.operators.stats import crosstab, present

EPS = 2.220446049250313e-16


def regression_exprs(y: str, pred: str) -> dict[str, Column]:
    """R2, MAE, MAPE and RMSE as aggregates over the rows that have both numbers, usable with and without grouping.

    The total sum of squares is n times the population variance, which Spark
    computes in the same pass without subtracting large sums.
    """
    both = F.col(y).isNotNull() & F.col(pred).isNotNull()
    t, p = (F.when(both, F.col(c).cast("double")) for c in (y, pred))
    err = t - p
    return {
        "r2": 1 - F.try_divide(F.sum(err * err), F.count(t) * F.var_pop(t)),
        "mae": F.avg(F.abs(err)),
        "mape": F.avg(F.abs(err) / F.greatest(F.abs(t), F.lit(EPS))),
        "rmse": F.sqrt(F.avg(err * err)),
    }


def regression_metrics(df: DataFrame, y: str, pred: str, by=()) -> DataFrame:
    exprs = [c.alias(n) for n, c in regression_exprs(y, pred).items()]
    return present(df, by).groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def median_absolute_error(df: DataFrame, y: str, pred: str) -> DataFrame:
    errors = df.select(F.abs(F.col(y) - F.col(pred)).alias("e"))
    return exact_quantiles(errors, ["e"], [0.5]).select(F.get("q", 0).alias("median_abs_error"))


def log_error_score(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One minus the median absolute error of the logarithms."""
    logs = df.select(F.log(y).alias("a"), F.log(pred).alias("b"))
    return median_absolute_error(logs, "a", "b").withColumn("one_minus_error", 1 - F.col("median_abs_error"))


def accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion_counts(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Long confusion table (truth, predicted, n) of the rows that have both labels, like every class metric here."""
    return present(df, [y, pred]).groupBy(F.col(y).alias("truth"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, y: str, pred: str, classes=None) -> DataFrame:
    """Rows are the truth, columns the prediction, absent cells zero."""
    return crosstab(df, y, pred, classes)


def class_scores(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class; 0/0 counts as 0."""
    counts = confusion_counts(df, y, pred)
    cells = counts.select(F.inline(F.array(
        F.struct(F.col("truth").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hit")),
    )))
    sums = cells.groupBy("class").agg(F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hit", "guessed"), zero)
    recall = F.coalesce(F.try_divide("hit", "support"), zero)
    return sums.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    ).select("class", "precision", "recall", "f1", "support", "hit")


def balanced_accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Mean recall over the classes present in the truth."""
    return class_scores(df, y, pred).where(F.col("support") > 0).agg(F.avg("recall").alias("balanced_accuracy"))


def f1_binary(df: DataFrame, y: str, pred: str, positive=1) -> DataFrame:
    t, p = F.col(y) == F.lit(positive), F.col(pred) == F.lit(positive)
    hit, fp, fn = F.count_if(t & p), F.count_if(~t & p), F.count_if(t & ~p)
    return present(df, [y, pred]).agg(F.coalesce(F.try_divide(2 * hit, 2 * hit + fp + fn), F.lit(0.0)).alias("f1"))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per-class scores followed by the rows accuracy, macro avg and weighted avg."""
    scores = class_scores(df, y, pred)
    rows = scores.select(F.col("class").cast("string").alias("label"), "precision", "recall", "f1", "support")
    n = F.sum("support")
    acc = F.sum("hit") / n
    summary = scores.agg(
        acc.alias("acc"), n.alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    ).select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.col("acc").alias("precision"), F.col("acc").alias("recall"),
                 F.col("acc").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("m_precision").alias("precision"), F.col("m_recall").alias("recall"),
                 F.col("m_f1").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("w_precision").alias("precision"),
                 F.col("w_recall").alias("recall"), F.col("w_f1").alias("f1"), F.col("n").alias("support")),
    )))
    return rows.unionByName(summary)

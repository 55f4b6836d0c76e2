"""Forecast errors, overall and by group; classification tables; shifts between data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _errors(y: str, p: str) -> dict[str, Column]:
    e = F.col(y) - F.col(p)
    spread = F.sum(F.col(y) * F.col(y)) - F.count(y) * F.avg(y) * F.avg(y)
    return {"rmse": F.sqrt(F.avg(e * e)), "mae": F.avg(F.abs(e)), "r2": 1 - F.sum(e * e) / (spread + 1e-10), "n": F.count(F.lit(1))}


def regression(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """rmse, mae, r2 and n, of all rows or of each group, in one aggregation."""
    return df.groupBy(*(by or [])).agg(*[c.alias(k) for k, c in _errors(y, p).items()])


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    """Mean and population deviation of the residuals, and the percentages within 5 and 10."""
    e = F.col(y) - F.col(p)
    within = lambda k: F.avg(F.when(F.abs(e) <= k, 100.0).otherwise(0.0))
    return df.agg(F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), within(5).alias("within_5"), within(10).alias("within_10"))


def mean_baseline(train: DataFrame, test: DataFrame, y: str) -> DataFrame:
    guess = train.agg(F.avg(y).alias("_p"))  # one row
    return regression(test.crossJoin(F.broadcast(guess)), y, "_p")


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve from average ranks (ties count half)."""
    from .stats import average_ranks

    counts = df.select(F.col(label).alias("y"), F.col(score).cast("double").alias("x")).na.drop().groupBy("x").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("q"), F.count(F.lit(1)).alias("n"))
    one = average_ranks(counts, ["x"], "n").agg(F.sum(F.col("p") * F.col("r_x")).alias("s"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    return one.select(F.try_divide(F.col("s") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q")).alias("auc"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """True and false positive rates at each distinct score (a table of scores, best first)."""
    from pyspark.sql import Window

    counts = df.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    down = Window.orderBy(F.col(score).desc())
    whole = Window.partitionBy()
    return counts.select(F.col(score).alias("threshold"), F.try_divide(F.sum("p").over(down), F.sum("p").over(whole)).alias("tpr"), F.try_divide(F.sum("q").over(down), F.sum("q").over(whole)).alias("fpr"))


def shift(train: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and deviation of each column in two data sets, and how many deviations the means are apart."""
    from .stats import melt

    one = lambda df: melt(df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns]), columns)
    a = one(train).select("column", F.col("value.mean").alias("train_mean"), F.col("value.std").alias("train_std"))
    b = one(other).select("column", F.col("value.mean").alias("other_mean"), F.col("value.std").alias("other_std"))
    return a.join(b, "column").withColumn("shift", (F.col("other_mean") - F.col("train_mean")) / (F.col("train_std") + 1e-10))


def zscores(df: DataFrame, fit: DataFrame, columns: list[str], like: dict[str, str] | None = None) -> DataFrame:
    """(x - mean) / population deviation, fitted on another frame; like: columns scaled with another's figures."""
    like = like or {}
    base = sorted({like.get(c, c) for c in columns})
    figures = fit.agg(*[x for c in base for x in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])  # one row
    wide = df.crossJoin(F.broadcast(figures))
    scaled = {c: (F.col(c) - F.col(f"_m_{like.get(c, c)}")) / F.when(F.col(f"_s_{like.get(c, c)}") > 0, F.col(f"_s_{like.get(c, c)}")).otherwise(1.0) for c in columns}
    return wide.withColumns(scaled).select(*df.columns)


def minmax(df: DataFrame, column: str, name: str) -> DataFrame:
    """Scaled to 0..1; all 0 where the range is under 1e-10."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))  # one row
    span = F.col("_hi") - F.col("_lo")
    return df.crossJoin(F.broadcast(ends)).withColumn(name, F.when(span < 1e-10, 0.0).otherwise((F.col(column) - F.col("_lo")) / span)).drop("_lo", "_hi")

"""Lags, rolling means, time-ordered splits, look-back sequences, ordered tops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lags(df: DataFrame, columns: list[str], n: int, key: str, order: list[str]) -> DataFrame:
    """<column>_past_1 to _past_n: values so many rows (not hours) earlier in the same series."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({f"{c}_past_{k}": F.lag(c, k).over(w) for c in columns for k in range(1, n + 1)})


def rolling_mean(df: DataFrame, column: str, rows: int, key: str, order: list[str], name: str) -> DataFrame:
    """Mean of the last rows, null before there are as many."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn(name, F.when(F.count(column).over(w) >= rows, F.avg(column).over(w)))


def time_split(df: DataFrame, share: float, key: str, order: list[str]) -> DataFrame:
    """is_train: whether a row is among the first int(n * (1 - share)) of its series."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return df.withColumn("is_train", nth <= F.floor(n * (1.0 - share) + 1e-9))


def sequences(df: DataFrame, features: list[str], target: str, lookback: int, horizon: int, key: str, order: list[str]) -> DataFrame:
    """A row for each full window: its features (oldest first) and the target lookback + horizon - 1 rows after its first."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-(lookback + horizon - 1), -horizon)
    held = df.withColumn("sequence", F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(w))
    return held.where(F.size("sequence") == lookback).select(key, *[c for c in order if c != key], "sequence", F.col(target).alias("target"))


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def in_stated_order(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows in a stated order of one column; values that have no row get one of nulls."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(enumerate(values)), f"_place int, {column} string")
    return wanted.join(df, column, "left").withColumnRenamed("_place", "place")

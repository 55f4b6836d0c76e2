"""Filters of columns: by cardinality, variance, name patterns and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stats

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def cardinality_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return stats.melt(df.agg(*[stats.cardinality(c).alias(c) for c in columns]), columns).withColumnRenamed("value", "n_distinct")


def variance_table(df: DataFrame, columns: list[str]) -> DataFrame:
    return stats.melt(df.agg(*[stats.normalized_variance(c).alias(c) for c in columns]), columns).withColumnRenamed("value", "variance")


def without_low_cardinality(df: DataFrame, least: int, excluded: tuple[str, ...] = ()) -> DataFrame:
    measured = [c for c in df.columns if c not in excluded]
    low = {r.column for r in cardinality_table(df, measured).collect() if r.n_distinct < least}  # a row a column
    return df.select(*[c for c in df.columns if c not in low])


def without_low_variance(df: DataFrame, least: float, excluded: tuple[str, ...] = (), poisoned: tuple[str, ...] = ()) -> DataFrame:
    """Drop numeric columns under a normalized variance; excluded ones are not measured, poisoned ones (with gaps the engine made) stay."""
    measured = [c for c, k in df.dtypes if k in NUMERIC and c not in excluded and c not in poisoned]
    low = {r.column for r in variance_table(df, measured).collect() if r.variance is not None and r.variance < least}
    return df.select(*[c for c in df.columns if c not in low])


def numeric_columns(df: DataFrame, metadata: tuple[str, ...] = ()) -> list[str]:
    return [c for c, k in df.dtypes if k in NUMERIC and c not in metadata]


def direction_columns(columns: list[str], listed: tuple[str, ...] = ()) -> list[str]:
    return [c for c in columns if c in listed or ("direction" in c.lower() and not c.endswith(("_sin", "_cos")))]


def binary_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns of two distinct values (nulls aside) that are no cyclic part."""
    plain = [c for c in columns if not c.endswith(("_sin", "_cos"))]
    one = df.agg(*[F.countDistinct(c).alias(c) for c in plain]).first()
    return [c for c in plain if one[c] == 2]


def feature_groups(df: DataFrame, features: list[str], lagged: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """cyclic, lag, binary and base columns."""
    cyclic = [c for c in features if c.endswith(("_sin", "_cos"))]
    lag = [c for c in features if any(c.startswith(f"{x}_past_") for x in lagged)]
    rest = [c for c in features if c not in cyclic and c not in lag]
    binary = binary_columns(df, rest)
    return {"cyclic": cyclic, "lag": lag, "binary": binary, "base": [c for c in rest if c not in binary]}


def first_lags(columns: list[str], feature: str, n: int | None = None) -> list[str]:
    own = sorted((c for c in columns if c.startswith(f"{feature}_past_")), key=lambda c: int(c.rsplit("_", 1)[1]))
    return own[:n]


def output_order(left: list[str], right: list[str], keys: list[str], derived: list[str], dropped: list[str] = ()) -> list[str]:
    """Keys, the left side's others, the right side's new ones, then derived columns."""
    rest = [c for c in [*left, *[c for c in right if c not in left]] if c not in keys and c not in dropped]
    return [*keys, *rest, *[c for c in derived if c not in rest]]

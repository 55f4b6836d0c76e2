"""Projection, filters, duplicates, unions and alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: list[str], missing: str = "error", keys: tuple[str, ...] = ()) -> DataFrame:
    """Drop columns; missing names raise (or are ignored), key columns may not be dropped."""
    held = set(names) & set(keys)
    if held:
        raise ValueError(f"key columns may not be dropped: {sorted(held)}")
    lacking = [n for n in names if n not in df.columns]
    if lacking and missing == "error":
        raise ValueError(f"no such columns: {lacking}")
    return df.drop(*[n for n in names if n in df.columns])


def find_column(names: list[str], candidates: list[str]) -> str | None:
    """The first candidate that is a name (whatever its case), else the first that is part of one."""
    lower = {n.lower(): n for n in reversed(names)}
    for c in candidates:
        if c.lower() in lower:
            return lower[c.lower()]
    return next((n for c in candidates for n in names if c.lower() in n.lower()), None)


def first_of_each(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a stated order."""
    ranked = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_nth = 1").drop("_nth")


def members(df: DataFrame, other: DataFrame, keys: list[str], keep: bool = True) -> DataFrame:
    """Rows whose key is (or is not) among other's."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi" if keep else "left_anti")


def strict_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, whose headers must be equal."""
    if a.columns != b.columns:
        raise ValueError(f"headers differ: {a.columns} and {b.columns}")
    return a.union(b)


def align(df: DataFrame, to: DataFrame) -> DataFrame:
    """df with the columns of another frame, in its order: missing ones null, others gone."""
    kinds = dict(to.dtypes)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in to.columns])


def split_at_quantile(df: DataFrame, column: str, q: float) -> tuple[DataFrame, DataFrame]:
    """Rows above the exact quantile, and the others (nulls are others)."""
    from .stats import quantiles

    over = F.coalesce(F.col(column) > F.lit(quantiles(df, [column], [q])[column][0]).cast("double"), F.lit(False))
    return df.where(over), df.where(~over)


def numbered_batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """A batch number for each row of a small table (locations to ask for)."""
    return df.withColumn("batch", ((F.row_number().over(Window.orderBy(*order)) - 1) / size).cast("int"))


def recoded(df: DataFrame, column: str, names: dict[str, str], to: str) -> DataFrame:
    """Rows of the named categories alone, their names changed."""
    renamed = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col(column)]
    return df.where(F.col(column).isin(list(names))).withColumn(to, renamed).drop(column)


def _draw(key: str, seed: int) -> Column:
    """A number under 2 ** 52 from the seed and a row's key."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def sampled(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows (all, where there are fewer) that the seed decides, whatever the partitioning: a bounded top in each task."""
    return df.withColumn("_draw", _draw(key, seed)).orderBy("_draw", key).limit(n).drop("_draw")


def random_split(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """is_train: false for about that share of rows, decided by the seed and each row's key."""
    return df.withColumn("is_train", _draw(key, seed) >= int(share * (1 << 52) + 0.5))


def fill(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, v) for c, v in values.items()})

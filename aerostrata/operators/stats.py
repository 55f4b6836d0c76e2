"""Exact descriptive statistics, each in as few passes as its semantics allow."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Relative error of the sketches that narrow a quantile down, and values that one task then puts in order.
ACCURACY, BAND = 5000, 1 << 22


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float | None]]:
    """Exact quantiles (linear between neighbours) of whole columns; None without values.

    Sketches give for each wanted rank an interval of values that holds it; one
    pass counts what lies below each interval, and only the values inside are
    shuffled, counted and put in order.  An interval of more than ``BAND`` values
    is narrowed by sketches of its own first.  So no task sees a whole column.
    """
    df = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    eps = 2.0 / ACCURACY
    ends = sorted({min(1.0, max(0.0, q + e)) for q in shares for e in (-eps, eps)})
    sketch = [F.struct(F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("low"), F.max(f"v{i}").alias("high"), F.percentile_approx(f"v{i}", ends, ACCURACY).alias("at")).alias(f"v{i}") for i in range(len(columns))]
    seen = df.agg(*sketch).first()
    out: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    spans: dict[tuple[int, int], list] = {}  # of column and share: lowest and highest value, first wanted rank
    for i in range(len(columns)):
        for j, q in enumerate(shares):
            if seen[i].n:
                a, b = (seen[i].at[ends.index(min(1.0, max(0.0, q + e)))] for e in (-eps, eps))
                spans[i, j] = [seen[i].low if q <= eps else a, seen[i].high if q >= 1 - eps else b, int(q * (seen[i].n - 1) + 1e-9), seen[i]]
    below: dict[tuple[int, int], tuple[int, int]] = {}
    todo = dict(spans)
    while todo:
        keys = list(todo)
        counted = df.agg(*[F.struct(F.count_if(F.col(f"v{i}") < todo[i, j][0]).alias("below"), F.count_if(F.col(f"v{i}").between(*todo[i, j][:2])).alias("inside")).alias(f"s{k}") for k, (i, j) in enumerate(keys)]).first()
        for k, (i, j) in enumerate(keys):
            low, high, rank, whole = todo[i, j]
            n_below, inside = counted[k].below, counted[k].inside
            if n_below > rank or n_below + inside <= min(rank + 1, whole.n - 1):
                spans[i, j][:2] = todo[i, j][:2] = [whole.low, whole.high]  # a sketch missed: all values, to be narrowed again
            elif inside > BAND and low < high:
                mid = [min(1.0, max(0.0, (rank + x - n_below) / inside)) for x in (-eps * inside, 1 + eps * inside)]
                a, b = df.where(F.col(f"v{i}").between(low, high)).agg(F.percentile_approx(f"v{i}", mid, ACCURACY)).first()[0]
                if (a, b) == (low, high):
                    below[i, j] = (n_below, inside)
                    del todo[i, j]
                else:
                    spans[i, j][:2] = todo[i, j][:2] = [a, b]
            else:
                below[i, j] = (n_below, inside)
                del todo[i, j]
    held = [F.when(F.col(f"v{i}").between(*spans[i, j][:2]), F.struct(F.lit(k).alias("span"), F.col(f"v{i}").alias("v"))) for k, (i, j) in enumerate(spans)]
    if held:
        counts = df.select(F.explode(F.array_compact(F.array(*held))).alias("x")).groupBy("x.span", "x.v").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("span").orderBy("v"))
        ranks = F.create_map(*[F.lit(x) for k, key in enumerate(spans) for x in (k, spans[key][2] - below[key][0])])[F.col("span")]
        last = F.create_map(*[F.lit(x) for k, key in enumerate(spans) for x in (k, min(spans[key][2] + 1, spans[key][3].n - 1) - below[key][0])])[F.col("span")]
        counts = counts.withColumn("upto", upto).withColumn("first", ranks).withColumn("last", last)
        # two values of each interval at most
        picked = counts.where((F.col("upto") > F.col("first")) & (F.col("upto") - F.col("n") <= F.col("last"))).groupBy("span").agg(F.min("v").alias("a"), F.max("v").alias("b")).collect()
        found = {r.span: (r.a, r.b) for r in picked}
        for k, (i, j) in enumerate(spans):
            at = shares[j] * (spans[i, j][3].n - 1)
            a, b = found[k]
            part = max(0.0, at - spans[i, j][2])
            out[columns[i]][j] = a if part < 1e-9 else a + (b - a) * part
    return out


def weighted_quantile(df: DataFrame, value: str, weight: str, share: float) -> float | None:
    """The exact quantile (linear between neighbours) of values that count as often as their whole weight says; None without values.

    Of more than ``BAND`` different values only those of the ranges that hold the wanted ranks are put in order.
    """
    df = df.select(F.col(value).cast("double").alias("v"), F.col(weight).alias("w")).where("v is not null and w > 0").groupBy("v").agg(F.sum("w").alias("w"))
    n, total = df.agg(F.count("v"), F.sum("w")).first()
    if not n:
        return None
    at, below = share * (total - 1), 0
    rank = int(at + 1e-9)
    last = min(rank + 1, total - 1)
    while n > BAND:
        cuts = sorted(set(df.agg(F.percentile_approx("v", [i / 64 for i in range(1, 64)], ACCURACY)).first()[0]))
        ranges = sorted(df.groupBy(_place(F.col("v"), cuts).alias("k")).agg(F.count("v").alias("n"), F.sum("w").alias("w")).collect())  # a row for each range
        upto, n = below, 0
        kept = []
        for r in ranges:
            if upto <= last and upto + r.w > rank:
                below = below if kept else upto
                kept.append(r.k)
                n += r.n
            upto += r.w
        if len(kept) == len(ranges):
            break
        df = df.where(_place(F.col("v"), cuts).isin(kept))
    upto = F.sum("w").over(Window.partitionBy(F.lit(0)).orderBy("v"))
    picked = df.withColumn("upto", upto + below).where((F.col("upto") > rank) & (F.col("upto") - F.col("w") <= last))
    a, b = picked.agg(F.min("v"), F.max("v")).first()
    part = max(0.0, at - rank)
    return a if part < 1e-9 else a + (b - a) * part


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles (exact, linear), max: a row for each column (and group); whole columns share one pass beside their quartiles."""
    figures = lambda c: {"count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c).cast("double"), "max": F.max(c).cast("double")}
    if not by:
        q = quantiles(df, columns, [0.25, 0.5, 0.75])
        one = df.agg(*[F.struct(*[f.alias(k) for k, f in figures(c).items()], *[F.lit(x).cast("double").alias(k) for k, x in zip(("q25", "q50", "q75"), q[c])]).alias(c) for c in columns])
        return melt(one, columns).select("column", *[F.col(f"value.{k}").alias(k) for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")])
    # a group's values meet in one task: groups are places or kinds
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.column", *by, "x.v")
    return long.groupBy("column", *by).agg(*[f.alias(k) for k, f in figures("v").items()], *[F.percentile("v", F.lit(q)).alias(k) for k, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])


def skewness_corrected(c: str | Column) -> Column:
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_corrected(c: str | Column) -> Column:
    n = F.count(c)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def iqr_outliers(df: DataFrame, columns: list[str], k: float) -> DataFrame:
    """How many values of each column lie strictly outside its quartiles by k interquartile ranges."""
    q = quantiles(df, columns, [0.25, 0.75])
    low = lambda c: F.lit(None if q[c][0] is None else q[c][0] - k * (q[c][1] - q[c][0])).cast("double")
    high = lambda c: F.lit(None if q[c][0] is None else q[c][1] + k * (q[c][1] - q[c][0])).cast("double")
    counted = df.agg(*[F.struct(F.count_if((F.col(c) < low(c)) | (F.col(c) > high(c))).alias("outliers"), F.count(c).alias("n")).alias(c) for c in columns])
    return melt(counted, columns).select("column", "value.outliers", F.try_divide(F.col("value.outliers") * F.lit(100.0), F.col("value.n")).alias("percent"))


def melt(row: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column of a one-row frame: column, value."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("x")).select("x.*")


def null_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls of each column: n_null, percent."""
    columns = columns or df.columns
    one = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_null"), F.count(F.lit(1)).alias("n")).alias(c) for c in columns])
    return melt(one, columns).select("column", "value.n_null", F.try_divide(F.col("value.n_null") * F.lit(100.0), F.col("value.n")).alias("percent"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows less distinct rows (nulls are equal), and the share of missing cells."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    missing = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return per.agg((F.sum("_n") - F.count(F.lit(1))).alias("duplicates"), (F.sum(missing * F.col("_n")) * 100.0 / (F.sum("_n") * len(df.columns))).alias("missing_percent"))


def data_dictionary(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.struct(F.count(c).alias("non_null"), F.count_if(F.col(c).isNull()).alias("n_null"), F.countDistinct(c).alias("n_unique"), F.count(F.lit(1)).alias("n")).alias(c) for c in df.columns])
    kinds = F.create_map(*[x for c, k in df.dtypes for x in (F.lit(c), F.lit(k))])
    return melt(one, df.columns).select("column", kinds[F.col("column")].alias("kind"), "value.non_null", "value.n_null", F.try_divide(F.col("value.n_null") * F.lit(100.0), F.col("value.n")).alias("null_percent"), "value.n_unique")


def pearson(a: str, b: str) -> Column:
    """Pearson's r of rows where both are present; null without spread."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson's r of each pair of columns (rows where both are present), in one pass."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[pearson(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("r")) for i, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")


def own_past(df: DataFrame, columns: list[str], n: int, key: str, order: list[str]) -> DataFrame:
    """Correlation of each column with its own values 1 to n rows earlier in the series: series, k, r."""
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(-n, -1)
    seen = df.withColumn("_past", F.reverse(F.collect_list(F.struct(*columns)).over(before)))
    each = seen.select(*columns, F.posexplode("_past").alias("_k", "_then"))
    pairs = F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("x"), F.col(f"_then.{c}").cast("double").alias("y")) for c in columns])
    rows = each.select((F.col("_k") + 1).alias("k"), F.explode(pairs).alias("p")).select("k", "p.*")
    return rows.groupBy("series", "k").agg(pearson("x", "y").alias("r"))


def _place(c: Column, splits: list[float], low: int = 0, high: int | None = None) -> Column:
    """How many of the sorted splits are under c, as a tree of comparisons."""
    high = len(splits) if high is None else high
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(c <= splits[mid], _place(c, splits, low, mid)).otherwise(_place(c, splits, mid + 1, high))


def average_ranks(df: DataFrame, columns: list[str], count: str) -> DataFrame:
    """df, of no nulls and with a count of each row, with r_<column>: average ranks among all that is counted, ties sharing theirs.

    Values are dealt to ranges of about equal size, as many as twice the shuffle's
    partitions; each is ordered by itself, after the number of values below it.  A
    value that fills a range has its rank from the counts alone and is spread over
    tasks, so it is not ordered with anything.
    """
    n_ranges = max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(*[F.percentile_approx(c, [i / n_ranges for i in range(1, n_ranges)], 4 * n_ranges).alias(c) for c in columns]).first()
    ranges = {}
    for c in columns:
        splits = [float(x) for x in cuts[c] or []]
        popular = sorted({x for x, y in zip(splits, splits[1:]) if x == y})
        place = _place(F.col(c).cast("double"), sorted(set(splits)))
        ranges[c] = (place * 2 + F.col(c).isin(popular).cast("int") if popular else place * 2).cast("int")
    kinds = [F.struct(F.lit(i).alias("i"), ranges[c].alias("range")) for i, c in enumerate(columns)]
    sizes: list[dict[int, int]] = [{} for _ in columns]
    for r in df.select(F.explode(F.array(*kinds)).alias("x"), count).groupBy("x.i", "x.range").agg(F.sum(count).alias("n")).collect():  # a row for each range
        sizes[r.i][r.range] = r.n
    for i, c in enumerate(columns):
        at, before, single = 0, [], []
        for k in sorted(sizes[i]):
            before += [F.lit(k), F.lit(float(at))]
            single += [F.lit(k), F.lit(at + (sizes[i][k] + 1) / 2)]
            at += sizes[i][k]
        if not before:
            df = df.withColumn(f"r_{c}", F.lit(None).cast("double"))
            continue
        df = df.withColumn("_range", ranges[c])
        alone = F.col("_range") % 2 == 1
        df = df.withColumn("_spread", F.when(alone, F.pmod(F.xxhash64(*columns), F.lit(n_ranges))).otherwise(F.lit(0).cast("long")))
        ties = F.sum(count).over(Window.partitionBy("_range", "_spread", c))
        upto = F.sum(count).over(Window.partitionBy("_range", "_spread").orderBy(c))
        ranked = F.create_map(*before)[F.col("_range")] + upto - (ties - 1) / 2
        df = df.withColumn(f"r_{c}", F.when(alone, F.create_map(*single)[F.col("_range")]).otherwise(ranked)).drop("_range", "_spread")
    return df


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """n, Spearman's rho and its two-sided p value; under 30 rows or without spread they are 0 and 1.  From joint counts: equal pairs of values are one row."""
    both = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranked = average_ranks(both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), ["a", "b"], "n")
    total = F.sum("n")
    mean = lambda c: F.sum(F.col("n") * c) / total
    ra, rb = F.col("r_a"), F.col("r_b")
    one = ranked.agg(total.alias("n"), mean(ra).alias("ma"), mean(rb).alias("mb"), mean(ra * ra).alias("aa"), mean(rb * rb).alias("bb"), mean(ra * rb).alias("ab"), (F.max("a") - F.min("a")).alias("sa"), (F.max("b") - F.min("b")).alias("sb"))
    rho = F.try_divide(F.col("ab") - F.col("ma") * F.col("mb"), F.sqrt((F.col("aa") - F.col("ma") * F.col("ma")) * (F.col("bb") - F.col("mb") * F.col("mb"))))
    poor = (F.coalesce("n", F.lit(0).cast("long")) < 30) | (F.coalesce("sa", F.lit(0.0)) < 1e-8) | (F.coalesce("sb", F.lit(0.0)) < 1e-8)
    r = one.select(F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.when(poor, 0.0).otherwise(rho).alias("rho"), poor.alias("poor")).first()  # one row
    return df.sparkSession.createDataFrame([(r.n, r.rho, 1.0 if r.poor else t_tail(r.rho, r.n))], "n long, rho double, p double")


def t_tail(rho: float, n: int) -> float:
    """Two-sided p value of a rank correlation, by Student's t with n - 2 degrees of freedom."""
    if n < 3 or abs(rho) >= 1:
        return 0.0 if n >= 3 else 1.0
    df = n - 2
    x = df / (df + rho * rho * df / (1 - rho * rho))
    return _beta_share(df / 2, 0.5, x)


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by Gauss-Legendre after a substitution that removes the end's pole."""
    from math import exp, lgamma

    nodes, weights = np.polynomial.legendre.leggauss(400)
    u = (nodes + 1) / 2 * (1 - np.sqrt(1 - x))  # 1 - t = (1 - u) ** 2
    s = 1 - u
    inside = (1 - s**2) ** (a - 1) * 2 * s ** (2 * b - 1)
    return float((weights * inside).sum() / 2 * (1 - np.sqrt(1 - x)) * exp(lgamma(a + b) - lgamma(a) - lgamma(b)))


def normalized_variance(c: str) -> Column:
    """Population variance over the squared range; 0 without a range.  A NaN makes it NaN."""
    span = F.max(c) - F.min(c)
    return F.when(F.isnan(F.sum(c)), F.lit(float("nan"))).when(span <= 0, 0.0).otherwise(F.greatest(F.var_pop(c) / (span * span), F.lit(0.0)))


def cardinality(c: str) -> Column:
    """Distinct values as text, missing ones being one value."""
    return F.countDistinct(F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("nan")))


def bucket(c: Column, low: float, high: float, n: int) -> Column:
    """Number of the bin of n equal ones (from 0), the last closed at both ends; null outside."""
    at = F.floor((c - low) / ((high - low) / n)).cast("int")
    return F.when((c < low) | (c > high), None).when(c == high, n - 1).otherwise(at)


def histogram(df: DataFrame, column: str, low: float, high: float, n: int) -> DataFrame:
    return df.withColumn("bin", bucket(F.col(column), low, high, n)).where("bin is not null").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def histogram2(df: DataFrame, x: str, y: str, xs: tuple[float, float, int], ys: tuple[float, float, int]) -> DataFrame:
    both = df.withColumn("x_bin", bucket(F.col(x), *xs)).withColumn("y_bin", bucket(F.col(y), *ys)).where("x_bin is not null and y_bin is not null")
    counts = both.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))
    area = (xs[1] - xs[0]) / xs[2] * (ys[1] - ys[0]) / ys[2]
    return counts.withColumn("density", F.col("n") / (F.sum("n").over(Window.partitionBy()) * area))  # over cells, not rows


def mean_grid(df: DataFrame, x: str, y: str, value: str, xs: tuple[float, float, int], ys: tuple[float, float, int]) -> DataFrame:
    """Mean of value in each half-open cell; an empty cell has the mean of the others."""
    at = lambda c, e: F.floor((F.col(c) - e[0]) / ((e[1] - e[0]) / e[2])).cast("int")
    cells = df.withColumn("x_bin", at(x, xs)).withColumn("y_bin", at(y, ys)).groupBy("x_bin", "y_bin").agg(F.avg(value).alias("mean"))
    grid = df.sparkSession.range(xs[2] * ys[2]).select((F.col("id") / ys[2]).cast("int").alias("x_bin"), (F.col("id") % ys[2]).cast("int").alias("y_bin"))
    out = grid.join(cells, ["x_bin", "y_bin"], "left")
    return out.withColumn("mean", F.coalesce("mean", F.avg("mean").over(Window.partitionBy())))  # over cells


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs (null is one), and its percentage."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))  # over values


def pivot_mean(df: DataFrame, row: str, column: str, values: list, value: str) -> DataFrame:
    return df.groupBy(row).pivot(column, values).agg(F.avg(value))


def joined_distinct(c: str, limit: int, sep: str) -> Column:
    """Distinct values in code point order, so many at most, as one text."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(c)), 1, limit), sep)


def joined_in_order(c: str, order: str, sep: str) -> Column:
    """Distinct values in order of first appearance, as one text."""
    rows = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v")))))
    return F.array_join(F.array_distinct(F.transform(rows, lambda x: x["v"])), sep)


def any_yes(c: str) -> Column:
    return F.when(F.coalesce(F.bool_or(F.col(c) == "YES"), F.lit(False)), "YES").otherwise("NO")


def variance_inflation(df: DataFrame, columns: list[str]) -> DataFrame:
    """VIF of each column: the diagonal of the inverse correlation matrix (a table of columns, not rows, is inverted)."""
    r = {(x.a, x.b): x.r for x in correlations(df.na.drop(subset=columns), columns).collect()}
    m = np.array([[1.0 if a == b else r.get((a, b), r.get((b, a))) or 0.0 for b in columns] for a in columns])
    vif = np.diag(np.linalg.pinv(m))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, vif)], "column string, vif double")

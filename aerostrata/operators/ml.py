"""Models: linear with stated penalties, trees, neighbours, clusters, and small numpy networks."""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are held against all rows at once; more are taken block by block.
QUERY_BLOCK = 4096

#: Queries of a block whose distances are in memory at once.
QUERY_TILE = 128


def assembled(df: DataFrame, features: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=name, handleInvalid="skip").transform(df)


def linear(df: DataFrame, features: list[str], label: str, alpha: float = 0.0, l1_share: float | None = None):
    """Least squares; with alpha ridge (squared errors' sum + alpha |w|^2), with l1_share elastic net.

    Spark divides its L2 penalty by the label's deviation, which is undone here.
    """
    n, sd = df.na.drop(subset=[*features, label]).agg(F.count(F.lit(1)), F.stddev_pop(label)).first()
    fit = LinearRegression(featuresCol="features", labelCol=label, standardization=False, solver="normal" if l1_share is None else "auto", maxIter=500, tol=1e-12)
    if alpha and l1_share is None:
        fit = fit.setRegParam(alpha / n * sd).setElasticNetParam(0.0)
    elif alpha:
        one, two = alpha * l1_share, alpha * (1 - l1_share) * sd
        fit = fit.setRegParam(one + two).setElasticNetParam(one / (one + two))
    return fit.fit(assembled(df, features))


def forest(df: DataFrame, features: list[str], label: str, trees: int = 200, depth: int = 12, seed: int = 42):
    return RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(assembled(df, features))


def boosted(df: DataFrame, features: list[str], label: str, rounds: int = 200, rate: float = 0.05, depth: int = 3, share: float = 1.0, seed: int = 42):
    return GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=share, seed=seed).fit(assembled(df, features))


def forest_classifier(df: DataFrame, features: list[str], label: str, trees: int = 200, depth: int = 12, seed: int = 42):
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(assembled(df, features))


def impurity_importances(model, features: list[str]) -> list[tuple[str, float]]:
    """How much of a forest's fall in impurity each feature brings, the greatest first."""
    return sorted(zip(features, map(float, model.featureImportances.toArray())), key=lambda x: -x[1])


def clusters(df: DataFrame, features: list[str], k: int = 3, seed: int = 42) -> DataFrame:
    wide = assembled(df, features)
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(wide).transform(wide).drop("features")


def components(df: DataFrame, features: list[str], k: int = 2):
    """A fitted PCA; its explainedVariance holds the shares."""
    return PCA(k=k, inputCol="features", outputCol="scores").fit(assembled(df, features))


def _merge(held_d: np.ndarray, held_k: np.ndarray, q: np.ndarray, keys: np.ndarray, x: np.ndarray) -> None:
    """Take the rows x among the k nearest that are held for each query, a tile of QUERY_TILE queries at a time.

    A matrix product tells which rows may be as near as the k-th one held, with room
    for its rounding; only their distances are worked out from differences.
    """
    own = (x * x).sum(1)
    k = held_d.shape[1]
    for a in range(0, len(q), QUERY_TILE):
        part = q[a : a + QUERY_TILE]
        norm = (part * part).sum(1)[:, None] + own
        near = norm - 2 * (part @ x.T)
        slack = norm * 1e-9
        limit = held_d[a : a + QUERY_TILE, -1:] ** 2
        if len(keys) > k:
            limit = np.fmin(limit, np.partition(near + slack, k - 1, 1)[:, k - 1 : k])
        may = ~(near - slack > limit * (1 + 1e-9))
        for r in np.flatnonzero(may.any(1)):
            at = np.flatnonzero(may[r])
            d = np.concatenate([held_d[a + r], np.sqrt(((x[at] - part[r]) ** 2).sum(1))])
            n = np.concatenate([held_k[a + r], keys[at]])
            order = np.lexsort((n, d))[:k]
            held_d[a + r], held_k[a + r] = d[order], n[order]


def nearest(train: DataFrame, queries: DataFrame, k: int, key: str, query_key: str, vector: str) -> DataFrame:
    """The k nearest rows of train to each query: (query_key, key, dist, rank), ties by key.

    Queries are taken in blocks of at most QUERY_BLOCK; each block goes to all
    partitions of train, which answer with their own k best, so what is shuffled
    is k rows a query and partition.
    """
    out = None
    numbered = queries.select(query_key, F.col(vector).alias("_v")).orderBy(query_key)
    rows = numbered.toLocalIterator()
    block: list = []

    def answer(block: list) -> DataFrame:
        ids, q = np.array([r[0] for r in block]), np.array([r[1] for r in block], np.float64)

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held_d = np.full((len(ids), k), np.nan)  # sorted last, as a missing row is
            held_k = np.full((len(ids), k), np.iinfo(np.int64).max)
            for batch in batches:
                keys = np.asarray(batch.column(key))
                x = np.stack(batch.column(vector).to_numpy(zero_copy_only=False)).astype(np.float64) if len(keys) else np.zeros((0, q.shape[1]))
                for i in range(0, len(keys), 1024):
                    _merge(held_d, held_k, q, keys[i : i + 1024], x[i : i + 1024])
            found = held_k != np.iinfo(np.int64).max
            if found.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)[found.ravel()]), pa.array(held_k[found]), pa.array(held_d[found])], [query_key, key, "dist"])

        found = train.select(key, vector).mapInArrow(best, f"{query_key} long, {key} long, dist double")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(query_key).orderBy("dist", key)))
        return ranked.where(F.col("rank") <= k)

    for r in rows:
        block.append((r[0], list(r[1])))
        if len(block) == QUERY_BLOCK:
            out = answer(block) if out is None else out.unionByName(answer(block))
            block = []
    if block or out is None:
        out = answer(block) if out is None else out.unionByName(answer(block))
    return out


def knn_regression(train: DataFrame, queries: DataFrame, k: int, key: str, query_key: str, vector: str, label: str) -> DataFrame:
    near = nearest(train, queries, k, key, query_key, vector).join(train.select(key, label), key)
    return near.groupBy(query_key).agg(F.avg(label).alias("prediction"))


def permutation_importance(df: DataFrame, predict, features: list[str], label: str, key: str, repeats: int = 5, seed: int = 42) -> DataFrame:
    """Mean rise of the squared error when a column's values are dealt anew.

    Values change places along a ring of the rows in a random order, group by
    group: a row gets the value of the one before it, the first one the last's.
    One shuffle a repeat serves all columns; predict(df) adds ``prediction`` to each row.
    """
    loss = lambda c: F.avg((F.col(c) - F.col(label)) ** 2)
    n, base = predict(df).agg(F.count(F.lit(1)), loss("prediction")).first()
    rises: list[list[float]] = [[] for _ in features]
    for r in range(repeats):
        moved = df.withColumn("_g", F.pmod(F.xxhash64(key, F.lit(seed + r)), F.lit(max(1, n // 10_000))))
        for i, f in enumerate(features):
            ring = Window.partitionBy("_g").orderBy(F.xxhash64(key, F.lit(f), F.lit(r)), key)
            whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            moved = moved.withColumn(f"_m{i}", F.when(F.row_number().over(ring) == 1, F.last(f).over(whole)).otherwise(F.lag(f).over(ring)))
        for i, f in enumerate(features):
            moved = predict(moved.withColumn("_own", F.col(f)).withColumn(f, F.col(f"_m{i}")))
            moved = moved.withColumn(f"_p{i}", F.col("prediction")).withColumn(f, F.col("_own")).drop("prediction", "_own")
        for held, one in zip(rises, moved.agg(*[loss(f"_p{i}") for i in range(len(features))]).first()):
            held.append(one - base)
    out = [(f, float(np.mean(x)), float(np.std(x))) for f, x in zip(features, rises)]
    return df.sparkSession.createDataFrame(out, "feature string, mean double, std double")


def fitted(df: DataFrame, net, arrays, rounds: int = 5, batch: int = 256, rate: float = 1e-2, clip: float | None = 1.0):
    """A numpy network fitted on all rows of df, wherever they are; arrays(batch) gives what net.gradients takes.

    In each round every task goes on from the same parameters over its own rows, a
    batch at a time; then the tasks' parameters are averaged, weighed by rows.  What
    is shuffled and collected is a row for each parameter.  Where there are no rows
    the network stays as it is.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = copy.deepcopy(net)
        step, n = _Adam(mine.p, rate), 0
        for some in batches:
            given = arrays(some)
            for i in range(0, len(some), batch):
                step(mine.gradients(*[x[i : i + batch] for x in given]), clip)
            n += len(some)
        if n:
            flat = np.concatenate([mine.p[k].ravel() for k in sorted(mine.p)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * n), pa.array(np.full(len(flat), n))], ["i", "v", "n"])

    for _ in range(rounds):
        sums = df.mapInArrow(learn, "i long, v double, n long").groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).collect()
        flat = np.array([r.v for r in sorted(sums)])
        at = 0
        for k in sorted(net.p) if len(flat) else ():
            size = net.p[k].size
            net.p[k] = flat[at : at + size].reshape(net.p[k].shape)
            at += size
    return net


def matrix(*columns: str):
    """For fitted(): a batch's columns as one array."""
    return lambda batch: (np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns], 1),)


class DenseClassifier:
    """Dense layers of leaky units and a logistic output, for a binary label (numpy)."""

    def __init__(self, width: int, hidden: tuple[int, ...] = (64, 32), seed: int = 42):
        r, sizes = np.random.default_rng(seed), [width, *hidden, 1]
        self.depth = len(sizes) - 1
        self.p = {f"w{i}": r.standard_normal((a, b)) / np.sqrt(a) for i, (a, b) in enumerate(zip(sizes, sizes[1:]))} | {f"b{i}": np.zeros(b) for i, b in enumerate(sizes[1:])}

    def _run(self, x: np.ndarray) -> list[np.ndarray]:
        out = [x]
        for i in range(self.depth):
            z = out[-1] @ self.p[f"w{i}"] + self.p[f"b{i}"]
            out.append(np.where(z > 0, z, 0.01 * z) if i < self.depth - 1 else 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._run(x)[-1][:, 0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean cross entropy."""
        held, g = self._run(x), {}
        d = (held[-1] - y[:, None]) / len(y)
        for i in reversed(range(self.depth)):
            g[f"w{i}"], g[f"b{i}"] = held[i].T @ d, d.sum(0)
            d = d @ self.p[f"w{i}"].T * np.where(held[i] > 0, 1, 0.01)
        return g


def dense_classifier(df: DataFrame, features: list[str], label: str, hidden: tuple[int, ...] = (64, 32), rounds: int = 10, rate: float = 1e-2) -> DenseClassifier:
    whole = matrix(*features, label)

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        both = whole(batch)[0]
        return both[:, :-1], both[:, -1]

    return fitted(df.select(*features, label).na.drop(), DenseClassifier(len(features), hidden), arrays, rounds, 64, rate)


def predict_classes(df: DataFrame, net: DenseClassifier, features: list[str]) -> DataFrame:
    """prediction (0 or 1) of each row, batch by batch."""

    @F.pandas_udf("int")
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series((net.probability(np.stack([c.to_numpy(np.float64) for c in columns], 1)) >= 0.5).astype(np.int32))

    return df.withColumn("prediction", run(*features))


class Autoencoder:
    """One hidden layer of leaky units, trained by Adam on squared error (numpy)."""

    def __init__(self, width: int, latent: int = 8, seed: int = 42):
        r = np.random.default_rng(seed)
        self.p = {"w1": r.standard_normal((width, latent)) / np.sqrt(width), "b1": np.zeros(latent), "w2": r.standard_normal((latent, width)) / np.sqrt(latent), "b2": np.zeros(width)}

    def encode(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.p["w1"] + self.p["b1"]
        return np.where(z > 0, z, 0.01 * z)

    def decode(self, h: np.ndarray) -> np.ndarray:
        return h @ self.p["w2"] + self.p["b2"]

    def gradients(self, b: np.ndarray) -> dict:
        z = b @ self.p["w1"] + self.p["b1"]
        h = np.where(z > 0, z, 0.01 * z)
        d = 2 * (self.decode(h) - b) / b.size
        back = d @ self.p["w2"].T * np.where(z > 0, 1, 0.01)
        return {"w2": h.T @ d, "b2": d.sum(0), "w1": b.T @ back, "b1": back.sum(0)}

    def fit(self, x: np.ndarray, epochs: int = 50, batch: int = 256, rate: float = 1e-3, seed: int = 0) -> Autoencoder:
        """On rows that fit in memory; fitted() takes those of a DataFrame."""
        r, step = np.random.default_rng(seed), _Adam(self.p, rate)
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                step(self.gradients(x[order[i : i + batch]]))
        return self


class _Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def __call__(self, g: dict, clip: float | None = None) -> None:
        if clip:
            norm = np.sqrt(sum((x**2).sum() for x in g.values()))
            g = {k: x * min(1.0, clip / (norm + 1e-12)) for k, x in g.items()}
        self.t += 1
        for k, x in g.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * x
            self.v[k] = 0.999 * self.v[k] + 0.001 * x * x
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


class Lstm:
    """One LSTM layer and a linear output, gradients clipped to norm 1 (numpy); fit() stops early, on rows that fit in memory."""

    def __init__(self, width: int, hidden: int = 96, seed: int = 42):
        r, s = np.random.default_rng(seed), 1 / np.sqrt(hidden)
        self.h = hidden
        self.p = {"w": r.uniform(-s, s, (width + hidden, 4 * hidden)), "b": np.zeros(4 * hidden), "v": r.uniform(-s, s, hidden), "c": np.zeros(1)}

    def _run(self, x: np.ndarray):
        n, steps, _ = x.shape
        h, c, kept = np.zeros((n, self.h)), np.zeros((n, self.h)), []
        for t in range(steps):
            z = np.concatenate([x[:, t], h], 1)
            a = z @ self.p["w"] + self.p["b"]
            i, f, o = (1 / (1 + np.exp(-a[:, k * self.h : (k + 1) * self.h])) for k in range(3))
            g = np.tanh(a[:, 3 * self.h :])
            before, c = c, f * c + i * g
            h = o * np.tanh(c)
            kept.append((z, i, f, o, g, before, c))
        return h, kept

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._run(x)[0] @ self.p["v"] + self.p["c"][0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        h, kept = self._run(x)
        d = 2 * (h @ self.p["v"] + self.p["c"][0] - y) / len(y)
        g = {"v": h.T @ d, "c": np.array([d.sum()]), "w": np.zeros_like(self.p["w"]), "b": np.zeros_like(self.p["b"])}
        dh, dc = d[:, None] * self.p["v"], np.zeros_like(h)
        for z, i, f, o, u, before, c in reversed(kept):
            th = np.tanh(c)
            dc = dc + dh * o * (1 - th**2)
            da = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - u**2)], 1)
            g["w"] += z.T @ da
            g["b"] += da.sum(0)
            dh, dc = (da @ self.p["w"].T)[:, -self.h :], dc * f
        return g

    def fit(self, x, y, x_val, y_val, epochs: int = 50, patience: int = 5, batch: int = 128, rate: float = 1e-3, seed: int = 0) -> Lstm:
        r, step, best, bad, held = np.random.default_rng(seed), _Adam(self.p, rate), np.inf, 0, None
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                some = order[i : i + batch]
                step(self.gradients(x[some], y[some]), clip=1.0)
            loss = float(((self.predict(x_val) - y_val) ** 2).mean())
            if loss < best - 1e-9:
                best, bad, held = loss, 0, {k: v.copy() for k, v in self.p.items()}
            else:
                bad += 1
                if bad >= patience:
                    break
        self.p.update(held or {})
        return self


def predict_sequences(df: DataFrame, net: Lstm, column: str = "sequence") -> DataFrame:
    """prediction of each row's array of arrays, batch by batch."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(net.predict(np.stack([np.stack(x) for x in s])) if len(s) else [])

    return df.withColumn("prediction", run(column))

"""Sinks: tables, sidecar documents, reports, run logs, models."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def append(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Append as Parquet; clustered by key where the next reader works by it."""
    (df.repartition(*keys).sortWithinPartitions(*keys) if keys else df).write.mode("append").parquet(path)


def table(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """A whole text table with a header, columns in a stated order; without rows a header alone."""
    out = df.select(*columns) if columns else df
    if out.isEmpty():
        df.sparkSession.createDataFrame([(",".join(out.columns),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        out.write.mode("overwrite").option("header", True).csv(path)


def document(spark: SparkSession, value: dict | list, path: str) -> None:
    """A small JSON document, written by Spark so that any store will do."""
    spark.createDataFrame([(json.dumps(value, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def with_sidecar(df: DataFrame, path: str, source: str, notes: str = "") -> dict:
    """Write df and, beside it, its file, rows, columns, source and notes; the count rides on the write."""
    from pyspark.sql import Observation

    seen = Observation("rows_written")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    meta = {"file": path, "rows": seen.get["rows"], "columns": df.columns, "source": source, "notes": notes}
    document(df.sparkSession, meta, f"{path}.meta.json")
    return meta


def report(spark: SparkSession, path: str, variance: DataFrame | None = None, cardinality: DataFrame | None = None, **summary) -> dict:
    """What a feature build measured: a row for each column, and figures."""
    rows = lambda t: [r.asDict() for r in t.collect()] if t is not None else []
    out = {"variance": rows(variance), "cardinality": rows(cardinality), **summary}
    document(spark, out, path)
    return out


def log_run(spark: SparkSession, path: str, **facts) -> None:
    """Append one run to the log (Parquet); earlier ones are never touched."""
    row = {f.name: None for f in spark.createDataFrame([], schemas.RUN_LOG).schema} | {"run_id": uuid.uuid4().hex} | facts
    spark.createDataFrame([row], schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def model(fitted, path: str) -> None:
    fitted.write().overwrite().save(path)


def network(spark: SparkSession, params: dict, path: str) -> None:
    """Parameters of a numpy network as a table: name, shape, values."""
    rows = [(k, list(v.shape), [float(x) for x in v.ravel()]) for k, v in params.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def stored_network(spark: SparkSession, path: str) -> dict:
    import numpy as np

    return {r.name: np.array(r["values"]).reshape(r.shape) for r in spark.read.parquet(path).collect()}


def raw(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file of bytes, in any store that Spark writes."""
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to, True)
    out.write(bytearray(content))
    out.close()


def shapes(df: DataFrame, zips: DataFrame, path: str) -> None:
    """The shapes of the ZIP codes in use, as Parquet."""
    df.join(zips.select("zip").distinct(), "zip", "left_semi").write.mode("overwrite").parquet(path)

"""Incremental ingestion and per-place lag state with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_trigger: int = 1) -> DataFrame:
    """New files of a folder as a stream; which ones were read is in the query's checkpoint."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_trigger).load(path)


def append_days(stream: DataFrame, path: str, checkpoint: str, time: str = "time", key: str = "zip") -> None:
    """Append what is new, by day, and stop.

    A batch that runs again after a failure replaces its own folder, so rows are
    appended once; late or unordered files need no rebuild, readers order by time.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("day", F.to_date(time))
        rows.repartition(key).sortWithinPartitions(key, time).write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def missing_windows(requested: DataFrame, log: DataFrame) -> DataFrame:
    """Requested windows (script, start_date, end_date) without a logged success of just that script and window."""
    day = lambda k: F.col("parameters")[k].alias(k)
    done = log.where("status = 'success'").select("script", day("start_date"), day("end_date")).distinct()
    return requested.join(done, ["script", "start_date", "end_date"], "left_anti")


def lag_stream(stream: DataFrame, value: str, n: int, key: str, order: list[str]) -> DataFrame:
    """Lags kept as state: the last n values of each key, from batch to batch; rows of a batch are taken in order.

    A key's rows of one batch are held together, so a batch (files a trigger) should be hours of a place, not years.
    Output: key, the order columns, value and <value>_past_1 to _n.
    """
    kinds = dict(stream.dtypes)
    past = [f"{value}_past_{k}" for k in range(1, n + 1)]
    out = ", ".join(f"{c} {kinds[c]}" for c in [key, *order, value]) + "".join(f", {p} double" for p in past)

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        kept = list(state.get[0]) if state.exists else []
        taken = rows[value].astype(object).where(rows[value].notna(), None).tolist()
        whole = kept + taken
        for k, p in enumerate(past, 1):
            rows[p] = pd.array([whole[len(kept) + i - k] if len(kept) + i - k >= 0 else None for i in range(len(taken))], dtype="Float64").astype("float64")
        state.update((whole[-n:],))  # the next batch's rows have these before them
        yield rows[[key, *order, value, *past]]

    return stream.groupBy(key).applyInPandasWithState(step, out, "last array<double>", "append", GroupStateTimeout.NoTimeout)


def late_hourly_means(stream: DataFrame, time: str, value: str, key: str, late: str = "5 days") -> DataFrame:
    """Hourly means of each key; readings later than the archive's delay are dropped (an extension)."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 hour"), key).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))

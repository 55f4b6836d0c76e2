"""Queries on columns' names and kinds, samples, splits, recoded labels and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, colfilter, ml, windows
from ..sources import readers
from .catalog import query, read


def _values(kinds: str, rows: list[tuple]) -> str:
    text = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) v({kinds})"


@query(_values("kind, name", [("kept", "o_custkey"), ("kept", "o_orderdate"), ("kept", "o_orderkey"), ("kept", "o_orderpriority"), ("ignored", "o_custkey"), ("ignored", "o_orderdate"), ("ignored", "o_orderkey"), ("ignored", "o_orderpriority"), ("ignored", "o_orderstatus"), ("error", "lacking"), ("error", "o_orderkey")]))
def dropped_columns(spark, d):
    """Dropping columns: known ones go, unknown ones are an error or ignored, keys are an error."""
    o = read(spark, d, "orders")
    rows = [("kept", c) for c in clean.drop_columns(o, ["o_orderstatus", "o_totalprice"]).columns]
    rows += [("ignored", c) for c in clean.drop_columns(o, ["o_totalprice", "lacking"], missing="ignore").columns]
    for names, keys in ((["lacking"], ()), (["o_orderkey"], ("o_orderkey",))):
        try:
            clean.drop_columns(o, names, keys=keys)
        except ValueError:
            rows.append(("error", names[0]))
    return spark.createDataFrame(rows, "kind string, name string")


@query("SELECT event_id, value FROM events WHERE event_id % 17 <> 0 AND event_id % 5 <> 0")
def complete_rows(spark, d):
    """Rows without a missing value."""
    e = read(spark, d, "events").select("event_id", F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("kind"))
    return e.na.drop(how="any").select("event_id", "value")


@query(_values("purpose, name", [("numeric", "l_partkey"), ("numeric", "l_quantity"), ("numeric", "l_extendedprice"), ("numeric", "l_discount"), ("numeric", "l_tax"), ("numeric", "l_linenumber"), ("numeric", "l_suppkey"), ("binary", "flag"), ("cyclic", "hour_sin"), ("cyclic", "hour_cos"), ("lag", "pm_past_1"), ("lag", "pm_past_2"), ("base", "pm"), ("base", "wind_direction_10m"), ("direction", "wind_direction_10m"), ("first_lag", "pm_past_1"), ("candidate", "TIME_utc"), ("candidate", "zip_code")]))
def column_groups(spark, d):
    """Columns by kind, pattern, values and candidates."""
    li = read(spark, d, "lineitem")
    rows = [("numeric", c) for c in colfilter.numeric_columns(li, ("l_orderkey",))]
    wide = li.select(F.col("l_quantity").alias("pm"), F.lit(0.5).alias("hour_sin"), F.lit(0.25).alias("hour_cos"), F.col("l_tax").alias("pm_past_1"), F.col("l_discount").alias("pm_past_2"), (F.col("l_linenumber") % 2).alias("flag"), F.col("l_extendedprice").alias("wind_direction_10m"))
    for kind, names in colfilter.feature_groups(wide, wide.columns, ("pm",)).items():
        rows += [(kind, c) for c in names]
    rows += [("direction", c) for c in colfilter.direction_columns(wide.columns)]
    rows += [("first_lag", c) for c in colfilter.first_lags(wide.columns, "pm", 1)]
    names = ["TIME_utc", "zip_code", "Zip_code_2"]
    rows += [("candidate", clean.find_column(names, ["time_utc", "datetime"])), ("candidate", clean.find_column(names, ["postcode", "zip"]))]
    return spark.createDataFrame(rows, "purpose string, name string")


@query("SELECT c_custkey, asked FROM (SELECT c_custkey, lower(c_mktsegment) || ',' || CASE WHEN c_custkey % 2 = 0 THEN 'TX' ELSE 'LA' END AS asked FROM customer) WHERE asked IN ('building,TX', 'machinery,LA')")
def places_asked(spark, d):
    """Rows of the places that a run asks for."""
    places = readers.places_asked("Building, tx; MACHINERY,la")
    c = read(spark, d, "customer").select("c_custkey", F.lower("c_mktsegment").alias("city"), F.when(F.col("c_custkey") % 2 == 0, "TX").otherwise("LA").alias("state"))
    wanted = spark.createDataFrame(places, "city string, state string")
    return clean.members(c, wanted, ["city", "state"]).select("c_custkey", F.concat_ws(",", "city", "state").alias("asked"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'used' END AS label FROM events WHERE event_type IN ('view', 'click')")
def recoded_labels(spark, d):
    """Labels renamed after a filter by category."""
    return clean.recoded(read(spark, d, "events").select("event_id", "event_type"), "event_type", {"view": "seen", "click": "used"}, "label")


_HASH = "CAST('0x' || substr(md5(CAST({seed} AS VARCHAR) || ':' || CAST(event_id AS VARCHAR)), 1, 13) AS BIGINT)"


@query(f"SELECT event_id, value FROM events ORDER BY {_HASH.format(seed=42)}, event_id LIMIT 500")
def seeded_sample(spark, d):
    """A sample of 500 rows that a seed decides, the same on every run and partitioning."""
    return clean.sampled(read(spark, d, "events").select("event_id", "value"), "event_id", 500, 42)


@query(f"SELECT event_id, {_HASH.format(seed=7)} >= CAST(0.2 * 4503599627370496 AS BIGINT) AS is_train FROM events")
def random_split(spark, d):
    """A random fifth held out, by a seed and each row's key."""
    return clean.random_split(read(spark, d, "events").select("event_id"), "event_id", 0.2, 7)


@query("SELECT 'forest' AS model, 'quantity' AS feature, true AS first, true AS sums_to_one UNION ALL SELECT 'forest', 'noise', false, true")
def impurity_importances(spark, d):
    """A forest's importances by impurity: the feature that decides the label comes first."""
    li = read(spark, d, "lineitem").select(F.col("l_quantity").alias("quantity"), (F.col("l_orderkey") * 7919 % 97).cast("double").alias("noise"), (F.col("l_quantity") * 3.0).alias("y"))
    found = ml.impurity_importances(ml.forest(li, ["quantity", "noise"], "y", 10, 5), ["quantity", "noise"])
    best, total = max(v for _, v in found), sum(v for _, v in found)
    return spark.createDataFrame([("forest", f, v == best, abs(total - 1) < 1e-6) for f, v in found], "model string, feature string, first boolean, sums_to_one boolean")


@query("SELECT model, count(*) AS n, true AS separates FROM (VALUES ('forest'), ('network')) m(model), (SELECT * FROM lineitem WHERE l_orderkey % 5 = 0) GROUP BY 1")
def binary_classifiers(spark, d):
    """A forest and a dense network for a binary label, on a held-out fifth; label and errors follow from two columns."""
    li = read(spark, d, "lineitem").select("l_orderkey", (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"), (F.col("l_quantity") / 50 + F.col("l_discount") * 10 > 1.0).cast("int").alias("y"))
    train, test = li.where("l_orderkey % 5 <> 0"), li.where("l_orderkey % 5 = 0")
    forest = ml.forest_classifier(train, ["a", "b"], "y", 10, 6).transform(ml.assembled(test, ["a", "b"]))
    network = ml.predict_classes(test, ml.dense_classifier(train, ["a", "b"], "y", (8,)), ["a", "b"])
    right = F.avg((F.col("prediction") == F.col("y")).cast("double")) > 0.9
    one = lambda name, scored: scored.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"), right.alias("separates"))
    return one("forest", forest).unionByName(one("network", network))


@query("SELECT v.x AS place, v.y AS name FROM (VALUES (0, 'AUTOMOBILE'), (1, 'BUILDING'), (2, 'NONE')) v(x, y)")
def stated_order(spark, d):
    """Rows in a stated order, values without rows included."""
    seen = read(spark, d, "customer").select(F.col("c_mktsegment").alias("name")).distinct()
    return windows.in_stated_order(seen, "name", ["AUTOMOBILE", "BUILDING", "NONE"]).select("place", "name")

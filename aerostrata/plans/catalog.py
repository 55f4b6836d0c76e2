"""Named queries over the driver's tables, each with the SQL it is held against.

``events`` stands for the hourly readings: user_id for the place, ts for the time,
value for the measurement, event_type for its kind.  Suppliers and customers get
synthetic coordinates from their keys.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean, colfilter, joins, metrics, spatial, stats, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, dir) under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one only where none is set and all runs on this machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="aerostrata-") + "/work"


def readings(spark: SparkSession, d: str) -> DataFrame:
    """events as readings; every 17th value is missing."""
    e = read(spark, d, "events")
    return e.select("event_id", S.zip5(F.col("user_id")).alias("zip"), F.col("ts").alias("time"), "event_type", F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"))


R = "r AS (SELECT event_id, lpad(CAST(user_id AS VARCHAR), 5, '0') AS zip, ts AS time, event_type, CASE WHEN event_id % 17 <> 0 THEN value END AS value FROM events)"

# -- joins ---------------------------------------------------------------------


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = readings(spark, d).withColumn("day", F.to_date("time"))
    left = r.where("event_type = 'view'").select("zip", "day", F.col("event_id").alias("seq_l"), F.col("value").alias("air"), (F.col("event_id") % 7).alias("latitude"))
    right = r.where("event_type = 'click'").select("zip", "day", F.col("event_id").alias("seq_r"), F.col("value").alias("wind"), (F.col("event_id") % 5).alias("latitude"))
    return left, right


_SIDES = f"{R}, l AS (SELECT zip, CAST(time AS DATE) AS day, event_id AS seq_l, value AS air, row_number() OVER (PARTITION BY zip, CAST(time AS DATE) ORDER BY event_id) AS rn FROM r WHERE event_type = 'view'), q AS (SELECT zip, CAST(time AS DATE) AS day, event_id AS seq_r, value AS wind, event_id % 5 AS latitude, row_number() OVER (PARTITION BY zip, CAST(time AS DATE) ORDER BY event_id) AS rn FROM r WHERE event_type = 'click')"


@query(f"WITH {_SIDES} SELECT zip, day, seq_l, air, latitude, seq_r, wind FROM l FULL OUTER JOIN q USING (zip, day, rn)")
def positional_outer_join(spark, d):
    left, right = _sides(spark, d)
    return joins.positional_join(left, right, ["zip", "day"], ["seq_l"], ["seq_r"])


@query(f"WITH {_SIDES} SELECT zip, day, seq_l, air, latitude, seq_r, wind FROM l JOIN q USING (zip, day, rn)")
def positional_inner_join(spark, d):
    left, right = _sides(spark, d)
    return joins.positional_join(left, right, ["zip", "day"], ["seq_l"], ["seq_r"], "inner")


@query(f"""WITH {_SIDES}, j AS (SELECT zip, day, rn, air, wind FROM l FULL OUTER JOIN q USING (zip, day, rn)), o AS (SELECT * FROM j)
SELECT zip, day, rn, air, wind, CAST(month(day) AS INTEGER) AS month, CAST(isodow(day) - 1 AS INTEGER) AS day_of_week, sin(2.0 * pi() * (isodow(day) - 1) / 7) AS day_of_week_sin, cos(2.0 * pi() * (isodow(day) - 1) / 7) AS day_of_week_cos,
lag(air, 1) OVER w AS air_past_1, lag(air, 2) OVER w AS air_past_2, lag(wind, 1) OVER w AS wind_past_1, lag(wind, 2) OVER w AS wind_past_2 FROM o WINDOW w AS (PARTITION BY zip ORDER BY day, rn)""")
def feature_build(spark, d):
    """Merge two kinds of readings, then calendar parts and lags: the features' main path."""
    from pyspark.sql import Window

    left, right = _sides(spark, d)
    both = joins.positional_join(left.drop("latitude"), right.drop("latitude"), ["zip", "day"], ["seq_l"], ["seq_r"])
    both = both.withColumn("rn", F.row_number().over(Window.partitionBy("zip", "day").orderBy(F.col("seq_l").asc_nulls_last(), F.col("seq_r").asc_nulls_last())))
    parts = S.calendar(F.col("day"))
    both = both.withColumns({"month": parts["month"], "day_of_week": parts["day_of_week"], **S.cyclic("day_of_week", parts["day_of_week"], 7)})
    return windows.lags(both, ["air", "wind"], 2, "zip", ["day", "rn"]).drop("seq_l", "seq_r")


@query("SELECT o_orderkey, o_custkey, coalesce(c_mktsegment, 'NONE') AS segment, coalesce(c_acctbal, 0.0) AS balance FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON o_custkey = c_custkey")
def left_lookup(spark, d):
    c = read(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return joins.lookup(read(spark, d, "orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"], {"segment": F.lit("NONE"), "balance": F.lit(0.0)})


@query("WITH e AS (SELECT user_id AS zip, date_trunc('hour', ts) AS time, event_type, value FROM events) SELECT a.time, a.zip AS zip_x, a.value AS value_x, b.zip AS zip_y, b.value AS value_y FROM e a JOIN e b ON a.time = b.time WHERE a.event_type = 'view' AND b.event_type = 'error'")
def time_join_suffixes(spark, d):
    e = read(spark, d, "events").select(F.col("user_id").alias("zip"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"), "event_type", "value")
    return joins.suffixed_join(e.where("event_type = 'view'").drop("event_type"), e.where("event_type = 'error'").drop("event_type"), ["time"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_zip(spark, d):
    return clean.members(read(spark, d, "customer").select("c_custkey", "c_name"), read(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_zip(spark, d):
    return clean.members(read(spark, d, "customer").select("c_custkey"), read(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"], keep=False)


@query("WITH days AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-02-10', INTERVAL 1 DAY)) AS DATE) AS day), done AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase' AND value > 100) SELECT day FROM days WHERE day NOT IN (SELECT day FROM done)")
def run_log_antijoin(spark, d):
    """Days to fetch: those without a logged successful run."""
    days = spark.range(1).select(F.explode(F.expr("sequence(DATE '2024-01-01', DATE '2024-02-09')")).alias("day"))
    done = read(spark, d, "events").where("event_type = 'purchase' AND value > 100").select(F.to_date("ts").alias("day"))
    return clean.members(days, done, ["day"], keep=False)


@query("WITH c AS (SELECT p_brand AS feature, avg(p_retailprice) / 2000 AS a FROM part GROUP BY 1), f AS (SELECT p_brand AS feature, max(p_retailprice) / 2500 AS a FROM part WHERE p_size > 5 GROUP BY 1), m AS (SELECT p_brand AS feature, avg(p_size) / 50 AS a FROM part WHERE p_size > 20 GROUP BY 1), v AS (SELECT p_brand AS feature, var_samp(p_size) / 400 AS a FROM part WHERE p_size > 10 GROUP BY 1), s AS (SELECT feature, coalesce(c.a, 0) * 0.25 + coalesce(f.a, 0) * 0.30 + coalesce(m.a, 0) * 0.35 + coalesce(v.a, 0) * 0.10 AS raw, coalesce(v.a, 0) < 0.2 AS low FROM c LEFT JOIN f USING (feature) LEFT JOIN m USING (feature) LEFT JOIN v USING (feature)), t AS (SELECT feature, low, CASE WHEN low THEN raw * 0.1 ELSE raw END AS score FROM s) SELECT feature, score, CASE WHEN low THEN 'USELESS (near-zero variance)' WHEN score >= 0.4 THEN 'IMPORTANT' WHEN score >= 0.15 THEN 'MARGINAL' ELSE 'USELESS' END AS verdict FROM t")
def consensus_score(spark, d):
    """Four importances of each feature, from four inputs joined one after another."""
    p = read(spark, d, "part")
    one = lambda rows, figure, name: rows.groupBy(F.col("p_brand").alias("feature")).agg(figure.alias(name))
    both = one(p, F.avg("p_retailprice") / 2000, "correlation")
    both = both.join(one(p.where("p_size > 5"), F.max("p_retailprice") / 2500, "forest"), "feature", "left")
    both = both.join(one(p.where("p_size > 20"), F.avg("p_size") / 50, "permutation"), "feature", "left")
    both = both.join(one(p.where("p_size > 10"), F.var_samp("p_size") / 400, "variance"), "feature", "left")
    both = both.withColumn("low", F.coalesce("variance", F.lit(0.0)) < 0.2)
    scored = both.withColumn("score", S.consensus(*[F.col(c) for c in ("correlation", "forest", "permutation", "variance", "low")]))
    return scored.select("feature", "score", S.verdict(F.col("score"), F.col("low")).alias("verdict"))


_PLACES = "z AS (SELECT c_custkey AS zip, radians(-95.0 - (c_custkey * 37 % 1000) / 1000.0) * 6378137.0 AS x, ln(tan(pi() / 4 + radians(29.3 + (c_custkey * 61 % 1000) / 1000.0) / 2)) * 6378137.0 AS y FROM customer), f AS (SELECT s_suppkey AS fid, radians(-95.0 - (s_suppkey * 53 % 1000) / 1000.0) * 6378137.0 AS fx, ln(tan(pi() / 4 + radians(29.3 + (s_suppkey * 29 % 1000) / 1000.0) / 2)) * 6378137.0 AS fy, greatest(s_acctbal, 0.0) AS amount, s_suppkey % 5 AS n_chemicals FROM supplier), p0 AS (SELECT zip, fid, x, y, fx, fy, amount, n_chemicals, fx - x AS dx, fy - y AS dy, sqrt((fx - x) * (fx - x) + (fy - y) * (fy - y)) AS dist FROM z, f), p AS (SELECT * FROM p0 WHERE dist > 0 AND dist <= 10000)"


def _places(spark, d):
    c, s = read(spark, d, "customer"), read(spark, d, "supplier")
    zx, zy = S.web_mercator(-95.0 - (F.col("c_custkey") * 37 % 1000) / 1000.0, 29.3 + (F.col("c_custkey") * 61 % 1000) / 1000.0)
    fx, fy = S.web_mercator(-95.0 - (F.col("s_suppkey") * 53 % 1000) / 1000.0, 29.3 + (F.col("s_suppkey") * 29 % 1000) / 1000.0)
    places = c.select(F.col("c_custkey").alias("zip"), zx.alias("x"), zy.alias("y"))
    return places, s.select(F.col("s_suppkey").alias("fid"), fx.alias("fx"), fy.alias("fy"), F.greatest(F.col("s_acctbal"), F.lit(0.0)).alias("amount"), (F.col("s_suppkey") % 5).alias("n_chemicals"))


@query(f"WITH {_PLACES} SELECT zip, fid, round(dist, 4) AS dist FROM p")
def spatial_pairs(spark, d):
    places, facilities = _places(spark, d)
    pairs = joins.points_within(places, facilities.select("fid", "fx", "fy"), 10_000, also={"rounded": F.round("dist", 4)})
    return pairs.select("zip", "fid", F.col("rounded").alias("dist"))


@query(f"WITH {_PLACES}, k AS (SELECT CASE WHEN quantile_cont(amount, 0.95) > 0 THEN quantile_cont(amount, 0.95) ELSE greatest(max(amount), 1) END AS q, greatest(max(n_chemicals), 1) AS c FROM p), s AS (SELECT zip, dx / dist AS ux, dy / dist AS uy, exp(-dist / 10000) AS decay, 0.7 * least(1, amount / q) + 0.3 * least(1, n_chemicals / c) AS severity FROM p, k), w AS (SELECT c_custkey AS zip, 10.0 * cos(radians(c_custkey % 360)) * 0.3 + 20.0 * cos(radians(c_custkey * 7 % 360)) * 0.7 AS wx, 10.0 * sin(radians(c_custkey % 360)) * 0.3 + 20.0 * sin(radians(c_custkey * 7 % 360)) * 0.7 AS wy FROM customer) SELECT w.zip, round(coalesce(sum(severity * decay * greatest(wx * ux + wy * uy, 0)), 0.0), 6) AS score FROM w LEFT JOIN s ON s.zip = w.zip GROUP BY w.zip")
def impact_score(spark, d):
    places, facilities = _places(spark, d)
    wx, wy = S.wind_vector(F.lit(10.0), F.col("zip") % 360, F.lit(20.0), F.col("zip") * 7 % 360, share=0.7)
    return spatial.impact_scores(places, facilities, 10_000.0, "zip", wx, wy).withColumn("score", F.round("score", 6))


@query(f"WITH {_PLACES}, seg AS (SELECT fid AS road_id, fx AS x1, fy AS y1, fx + 3000 * cos(fid) AS x2, fy + 3000 * sin(fid) AS y2 FROM f), t AS (SELECT zip, road_id, x, y, x1, y1, x2 - x1 AS vx, y2 - y1 AS vy, least(1, greatest(0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t FROM z, seg), u AS (SELECT zip, road_id, sqrt((x1 + t * vx - x) * (x1 + t * vx - x) + (y1 + t * vy - y) * (y1 + t * vy - y)) AS dist FROM t) SELECT zip, road_id, round(dist, 4) AS dist FROM u WHERE dist > 0 AND dist <= 5000")
def nearest_polyline(spark, d):
    places, f = _places(spark, d)
    pieces = f.select(F.col("fid").alias("road_id"), F.col("fx").alias("x1"), F.col("fy").alias("y1"), (F.col("fx") + 3000 * F.cos("fid")).alias("x2"), (F.col("fy") + 3000 * F.sin("fid")).alias("y2"))
    near = joins.nearest_on_lines(places, pieces, 5000.0, ["zip"], "road_id", also={"rounded": F.round("dist", 4)})
    return near.select("zip", "road_id", F.col("rounded").alias("dist"))


@query("SELECT n_nationkey AS zip, n_nationkey + 2.0 AS x, n_nationkey * 2 + 1.0 AS y FROM nation")
def polygon_centroid(spark, d):
    """Centroids of 4 x 2 rectangles, each with a symmetric hole."""
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("zip"), F.col("n_nationkey").cast("double").alias("a"), (F.col("n_nationkey") * 2.0).alias("b"))
    ring = lambda x0, y0, w, h: F.array(*[F.struct((F.col("a") + x0 + i * w).alias("x"), (F.col("b") + y0 + j * h).alias("y")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    rings = n.select("zip", ring(0, 0, 4, 2).alias("ring"), F.lit(False).alias("is_hole")).unionByName(n.select("zip", ring(1.5, 0.5, 1, 1).alias("ring"), F.lit(True).alias("is_hole")))
    return spatial.centroids(rings, "zip").select("zip", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


# -- windows and order ----------------------------------------------------------


@query(f"WITH {R} SELECT event_id, zip, value, lag(value, 1) OVER w AS value_past_1, lag(value, 2) OVER w AS value_past_2, lag(value, 3) OVER w AS value_past_3 FROM r WINDOW w AS (PARTITION BY zip ORDER BY time, event_id)")
def lag_features(spark, d):
    r = readings(spark, d)
    return windows.lags(r, ["value"], 3, "zip", ["time", "event_id"]).drop("time", "event_type")


@query(f"WITH {R} SELECT event_id, zip, CASE WHEN count(value) OVER w >= 24 THEN avg(value) OVER w END AS mean_24 FROM r WINDOW w AS (PARTITION BY zip ORDER BY time, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)")
def rolling_mean_24(spark, d):
    return windows.rolling_mean(readings(spark, d), "value", 24, "zip", ["time", "event_id"], "mean_24").select("event_id", "zip", "mean_24")


@query(f"WITH {R} SELECT event_id, zip, row_number() OVER (PARTITION BY zip ORDER BY time, event_id) <= floor(count(*) OVER (PARTITION BY zip) * 0.8 + 1e-9) AS is_train FROM r")
def chrono_split(spark, d):
    return windows.time_split(readings(spark, d), 0.2, "zip", ["time", "event_id"]).select("event_id", "zip", "is_train")


@query("WITH n AS (SELECT user_id, event_id, ts, value, row_number() OVER w AS rn, sum(value) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS s, first_value(value) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS oldest FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT user_id, event_id, round(s, 6) AS sum_24, oldest, value AS target FROM n WHERE rn > 24")
def sequence_windows(spark, d):
    """Look-back 24, horizon 1: each window's sum and oldest value stand for its array."""
    out = windows.sequences(read(spark, d, "events"), ["value"], "value", 24, 1, "user_id", ["ts", "event_id"])
    return out.select("user_id", "event_id", F.round(F.aggregate("sequence", F.lit(0.0), lambda a, x: a + x[0]), 6).alias("sum_24"), F.col("sequence")[0][0].alias("oldest"), "target")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(spark, d):
    return windows.top(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20)


@query("SELECT p_partkey, p_size FROM part ORDER BY p_size, p_partkey LIMIT 15")
def smallest_parts(spark, d):
    return windows.top(read(spark, d, "part").select("p_partkey", "p_size"), ["p_size", "p_partkey"], 15)


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY abs(s_acctbal) DESC, s_suppkey LIMIT 10")
def top_by_absolute(spark, d):
    return windows.top(read(spark, d, "supplier").select("s_suppkey", "s_acctbal"), [F.abs("s_acctbal").desc(), "s_suppkey"], 10)


@query("WITH m AS (SELECT dayname(ts) AS day_name, avg(value) AS mean FROM events GROUP BY 1) SELECT place, v.day_name, mean FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday'), (7, 'Noday')) v(place, day_name) LEFT JOIN m USING (day_name)")
def dow_means_ordered(spark, d):
    means = read(spark, d, "events").groupBy(F.date_format("ts", "EEEE").alias("day_name")).agg(F.avg("value").alias("mean"))
    return windows.in_stated_order(means, "day_name", ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday", "Noday"])


@query("SELECT s_suppkey, CAST((row_number() OVER (ORDER BY s_suppkey) - 1) // 7 AS INTEGER) AS batch FROM supplier")
def location_batches(spark, d):
    return clean.numbered_batches(read(spark, d, "supplier").select("s_suppkey"), ["s_suppkey"], 7)


@query("WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) SELECT o_custkey, o_orderkey, o_orderdate FROM s WHERE rn = 1")
def keep_first_dedupe(spark, d):
    return clean.first_of_each(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT event_id, sum(1) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS weight_60m FROM events")
def sliding_weight(spark, d):
    """Each client's requests' weight within the last hour, as a rate limiter adds it up."""
    from pyspark.sql import Window

    one = read(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("user_id").orderBy("us").rangeBetween(-3_600_000_000, 0)
    return one.select("event_id", F.sum(F.lit(1)).over(w).alias("weight_60m"))


# -- scalars -------------------------------------------------------------------


@query("SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, sin(2.0 * pi() * month(ts) / 12) AS month_sin, cos(2.0 * pi() * month(ts) / 12) AS month_cos, sin(2.0 * pi() * hour(ts) / 24) AS hour_sin, cos(2.0 * pi() * hour(ts) / 24) AS hour_cos FROM events")
def calendar_features(spark, d):
    parts = S.calendar(F.col("ts"))
    out = read(spark, d, "events").select("event_id", *[c.alias(k) for k, c in parts.items()])
    return out.withColumns({**S.cyclic("month", F.col("month"), 12), **S.cyclic("hour", F.col("hour"), 24)})


@query("SELECT event_id, dayname(ts) AS day_name, monthname(ts) AS month_name, CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring' WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season, CASE WHEN isodow(ts) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, CASE WHEN hour(ts) <= 5 THEN 'Night(0-5)' WHEN hour(ts) <= 11 THEN 'Morning(6-11)' WHEN hour(ts) <= 17 THEN 'Afternoon(12-17)' ELSE 'Evening(18-23)' END AS hour_group, strftime(ts, '%Y-%m-%d %H:%M') AS minute_key, strftime(ts, '%H:00') AS hour_key FROM events")
def calendar_names(spark, d):
    ts = F.col("ts")
    return read(spark, d, "events").select("event_id", F.date_format(ts, "EEEE").alias("day_name"), F.date_format(ts, "MMMM").alias("month_name"), S.season(F.month(ts)).alias("season"), F.when(F.weekday(ts) >= 5, "Weekend").otherwise("Weekday").alias("day_type"), S.hour_group(F.hour(ts)).alias("hour_group"), F.date_format(ts, "yyyy-MM-dd HH:mm").alias("minute_key"), F.date_format(ts, "HH:00").alias("hour_key"))


@query("WITH a AS (SELECT event_id, event_id * 13 % 360 AS deg FROM events), b AS (SELECT event_id, sin(radians(deg)) AS wind_sin, cos(radians(deg)) AS wind_cos FROM a) SELECT event_id, wind_sin, wind_cos, round(atan2(wind_sin, wind_cos), 9) AS angle FROM b")
def direction_features(spark, d):
    a = read(spark, d, "events").withColumn("deg", F.col("event_id") * 13 % 360).select("event_id", *[c.alias(k) for k, c in S.direction("wind", F.col("deg")).items()])
    return a.withColumn("angle", F.round(F.atan2("wind_sin", "wind_cos"), 9))


_CUT = " ".join(f"WHEN value <= {e} THEN '{n}'" for e, n in S.AQI_BANDS)
_FIVE = " ".join(f"WHEN value <= {e} THEN '{n}'" for e, n in S.AQI_FIVE)


@query(f"SELECT event_id, CASE WHEN value <= 0 THEN NULL {_CUT} END AS banded, CASE WHEN value IS NULL THEN NULL WHEN value <= 50 THEN 'Good' WHEN value <= 100 THEN 'Moderate' WHEN value <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN value <= 200 THEN 'Unhealthy' WHEN value <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS chained, CASE WHEN value <= 0 THEN NULL {_FIVE} END AS five FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 0 ELSE value * 2 END AS value FROM events)")
def category_cut(spark, d):
    v = F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 13 == 0, 0).otherwise(F.col("value") * 2)
    e = read(spark, d, "events").select("event_id", v.alias("v"))
    return e.select("event_id", S.aqi_cut(F.col("v")).alias("banded"), S.aqi_chain(F.col("v")).alias("chained"), S.aqi_cut(F.col("v"), S.AQI_FIVE).alias("five"))


@query("WITH a AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') WHEN 1 THEN 'x' WHEN 2 THEN ' ' || CAST(value AS VARCHAR) WHEN 3 THEN NULL ELSE '' END AS raw FROM events) SELECT event_id, coalesce(try_cast(replace(trim(raw), ',', '') AS DOUBLE), 0.0) AS zeroed, try_cast(trim(raw) AS DOUBLE) AS nulled, coalesce(try_cast(trim(raw) AS DOUBLE), 7.0) AS filled FROM a")
def tri_clean_numeric(spark, d):
    k = F.col("event_id") % 5
    raw = F.when(k == 0, F.concat(F.lit("1,"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))).when(k == 1, "x").when(k == 2, F.concat(F.lit(" "), F.col("value").cast("string"))).when(k == 3, None).otherwise("")
    e = read(spark, d, "events").select("event_id", raw.alias("raw"))
    return e.select("event_id", S.number_or_zero(F.col("raw")).alias("zeroed"), S.number_or_null(F.col("raw")).alias("nulled"), F.coalesce(S.number_or_null(F.col("raw")), F.lit(7.0)).alias("filled"))


@query("WITH a AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 9999 AS VARCHAR) || '.0' WHEN 1 THEN NULL WHEN 2 THEN 'ZCTA5 7' || lpad(CAST(event_id % 9999 AS VARCHAR), 4, '0') ELSE CAST(event_id + 100000 AS VARCHAR) END AS raw FROM events), b AS (SELECT event_id, raw, split_part(trim(raw), '.', 1) AS head FROM a) SELECT event_id, CASE WHEN raw IS NULL OR head = '' THEN NULL WHEN length(head) >= 5 THEN head ELSE lpad(head, 5, '0') END AS zip, nullif(regexp_extract(raw, '(\\d{5})', 1), '') AS digits FROM b".replace("\\\\", "\\"))
def zip_normalize(spark, d):
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.concat((F.col("event_id") % 9999).cast("string"), F.lit(".0"))).when(k == 1, None).when(k == 2, F.concat(F.lit("ZCTA5 7"), F.lpad((F.col("event_id") % 9999).cast("string"), 4, "0"))).otherwise((F.col("event_id") + 100000).cast("string"))
    return read(spark, d, "events").select("event_id", S.zip5(raw).alias("zip"), S.five_digits(raw).alias("digits"))


@query("WITH a AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '-06:00' WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z' WHEN 2 THEN 'bad' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS raw, date_trunc('second', ts) AS t FROM events) SELECT event_id, CASE WHEN event_id % 4 < 2 THEN substr(raw, 1, 19) ELSE raw END AS stripped, CASE WHEN event_id % 4 <> 2 THEN t END AS parsed FROM a")
def tz_strip(spark, d):
    k, text = F.col("event_id") % 4, lambda f: F.date_format("ts", f)
    raw = F.when(k == 0, F.concat(text("yyyy-MM-dd HH:mm:ss"), F.lit("-06:00"))).when(k == 1, F.concat(text("yyyy-MM-dd HH:mm:ss"), F.lit("Z"))).when(k == 2, "bad").otherwise(text("yyyy-MM-dd'T'HH:mm:ss"))
    e = read(spark, d, "events").select("event_id", raw.alias("raw"))
    return e.select("event_id", S.strip_zone(F.col("raw")).alias("stripped"), S.wall_clock(F.col("raw")).alias("parsed"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 6000 > 4000 THEN least(2000, 3000) WHEN c_custkey % 6000 > 1000 THEN 3000 WHEN c_custkey % 6000 > 300 THEN 3000 ELSE 3000 END AS radius, CASE WHEN 29.5 + (c_custkey % 10) / 10.0 > 30.05 OR -95.2 - (c_custkey % 7) / 10.0 < -95.60 THEN 80.0::DOUBLE WHEN 29.5 + (c_custkey % 10) / 10.0 > 29.90 OR -95.2 - (c_custkey % 7) / 10.0 < -95.45 THEN 40.0 ELSE 15.0 END AS area, greatest(11 / 10.0::DOUBLE, 11 / 10.0::DOUBLE * (c_custkey % 40 + 1) / 7) AS weight FROM customer")
def place_tiers(spark, d):
    c, k = read(spark, d, "customer"), F.col("c_custkey")
    return c.select("c_custkey", S.search_radius(k % 6000, 3000).alias("radius"), S.area_km2(29.5 + (k % 10) / 10.0, -95.2 - (k % 7) / 10.0).alias("area"), S.request_weight(F.lit(11.0), k % 40 + 1).alias("weight"))


@query("WITH a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate + to_days(CAST(o_orderkey % 4 * 10 AS INTEGER)) AS DATE) AS e FROM orders) SELECT o_orderkey, CASE WHEN s = e THEN lower(monthname(s)) || '_' || day(s) WHEN month(s) = month(e) THEN lower(monthname(s)) || '_' || day(s) || '_' || day(e) ELSE lower(monthname(s)) || '_' || day(s) || '_' || lower(monthname(e)) || '_' || day(e) END AS prefix, s + 1 AS next_day, e - 5 AS archive_limit FROM a")
def run_prefix(spark, d):
    a = read(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("s"), F.expr("date_add(to_date(o_orderdate), cast(o_orderkey % 4 * 10 as int))").alias("e"))
    return a.select("o_orderkey", S.window_prefix(F.col("s"), F.col("e")).alias("prefix"), F.date_add("s", 1).alias("next_day"), F.date_sub("e", 5).alias("archive_limit"))


@query("SELECT s_suppkey, unnest(range(TIMESTAMP '2024-03-09 00:00:00', TIMESTAMP '2024-03-10 00:00:00', INTERVAL 1 HOUR)) AS time FROM supplier")
def hour_axis(spark, d):
    """Half-open hourly series for each place."""
    axis = F.expr("explode(sequence(timestamp_ntz'2024-03-09 00:00:00', timestamp_ntz'2024-03-10 00:00:00' - interval 1 hour, interval 1 hour))")
    return read(spark, d, "supplier").select("s_suppkey", axis.alias("time"))


@query("SELECT n_nationkey, n_nationkey + i AS temperature, n_nationkey * i AS humidity FROM nation, range(3) t(i)")
def columns_to_rows(spark, d):
    """A source's parallel arrays, one for each variable, to rows."""
    n = read(spark, d, "nation")
    i = F.sequence(F.lit(0), F.lit(2))
    z = F.explode(F.arrays_zip(F.transform(i, lambda x: (F.col("n_nationkey") + x).cast("long")).alias("temperature"), F.transform(i, lambda x: (F.col("n_nationkey") * x).cast("long")).alias("humidity")))
    return n.select("n_nationkey", z.alias("z")).select("n_nationkey", F.col("z")["temperature"].alias("temperature"), F.col("z")["humidity"].alias("humidity"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, coalesce(json_extract_string(props, '$.name'), '') AS name FROM events")
def json_tags(spark, d):
    tags = F.from_json("props", "map<string,string>")
    return read(spark, d, "events").select("event_id", tags["k"].cast("int").alias("k"), F.coalesce(tags["name"], F.lit("")).alias("name"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) AS rounded FROM lineitem")
def rounded(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.bround(F.col("l_extendedprice") / 7, 2).alias("rounded"))


@query("SELECT c_custkey, c_name FROM customer WHERE lower(trim(c_mktsegment)) = 'building' AND regexp_matches(upper(c_name), '#00000(0|1)') AND c_acctbal IS NOT NULL AND c_acctbal > 0")
def normalized_filter(spark, d):
    c = read(spark, d, "customer")
    return c.where((F.lower(F.trim("c_mktsegment")) == "building") & F.coalesce(F.upper("c_name").rlike("#00000(0|1)"), F.lit(False)) & (F.col("c_acctbal") > 0)).select("c_custkey", "c_name")


@query("WITH q AS (SELECT quantile_cont(value, 0.95) AS q FROM events) SELECT event_id, value, value > q AS extreme, CASE WHEN value >= 35 THEN 1 ELSE 0 END AS label FROM events, q")
def quantile_split(spark, d):
    high, rest = clean.split_at_quantile(read(spark, d, "events"), "value", 0.95)
    both = high.withColumn("extreme", F.lit(True)).unionByName(rest.withColumn("extreme", F.lit(False)))
    return both.select("event_id", "value", "extreme", F.when(F.col("value") >= 35, 1).otherwise(0).alias("label"))


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def union_by_name(spark, d):
    a = read(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = read(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def union_strict(spark, d):
    return clean.strict_union(read(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), read(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")))


@query("SELECT CAST(NULL AS DOUBLE) AS price, s_name AS name, s_suppkey AS key FROM supplier")
def align_columns(spark, d):
    to = read(spark, d, "part").select(F.col("p_retailprice").alias("price"), F.col("p_name").alias("name"), F.col("p_partkey").alias("key"))
    return clean.align(read(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal"), to)


@query("SELECT DISTINCT p_type FROM part EXCEPT SELECT DISTINCT p_type FROM part WHERE p_size > 48")
def set_difference(spark, d):
    p = read(spark, d, "part")
    return clean.members(p.select("p_type").distinct(), p.where("p_size > 48"), ["p_type"], keep=False)


# -- aggregates ------------------------------------------------------------------


@query(f"WITH {R} SELECT CAST(hour(time) AS INTEGER) AS hour, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS least, max(value) AS most, count(value) AS n FROM r GROUP BY 1")
def hourly_stats(spark, d):
    return readings(spark, d).groupBy(F.hour("time").alias("hour")).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("least"), F.max("value").alias("most"), F.count("value").alias("n"))


@query("SELECT CASE WHEN isodow(ts) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, avg(value) AS mean, stddev_samp(value) AS std, count(*) AS n FROM events GROUP BY 1")
def weekday_weekend(spark, d):
    return read(spark, d, "events").groupBy(F.when(F.weekday("ts") >= 5, "Weekend").otherwise("Weekday").alias("day_type")).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey, coalesce(sum(CASE WHEN l_quantity > 10 THEN l_quantity END), 0) AS amount, count(DISTINCT l_partkey) AS n_parts FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1")
def sum_by_key(spark, d):
    return read(spark, d, "lineitem").where("l_suppkey is not null").groupBy("l_suppkey").agg(F.coalesce(F.sum(F.when(F.col("l_quantity") > 10, F.col("l_quantity"))), F.lit(0.0)).alias("amount"), F.countDistinct("l_partkey").alias("n_parts"))


@query("SELECT p_brand, CASE WHEN bool_or(p_type = 'SMALL') THEN 'YES' ELSE 'NO' END AS has_small FROM part GROUP BY 1")
def any_flag(spark, d):
    return read(spark, d, "part").withColumn("f", F.when(F.col("p_type") == "SMALL", "YES").otherwise("NO")).groupBy("p_brand").agg(stats.any_yes("f").alias("has_small"))


@query("WITH a AS (SELECT DISTINCT p_brand, p_name FROM part), b AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS rn FROM a) SELECT p_brand, string_agg(p_name, '; ' ORDER BY p_name) AS names FROM b WHERE rn <= 10 GROUP BY 1")
def string_agg_top10(spark, d):
    return read(spark, d, "part").groupBy("p_brand").agg(stats.joined_distinct("p_name", 10, "; ").alias("names"))


@query("WITH a AS (SELECT o_custkey, o_orderstatus, min(o_orderkey) AS k FROM orders GROUP BY 1, 2), f AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority FROM orders GROUP BY 1) SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY k) AS statuses, any_value(first_priority) AS first_priority FROM a JOIN f USING (o_custkey) GROUP BY 1")
def ordered_unique_agg(spark, d):
    return read(spark, d, "orders").groupBy("o_custkey").agg(stats.joined_in_order("o_orderstatus", "o_orderkey", ",").alias("statuses"), F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"))


@query("SELECT k AS segment, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS percent FROM (SELECT CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS k FROM customer) GROUP BY 1")
def value_counts(spark, d):
    return stats.value_counts(read(spark, d, "customer").select(F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("segment")), "segment")


def _by_column(expr: str, table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {expr.replace('@', c)} FROM {table}" for c in columns)


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(_by_column("count(@) AS count, avg(@) AS mean, stddev_samp(@) AS std, min(@) AS min, quantile_cont(@, 0.25) AS q25, quantile_cont(@, 0.5) AS q50, quantile_cont(@, 0.75) AS q75, max(@) AS max", "lineitem", _LINE))
def describe_table(spark, d):
    return stats.describe(read(spark, d, "lineitem"), _LINE)


@query("SELECT 'value' AS \"column\", event_type, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max FROM events GROUP BY event_type")
def describe_grouped(spark, d):
    return stats.describe(read(spark, d, "events"), ["value"], ["event_type"])


@query("SELECT skewness(value) AS skew, kurtosis(value) AS kurt FROM events")
def skew_kurt_corrected(spark, d):
    return read(spark, d, "events").agg(stats.skewness_corrected("value").alias("skew"), stats.kurtosis_corrected("value").alias("kurt"))


@query("WITH m AS (SELECT avg(value) AS m FROM events) SELECT avg((value - m) ** 3) / avg((value - m) ** 2) ** 1.5 AS skew, avg((value - m) ** 4) / avg((value - m) ** 2) ** 2 - 3 AS kurt FROM events, m")
def skew_kurt_pop(spark, d):
    return read(spark, d, "events").agg(F.skewness("value").alias("skew"), F.kurtosis("value").alias("kurt"))


@query("SELECT quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.02) AS q02, quantile_cont(value, 0.95) AS q95, quantile_cont(value, 0.98) AS q98, quantile_cont(value, 0.99) AS q99 FROM events")
def exact_quantiles(spark, d):
    found = stats.quantiles(read(spark, d, "events"), ["value"], [0.01, 0.02, 0.95, 0.98, 0.99])["value"]
    return spark.createDataFrame([tuple(found)], ", ".join(f"{n} double" for n in ("q01", "q02", "q95", "q98", "q99")))


def _iqr_sql(k: float) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1)) AS outliers, count(*) FILTER (WHERE {c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1)) * 100.0 / count({c}) AS percent FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})" for t, c in (("lineitem", "l_extendedprice"), ("lineitem", "l_quantity")))


@query(_iqr_sql(1.5))
def iqr_outliers(spark, d):
    return stats.iqr_outliers(read(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], 1.5)


@query(_iqr_sql(3.0))
def iqr_outliers_far(spark, d):
    return stats.iqr_outliers(read(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], 3.0)


@query(f"WITH {R} " + _by_column("count(*) - count(@) AS n_null, (count(*) - count(@)) * 100.0 / count(*) AS percent", "r", ["zip", "time", "event_type", "value"]))
def null_report(spark, d):
    return stats.null_report(readings(spark, d), ["zip", "time", "event_type", "value"])


@query(f"WITH {R}, s AS (SELECT zip, event_type, CASE WHEN value > 60 THEN 1 WHEN value IS NOT NULL THEN 0 END AS v FROM r) SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS duplicates, (count(*) - count(v)) * 100.0 / (count(*) * 3) AS missing_percent FROM s")
def null_dup_report(spark, d):
    return stats.duplicate_rows(readings(spark, d).select("zip", "event_type", F.when(F.col("value") > 60, 1).when(F.col("value").isNotNull(), 0).alias("v")))


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS kind, count({c}) AS non_null, count(*) - count({c}) AS n_null, (count(*) - count({c})) * 100.0 / count(*) AS null_percent, count(DISTINCT {c}) AS n_unique FROM orders" for c, k in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))))
def data_dictionary(spark, d):
    return stats.data_dictionary(read(spark, d, "orders"))


@query(_by_column("min(@) AS least, max(@) AS most, avg(@) AS mean", "lineitem", _LINE))
def min_max_table(spark, d):
    one = read(spark, d, "lineitem").agg(*[F.struct(F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean")).alias(c) for c in _LINE])
    return stats.melt(one, _LINE).select("column", "value.*")


@query("SELECT metric, value FROM (SELECT CAST(count(*) AS VARCHAR) AS a, CAST(count(DISTINCT user_id) AS VARCHAR) AS b, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS c, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS e FROM events), LATERAL (VALUES ('rows', a), ('places', b), ('first', c), ('last', e)) v(metric, value)")
def dataset_summary(spark, d):
    one = read(spark, d, "events").agg(F.count(F.lit(1)).cast("string").alias("rows"), F.countDistinct("user_id").cast("string").alias("places"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last"))
    return stats.melt(one, one.columns).withColumnRenamed("column", "metric")


@query("SELECT a, b, r FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for i, a in enumerate(_LINE) for b in _LINE[i + 1 :]) + ") ORDER BY abs(r) DESC LIMIT 20")
def corr_pairs_top20(spark, d):
    return windows.top(stats.correlations(read(spark, d, "lineitem"), _LINE), [F.abs("r").desc(), "a", "b"], 20)


@query("WITH k AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb FROM lineitem) SELECT count(*) AS n, corr(ra, rb) AS rho FROM k")
def spearman(spark, d):
    return stats.spearman(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice").drop("p")


# Student's density is summed by Simpson's rule over 2,000 steps from 0 to |t|.
@query("""WITH k AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra, rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS rb FROM lineitem),
r AS (SELECT count(*) AS n, corr(ra, rb) AS rho FROM k), t AS (SELECT n, rho, n - 2.0 AS df, abs(rho) * sqrt((n - 2) / (1 - rho * rho)) AS t FROM r),
s AS (SELECT sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-(df + 1) / 2 * ln(1 + (t * i / 2000) ** 2 / df))) * t / 6000 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) AS half FROM t, range(2001) g(i) GROUP BY t, df)
SELECT n, round(rho, 9) AS rho, round(1 - 2 * half, 7) AS p FROM t, s""")
def spearman_test(spark, d):
    """Rank correlation of two columns that have little to do with each other, and its p value."""
    return stats.spearman(read(spark, d, "lineitem"), "l_quantity", "l_discount").select("n", F.round("rho", 9).alias("rho"), F.round("p", 7).alias("p"))


_SERIES = {"value": "value", "hour": "CAST(hour(ts) AS DOUBLE)", "minute": "CAST(minute(ts) AS DOUBLE)", "turn": "CAST(event_id % 97 AS DOUBLE)"}
_LAGS = range(1, 25)


@query("WITH e AS (SELECT user_id, ts, event_id, " + ", ".join(f'{x} AS "{n}"' for n, x in _SERIES.items()) + " FROM events), g AS (SELECT *, " + ", ".join(f'lag("{n}", {k}) OVER w AS {n}_{k}' for n in _SERIES for k in _LAGS) + " FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) " + " UNION ALL ".join(f"SELECT '{n}' AS series, {k} AS k, corr(\"{n}\", {n}_{k}) AS r FROM g" for n in _SERIES for k in _LAGS))
def lag_autocorrelation(spark, d):
    """Correlation of four series with their own past, 1 to 24 rows back."""
    e = read(spark, d, "events").select("user_id", "ts", "event_id", *[F.expr(x).alias(n) for n, x in _SERIES.items()])
    return stats.own_past(e, list(_SERIES), len(_LAGS), "user_id", ["ts", "event_id"])


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, " + ", ".join(f'avg(value) FILTER (WHERE isodow(ts) - 1 = {k}) AS "{k}"' for k in range(7)) + " FROM events GROUP BY 1")
def pivot_hour_dow(spark, d):
    e = read(spark, d, "events").select(F.hour("ts").alias("hour"), F.weekday("ts").alias("dow"), "value")
    return stats.pivot_mean(e, "hour", "dow", list(range(7)), "value")


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, " + ", ".join(f"nullif(count(*) FILTER (WHERE event_type = '{k}'), 0) AS {k}" for k in ("click", "error", "view")) + " FROM events GROUP BY 1")
def pivot_counts(spark, d):
    e = read(spark, d, "events").select(F.hour("ts").alias("hour"), "event_type")
    return e.groupBy("hour").pivot("event_type", ["click", "error", "view"]).agg(F.nullif(F.count(F.lit(1)), F.lit(0)))


@query("WITH m AS (SELECT user_id, event_type, avg(value) AS m FROM events GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, event_type) AS rn FROM m) SELECT user_id, event_type AS dominant FROM k WHERE rn = 1")
def dominant_type(spark, d):
    """The kind of the greatest mean; of equal ones the first in column order."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    wide = read(spark, d, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.avg("value"))
    means = F.array(*[F.col(k) for k in kinds])
    return wide.select("user_id", F.element_at(F.array(*[F.lit(k) for k in kinds]), F.array_position(means, F.array_max(means)).cast("int")).alias("dominant"))


@query("SELECT CASE WHEN value = 400 THEN 39 ELSE CAST(floor(value / 10.0) AS INTEGER) END AS bin, count(*) AS n FROM events WHERE value BETWEEN 0 AND 400 GROUP BY 1")
def hist1d(spark, d):
    return stats.histogram(read(spark, d, "events"), "value", 0.0, 400.0, 40)


@query("WITH b AS (SELECT CASE WHEN l_quantity = 50 THEN 9 ELSE CAST(floor(l_quantity / 5.0) AS INTEGER) END AS x_bin, CASE WHEN l_extendedprice = 100000 THEN 19 ELSE CAST(floor(l_extendedprice / 5000.0) AS INTEGER) END AS y_bin FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 AND l_extendedprice BETWEEN 0 AND 100000) SELECT x_bin, y_bin, count(*) AS n, count(*) / (sum(count(*)) OVER () * 25000.0) AS density FROM b GROUP BY 1, 2")
def hist2d(spark, d):
    return stats.histogram2(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice", (0.0, 50.0, 10), (0.0, 100000.0, 20))


@query("WITH c AS (SELECT CAST(floor(l_quantity / 5.0) AS INTEGER) AS x_bin, CAST(floor(l_extendedprice / 20000.0) AS INTEGER) AS y_bin, avg(l_discount) AS m FROM lineitem GROUP BY 1, 2), g AS (SELECT CAST(x AS INTEGER) AS x_bin, CAST(y AS INTEGER) AS y_bin FROM range(10) a(x), range(8) b(y)), j AS (SELECT g.x_bin, g.y_bin, m FROM g LEFT JOIN c USING (x_bin, y_bin)) SELECT x_bin, y_bin, coalesce(m, avg(m) OVER ()) AS mean FROM j")
def bin_mean_grid(spark, d):
    return stats.mean_grid(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "l_discount", (0.0, 50.0, 10), (0.0, 160000.0, 8))


@query(f"WITH {R} " + _by_column("count(DISTINCT coalesce(nullif(trim(CAST(@ AS VARCHAR)), ''), 'nan')) AS n_distinct", "r", ["zip", "event_type", "value"]))
def cardinality_filter_stats(spark, d):
    return colfilter.cardinality_table(readings(spark, d), ["zip", "event_type", "value"])


@query(_by_column("greatest(var_pop(@) / (max(@) - min(@)) ** 2, 0) AS variance", "lineitem", _LINE))
def norm_variance(spark, d):
    return colfilter.variance_table(read(spark, d, "lineitem"), _LINE)


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def column_filters(spark, d):
    """Cardinality first, then variance: constants and narrow columns go."""
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.lit(1.0).alias("constant"), F.when(F.col("l_orderkey") % 5000 == 0, 1.0).otherwise(0.0).alias("rare"))
    return colfilter.without_low_variance(colfilter.without_low_cardinality(li, 2), 0.01, ("l_orderkey", "l_linenumber", "l_extendedprice"))


@query(_by_column("var_samp(@) AS variance", "lineitem", _LINE))
def sample_variance(spark, d):
    return stats.melt(read(spark, d, "lineitem").agg(*[F.var_samp(c).alias(c) for c in _LINE]), _LINE).withColumnRenamed("value", "variance")


@query("WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_discount) AS b, corr(l_extendedprice, l_discount) AS c FROM lineitem), x AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM r) SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS \"column\", unnest([(1 - c * c) / det, (1 - b * b) / det, (1 - a * a) / det]) AS vif FROM x")
def variance_inflation(spark, d):
    return stats.variance_inflation(read(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


# -- metrics ---------------------------------------------------------------------

_P = "p AS (SELECT l_suppkey, l_extendedprice / 1000 AS y, l_quantity * 1.5 AS p FROM lineitem)"
_M = "sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, 1 - sum((y - p) * (y - p)) / (sum(y * y) - count(y) * avg(y) * avg(y) + 1e-10) AS r2, count(*) AS n"


def _predicted(spark, d):
    return read(spark, d, "lineitem").select("l_suppkey", (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.5).alias("p"))


@query(f"WITH {_P} SELECT {_M} FROM p")
def regression_metrics(spark, d):
    return metrics.regression(_predicted(spark, d), "y", "p")


@query(f"WITH {_P} SELECT l_suppkey, {_M} FROM p GROUP BY 1")
def grouped_metrics(spark, d):
    return metrics.regression(_predicted(spark, d), "y", "p", ["l_suppkey"])


@query(f"WITH {_P} SELECT avg(y - p) AS mean, stddev_pop(y - p) AS std, avg(CASE WHEN abs(y - p) <= 5 THEN 100.0 ELSE 0 END) AS within_5, avg(CASE WHEN abs(y - p) <= 10 THEN 100.0 ELSE 0 END) AS within_10 FROM p")
def residual_stats(spark, d):
    return metrics.residuals(_predicted(spark, d), "y", "p")


@query("WITH p AS (SELECT value AS y, (SELECT avg(value) FROM events WHERE event_id % 5 <> 0) AS p FROM events WHERE event_id % 5 = 0) " + f"SELECT {_M} FROM p")
def mean_baseline(spark, d):
    e = read(spark, d, "events")
    return metrics.mean_baseline(e.where("event_id % 5 <> 0"), e.where("event_id % 5 = 0"), "value")


@query("WITH a AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events WHERE event_id % 5 <> 0), b AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events WHERE event_id % 5 = 0) SELECT 'value' AS \"column\", a.m AS train_mean, a.s AS train_std, b.m AS other_mean, b.s AS other_std, (b.m - a.m) / (a.s + 1e-10) AS shift FROM a, b")
def shift_summary(spark, d):
    e = read(spark, d, "events")
    return metrics.shift(e.where("event_id % 5 <> 0"), e.where("event_id % 5 = 0"), ["value"])


@query("SELECT event_id, (value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events) AS value FROM events")
def zscore_pop(spark, d):
    e = read(spark, d, "events").select("event_id", "value")
    return metrics.zscores(e, e, ["value"])


@query("SELECT event_id, (value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events) AS scaled FROM events")
def minmax(spark, d):
    return metrics.minmax(read(spark, d, "events").select("event_id", "value"), "value", "scaled").select("event_id", "scaled")


@query("SELECT CASE WHEN value >= 35 THEN 1 ELSE 0 END AS label, CASE WHEN event_id % 100 < value THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM events GROUP BY 1, 2")
def confusion(spark, d):
    e = read(spark, d, "events").select(F.when(F.col("value") >= 35, 1).otherwise(0).alias("label"), F.when(F.col("event_id") % 100 < F.col("value"), 1).otherwise(0).alias("predicted"))
    return metrics.confusion(e, "label", "predicted")


@query("WITH e AS (SELECT CASE WHEN value >= 35 THEN 1 ELSE 0 END AS label, event_id % 97 + value AS score FROM events), k AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM e) SELECT (sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0) / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS auc FROM k")
def roc_auc(spark, d):
    e = read(spark, d, "events").select(F.when(F.col("value") >= 35, 1).otherwise(0).alias("label"), (F.col("event_id") % 97 + F.col("value")).alias("score"))
    return metrics.auc(e, "label", "score")

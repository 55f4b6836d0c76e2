"""Fixtures computed by hand, and properties that any data must keep."""

import math
import struct
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerostrata.functions import scalar as S
from aerostrata.operators import clean, colfilter, joins, metrics, ml, spatial, stats, windows


def one(spark, *columns, **values):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)], *[F.lit(v).alias(k) for k, v in values.items()]).first()


def test_positional_join(spark):
    a = spark.createDataFrame([("A", 1, 1, 29.7), ("A", 1, 2, 29.7), ("A", 2, 3, 29.7)], "zip string, t int, x int, latitude double")
    b = spark.createDataFrame([("A", 1, 10, 29.8), ("B", 1, 20, 29.9)], "zip string, t int, y int, latitude double")
    got = {(r.zip, r.t, r.x, r.y, r.latitude) for r in joins.positional_join(a, b, ["zip", "t"], ["x"], ["y"]).collect()}
    assert got == {("A", 1, 1, 10, 29.8), ("A", 1, 2, None, None), ("A", 2, 3, None, None), ("B", 1, None, 20, 29.9)}
    assert joins.positional_join(a, b, ["zip", "t"], ["x"], ["y"], "inner").count() == 1


def test_positional_join_counts(spark):
    a = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("x"))
    b = spark.range(300).select((F.col("id") % 11).alias("k"), F.col("id").alias("y"))
    na, nb = ({r.k: r["count"] for r in d.groupBy("k").count().collect()} for d in (a, b))
    assert joins.positional_join(a, b, ["k"], ["x"], ["y"]).count() == sum(max(na.get(k, 0), nb.get(k, 0)) for k in {*na, *nb})


def test_lags_and_rolling(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 7.0), ("A", 5, 9.0), ("B", 1, 1.0)], "zip string, t int, v double").repartition(3)
    got = sorted((r.zip, r.t, r.v_past_1, r.v_past_2) for r in windows.lags(df, ["v"], 2, "zip", ["t"]).collect())
    assert got == [("A", 1, None, None), ("A", 2, 5.0, None), ("A", 5, 7.0, 5.0), ("B", 1, None, None)]
    assert windows.lags(df, ["v"], 0, "zip", ["t"]).columns == df.columns
    assert [r.m for r in windows.rolling_mean(df, "v", 3, "zip", ["t"], "m").orderBy("zip", "t").collect()] == [None, None, 7.0, None]


def test_split_and_sequences(spark):
    df = spark.range(3 * 50).select((F.col("id") % 3).alias("zip"), F.expr("id div 3").alias("t"), F.col("id").cast("double").alias("v"))
    split = windows.time_split(df, 0.2, "zip", ["t"])
    assert split.where("is_train").count() == 3 * 40
    s = windows.sequences(df, ["v"], "v", 24, 1, "zip", ["t"])
    assert s.count() == 3 * (50 - 24)
    r = s.where("zip = 1").orderBy("t").first()
    assert r.t == 24 and r.target == 24 * 3 + 1 and r.sequence[0] == [1.0] and r.sequence[-1] == [23 * 3 + 1.0]
    assert windows.sequences(df.where("t < 24"), ["v"], "v", 24, 1, "zip", ["t"]).count() == 0


def test_statistics(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10)], "v double")
    r = df.agg(F.percentile("v", F.lit(0.95)).alias("q"), F.skewness("v").alias("g1"), stats.skewness_corrected("v").alias("G1"), F.kurtosis("v").alias("g2"), stats.kurtosis_corrected("v").alias("G2"), stats.normalized_variance("v").alias("nv")).first()
    assert [round(x, 6) for x in r] == pytest.approx([8.95, 1.018234, 1.763633, -0.7696, 3.228, 0.154321], abs=1e-4)
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    assert math.isnan(nan.agg(stats.normalized_variance("v")).first()[0])
    assert spark.range(3).select(F.lit(2.0).alias("v")).agg(stats.normalized_variance("v")).first()[0] == 0
    assert stats.iqr_outliers(df, ["v"], 1.5).first().outliers == 1


def test_spearman_ties_and_guards(spark):
    few = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    assert stats.spearman(few, "a", "b").first().rho == 0
    df = spark.range(200).select((F.col("id") % 10).cast("double").alias("a"), ((F.col("id") % 10) * 2.0).alias("b"))
    assert stats.spearman(df, "a", "b").first().rho == pytest.approx(1.0)
    ranks = [r.r_v for r in stats.average_ranks(spark.createDataFrame([(1.0, 1), (1.0, 1), (5.0, 1)], "v double, n int"), ["v"], "n").orderBy("r_v").collect()]
    assert ranks == [1.5, 1.5, 3.0]
    assert stats.t_tail(0.3, 50) == pytest.approx(0.034286, abs=1e-5)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 4.999, 5, -1, 6)], "v double")
    assert {r.bin: r.n for r in stats.histogram(df, "v", 0.0, 5.0, 5).collect()} == {0: 1, 1: 1, 4: 2}


def test_wind_and_facility(spark):
    places = spark.createDataFrame([("Z", -95.3698, 29.7604)], "zip string, lon double, lat double").select("zip", *[c.alias(n) for n, c in zip("xy", S.web_mercator(F.col("lon"), F.col("lat")))])
    p = places.first()
    assert (p.x, p.y) == pytest.approx((-10616517.573056, 3472788.527595), abs=1e-3)
    fx, fy = S.web_mercator(F.lit(-95.4), F.lit(29.74))
    f = spark.range(1).select(fx.alias("fx"), fy.alias("fy"))
    pair = joins.points_within(places, f, 10_000.0).first()
    assert (pair.dx, pair.dy, pair.dist) == pytest.approx((-3361.848622, -2615.670656, 4259.549171), abs=1e-3) and math.exp(-pair.dist / 10_000) == pytest.approx(0.653145787)
    pairs = F.array(F.struct((F.lit(3361.848622) / 4259.549171).alias("dir_x"), (F.lit(2615.670656) / 4259.549171).alias("dir_y"), F.lit(0.653145787).alias("decay"), F.lit(0.5).alias("severity")))
    wx, wy = S.wind_vector(F.lit(10.0), F.lit(45.0), F.lit(20.0), F.lit(90.0))
    r = one(spark, wx, wy, spatial.impact(pairs, wx, wy), spatial.impact(pairs, -wx, -wy), spatial.impact(F.lit(None).cast("array<struct<dir_x:double,dir_y:double,decay:double,severity:double>>"), wx, wy), spatial.impact(pairs, F.lit(None).cast("double"), wy))
    assert (r.c0, r.c1) == pytest.approx((2.121320344, 16.121320344)) and r.c2 == pytest.approx(3.779724028, abs=1e-6) and r.c3 == 0 and r.c4 == 0 and r.c5 is None


def test_distances(spark):
    at = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 3.0)], "zip int, x double, y double")
    pieces = spark.createDataFrame([(9, 0.0, 4.0, 10.0, 4.0), (8, 8.0, 7.0, 8.0, 7.0)], "road_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r.zip, r.road_id): r.dist for r in joins.nearest_on_lines(at, pieces, 5.0, ["zip"], "road_id").collect()}
    assert got == {(1, 9): 4.0, (2, 9): 1.0, (2, 8): 5.0}
    same = joins.points_within(at, at.select(F.col("x").alias("fx"), F.col("y").alias("fy")), 6.0)
    assert same.count() == 2  # a place is no neighbour of itself


def test_lines(spark):
    lines = spark.createDataFrame([(1, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], []]), (2, [[(5.0, 5.0), (6.0, 6.0)], [(7.0, 7.0), (8.0, 8.0)]])], "line_id int, parts array<array<struct<x:double,y:double>>>")
    parts = spatial.parts_of_lines(lines)
    assert sorted(r.road_id for r in parts.collect()) == [0, 1, 2] and spatial.segments(parts).count() == 4


def test_categories_and_cleaning(spark):
    rows = spark.createDataFrame([(x,) for x in (0.0, 50.0, 50.5, 500.0, 501.0)], "v double").select(S.aqi_cut(F.col("v")).alias("a"), S.aqi_chain(F.col("v")).alias("b")).collect()
    assert [r.a for r in rows] == [None, "Good (0-50)", "Moderate (51-100)", "Hazardous (301+)", None]
    assert [r.b for r in rows] == ["Good", "Good", "Moderate", "Hazardous", "Hazardous"]
    r = one(spark, S.zip5(F.lit("77002.0")), S.zip5(F.lit("7702")), S.zip5(F.lit(None)), S.number_or_zero(F.lit("1,234")), S.number_or_zero(F.lit("x")), S.strip_zone(F.lit("2026-03-05 12:34:56-06:00")), S.strip_zone(F.lit("bad")), S.wall_clock(F.lit("bad")), S.zip5(F.lit("770021")))
    assert list(r) == ["77002", "07702", None, 1234.0, 0.0, "2026-03-05 12:34:56", "bad", None, "770021"]
    w = S.request_weight(F.lit(11.0), F.lit(1))
    r = one(spark, w, S.safe_batch(w), *[S.search_radius(F.lit(d), c) for d in (5000, 1500, 500, 100) for c in (99999, 3000)])
    assert list(r) == pytest.approx([1.1, 490, 2000, 2000, 3500, 3000, 5500, 3000, 9000, 3000])
    d = lambda s: F.lit(s).cast("date")
    r = one(spark, S.window_prefix(d("2026-03-14"), d("2026-03-14")), S.window_prefix(d("2026-03-13"), d("2026-03-14")), S.window_prefix(d("2026-03-31"), d("2026-04-02")))
    assert list(r) == ["march_14", "march_13_14", "march_31_april_2"]
    parts = S.calendar(F.lit("2026-03-07 05:00:00").cast("timestamp_ntz"))
    assert list(one(spark, *parts.values())) == [3, 7, 5, 5, 66, 1]


def test_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, name string, v double")
    with pytest.raises(ValueError):
        clean.drop_columns(df, ["nope"])
    with pytest.raises(ValueError):
        clean.drop_columns(df, ["k"], keys=("k",))
    assert clean.drop_columns(df, ["nope", "v"], missing="ignore").columns == ["k", "name"]
    with pytest.raises(ValueError):
        clean.strict_union(df, df.select("name", "k", "v"))
    assert clean.find_column(["ZIP_code", "Lat"], ["lat"]) == "Lat" and clean.find_column(["ZIP_code"], ["zip"]) == "ZIP_code" and clean.find_column(["a"], ["b"]) is None
    wide = spark.createDataFrame([(1, 0, 0.1, 5.0), (2, 1, 0.2, 6.0), (3, 1, 0.3, 7.0)], "k int, flag int, hour_sin double, v double")
    groups = colfilter.feature_groups(wide, ["flag", "hour_sin", "v"])
    assert groups == {"cyclic": ["hour_sin"], "lag": [], "binary": ["flag"], "base": ["v"]}
    assert colfilter.without_low_cardinality(wide.withColumn("same", F.lit(1)), 2).columns == wide.columns
    assert colfilter.without_low_variance(wide, 0.2, ("k",)).columns == ["k", "flag"]
    assert colfilter.direction_columns(["wind_direction_10m", "wind_direction_10m_sin", "x"]) == ["wind_direction_10m"]
    assert colfilter.first_lags(["pm_past_10", "pm_past_2", "pm_past_1"], "pm", 2) == ["pm_past_1", "pm_past_2"]
    assert colfilter.output_order(["k", "a"], ["k", "a", "b"], ["k"], ["s"], ["b"]) == ["k", "a", "s"]
    z = metrics.zscores(wide, wide, ["v"]).agg(F.avg("v"), F.stddev_pop("v")).first()
    assert z[0] == pytest.approx(0) and z[1] == pytest.approx(1)
    shown = metrics.roc_points(spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, s double"), "y", "s").collect()
    assert {(r.tpr, r.fpr) for r in shown} == {(1.0, 0.0), (1.0, 1.0)}


def test_linear_penalties(spark):
    import numpy as np

    r = np.random.default_rng(0)
    x = r.standard_normal((300, 3)) * [1, 5, 0.3]
    y = x @ [2.0, -1.0, 3.0] + 1 + r.standard_normal(300)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc)
    assert ml.linear(df, ["a", "b", "c"], "y", 10.0).coefficients.toArray() == pytest.approx(want, rel=1e-6)
    w, n = np.zeros(3), len(y)
    for _ in range(5000):
        for j in range(3):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - 0.05 * 0.5, 0) / (xc[:, j] @ xc[:, j] / n + 0.05 * 0.5)
    assert ml.linear(df, ["a", "b", "c"], "y", 0.05, 0.5).coefficients.toArray() == pytest.approx(w, abs=1e-4)


def test_networks():
    import numpy as np

    r = np.random.default_rng(1)
    x = r.standard_normal((400, 2)) @ r.standard_normal((2, 6))
    net = ml.Autoencoder(6, 4)  # two leaky units for each direction of the data
    before = ((net.decode(net.encode(x)) - x) ** 2).mean()
    net.fit(x, epochs=60, rate=1e-2)
    assert ((net.decode(net.encode(x)) - x) ** 2).mean() < 0.2 * before
    s = r.standard_normal((300, 6, 1))
    y = s[:, -1, 0] * 0.5
    lstm = ml.Lstm(1, 8)
    grads, eps = lstm.gradients(s[:20], y[:20]), 1e-6
    for k in ("w", "v"):
        at = (1, 2) if k == "w" else (2,)
        lstm.p[k][at] += eps
        up = ((lstm.predict(s[:20]) - y[:20]) ** 2).mean()
        lstm.p[k][at] -= 2 * eps
        down = ((lstm.predict(s[:20]) - y[:20]) ** 2).mean()
        lstm.p[k][at] += eps
        assert (up - down) / (2 * eps) == pytest.approx(grads[k][at], rel=1e-3)
    lstm.fit(s[:240], y[:240], s[240:], y[240:], epochs=30, rate=1e-2)
    assert ((lstm.predict(s[240:]) - y[240:]) ** 2).mean() < 0.3 * (y**2).mean()


def _shape_file(parts):
    points = [p for part in parts for p in part]
    starts, at = [], 0
    for part in parts:
        starts.append(at)
        at += len(part)
    body = struct.pack("<i4d", 5, 0, 0, 1, 1) + struct.pack("<ii", len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in points)
    head = struct.pack(">i", 9994) + bytes(20) + struct.pack(">i", (100 + 8 + len(body)) // 2) + struct.pack("<ii", 1000, 5) + bytes(64)
    return head + struct.pack(">ii", 1, len(body) // 2) + body


def test_sources_and_sinks(spark, tmp_path):
    from aerostrata.sources import api, readers, schemas, sinks

    (tmp_path / "z").mkdir()
    ring = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]
    (tmp_path / "z" / "a.shp").write_bytes(_shape_file([ring]))
    (tmp_path / "z" / "a.dbf").write_bytes(struct.pack("<B3xIHH20x", 3, 1, 65, 6) + b"ZCTA5CE20".ljust(11, b"\0") + b"C" + bytes(4) + bytes([5, 0]) + bytes(14) + b"\r" + b" 77002")
    got = readers.shapes(spark, str(tmp_path / "z")).first()
    assert got.kind == "polygon" and [(p.x, p.y) for p in got.parts[0]] == ring
    assert readers.attributes(spark, str(tmp_path / "z")).first().attributes == {"ZCTA5CE20": "77002"}

    head = list(schemas.TRI_HEADERS.values())
    cell = dict.fromkeys(head, "") | {head[0]: "T1", head[3]: "Harris", head[4]: " TX", head[5]: "77002", head[8]: "é acid", head[9]: "YES", head[13]: "1,200"}
    (tmp_path / "tri.txt").write_bytes(("\t".join(head) + "\n" + "\t".join(cell[h] for h in head) + "\n").encode("latin-1"))
    r = readers.toxic_releases(spark, str(tmp_path / "tri.txt")).first()
    assert (r.trifd, r.chemical, r.total_air, r.latitude) == ("T1", "é acid", 1200.0, 0.0)

    place = tmp_path / "api"
    place.mkdir()
    (place / "77002.json").write_text('{"hourly": {"time": ["2026-03-01T00:00", "2026-03-01T01:00"], "pm10": [1, null]}}')
    spark.dataSource.register(api.HourlyReadings)
    df = spark.read.format("hourly_readings").options(url=f"file://{place}", start="2026-03-01", end="2026-03-01", variables="pm10", places='[["77002", 29.7, -95.3]]').load()
    assert [(r.zip, r.time, r.pm10) for r in df.collect()] == [("77002", datetime(2026, 3, 1, 0), 1.0), ("77002", datetime(2026, 3, 1, 1), None)]
    now = [0.0]
    limiter = api.WeightLimiter(10, 60, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(3):
        limiter.acquire(5)
    assert now[0] == 60
    assert list(api.pages(lambda at: {"Results": [{"n": at}], "Total": "3"}, 1)) == [{"n": 0}, {"n": 1}, {"n": 2}]

    meta = sinks.with_sidecar(spark.range(5), str(tmp_path / "out"), "test")
    assert meta["rows"] == 5 and readers.one_document(spark, str(tmp_path / "out.meta.json"), {})["columns"] == ["id"]
    assert readers.one_document(spark, str(tmp_path / "none"), {"a": 1}) == {"a": 1}
    sinks.table(spark.range(0), str(tmp_path / "empty"))
    assert readers.header_of(spark, str(tmp_path / "empty")) == ["id"]
    sinks.log_run(spark, str(tmp_path / "log"), script="collect", status="success")
    sinks.log_run(spark, str(tmp_path / "log"), script="collect", status="error")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    assert readers.places_asked("Houston,tx; Katy,TX") == [("houston", "TX"), ("katy", "TX")]
    with pytest.raises(ValueError):
        readers.places_asked("Houston")
    m, d = readers.file_day(F.lit("march_14_air_quality_hourly_1.csv"))
    assert list(one(spark, m, d)) == [3, 14]
    assert readers.classified_files(spark, ["a/march_1_air_quality_hourly.csv", "b_weather_x.csv", "c.csv"]).count() == 2


def test_partitioning_does_not_matter(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a, b = (sorted(map(str, windows.lags(x, ["value"], 2, "user_id", ["ts", "event_id"]).collect())) for x in (e, e.repartition(13)))
    assert a == b


def test_permutation_importance_takes_all_lines(spark, monkeypatch):
    from aerostrata.operators import ml
    from aerostrata.plans import QUERIES

    taken = []
    monkeypatch.setattr(ml, "permutation_importance", lambda df, *rest: taken.append(df))
    QUERIES["permutation_importance"](spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert taken[0].count() == lines.count()


def test_points_of_one_place_meet_once(spark, monkeypatch):
    """Ten rows of each of two places, five of each facility's: two distances are worked out, not 100; chunks and stated tasks give the same rows."""
    a = spark.range(20).select("id", (F.col("id") % 2).cast("double").alias("x"), F.lit(0.0).alias("y"))
    b = spark.range(10).select(F.col("id").alias("fid"), (F.col("id") % 2 + 0.25).alias("fx"), F.lit(0.0).alias("fy"))
    want = {(i, j) for i in range(20) for j in range(10) if abs(i % 2 - j % 2 - 0.25) <= 0.5}
    calls = spark.sparkContext.accumulator(0)

    def seen(x):
        calls.add(1)
        return x

    pairs = joins.points_within(a, b, 0.5, also={"same": F.udf(seen, "double")("dist")}).collect()
    assert {(r.id, r.fid) for r in pairs} == want and len(pairs) == 100 and all(r.same == r.dist == 0.25 for r in pairs) and calls.value == 2
    monkeypatch.setattr(joins, "CHUNK_ROWS", 3)
    monkeypatch.setattr(joins, "PRODUCT_OF_ONE", 10)
    dealt = joins.points_within(a, b, 0.5)
    assert sorted((r.id, r.fid) for r in dealt.collect()) == sorted(want) and dealt.rdd.getNumPartitions() > 1


def test_lines_of_pieces_meet_without_aggregation(spark, monkeypatch):
    import math as m

    points = spark.range(30).select(F.col("id").alias("zip"), (F.col("id") % 5 * 1.5).alias("x"), (F.col("id") % 3 * 0.7).alias("y"))
    pieces = [(k, float(k + i), i * 0.3, k + i + 1.0, (i + 1) * 0.3) for k in range(3) for i in range(4)] + [(3, 1.5, 0.7, 1.5, 0.7), (4, None, 0.0, 1.0, 1.0)]
    lines = spark.createDataFrame(pieces, "road_id int, x1 double, y1 double, x2 double, y2 double")

    def far(x, y, x1, y1, x2, y2):
        vx, vy = x2 - x1, y2 - y1
        t = min(1.0, max(0.0, ((x - x1) * vx + (y - y1) * vy) / (vx * vx + vy * vy))) if vx or vy else 0.0
        return m.hypot(x1 + t * vx - x, y1 + t * vy - y)

    want = {}
    for p in points.collect():
        for k, *at in pieces:
            d = None if at[0] is None else far(p.x, p.y, *at)
            if d and 1e-12 < d <= 1.0:
                want[p.zip, k] = min(d, want.get((p.zip, k), 9.0))
    for rows in (joins.CHUNK_ROWS, 7):
        monkeypatch.setattr(joins, "CHUNK_ROWS", rows)
        near = joins.nearest_on_lines(points, lines, 1.0, ["zip"], "road_id")
        got = {(r.zip, r.road_id): r.dist for r in near.where("dist > 1e-12").collect()}
        assert got == pytest.approx(want)
        assert "partial_min" not in near._jdf.queryExecution().toString()


def test_weighted_quantile(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 37 % 101).cast("double").alias("v"), (F.col("id") % 4).alias("w"))
    each = df.select("v", F.explode(F.sequence(F.lit(1), F.greatest("w", F.lit(1)))).alias("i"), "w").where("w > 0")
    for band in (stats.BAND, 5):
        monkeypatch.setattr(stats, "BAND", band)
        for q in (0.0, 0.3, 0.95, 1.0):
            assert stats.weighted_quantile(df, "v", "w", q) == pytest.approx(each.agg(F.percentile("v", F.lit(q))).first()[0])
    assert stats.weighted_quantile(df.where("w < 0"), "v", "w", 0.5) is None


def test_impact_scores_are_sums_over_pairs(spark):
    places = spark.range(60).select(F.col("id").alias("zip"), (F.col("id") % 7 * 0.3).alias("x"), (F.col("id") % 5 * 0.2).alias("y"))
    facilities = spark.range(40).select(F.col("id").alias("fid"), (F.col("id") % 4 * 0.5).alias("fx"), (F.col("id") % 3 * 0.4).alias("fy"), (F.col("id") % 9 * 1.0).alias("amount"), (F.col("id") % 5).alias("n_chemicals"))
    wx, wy = F.when(F.col("zip") != 3, F.col("zip") % 3 - 1.0), F.col("zip") % 2 * 1.0
    lists = spatial.as_lists(spatial.facility_pairs(places, facilities, 0.6), "zip")
    want = {r.zip: r.s for r in places.join(lists, "zip", "left").select("zip", spatial.impact(F.col("pairs"), wx, wy).alias("s")).collect()}
    found = spatial.impact_scores(places, facilities, 0.6, "zip", wx, wy)
    assert {r.zip: r.score for r in found.collect()} == pytest.approx(want) and want[3] is None
    assert "collect_list(struct(dir_x" not in found._jdf.queryExecution().toString()


def test_permutation_importance_needs_no_join(spark, monkeypatch):
    """One group: both columns move along their rings; no values are joined back."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 7 * 1.0).alias("a"), (F.col("id") % 3 * 1.0).alias("b"), F.lit(0.0).alias("y"))
    predict = lambda d: d.withColumn("prediction", F.col("a") * F.col("b"))
    want = {}
    for f, other in (("a", "b"), ("b", "a")):
        for r in range(2):
            rows = df.withColumn("o", F.xxhash64("k", F.lit(f), F.lit(r))).orderBy("o", "k").collect()
            moved = [rows[i - 1][f] for i in range(50)]
            rise = sum((m * x[other]) ** 2 - (x.a * x.b) ** 2 for m, x in zip(moved, rows)) / 50
            want.setdefault(f, []).append(rise)

    def joined(*_, **__):
        raise AssertionError("joined")

    monkeypatch.setattr(Frame, "join", joined)
    got = {r.feature: r["mean"] for r in ml.permutation_importance(df, predict, ["a", "b"], "y", "k", 2).collect()}
    assert got == pytest.approx({f: sum(v) / 2 for f, v in want.items()})


def test_time_join_deals_out_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "PACK_ROWS", 4, raising=False)
    monkeypatch.setattr(joins, "PRODUCT_OF_ONE", 10, raising=False)
    a = spark.range(40).select(F.when(F.col("id") < 30, 1).when(F.col("id") < 38, 2).alias("t"), (F.col("id") % 5).alias("v"), F.col("id").alias("l"))
    b = spark.range(30).select(F.when(F.col("id") < 20, 1).otherwise(3).alias("t"), (F.col("id") % 3).alias("v"))
    out = joins.suffixed_join(a, b, ["t"])
    assert out.columns == ["t", "v_x", "l", "v_y"]
    got = out.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.t, r.v_x, r.l, r.v_y) for r in got) == sorted((1, x % 5, x, y % 3) for x in range(30) for y in range(20))
    assert len({r.task for r in got}) > 2  # one key's rows are not in one task


def test_nearest_in_tiles():
    """Far from the origin, with equal rows and few rows: the same as all distances at once, in memory of tiles."""
    import tracemalloc

    import numpy as np

    r = np.random.default_rng(3)
    x = np.repeat(r.standard_normal((700, 8)) + 1e5, 3, 0)
    keys, q, k = r.permutation(len(x)), x[::7] + 0.0, 10
    d, n = np.full((len(q), k), np.nan), np.full((len(q), k), np.iinfo(np.int64).max)
    for i in range(0, len(x), 500):
        ml._merge(d, n, q, keys[i : i + 500], x[i : i + 500])
    for j, one in enumerate(q):
        far = np.sqrt(((x - one) ** 2).sum(1))
        order = np.lexsort((keys, far))[:k]
        assert (n[j] == keys[order]).all() and (d[j] == far[order]).all()
    few, nf = np.full((2, k), np.nan), np.full((2, k), np.iinfo(np.int64).max)
    ml._merge(few, nf, q[:2], keys[:3], np.array([x[0], x[3], x[0] * np.nan]))
    assert np.isfinite(few).sum() == 4 and (nf < np.iinfo(np.int64).max).sum() == 6
    many, dm, nm = np.tile(q, (14, 1))[:4096], np.full((4096, k), np.nan), np.full((4096, k), np.iinfo(np.int64).max)
    tracemalloc.start()
    ml._merge(dm, nm, many, keys[:1024], x[:1024])
    assert tracemalloc.get_traced_memory()[1] < 20e6
    tracemalloc.stop()


def test_late_means_reads_many_files_in_one_batch(spark, tmp_path):
    from aerostrata.plans import QUERIES, storage

    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.repartition(4, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    made, real = [], storage.scratch
    storage.scratch = lambda s: made.append(real(s)) or made[-1]
    try:
        out = QUERIES["late_means"](spark, str(tmp_path))
    finally:
        storage.scratch = real
    assert sorted(out.agg(F.sum("n")).first()) == [e.count()]
    assert len(spark.read.parquet(made[0]).inputFiles()) == 4

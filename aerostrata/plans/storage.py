"""Queries that write through the sinks and read back through the sources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean, colfilter, spatial, stats
from ..sources import api, readers, schemas, sinks
from ..streaming import ingest
from .catalog import query, read, scratch

_EVENTS = "event_id bigint, user_id bigint, event_type string, value double"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, user_id, event_type, value FROM events")
def csv_table(spark, d):
    """A whole text table and back, its schema held against its header."""
    path = scratch(spark)
    sinks.table(_events(spark, d), path)
    return readers.delimited(spark, path, _EVENTS)


@query("SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, event_type, value FROM events")
def csv_inferred(spark, d):
    """The same with types found in the text."""
    path = scratch(spark)
    sinks.table(_events(spark, d), path)
    return readers.delimited(spark, path).select(F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", "value")


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders")
def csv_short_rows(spark, d):
    """Lines that lack their last cell."""
    path, o = scratch(spark), read(spark, d, "orders")
    cells = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")))
    spark.createDataFrame([("o_orderkey,o_custkey,o_orderstatus",)], "value string").coalesce(1).write.text(f"{path}/header")
    o.select(cells.alias("value")).write.text(f"{path}/rows")
    return spark.read.schema("o_orderkey bigint, o_custkey bigint, o_orderstatus string").option("mode", "PERMISSIVE").csv(f"{path}/rows")


@query("SELECT * FROM (VALUES ('o_custkey', 0), ('o_orderkey', 1), ('o_totalprice', 2), ('o_orderstatus', 3), ('n_lines', 4)) v(name, place)")
def computed_header(spark, d):
    """A merged table's columns in their stated order, written and found again in the header."""
    path, o = scratch(spark), read(spark, d, "orders")
    lines = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    both = o.select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus").join(lines, "o_orderkey")
    order = colfilter.output_order(["o_orderkey", "o_totalprice", "o_custkey"], ["o_orderkey", "o_custkey", "o_orderstatus"], ["o_custkey", "o_orderkey"], ["n_lines"])
    sinks.table(both, path, order)
    return spark.createDataFrame([(n, i) for i, n in enumerate(readers.header_of(spark, path))], "name string, place int")


@query("SELECT name, 0 AS rows_read FROM (VALUES ('event_id'), ('user_id'), ('event_type'), ('value')) v(name)")
def header_only(spark, d):
    """A table without rows is a header alone."""
    path = scratch(spark)
    sinks.table(_events(spark, d).where("event_id < 0"), path)
    n = readers.text_columns(spark, path).count()
    return spark.createDataFrame([(c, n) for c in readers.header_of(spark, path)], "name string, rows_read int")


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def appended_batches(spark, d):
    """Batches appended one after another, clustered by place."""
    path, e = scratch(spark), read(spark, d, "events")
    for i in range(3):
        sinks.append(e.where(F.pmod("event_id", F.lit(3)) == i), path, ["user_id"])
    return spark.read.parquet(path).groupBy(F.to_date("ts").cast("string").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


_TRI_SQL = """r AS (SELECT 'F' || s_suppkey AS trifd, s_name AS facility, CASE WHEN s_nationkey % 2 = 0 THEN 'Harris' ELSE ' fort bend' END AS county, CASE WHEN s_nationkey % 5 = 4 THEN 'LA' ELSE ' TX ' END AS state, lpad(CAST(s_suppkey AS VARCHAR), 5, '7') AS zip, 29.0 + s_suppkey % 7 AS latitude, -95.0 - s_suppkey % 5 AS longitude, 'Säure ' || l_linenumber AS chemical, CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE 'NO' END AS carcinogen, CASE WHEN l_linestatus = 'O' THEN 'YES' ELSE 'NO' END AS hap, CASE WHEN l_orderkey % 11 = 0 THEN 0.0 ELSE l_quantity END AS amount, CASE WHEN l_orderkey % 2 = 0 THEN '2023' ELSE '2024' END AS reporting_year FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
t AS (SELECT * FROM r WHERE trim(state) = 'TX')"""


def _releases(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Two years' inventories as text files under their odd headers, read back."""
    li, s = read(spark, d, "lineitem"), read(spark, d, "supplier")
    raw = li.join(s, li["l_suppkey"] == s["s_suppkey"])
    even, key = F.col("s_nationkey") % 2 == 0, F.col("s_suppkey")
    amount = F.when(F.col("l_orderkey") % 11 == 0, "none").otherwise(F.col("l_quantity").cast("string"))
    cells = {
        "trifd": F.concat(F.lit("F"), key.cast("string")), "facility": F.col("s_name"), "city": F.lit("X"), "county": F.when(even, "Harris").otherwise(" fort bend"),
        "state": F.when(F.col("s_nationkey") % 5 == 4, "LA").otherwise(" TX "), "zip": F.lpad(key.cast("string"), 5, "7"), "latitude": 29.0 + key % 7, "longitude": -95.0 - key % 5,
        "chemical": F.concat(F.lit("Säure "), F.col("l_linenumber").cast("string")), "carcinogen": F.when(F.col("l_returnflag") == "R", "YES").otherwise("NO"), "hap": F.when(F.col("l_linestatus") == "O", "YES").otherwise("NO"),
        "fugitive_lbs": amount, "stack_lbs": amount, "total_air": amount,
    }
    path, out = scratch(spark), {}
    for year, rest in (("2023", 0), ("2024", 1)):
        part = raw.where(F.pmod("l_orderkey", F.lit(2)) == rest).select(*[c.cast("string").alias(k) for k, c in cells.items()], F.lit("-").alias("unused"))
        part = part.toDF(*schemas.TRI_HEADERS.values(), "1. UNUSED")
        part.write.option("header", True).option("sep", "\t").option("encoding", "ISO-8859-1").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{year}")
        out[year] = readers.toxic_releases(spark, f"{path}/{year}")
    return out


@query(f"WITH {_TRI_SQL} SELECT trifd, facility, 'X' AS city, county, zip, latitude, longitude, sum(amount) AS total_air_emissions_lbs, array_to_string(list_sort(list(DISTINCT chemical))[1:10], '; ') AS chemicals, max(carcinogen) AS has_carcinogen, max(hap) AS has_hap, reporting_year FROM t GROUP BY ALL")
def toxic_facilities(spark, d):
    """The inventory's facilities by year."""
    return readers.yearly({y: readers.toxic_facilities(r) for y, r in _releases(spark, d).items()})


@query(f"WITH {_TRI_SQL} SELECT trifd, zip, chemical, amount AS total_air_emissions_lbs, reporting_year FROM t WHERE amount > 0")
def toxic_chemicals(spark, d):
    """All releases that amount to something, repeated rows too."""
    return readers.yearly({y: readers.toxic_chemicals(r) for y, r in _releases(spark, d).items()}).select("trifd", "zip", "chemical", "total_air_emissions_lbs", "reporting_year")


@query("SELECT s_suppkey AS trifd, coalesce(CASE WHEN s_suppkey % 4 = 0 THEN s_acctbal END, total, 0.0) AS amount, coalesce(n, 0)::DOUBLE AS chemical_count FROM supplier LEFT JOIN (SELECT l_suppkey, sum(l_quantity) AS total, count(DISTINCT l_linenumber) AS n FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY 1) ON s_suppkey = l_suppkey WHERE s_suppkey % 7 <> 0")
def facility_amounts(spark, d):
    """Chemicals' totals and counts joined to facilities; some have amounts of their own, some no place."""
    s, key = read(spark, d, "supplier"), F.col("s_suppkey")
    own = s.select(key.alias("trifd"), F.when(key % 7 != 0, "29.5").otherwise("").alias("latitude"), F.lit("-95.0").alias("longitude"), F.when(key % 4 == 0, F.col("s_acctbal").cast("string")).otherwise("n/a").alias("own"))
    chemicals = read(spark, d, "lineitem").where("l_suppkey % 3 <> 0").select(F.col("l_suppkey").alias("trifd"), F.col("l_linenumber").alias("chemical"), F.col("l_quantity").cast("string").alias("total_air_emissions_lbs"))
    return readers.enriched_facilities(own, chemicals, own="own").select("trifd", "amount", "chemical_count")


def _polygons() -> bytes:
    """A shape file of five records: squares of sides 1 to 3 with a hole in the third, a null shape, a line."""
    import struct

    def record(number: int, kind: int, parts: list) -> bytes:
        if kind == 0:
            body = struct.pack("<i", 0)
        else:
            flat = [p for part in parts for p in part]
            starts = [sum(len(x) for x in parts[:i]) for i in range(len(parts))]
            body = struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(parts), len(flat)) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in flat)
        return struct.pack(">ii", number, len(body) // 2) + body

    square = lambda a, x: [(x, 0.0), (x, a), (x + a, a), (x + a, 0.0), (x, 0.0)]
    hole = [(20.5, 0.5), (21.0, 0.5), (21.0, 1.0), (20.5, 1.0), (20.5, 0.5)]
    records = record(1, 5, [square(1.0, 0.0)]) + record(2, 5, [square(2.0, 10.0)]) + record(3, 5, [square(3.0, 20.0), hole]) + record(4, 0, []) + record(5, 3, [[(0.0, 0.0), (3.0, 4.0)], [(9.0, 9.0), (9.0, 10.0)]])
    return struct.pack(">i", 9994) + bytes(20) + struct.pack(">i", (100 + len(records)) // 2) + bytes(72) + records


@query("SELECT s_suppkey, CAST(1 + s_suppkey % 3 AS INTEGER) AS record, CASE s_suppkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 4.0 ELSE 8.75 END AS area FROM supplier")
def shape_areas(spark, d):
    """Polygons of a shape file, written as a table for the places in use, with their areas."""
    path, out = scratch(spark), scratch(spark)
    sinks.raw(spark, f"{path}/zcta.shp", _polygons())
    found = readers.shapes(spark, path).where("kind = 'polygon'").withColumn("zip", F.col("record"))
    places = read(spark, d, "supplier").select("s_suppkey", (1 + F.col("s_suppkey") % 3).cast("int").alias("zip"))
    sinks.shapes(found, places, out)
    area = F.abs(F.aggregate(F.transform("parts", spatial.ring_area), F.lit(0.0), lambda a, x: a + x))
    return places.join(spark.read.parquet(out).select("zip", "record", area.alias("area")), "zip").select("s_suppkey", "record", "area")


@query("SELECT * FROM (VALUES (0, 0, 3.0, 4.0), (1, 1, 9.0, 10.0)) v(road_id, part, x, y)")
def shape_lines(spark, d):
    """A line of several parts as one road each, numbered densely; null shapes are gone."""
    path = scratch(spark)
    sinks.raw(spark, f"{path}/roads.shp", _polygons())
    parts = readers.shapes(spark, path).where("kind = 'line'").select("record", F.posexplode("parts").alias("part", "points")).where(F.size("points") > 0)
    roads = clean.numbered_batches(parts, ["record", "part"], 1).withColumnRenamed("batch", "road_id")
    return roads.select("road_id", "part", F.element_at("points", -1)["x"].alias("x"), F.element_at("points", -1)["y"].alias("y"))


@query("SELECT n_nationkey AS zip, CAST(count(s_suppkey) AS BIGINT) AS n_edges, sum(s_acctbal) AS road_len_m_2000 FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def road_lengths(spark, d):
    """Street networks, a document for each place, and their lengths; places without one have null."""
    s = read(spark, d, "supplier")
    edge = F.struct(F.col("s_suppkey").alias("source"), (F.col("s_suppkey") + 1).alias("target"), F.col("s_acctbal").alias("length"))
    docs = s.groupBy(F.col("s_nationkey").alias("zip")).agg(F.to_json(F.struct(F.collect_list(edge).alias("links"))).alias("value"))
    edges, places = readers.street_edges(docs), read(spark, d, "nation").select(F.col("n_nationkey").alias("zip"))
    n = edges.groupBy("zip").agg(F.count(F.lit(1)).alias("n_edges"))
    return readers.road_density(edges, 2000, places).join(n, "zip", "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0).cast("long")))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN '2026-03-' || lpad(CAST(n_nationkey % 28 + 1 AS VARCHAR), 2, '0') END AS last_ingested_date FROM nation WHERE n_nationkey < 6")
def state_documents(spark, d):
    """State documents: whole ones are read, damaged and missing ones are the default."""
    out = []
    for r in read(spark, d, "nation").where("n_nationkey < 6").select("n_nationkey").collect():
        path, k = scratch(spark), r.n_nationkey
        if k % 3 == 0:
            sinks.document(spark, {"last_ingested_date": f"2026-03-{k % 28 + 1:02d}"}, path)
        elif k % 3 == 1:
            sinks.raw(spark, f"{path}/part-0.txt", b'{"last_ingested')
        out.append((k, readers.one_document(spark, path, {"last_ingested_date": None})["last_ingested_date"]))
    return spark.createDataFrame(out, "n_nationkey int, last_ingested_date string")


@query("SELECT n_name AS script, '2026-03-0' || (1 + i) AS start_date, '2026-03-0' || (2 + i) AS end_date FROM nation, range(3) t(i) WHERE NOT (n_nationkey = 1 AND i = 0) AND NOT (n_nationkey = 2 AND i = 1)")
def windows_to_fetch(spark, d):
    """Windows without a logged success of just that script and window; failures and other windows do not count."""
    path = scratch(spark)
    names = {r.n_nationkey: r.n_name for r in read(spark, d, "nation").collect()}
    for k, i, status in ((1, 0, "success"), (2, 1, "success"), (2, 2, "error"), (3, 5, "success")):
        sinks.log_run(spark, path, script=names[k], status=status, parameters={"start_date": f"2026-03-0{1 + i}", "end_date": f"2026-03-0{2 + i}", "batch": "50"})
    asked = read(spark, d, "nation").select(F.col("n_name").alias("script"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    day = lambda n: F.concat(F.lit("2026-03-0"), (F.col("i") + n).cast("string"))
    asked = asked.select("script", day(1).alias("start_date"), day(2).alias("end_date"))
    return ingest.missing_windows(asked, readers.run_log(spark, path))


@query("SELECT status, count(*) AS n, sum(rows) AS row_count FROM (VALUES ('success', 10), ('success', 20), ('error', NULL)) v(status, rows) GROUP BY 1")
def run_log(spark, d):
    """Runs appended to the log and read back, their outputs' rows added up."""
    path = scratch(spark)
    for status, rows in (("success", 10), ("success", 20), ("error", None)):
        out = {"type": "air", "file": "x", "row_count": rows, "size_bytes": 1, "variable_count": 1, "variables": ["a"], "api_url": "", "batch_size_used": 50}
        sinks.log_run(spark, path, script="collect", status=status, outputs=[out] if rows else None, duration_seconds=1.5)
    log = readers.run_log(spark, path).select("status", F.explode_outer("outputs").alias("o"))
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("o.row_count").alias("row_count"))


def _daily_files(spark: SparkSession, d: str) -> str:
    """Daily files of two kinds, written out of order, and one of neither."""
    path, e = scratch(spark), _events(spark, d)
    for day, rest in (("march_14", 1), ("february_28", 0)):
        for kind, name in (("view", "air_quality"), ("click", "weather")):
            rows = e.where((F.pmod("event_id", F.lit(2)) == rest) & (F.col("event_type") == kind))
            text = rows.select(F.concat_ws(",", "event_id", "user_id", "event_type", F.col("value").cast("string")).alias("line")).collect()  # a fixture's file
            sinks.raw(spark, f"{path}/{day}_{name}_hourly.csv", "\n".join(["event_id,user_id,event_type,value", *(r.line for r in text)]).encode())
    sinks.raw(spark, f"{path}/notes.csv", b"a,b\n1,2\n")
    return path


@query("SELECT * FROM (VALUES ('february_28_air_quality_hourly.csv', 'air_quality', 2, 28), ('february_28_weather_hourly.csv', 'weather', 2, 28), ('march_14_air_quality_hourly.csv', 'air_quality', 3, 14), ('march_14_weather_hourly.csv', 'weather', 3, 14)) v(name, kind, month, day)")
def daily_files(spark, d):
    """A folder's daily files by kind and day."""
    month, day = readers.file_day(F.col("name"))
    return readers.classified_files(spark, _daily_files(spark, d)).select("name", "kind", month.alias("month"), day.alias("day"))


@query("SELECT event_id, user_id, value, CASE WHEN event_id % 2 = 1 THEN 3 ELSE 2 END AS month, CASE WHEN event_id % 2 = 1 THEN 14 ELSE 28 END AS day, row_number() OVER (ORDER BY event_id % 2, event_id) AS place FROM events WHERE event_type = 'view'")
def master_table(spark, d):
    """Daily files of one kind under one header, in the order of their days whatever that of arrival."""
    from pyspark.sql import Window

    rows = readers.merged_files(spark, readers.classified_files(spark, _daily_files(spark, d)), "air_quality", _EVENTS)
    # the fixture's order of rows is its event ids'
    return rows.select("event_id", "user_id", "value", "month", "day", F.row_number().over(Window.orderBy("month", "day", "event_id")).alias("place"))


@query("SELECT (SELECT count(*) FROM orders) AS rows_noted, (SELECT count(*) FROM orders) AS rows_read, 'o_orderkey,o_custkey' AS columns")
def sidecar(spark, d):
    """A table with its sidecar document, both read back."""
    path = scratch(spark)
    sinks.with_sidecar(read(spark, d, "orders").select("o_orderkey", "o_custkey"), path, "orders")
    meta = readers.one_document(spark, f"{path}.meta.json", {})
    return spark.createDataFrame([(meta["rows"], spark.read.parquet(path).count(), ",".join(meta["columns"]))], "rows_noted long, rows_read long, columns string")


@query("SELECT 'p_size' AS \"column\", count(DISTINCT p_size) AS n_distinct, round(var_pop(p_size) / (max(p_size) - min(p_size)) ** 2, 9) AS variance FROM part UNION ALL SELECT 'p_retailprice', count(DISTINCT CAST(p_retailprice AS VARCHAR)), round(var_pop(p_retailprice) / (max(p_retailprice) - min(p_retailprice)) ** 2, 9) FROM part")
def build_report(spark, d):
    """The report of a feature build, written as a document and read back."""
    path, p = scratch(spark), read(spark, d, "part").select("p_size", "p_retailprice")
    sinks.report(spark, path, colfilter.variance_table(p, p.columns), colfilter.cardinality_table(p), rows=p.count())
    doc = readers.one_document(spark, path, {})
    distinct = {r["column"]: r["n_distinct"] for r in doc["cardinality"]}
    return spark.createDataFrame([(r["column"], distinct[r["column"]], round(r["variance"], 9)) for r in doc["variance"]], "column string, n_distinct long, variance double")


@query("SELECT l_orderkey, l_linenumber, l_quantity, 3.0 * l_quantity + 2.0 AS prediction FROM lineitem")
def stored_model(spark, d):
    """A fitted model's artifact, loaded and applied (to data it fits exactly)."""
    from pyspark.ml.regression import LinearRegressionModel

    from ..operators import ml

    path, li = scratch(spark), read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    sinks.model(ml.linear(li.withColumn("y", F.col("l_quantity") * 3.0 + 2.0), ["l_quantity"], "y"), path)
    return LinearRegressionModel.load(path).transform(ml.assembled(li, ["l_quantity"])).select("l_orderkey", "l_linenumber", "l_quantity", F.round("prediction", 6).alias("prediction"))


@query("SELECT * FROM (VALUES ('b1', 2, 0.0), ('b2', 3, 0.0), ('w1', 6, 15.0), ('w2', 6, 15.0)) v(name, n, total)")
def stored_network(spark, d):
    """A numpy network's parameters as a table and back."""
    import numpy as np

    from ..operators import ml

    path, net = scratch(spark), ml.Autoencoder(3, 2)
    net.p["w1"], net.p["w2"] = np.arange(6.0).reshape(3, 2), np.arange(6.0).reshape(2, 3)
    sinks.network(spark, net.p, path)
    back = sinks.stored_network(spark, path)
    assert all(back[k].shape == v.shape for k, v in net.p.items())
    return spark.createDataFrame([(k, int(v.size), float(v.sum())) for k, v in back.items()], "name string, n int, total double")


@query("SELECT n_nationkey, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, TIMESTAMP '2026-03-01 00:00:00' + to_hours(CAST(i AS INTEGER)) AS time, CASE WHEN i = 1 THEN NULL ELSE n_nationkey + i * 0.5 END AS pm10 FROM nation, range(3) t(i)")
def hourly_source(spark, d):
    """The hourly readings' source over a folder of answers, a partition for each batch of places."""
    path = scratch(spark)
    nations = [r.n_nationkey for r in read(spark, d, "nation").select("n_nationkey").collect()]
    for k in nations:
        hourly = {"time": [f"2026-03-01T0{i}:00" for i in range(3)], "pm10": [None if i == 1 else k + i * 0.5 for i in range(3)]}
        sinks.raw(spark, f"{path}/{k:05d}.json", json.dumps({"hourly": hourly}).encode())
    spark.dataSource.register(api.HourlyReadings)
    options = {"url": _as_url(path), "start": "2026-03-01", "end": "2026-03-01", "variables": "pm10", "places": json.dumps([[f"{k:05d}", 29.0, -95.0] for k in nations]), "batch": "10"}
    got = spark.read.format("hourly_readings").options(**options).load()
    return got.select(F.col("zip").cast("int").alias("n_nationkey"), "zip", "time", "pm10")


def _as_url(path: str) -> str:
    return "file://" + path.removeprefix("file://").removeprefix("file:")


@query("SELECT * FROM (VALUES ('R0', 'A', 'AIR,TRIS'), ('R1', 'B', 'AIR'), ('R2', 'C', 'AIR'), ('R3', 'D', 'TRIS')) v(\"RegistryId\", \"FacilityName\", matched_program)")
def registry_pages(spark, d):
    """A registry read page by page for each program; facilities found twice are one row with both programs; a program without pages is skipped."""
    path = scratch(spark)
    found = {"AIR": [("R0", "A"), ("R1", "B"), ("R2", "C")], "TRIS": [("R3", "D"), ("R0", "A2")]}
    for program, rows in found.items():
        for first in range(1, len(rows) + 1, 2):
            page = {"Results": {"TotalQueryResults": str(len(rows)), "FRSFacility": [{"RegistryId": r, "FacilityName": n} for r, n in rows[first - 1 : first + 1]]}}
            sinks.raw(spark, f"{path}/77001_{program}_{first}.json", json.dumps(page).encode())
    spark.dataSource.register(api.FacilityPages)
    programs = ["AIR", "EIS", "TRIS"]
    rows = spark.read.format("facility_pages").options(url=_as_url(path), zips='["77001"]', programs=json.dumps(programs), columns="RegistryId,FacilityName", count="2").load()
    place = F.array_position(F.array(*[F.lit(p) for p in programs]), F.col("matched_program"))
    return readers.registry(rows.withColumn("seq", F.struct(place.alias("program"), "number")).drop("number")).select("RegistryId", "FacilityName", "matched_program")


@query("SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS zip, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL")
def late_means(spark, d):
    """Hourly counts of a stream under a watermark that no reading is later than."""
    source, out, mark = scratch(spark), scratch(spark), scratch(spark)
    e = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), S.zip5(F.col("user_id")).alias("zip"), "value")
    # files that as many tasks can read; one batch takes them all, so none is late
    e.write.option("maxRecordsPerFile", 1 << 20).parquet(source)
    stream = ingest.files(spark, source, "event_id bigint, ts timestamp, zip string, value double", per_trigger=(1 << 31) - 1)
    means = ingest.late_hourly_means(stream, "ts", "value", "zip", "5 days").select("zip", F.col("window.start").alias("hour"), F.col("n"))
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    means.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(out).groupBy("zip", "hour").agg(F.max_by("n", "batch").alias("n"))
    return rows.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("SELECT \"column\", n_rows, mean FROM (SELECT 'value' AS \"column\", count(*) AS n_rows, avg(value) AS mean FROM events)")
def union_of_metadata(spark, d):
    """Figures of two halves' sidecars put together."""
    rows = []
    for i in range(2):
        path, half = scratch(spark), read(spark, d, "events").where(F.pmod("event_id", F.lit(2)) == i)
        meta = sinks.with_sidecar(half.select("value"), path, f"half {i}")
        rows.append((meta["columns"][0], meta["rows"], stats.describe(spark.read.parquet(path), ["value"]).first()["mean"]))
    halves = spark.createDataFrame(rows, "column string, n long, mean double")
    return halves.groupBy("column").agg(F.sum("n").alias("n_rows"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"))

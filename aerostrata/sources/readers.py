"""Readers: delimited text, JSON documents, shapes, file lists."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import number_or_zero
from ..operators.stats import any_yes, joined_distinct, joined_in_order
from . import schemas

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def delimited(spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A text table with a header; a given schema is held against the header, short rows get nulls."""
    r = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
    return r.option("enforceSchema", False).schema(schema).csv(path) if schema else r.option("inferSchema", True).csv(path)


def text_columns(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A text table with all columns as text."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    return text_columns(spark, path).limit(0).columns


def toxic_releases(spark: SparkSession, path: str, state: str = "TX", counties: tuple[str, ...] = schemas.HOUSTON_COUNTIES) -> DataFrame:
    """The yearly inventory (tab separated, Latin-1): wanted columns, rows of one state and some counties, amounts as numbers."""
    raw = text_columns(spark, path, "\t", "ISO-8859-1")
    picked = raw.select(*[F.col(f"`{h}`").alias(n) for n, h in schemas.TRI_HEADERS.items()])
    here = (F.trim("state") == state) & F.coalesce(F.upper("county").rlike("|".join(counties)), F.lit(False))
    return picked.where(here).withColumns({c: number_or_zero(F.col(c)) for c in ("latitude", "longitude", "fugitive_lbs", "stack_lbs", "total_air")})


def toxic_facilities(releases: DataFrame) -> DataFrame:
    """One row a facility: summed emissions, first ten chemicals, flags; the largest first."""
    ids = ["trifd", "facility", "city", "county", "zip", "latitude", "longitude"]
    known = releases.na.drop(subset=ids)
    out = known.groupBy(*ids).agg(F.sum("total_air").alias("total_air_emissions_lbs"), joined_distinct("chemical", 10, "; ").alias("chemicals"), any_yes("carcinogen").alias("has_carcinogen"), any_yes("hap").alias("has_hap"))
    return out.orderBy(F.desc("total_air_emissions_lbs"))


def population_rows(documents: DataFrame, column: str = "value", prefix: str = "77") -> DataFrame:
    """ZCTA population from arrays of arrays whose first is the header; numbers that do not parse drop their row."""
    rows = documents.select(F.from_json(column, "array<array<string>>").alias("a"))
    header = F.col("a")[0]
    place = lambda name: F.array_position(header, name).cast("int")
    out = rows.select(place("B01003_001E").alias("p"), F.size(header).alias("z"), F.explode(F.slice("a", 2, F.greatest(F.size("a") - 1, F.lit(0)))).alias("r"))
    out = out.select(F.element_at("r", F.col("z")).alias("zip"), F.element_at("r", F.col("p")).try_cast("int").alias("population"))
    return out.where(F.col("zip").startswith(prefix) & F.col("population").isNotNull())


def map_elements(documents: DataFrame, column: str = "value") -> DataFrame:
    """Buildings and amenities from map elements: a way's place is its centre, missing tags are ''."""
    e = documents.select(F.explode(F.from_json(F.get_json_object(column, "$.elements"), schemas.OVERPASS)).alias("e")).select("e.*")
    tag = lambda k: F.coalesce(F.col("tags")[k], F.lit(""))
    at = lambda k: F.when(F.col("type") == "node", F.col(k)).otherwise(F.col(f"center.{k}"))
    named = {"name": "name", "housenumber": "addr:housenumber", "street": "addr:street", "city": "addr:city", "postcode": "addr:postcode", "building_tag": "building", "amenity_tag": "amenity"}
    return e.select(F.col("id").alias("osm_id"), F.col("type").alias("osm_type"), *[tag(k).alias(n) for n, k in named.items()], at("lat").alias("lat"), at("lon").alias("lon"))


def yearly(parts: dict[str, DataFrame]) -> DataFrame:
    """The tables of some years under one another, with reporting_year; nothing is dropped."""
    out = None
    for year, df in sorted(parts.items()):
        df = df.withColumn("reporting_year", F.lit(year))
        out = df if out is None else out.unionByName(df)
    return out


def toxic_chemicals(releases: DataFrame) -> DataFrame:
    """The releases that amount to something, a row each."""
    cols = ["trifd", "facility", "zip", "latitude", "longitude", "chemical", "carcinogen", "hap", "fugitive_lbs", "stack_lbs"]
    return releases.where("total_air > 0").select(*cols, F.col("total_air").alias("total_air_emissions_lbs"))


def enriched_facilities(facilities: DataFrame, chemicals: DataFrame, key: str = "trifd", amount: str = "total_air_emissions_lbs", own: str | None = None) -> DataFrame:
    """Facilities with amount (their own where they have one, else their chemicals' sum) and chemical_count, 0 where there is none; rows without a place go."""
    sums = chemicals.groupBy(key).agg(F.sum(F.coalesce(F.col(amount).try_cast("double"), F.lit(0.0))).alias("_sum"), F.countDistinct("chemical").cast("double").alias("_count"))
    known = facilities.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")}).na.drop(subset=["latitude", "longitude"])
    joined = known.join(sums, key, "left")
    first = F.col(own).try_cast("double") if own else F.lit(None).cast("double")
    return joined.withColumns({"amount": F.coalesce(first, "_sum", F.lit(0.0)), "chemical_count": F.coalesce("_count", F.lit(0.0))}).drop("_sum", "_count")


def street_edges(documents: DataFrame, zip_code: str = "zip", column: str = "value") -> DataFrame:
    """Edges of street networks, a document for each place, as node-link graphs: zip, u, v, length."""
    links = F.from_json(F.get_json_object(column, "$.links"), "array<struct<source:bigint,target:bigint,length:double>>")
    return documents.select(F.col(zip_code).alias("zip"), F.explode(links).alias("e")).select("zip", F.col("e.source").alias("u"), F.col("e.target").alias("v"), "e.length")


def road_density(edges: DataFrame, radius: int, places: DataFrame | None = None) -> DataFrame:
    """Length of all streets about each place; null for places without a network."""
    out = edges.groupBy("zip").agg(F.sum("length").alias(f"road_len_m_{radius}"))
    return places.select("zip").distinct().join(out, "zip", "left") if places is not None else out


def registry(rows: DataFrame, order: str = "seq") -> DataFrame:
    """One row for each RegistryId: its first row, with all programs that found it in the order of finding them."""
    others = [c for c in rows.columns if c not in ("RegistryId", "matched_program", order)]
    programs = joined_in_order("matched_program", order, ",").alias("matched_program")
    return rows.groupBy("RegistryId").agg(F.min_by(F.struct(*others), order).alias("_first"), programs).select("RegistryId", "_first.*", "matched_program")


def listed(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Paths of a folder's files, in any store that Spark reads; contents are not read."""
    try:
        rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path").collect()
    except AnalysisException:  # no such folder
        return []
    return sorted(r.path for r in rows)


def merged_files(spark: SparkSession, files: DataFrame, kind: str, schema: str) -> DataFrame:
    """All rows of one kind's daily files under one header (another one raises), with month and day of the file's name and seq, so that the order of arrival is no matter."""
    paths = [r.path for r in files.where(F.col("kind") == kind).select("path").collect()]
    wanted = spark.createDataFrame([], schema).columns
    for p in paths:
        got = header_of(spark, p)
        if got and got != wanted:
            raise ValueError(f"{p}: the header is {got}, not {wanted}")
    if not paths:
        return spark.createDataFrame([], f"{schema}, month int, day int, seq bigint")
    rows = delimited(spark, paths, schema)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    month, day = file_day(name)
    return rows.select("*", month.alias("month"), day.alias("day"), F.monotonically_increasing_id().alias("seq"))


def classified_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Daily files by kind: air or weather, by name; of a list of paths or of a folder."""
    paths = listed(spark, paths) if isinstance(paths, str) else paths
    files = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("name", F.element_at(F.split("path", "/"), -1))
    kind = F.when(F.col("name").contains("_air_quality_"), "air_quality").when(F.col("name").contains("_weather_"), "weather")
    return files.withColumn("kind", kind).where(F.col("kind").isNotNull() & F.col("name").endswith(".csv"))


def file_day(name: Column) -> tuple[Column, Column]:
    """Month and day that a file's name begins with (march_14_...)."""
    parts = F.split(F.lower(name), "_")
    month = F.array_position(F.array(*[F.substring(F.lit(m), 1, 3) for m in MONTHS]), F.substring(parts[0], 1, 3)).cast("int")
    return F.nullif(month, F.lit(0)), F.regexp_extract(parts[1], r"^(\d+)", 1).try_cast("int")


def one_document(spark: SparkSession, path: str, default: dict) -> dict:
    """A small JSON document (a run's state); the default where there is none or it is damaged."""
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))
    except Exception:  # noqa: BLE001  no file and bad JSON mean the same here
        return dict(default)


def run_log(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """The log of runs as sinks.log_run writes it, or (json) a list of documents or one alone, damaged ones dropped; empty where there is none."""
    read = spark.read.schema(schemas.RUN_LOG)
    try:
        return read.option("multiLine", True).option("mode", "DROPMALFORMED").json(path) if kind == "json" else read.parquet(path)
    except AnalysisException:  # no such path
        return spark.createDataFrame([], schemas.RUN_LOG)


def places_asked(text: str) -> list[tuple[str, str]]:
    """'Houston,TX;Katy,TX' as pairs; anything else raises."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(";"))):
        pair = [x.strip() for x in part.split(",")]
        if len(pair) != 2 or not all(pair):
            raise ValueError(f"not a 'city,state' pair: {part!r}")
        out.append((pair[0].lower(), pair[1].upper()))
    if not out:
        raise ValueError("no place asked for")
    return out


def parse_shapes(raw: bytes) -> Iterator[tuple[int, str, list[list[tuple[float, float]]]]]:
    """Records of a .shp file: number, kind, parts of points (nothing for null shapes)."""
    if len(raw) < 100 or struct.unpack(">i", raw[:4])[0] != 9994:
        raise ValueError("not a shape file")
    at = 100
    while at + 8 <= len(raw):
        number, words = struct.unpack(">ii", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        kind = struct.unpack("<i", body[:4])[0]
        if kind in (1, 11, 21):
            yield number, "point", [[struct.unpack("<dd", body[4:20])]]
        elif kind in (3, 5, 13, 15, 23, 25):
            n_parts, n_points = struct.unpack("<ii", body[36:44])
            starts = [*struct.unpack(f"<{n_parts}i", body[44 : 44 + 4 * n_parts]), n_points]
            flat = struct.unpack(f"<{2 * n_points}d", body[44 + 4 * n_parts : 44 + 4 * n_parts + 16 * n_points])
            points = list(zip(flat[0::2], flat[1::2]))
            yield number, "line" if kind in (3, 13, 23) else "polygon", [points[a:b] for a, b in zip(starts, starts[1:])]


def parse_attributes(raw: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    """Records of a .dbf file as text."""
    n, header, size = struct.unpack("<IHH", raw[4:12])
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode("ascii"), raw[at + 16]))
        at += 32
    out = []
    for i in range(n):
        row, at = {}, header + i * size + 1
        for name, width in fields:
            row[name] = raw[at : at + width].decode(encoding, "replace").strip()
            at += width
        out.append(row)
    return out


_SHAPE = "path string, record int, kind string, parts array<array<struct<x:double,y:double>>>"


def shapes(spark: SparkSession, path: str) -> DataFrame:
    """Shapes of .shp files in any store that Spark reads: one row a record."""

    def rows(batches):
        for pdf in batches:
            got = [(p, n, k, [[{"x": x, "y": y} for x, y in part] for part in parts]) for p, raw in zip(pdf["path"], pdf["content"]) for n, k, parts in parse_shapes(raw)]
            yield pd.DataFrame(got, columns=["path", "record", "kind", "parts"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path).select("path", "content").mapInPandas(rows, _SHAPE)


def attributes(spark: SparkSession, path: str) -> DataFrame:
    """Attributes of .dbf files: record and a map of text."""

    def rows(batches):
        for pdf in batches:
            got = [(p, i + 1, row) for p, raw in zip(pdf["path"], pdf["content"]) for i, row in enumerate(parse_attributes(raw))]
            yield pd.DataFrame(got, columns=["path", "record", "attributes"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.dbf").load(path).select("path", "content").mapInPandas(rows, "path string, record int, attributes map<string,string>")



"""Impact of facilities and roads downwind of a place, in projected metres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import nearest_on_lines, points_within, small
from .stats import weighted_quantile


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring of (x, y) by the shoelace rule."""
    n = F.size(ring)
    step = lambda i: ring[i]["x"] * ring[i + 1]["y"] - ring[i + 1]["x"] * ring[i]["y"]
    return F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda a, i: a + step(i)) / 2


def ring_moment(ring: Column, axis: str) -> Column:
    n = F.size(ring)
    step = lambda i: (ring[i][axis] + ring[i + 1][axis]) * (ring[i]["x"] * ring[i + 1]["y"] - ring[i + 1]["x"] * ring[i]["y"])
    return F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda a, i: a + step(i)) / 6


def centroids(rings: DataFrame, key: str) -> DataFrame:
    """Centroid (x, y) of each polygon from its rings; is_hole rings are taken off."""
    sign = F.when(F.col("is_hole"), -1.0).otherwise(1.0)
    parts = rings.select(key, (F.abs(ring_area(F.col("ring"))) * sign).alias("a"), *[(ring_moment(F.col("ring"), k) * F.signum(ring_area(F.col("ring"))) * sign).alias(f"m{k}") for k in "xy"])
    return parts.groupBy(key).agg(F.try_divide(F.sum("mx"), F.sum("a")).alias("x"), F.try_divide(F.sum("my"), F.sum("a")).alias("y"))


def parts_of_lines(lines: DataFrame) -> DataFrame:
    """Parts of multi-part lines (column parts, an array of arrays of points), empty ones dropped, numbered in order of id and part."""
    from pyspark.sql import Window

    flat = lines.select("line_id", F.posexplode("parts").alias("part", "points")).where(F.size("points") > 1)
    chunk = Window.partitionBy().orderBy("line_id")
    before = flat.groupBy("line_id").agg(F.count(F.lit(1)).alias("n")).withColumn("first", F.sum("n").over(chunk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    inside = Window.partitionBy("line_id").orderBy("part")
    return flat.join(before, "line_id").select((F.col("first") + F.row_number().over(inside) - 1).alias("road_id"), "points")


def segments(lines: DataFrame, key: str = "road_id") -> DataFrame:
    """Pieces (x1, y1, x2, y2) of lines of points."""
    at = F.explode(F.sequence(F.lit(0), F.size("points") - 2)).alias("i")
    return lines.select(key, "points", at).select(key, F.col("points")[F.col("i")]["x"].alias("x1"), F.col("points")[F.col("i")]["y"].alias("y1"), F.col("points")[F.col("i") + 1]["x"].alias("x2"), F.col("points")[F.col("i") + 1]["y"].alias("y2"))


def _severity(q: Column, chemicals: Column) -> Column:
    """0.7 of the amount over its 95th percentile among pairs, 0.3 of chemicals over their most."""
    clip = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
    return clip(F.col("amount") / q) * 0.7 + clip(F.col("n_chemicals") / chemicals) * 0.3


def severities(places: DataFrame, facilities: DataFrame, radius: float) -> DataFrame:
    """Facilities within radius of a place, with their severity.

    Pairs are only counted, for each place of facilities: how many there are of a
    facility is its weight in the percentile.
    """
    where = places.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n_pairs"))
    met = points_within(where, facilities.select("fx", "fy").distinct(), radius).groupBy("fx", "fy").agg(F.sum("n_pairs").alias("n_pairs"))
    near = facilities.join(small(met), ["fx", "fy"]).persist()  # read again for each figure
    q = weighted_quantile(near, "amount", "n_pairs", 0.95)
    most = near.agg(F.max("amount").alias("a"), F.max("n_chemicals").alias("c")).select(F.greatest("a", F.lit(1.0)).alias("a"), F.greatest("c", F.lit(1.0)).alias("c")).first()  # one row
    q = q if q is not None and q > 0 else most.a
    return near.withColumn("severity", _severity(F.lit(q), F.lit(most.c)))


def facility_pairs(places: DataFrame, facilities: DataFrame, radius: float) -> DataFrame:
    """Pairs within radius with unit direction, decay and severity."""
    also = {"decay": F.exp(-F.col("dist") / radius), "dir_x": F.col("dx") / F.col("dist"), "dir_y": F.col("dy") / F.col("dist")}
    return points_within(places, severities(places, facilities, radius).drop("n_pairs"), radius, also=also)


def impact_scores(places: DataFrame, facilities: DataFrame, radius: float, key: str, wx: Column, wy: Column) -> DataFrame:
    """(key, score): impact() of each place's facilities without its list of pairs, in a sum; wind follows from places' columns.

    Facilities at the same place have the same direction and decay, so their
    severities are added up first and a place meets each such place once.
    """
    spots = severities(places, facilities, radius).groupBy("fx", "fy").agg(F.sum("severity").alias("severity"))
    asked = places.select(key, "x", "y", wx.alias("_wx"), wy.alias("_wy"))
    pairs = points_within(asked, spots, radius, also={"_decay": F.exp(-F.col("dist") / radius), "_ux": F.col("dx") / F.col("dist"), "_uy": F.col("dy") / F.col("dist")})
    wind = F.when(F.col("_wx").isNotNull() & F.col("_wy").isNotNull(), F.greatest(F.col("_wx") * F.col("_ux") + F.col("_wy") * F.col("_uy"), F.lit(0.0)))
    terms = pairs.select(key, (F.col("severity") * F.col("_decay") * wind).alias("_term"), F.lit(0).alias("_rows"))
    each = places.select(key, F.lit(0.0).alias("_term"), F.lit(1).alias("_rows")).unionByName(terms).groupBy(key)
    summed = each.agg((F.sum("_term") * F.sum("_rows")).alias("score"), F.count_if(F.col("_term").isNull()).alias("_calm"))
    return summed.select(key, F.when(F.col("_calm") == 0, F.col("score")).alias("score"))


def road_pairs(places: DataFrame, pieces: DataFrame, radius: float, key: str) -> DataFrame:
    near = nearest_on_lines(places, pieces, radius, [key, "x", "y"], "road_id")
    return near.select(key, ((F.col("px") - F.col("x")) / F.col("dist")).alias("dir_x"), ((F.col("py") - F.col("y")) / F.col("dist")).alias("dir_y"), F.exp(-F.col("dist") / radius).alias("decay"), F.lit(1.0).alias("severity"))


def as_lists(pairs: DataFrame, key: str, name: str = "pairs") -> DataFrame:
    """The pairs of each place as one array: as many as sources within the radius."""
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dir_x", "dir_y", "decay", "severity"))).alias(name))


def impact(pairs: Column, wx: Column, wy: Column) -> Column:
    """Sum over sources of severity, decay and the wind's part along the direction; upwind counts nothing.

    A place without sources has 0, whatever the wind; else missing wind gives null.
    """
    one = lambda acc, p: acc + p["severity"] * p["decay"] * F.greatest(wx * p["dir_x"] + wy * p["dir_y"], F.lit(0.0))
    return F.when(pairs.isNull(), 0.0).when(wx.isNull() | wy.isNull(), None).otherwise(F.aggregate(pairs, F.lit(0.0), one))

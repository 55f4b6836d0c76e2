"""Column expressions: cleaning, calendar, directions, categories, tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0
# Upper ends of the index's bands and the names given to them in
# the banded report, the row-wise report and the five-band chart.
AQI_BANDS = ((50, "Good (0-50)"), (100, "Moderate (51-100)"), (150, "Unhealthy SG (101-150)"), (200, "Unhealthy (151-200)"), (300, "Very Unhealthy (201-300)"), (500, "Hazardous (301+)"))
AQI_CHAIN = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"), (200, "Unhealthy"), (300, "Very Unhealthy"), (None, "Hazardous"))
AQI_FIVE = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy"), (200, "Very Unhealthy"), (300, "Hazardous"))
# Groups of hours.
HOUR_GROUPS = ((5, "Night(0-5)"), (11, "Morning(6-11)"), (17, "Afternoon(12-17)"), (23, "Evening(18-23)"))


def number_or_zero(c: Column) -> Column:
    """Text with thousands separators as a double; what does not parse is 0, the text NaN stays NaN."""
    return F.coalesce(F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("double"), F.lit(0.0))


def number_or_null(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def zip5(c: Column) -> Column:
    """A ZIP code's five digits: text after a '.' goes, zeros are put before; longer ones stay as they are."""
    head = F.split(F.trim(c.cast("string")), r"\.")[0]
    return F.when(head == "", None).when(F.length(head) >= 5, head).otherwise(F.lpad(head, 5, "0"))


def five_digits(c: Column) -> Column:
    """The first run of five digits, null without one."""
    return F.nullif(F.regexp_extract(c, r"(\d{5})", 1), F.lit(""))


def strip_zone(c: Column) -> Column:
    """Cut text of the shape 'YYYY-MM-DD hh:mm:ss...' after its seconds; other text stays."""
    t = F.trim(c)
    return F.when(t.rlike(r"^.{4}-.{2}-.{2} .{2}:.{2}:.{2}"), F.substring(t, 1, 19)).otherwise(c)


def wall_clock(c: Column) -> Column:
    """A timestamp without zone from text with or without an offset; null if it is none."""
    t = F.regexp_replace(F.regexp_replace(F.trim(c), r"([+-]\d{2}:\d{2}|Z)$", ""), "T", " ")
    return F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar parts; day_of_week is 0 on Monday."""
    dow = F.weekday(ts)
    return {"month": F.month(ts), "day": F.day(ts), "hour": F.hour(ts), "day_of_week": dow, "day_of_year": F.dayofyear(ts), "is_weekend": (dow >= 5).cast("int")}


def cyclic(name: str, c: Column, period: int) -> dict[str, Column]:
    turn = F.lit(2.0) * F.pi() * c / period
    return {f"{name}_sin": F.sin(turn), f"{name}_cos": F.cos(turn)}


def direction(name: str, degrees: Column) -> dict[str, Column]:
    return {f"{name}_sin": F.sin(F.radians(degrees)), f"{name}_cos": F.cos(F.radians(degrees))}


def wind_vector(s10: Column, d10: Column, s100: Column, d100: Column, mode: str = "blend", share: float = 0.7) -> tuple[Column, Column]:
    """x (cosine) and y (sine) of the 10 m and 100 m winds, weighted; a missing part makes both null."""
    high = {"10m": 0.0, "100m": 1.0, "blend": share}[mode]
    mix = lambda f: s10 * f(F.radians(d10)) * (1.0 - high) + s100 * f(F.radians(d100)) * high
    return mix(F.cos), mix(F.sin)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * EARTH_RADIUS_M, F.log(F.tan(F.pi() / 4 + F.radians(lat) / 2)) * EARTH_RADIUS_M


def aqi_cut(c: Column, bands: tuple = AQI_BANDS) -> Column:
    """Right-closed bands above 0; 0 and less, and more than the last end, are null."""
    out = F.when(c <= 0, None)
    for end, name in bands:
        out = out.when(c <= end, name)
    return out


def aqi_chain(c: Column) -> Column:
    """The first band whose end is not exceeded, else the last; null stays null."""
    out = F.when(c.isNull(), None)
    for end, name in AQI_CHAIN[:-1]:
        out = out.when(c <= end, name)
    return out.otherwise(AQI_CHAIN[-1][1])


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring").when(month.isin(6, 7, 8), "Summer").otherwise("Fall")


def hour_group(hour: Column) -> Column:
    out = F.when(hour.isNull(), None)
    for end, name in HOUR_GROUPS:
        out = out.when(hour <= end, name)
    return out


def area_km2(lat: Column, lon: Column) -> Column:
    """Rough area of a ZIP code: the farther north or west, the larger (fixed values)."""
    return F.when((lat > 30.05) | (lon < -95.60), 80.0).when((lat > 29.90) | (lon < -95.45), 40.0).otherwise(15.0)


def search_radius(density: Column, cap: int) -> Column:
    """Metres to search around a place: less, the denser it is (fixed values)."""
    return F.least(F.when(density > 4000, 2000).when(density > 1000, 3500).when(density > 300, 5500).otherwise(9000), F.lit(cap))


def request_weight(n_variables: Column, n_days: Column) -> Column:
    """Weight of one place's request: tens of variables, by weeks where they are more than one."""
    return F.greatest(n_variables / 10, n_variables / 10 * n_days / 7)


def safe_batch(weight: Column, limit: int = 600, share: float = 0.9) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(float(limit)) / weight * share).cast("int"))


def window_prefix(first: Column, last: Column) -> Column:
    """A file prefix from a window of days: march_14, march_13_14 or march_31_april_2."""
    name = lambda d: F.lower(F.date_format(d, "MMMM"))
    day = lambda d: F.day(d).cast("string")
    one = F.concat_ws("_", name(first), day(first))
    same = F.concat_ws("_", name(first), day(first), day(last))
    return F.when(first == last, one).when(F.month(first) == F.month(last), same).otherwise(F.concat_ws("_", name(first), day(first), name(last), day(last)))


def verdict(score: Column, low_variance: Column) -> Column:
    """Names and limits are fixed values."""
    return F.when(low_variance, "USELESS (near-zero variance)").when(score >= 0.40, "IMPORTANT").when(score >= 0.15, "MARGINAL").otherwise("USELESS")


def consensus(correlation: Column, forest: Column, permutation: Column, variance: Column, low_variance: Column) -> Column:
    """Weighted sum of four normalised importances (fixed weights), a tenth of it where variance is low."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    total = zero(correlation) * 0.25 + zero(forest) * 0.30 + zero(permutation) * 0.35 + zero(variance) * 0.10
    return F.when(low_variance, total * 0.1).otherwise(total)

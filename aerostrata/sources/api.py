"""Hourly readings from a paged web source as a Spark data source.

``spark.dataSource.register(HourlyReadings)`` then ``spark.read.format("hourly_readings")``
with options: url (``file://`` folders serve as fixtures), fallback_url, start, end,
variables, places (JSON list of [zip, latitude, longitude]), batch.  A partition
is one batch of places; its client keeps to its share (clients, as many as read at
a time) of a weight a minute, waits longer after each refusal, and turns to the
fallback address when it is not let in.  Times are wall clock times of the place.

``FacilityPages`` (``facility_pages``) reads a registry page by page, a partition
for each ZIP code and program; ``file://`` folders of ``<zip>_<program>_<first>.json``
serve as fixtures.  A page that is refused ends its list.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from datetime import date, datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class WeightLimiter:
    """Lets requests through while their weights within the last span stay within a limit."""

    def __init__(self, limit: float = 600, span: float = 60, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.limit, self.span, self.clock, self.sleep = limit, span, clock, sleep
        self.past: deque[tuple[float, float]] = deque()

    def acquire(self, weight: float) -> None:
        while True:
            now = self.clock()
            while self.past and now - self.past[0][0] >= self.span:
                self.past.popleft()
            if not self.past or sum(w for _, w in self.past) + weight <= self.limit:
                self.past.append((now, weight))
                return
            self.sleep(self.past[0][0] + self.span - now)


def fetch(url: str, tries: int = 5, first_wait: float = 1.0, sleep: Callable[[float], None] = time.sleep, opener=urllib.request.urlopen) -> dict | list:
    """A JSON document; refusals (406, 429) and server errors are tried again after doubled waits."""
    for k in range(tries):
        try:
            with opener(url) as got:
                return json.loads(got.read())
        except urllib.error.HTTPError as e:
            if e.code in (401, 403) or k == tries - 1 or (e.code < 500 and e.code not in (406, 429)):
                raise
            sleep(first_wait * 2**k)
    raise RuntimeError("no tries")


def _within(page: dict, path: str):
    for name in path.split("."):
        page = (page or {}).get(name)
    return page


def pages(get: Callable[[int], dict], size: int, rows: str = "Results", total: str = "Total", first: int = 0) -> Iterator[dict]:
    """Rows of all pages, each asked for by its first row's number; rows and total are paths in a page."""
    at, n = first, 0
    while True:
        page = get(at)
        found = _within(page, rows) or []
        yield from found
        at, n = at + size, n + len(found)
        if not found or n >= int(_within(page, total) or 0):
            return


class _Batch(InputPartition):
    def __init__(self, places):
        self.places = places


class _Reader(DataSourceReader):
    def __init__(self, options: dict, variables: list[str]):
        self.options, self.variables = dict(options), variables

    def partitions(self):
        places, size = json.loads(self.options["places"]), int(self.options.get("batch", 50))
        return [_Batch(places[i : i + size]) for i in range(0, len(places), size)] or [_Batch([])]

    def read(self, partition):
        if not partition.places:
            return
        limiter = WeightLimiter(float(self.options.get("limit", 600)) / int(self.options.get("clients", 1)), float(self.options.get("span", 60)))
        days = (date.fromisoformat(self.options["end"]) - date.fromisoformat(self.options["start"])).days + 1
        each = max(len(self.variables) / 10, len(self.variables) / 10 * days / 7)
        limiter.acquire(each * len(partition.places))
        ask = {"latitude": ",".join(str(p[1]) for p in partition.places), "longitude": ",".join(str(p[2]) for p in partition.places), "start_date": self.options["start"], "end_date": self.options["end"], "hourly": ",".join(self.variables)}
        try:
            got = self._get(self.options["url"], ask, partition)
        except urllib.error.HTTPError as e:
            if e.code not in (401, 403) or "fallback_url" not in self.options:
                raise
            got = self._get(self.options["fallback_url"], ask, partition)
        for place, answer in zip(partition.places, got if isinstance(got, list) else [got]):
            hourly = answer["hourly"]
            for i, at in enumerate(hourly["time"]):
                yield (place[0], float(place[1]), float(place[2]), datetime.fromisoformat(at).replace(tzinfo=None), *[None if hourly[v][i] is None else float(hourly[v][i]) for v in self.variables])

    @staticmethod
    def _get(url, ask, partition):
        if url.startswith("file://"):
            return [fetch(f"{url.rstrip('/')}/{p[0]}.json") for p in partition.places]
        return fetch(f"{url}?{urllib.parse.urlencode(ask)}")


class HourlyReadings(DataSource):
    @classmethod
    def name(cls):
        return "hourly_readings"

    def _variables(self):
        return [v.strip() for v in self.options["variables"].split(",")]

    def schema(self):
        return "zip string, latitude double, longitude double, time timestamp_ntz, " + ", ".join(f"{v} double" for v in self._variables())

    def reader(self, schema):
        return _Reader(self.options, self._variables())


class _Facilities(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = dict(options), columns

    def partitions(self):
        return [_Batch((z, p)) for z in json.loads(self.options["zips"]) for p in json.loads(self.options["programs"])]

    def read(self, partition):
        (zip_code, program), size = partition.places, int(self.options.get("count", 100))

        def get(first: int) -> dict:
            url = self.options["url"].rstrip("/")
            if url.startswith("file://"):
                return fetch(f"{url}/{zip_code}_{program}_{first}.json")
            return fetch(f"{url}?{urllib.parse.urlencode({'zip_code': zip_code, 'pgm_sys_acrnm': program, 'output': 'JSON', 'start_record': first, 'count': size})}")

        number = 0
        try:
            for row in pages(get, size, "Results.FRSFacility", "Results.TotalQueryResults", 1):
                yield (zip_code, program, number, *[None if row.get(c) is None else str(row[c]) for c in self.columns])
                number += 1
        except urllib.error.URLError:  # a program that is refused or has no pages
            return


class FacilityPages(DataSource):
    """zip, matched_program, number (of the row in its list) and the columns asked for, as text."""

    @classmethod
    def name(cls):
        return "facility_pages"

    def _columns(self):
        return [c.strip() for c in self.options["columns"].split(",")]

    def schema(self):
        return "zip string, matched_program string, number int, " + ", ".join(f"{c} string" for c in self._columns())

    def reader(self, schema):
        return _Facilities(self.options, self._columns())

"""Benchmark decontamination, with DataFrame and SQL functions only.

Which documents hold at least ``threshold`` of a test item's distinct word
shingles (containment, so the document may be any number of times longer)?

* Words are runs of letters and digits in lower case; a shingle is ``width``
  consecutive words.  A text of fewer words is one shingle of all its words.
* Test items are partitioned by size (number of distinct shingles, by powers of
  two).  Each partition fixes the length of its items' bottom-m MinHash
  sketches: m is over (1 - threshold) of the partition's largest size, so that
  an item contained at the threshold cannot miss all of its sketch, and must in
  fact hit at least ``m - floor((1 - threshold) * n)`` of it.  The search thus
  loses nothing; it prunes.
* The long side is never sketched (its minima say nothing of a short item
  inside it): its shingle hashes are streamed past the sketches.
* Candidates are verified by the exact shingles, as text, of the two sides.

The sketches are broadcast where there are at most ``BROADCAST_ROWS`` of them,
counted beforehand; beyond that the join shuffles.

Defined results: null and empty texts hold no shingle and match nothing; each
row of a repeated document or item id is judged by itself; null ids match as
ids do; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, unstage

WIDTH = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 200_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(width: int, cut) -> Column:
    """cut(first, length) of each shingle of the column words."""
    n = F.size("words")
    full = F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: cut(i, F.lit(width)))
    return F.when(n >= width, full).when(n > 0, F.array(cut(F.lit(1), n)))


def _hashes(width: int) -> Column:
    return _shingles(width, lambda i, m: F.xxhash64(F.slice("words", i, m)))


def _texts(width: int) -> Column:
    return F.array_distinct(_shingles(width, lambda i, m: F.array_join(F.slice("words", i, m), " ")))


def _bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def sketches(items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each hash of each item's sketch: item_key, size_class, n, need (hits a containing document has), h."""
    held = items.select("item_key", F.array_distinct(_hashes(width)).alias("hs")).where("hs is not null").withColumn("n", F.size("hs"))
    held = held.withColumn("size_class", F.floor(F.log2("n")).cast("int"))
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1
    # 1e-9: (1 - 0.8) * 5 counts as 1
    m = (2 * F.floor((1 - threshold) * largest + 1e-9) + 4).cast("int")
    sketch = F.slice(F.array_sort("hs"), F.lit(1), m)
    held = held.withColumn("sketch", sketch)
    held = held.withColumn("need", F.greatest(F.lit(1), F.size("sketch") - F.floor((1 - threshold) * F.col("n") + 1e-9)))
    return held.select("item_key", "size_class", "n", "need", F.explode("sketch").alias("h"))


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, item_id, n_shingles, n_found, containment) of contained items."""
    docs = docs.select("doc_id", "text")
    items = staged(items.select("item_id", _words(F.col("text")).alias("words")).withColumn("item_key", F.xxhash64("item_id", "words")), "leaks-items")
    sketch = staged(sketches(items.dropDuplicates(["item_key"]), width, threshold), "leaks-sketches")
    streamed = docs.select("doc_id", _words(F.col("text")).alias("words")).select("doc_id", F.size("words").alias("n_words"), F.explode(_hashes(width)).alias("h"))
    hits = streamed.join(_bounded(sketch), "h").where(F.col("n_words") >= threshold * F.col("n"))
    near = hits.groupBy("doc_id", "item_key").agg(F.size(F.collect_set("h")).alias("hit"), F.first("need").alias("need")).where("hit >= need")
    near = staged(near.select(F.col("doc_id").alias("near_id"), "item_key"), "leaks-near")

    unstage(sketch)
    found = docs.join(near.select("near_id").distinct(), F.col("doc_id").eqNullSafe(F.col("near_id")), "left_semi")
    found = found.select("doc_id", _words(F.col("text")).alias("words")).select("doc_id", _texts(width).alias("has"))
    asked = items.select("item_id", "item_key", _texts(width).alias("wants")).where("wants is not null")
    pairs = found.join(near, F.col("doc_id").eqNullSafe(F.col("near_id"))).join(_bounded(asked, 5_000), "item_key")
    pairs = pairs.select("doc_id", "item_id", F.size("wants").alias("n_shingles"), F.size(F.array_intersect("wants", "has")).alias("n_found"))
    return pairs.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("n_found") >= threshold * F.col("n_shingles") - 1e-9)


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item."""
    bad = leaks(docs, items, width, threshold).select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")


ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
d AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS i FROM dw)),
t AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS i FROM iw)),
n AS (SELECT item_id, count(*) AS n FROM t GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS found FROM d JOIN t USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(found AS INTEGER) AS n_found, found::DOUBLE / n AS containment
FROM f JOIN n USING (item_id) WHERE found >= 0.8::DOUBLE * n - 1e-9
"""

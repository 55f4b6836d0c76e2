"""Mixing sources to target weights, with DataFrame and SQL functions only.

The words of each source are laid end to end, documents in the order of a hash of
id and text, and cut into blocks of ``block_words``.  Targets come from the weights by water filling (no source
above ``cap`` times its size).  A source's target is a number of slots; the
slots are dealt over output shards, so that a source's counts per shard are a
multinomial draw (given the source's total, which a free draw would miss by
its sampling noise); the j-th slot of a source is mapped to a block by a
pseudorandom permutation of the source's block numbers ("swap or not", one per
epoch, computed from the index alone), and blocks are joined by that number.

Nothing is collected, sorted or windowed by a whole source: the layout's
running sums are taken in chunks of some hundred rows, dealt by that hash, and
those of chunks and shards in two levels of ``FAN`` each (``running``).  Only the
table of sources, a row each, is handled in one task.

Defined results: a null text has size 0; a very long one is laid whole, cut where
blocks end; a null source is a source (the last); null and repeated ids are rows
like others, in an order that id and text decide, and equal rows may stand for
each other; an empty table gives no rows; other columns are ignored (names such
as ``size`` or ``sid`` do not clash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged, unstage

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
SHARD_ROOM = 1 << 20
CHUNK_ROWS = 512
#: Chunks or shards whose running sums one task takes.
FAN = 1024
ROUNDS = 24
WEIGHTS = (5, 2, 1)
PRIME = 2147483647
#: Tables of at most so many rows are broadcast; larger ones are joined by shuffling.
SMALL_ROWS = 20_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _digest(*parts: Column | str | int) -> Column:
    """A 32-bit number from the md5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(str(p))).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, ratio: float = 1.5, cap: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: sid, source, source_size, weight, target, n_blocks, n_slots.

    Its windows run over the sources alone, not over rows of the input.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("sid", (F.row_number().over(by_name) - 1).cast("int"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights) + 1))
    up = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    total = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("taken_up", F.sum("source_size").over(up) - F.col("source_size"))
    per = per.withColumn("left_over", F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(up) + F.col("weight"))
    per = per.withColumn("level", (total * F.lit(float(ratio)) - F.col("taken_up") * F.lit(float(cap))) / F.col("left_over"))
    per = per.withColumn("level", F.max("level").over(Window.partitionBy()))
    per = per.withColumn("target", F.least(F.col("source_size") * F.lit(float(cap)), F.col("level") * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    per = per.withColumn("n_blocks", blocks)
    slots = F.least(F.col("n_blocks") * cap, F.floor(F.col("target") * F.col("n_blocks") / F.col("source_size") + 0.5).cast("long"))
    return per.withColumn("n_slots", F.when(F.col("source_size") > 0, slots).otherwise(0)).drop("taken_up", "left_over", "level")


def running(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """df (staged) with before: the sum of value over the rows of equal key and smaller order (numbers from 0 on)."""
    df = df.withColumn("fan", F.expr(f"{order} div {FAN}"))
    upto = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy(*key, "fan").agg(F.sum(value).alias("of_fan"))
    totals = totals.select(*key, "fan", (F.sum("of_fan").over(upto(*key).orderBy("fan")) - F.col("of_fan")).alias("before_fan"))
    inside = df.withColumn("before", F.sum(value).over(upto(*key, "fan").orderBy(order)) - F.col(value))
    return inside.join(totals, [*key, "fan"]).withColumn("before", F.col("before") + F.col("before_fan")).drop("fan", "before_fan")


def layout(sized: DataFrame, sources: DataFrame, n_rows: int, sizes: DataFrame) -> DataFrame:
    """Each row's first word's place among its source's words: adds sid, chunk, rn, off (and source_size, target); sizes: the staged rows without texts."""
    chunks = 2 * (n_rows // (2 * CHUNK_ROWS)) + 1
    rows = sized.withColumn("chunk", F.col("spread") % chunks)
    key = sources.select(F.col("source").alias("its_source"), "sid", "source_size", "target")
    rows = rows.join(_small(key), F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    inside = Window.partitionBy("sid", "chunk").orderBy("spread", F.col("doc_id").asc_nulls_first(), "size")
    rows = rows.withColumn("rn", F.row_number().over(inside))
    rows = rows.withColumn("off", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    if chunks > 1:
        sums = sizes.groupBy("source", (F.col("spread") % chunks).alias("chunk")).agg(F.sum("size").alias("words"))
        sums = staged(sums.join(_small(key.select("its_source", "sid")), F.col("source").eqNullSafe(F.col("its_source"))).select("sid", "chunk", "words"), "mix-chunks")
        sums = running(sums, ["sid"], "chunk", "words").drop("words")
        rows = rows.join(sums, ["sid", "chunk"]).withColumn("off", F.col("off") + F.col("before")).drop("before")
    return rows


def slots(sources: DataFrame, seed: int = 17) -> DataFrame:
    """The mix: shard, slot (of its source), sid, epoch, block."""
    live = sources.where("n_slots > 0").select("sid", "n_blocks", "n_slots")
    spark = sources.sparkSession
    n_shards = F.greatest(F.lit(1), F.ceil(F.sum("n_slots").over(Window.partitionBy()) / SHARD_SLOTS)).cast("long")
    live = live.withColumn("n_shards", n_shards)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    some = live.select("sid", "n_slots", "n_shards", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_slots - 1) div {SHARD_SLOTS * FAN}"))).alias("some")).repartition(parts, "sid", "some")
    last = F.least(F.expr(f"(n_slots - 1) div {SHARD_SLOTS}"), (F.col("some") + 1) * FAN - 1)
    runs = some.select("sid", "n_slots", "n_shards", F.explode(F.sequence(F.col("some") * FAN, last)).alias("run")).repartition(parts, "sid", "run")
    each = runs.select("sid", "n_shards", F.explode(F.sequence(F.col("run") * SHARD_SLOTS, F.least(F.col("n_slots"), (F.col("run") + 1) * SHARD_SLOTS) - 1)).alias("k"))
    drawn = each.groupBy((_digest(seed, "shard", F.col("sid"), F.col("k")) % F.col("n_shards")).alias("shard"), "sid").agg(F.count("*").alias("n"))
    drawn = running(staged(drawn.select("sid", "shard", "n"), "mix-drawn"), ["sid"], "shard", "n").repartition(parts, "sid", "shard")
    drawn = drawn.select("shard", "sid", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("slot"))
    rounds = F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda r: F.struct((_digest(seed, "key", F.col("sid"), F.col("epoch"), r) % F.col("n_blocks")).alias("k"), (_digest(seed, "bit", F.col("sid"), F.col("epoch"), r) % (PRIME - 1) + 1).alias("c")))
    keys = live.select("sid", "n_blocks", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("epoch")).withColumn("rounds", rounds)
    drawn = drawn.join(_small(live.select("sid", "n_blocks")), "sid").withColumn("epoch", F.expr("slot div n_blocks")).drop("n_blocks")
    drawn = drawn.join(_small(keys), ["sid", "epoch"])

    def swap(x: Column, r: Column) -> Column:
        other = (r["k"] - x + F.col("n_blocks")) % F.col("n_blocks")
        bit = (F.greatest(x, other) % PRIME + 1) * r["c"] % PRIME % 2
        return F.when(bit == 1, other).otherwise(x)

    return drawn.select("shard", "slot", "sid", "epoch", F.aggregate("rounds", F.col("slot") % F.col("n_blocks"), swap).alias("block"))


def sized(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    cols = ["doc_id", "source"] + (["lang", "text"] if keep_text else [])
    # the same number for equal rows, of id and text
    spread = _digest(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return docs.select(*cols, spread.alias("spread"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def _blocks(block_words: int) -> Column:
    return F.sequence(F.expr(f"off div {block_words}"), F.expr(f"(off + size - 1) div {block_words}"))


def _span(block: Column, block_words: int) -> tuple[Column, Column]:
    """Where a document's words in a block begin and end, counted as off is."""
    return F.greatest(F.col("off"), block * block_words), F.least(F.col("off") + F.col("size"), (block + 1) * block_words)


def pieces(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each block that a document's words fall in: adds block, words (how many)."""
    rows = rows.where("size > 0").withColumn("block", F.explode(_blocks(block_words)))
    begin, end = _span(F.col("block"), block_words)
    return rows.withColumn("words", end - begin)


def text_pieces(rows: DataFrame, block_words: int) -> DataFrame:
    """Those rows with their words: sid, block, source, lang, piece_from (in the block), part.  A text is cut to words once, and each word is in one piece."""

    def cut(words: Column, block: Column) -> Column:
        begin, end = _span(block, block_words)
        part = F.array_join(F.slice(words, (begin - F.col("off")).cast("int") + 1, (end - begin).cast("int")), " ")
        return F.struct(block.alias("block"), (begin - block * block_words).alias("piece_from"), part.alias("part"))

    # an array of one, so that the words are a variable and not found anew for each block
    cuts = F.transform(F.array(F.regexp_extract_all("text", F.lit(f"({WORD})"))), lambda words: F.transform(_blocks(block_words), lambda block: cut(words, block)))
    return rows.where("size > 0").select("sid", "source", "lang", F.explode(cuts[0]).alias("piece")).select("sid", "source", "lang", "piece.*")


def mix_counts(docs: DataFrame, weights: tuple = WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """How often the mix takes each document's words: doc_id, source, size, source_size, target, taken, n_blocks_taken."""
    sizes = staged(sized(docs), "mix-sizes")
    n = sizes.count()
    sources = staged(source_targets(sizes, weights, block_words=block_words), "mix-sources")
    laid = staged(layout(sizes, sources, n, sizes).drop("spread"), "mix-layout")
    unstage(sizes)
    times = slots(sources, seed).groupBy("sid", "block").agg(F.count("*").alias("times"))
    key = ["sid", "chunk", "rn"]
    cut = pieces(laid.select(*key, "off", "size"), block_words).select(*key, "block", "words")
    took = cut.join(times, ["sid", "block"]).groupBy(*key).agg(F.sum(F.col("words") * F.col("times")).alias("taken"), F.sum("times").alias("n_blocks_taken"))
    zero = F.lit(0).cast("long")
    return laid.join(took, key, "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"), F.coalesce("n_blocks_taken", zero).alias("n_blocks_taken"))


def mix_blocks(docs: DataFrame, weights: tuple = WEIGHTS, block_words: int = 512, seed: int = 17) -> DataFrame:
    """The mix itself, a row for each block taken: doc_id (shard, then place in it), source, lang (of the block's first word), text (its words), n_chars."""
    sizes = staged(sized(docs), "mix-sizes")
    n = sizes.count()
    sources = staged(source_targets(sizes, weights, block_words=block_words), "mix-sources")
    laid = layout(sized(docs, keep_text=True), sources, n, sizes).select("sid", "source", "lang", "off", "size", "text")
    part = text_pieces(laid, block_words)
    whole = part.groupBy("sid", "block").agg(F.array_sort(F.collect_list(F.struct("piece_from", "part", "lang", "source"))).alias("parts"))
    whole = whole.select("sid", "block", F.col("parts")[0]["source"].alias("source"), F.col("parts")[0]["lang"].alias("lang"), F.array_join(F.transform("parts", lambda p: p["part"]), " ").alias("text"))
    # shards have about SHARD_SLOTS rows; places are given before texts join
    place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("sid", "slot", F.lit(seed)), "sid", "slot")) - 1
    dealt = slots(sources, seed).withColumn("doc_id", F.col("shard") * SHARD_ROOM + place)
    return whole.join(dealt.select("doc_id", "sid", "block"), ["sid", "block"]).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def oracle_sql(weights: tuple = WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = 17) -> str:
    """mix_counts() of documents in DuckDB's SQL."""
    dig = lambda *p: "CAST('0x' || substr(md5(concat_ws(':', " + ", ".join(p) + ")), 1, 8) AS BIGINT)"
    w = "[" + ", ".join(f"{x}.0::DOUBLE" for x in weights) + "]"
    steps, last = [], "s0"
    for r in range(ROUNDS):
        other = f"(({dig(f"'{seed}'", "'key'", 'sid', 'epoch', f"'{r}'")} % n_blocks) - block + n_blocks) % n_blocks"
        steps.append(f"r{r} AS (SELECT *, {other} AS other, {dig(f"'{seed}'", "'bit'", 'sid', 'epoch', f"'{r}'")} % {PRIME - 1} + 1 AS c FROM {last}), s{r + 1} AS (SELECT sid, slot, epoch, n_blocks, CASE WHEN (greatest(block, other) % {PRIME} + 1) * c % {PRIME} % 2 = 1 THEN other ELSE block END AS block FROM r{r})")
        last = f"s{r + 1}"
    return f"""
WITH sizes AS (SELECT doc_id, source, {dig("coalesce(CAST(doc_id AS VARCHAR), '')", "coalesce(text, '')")} AS spread, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS sid FROM per),
weighed AS (SELECT *, {w}[sid % {len(weights)} + 1] AS weight FROM ranked),
levels AS (SELECT *, ((SELECT sum(source_size) FROM per) * 1.5::DOUBLE - (sum(source_size) OVER up - source_size) * 2.0::DOUBLE) / ((SELECT sum(weight) FROM weighed) - sum(weight) OVER up + weight) AS level FROM weighed WINDOW up AS (ORDER BY source_size / weight, sid)),
targets AS (SELECT sid, source, source_size, least(source_size * 2.0::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target, CAST(ceil(source_size / {block_words}.0::DOUBLE) AS BIGINT) AS n_blocks FROM levels),
src AS (SELECT *, CASE WHEN source_size > 0 THEN least(n_blocks * 2, CAST(floor(target * n_blocks / source_size + 0.5) AS BIGINT)) ELSE 0 END AS n_slots FROM targets),
chunked AS (SELECT s.*, spread % (2 * ((SELECT count(*) FROM sizes) // {2 * CHUNK_ROWS}) + 1) AS chunk FROM sizes s),
laid AS (SELECT c.doc_id, c.source, c.size, t.sid, t.source_size, t.target, row_number() OVER () AS rid, sum(c.size) OVER (PARTITION BY t.sid ORDER BY c.chunk, c.spread, c.doc_id NULLS FIRST, c.size ROWS UNBOUNDED PRECEDING) - c.size AS off FROM chunked c JOIN src t ON c.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT rid, sid, off, size, unnest(range(CAST(off // {block_words} AS BIGINT), CAST((off + size - 1) // {block_words} + 1 AS BIGINT))) AS block FROM laid WHERE size > 0),
dealt AS (SELECT sid, n_blocks, unnest(range(n_slots)) AS slot FROM src WHERE n_slots > 0),
s0 AS (SELECT sid, slot, slot // n_blocks AS epoch, n_blocks, slot % n_blocks AS block FROM dealt),
{", ".join(steps)},
times AS (SELECT sid, block, count(*) AS times FROM {last} GROUP BY sid, block),
took AS (SELECT rid, sum((least(off + size, (block + 1) * {block_words}) - greatest(off, block * {block_words})) * times) AS taken, sum(times) AS n_blocks_taken FROM cut JOIN times USING (sid, block) GROUP BY rid)
SELECT doc_id, source, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(coalesce(n_blocks_taken, 0) AS BIGINT) AS n_blocks_taken FROM laid LEFT JOIN took USING (rid)
"""

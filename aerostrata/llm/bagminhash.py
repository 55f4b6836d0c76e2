"""Near-duplicate documents by BagMinHash signatures of word-shingle multisets.

Words are runs of letters and digits, ASCII letters in lower case; a document is
the multiset of its runs of ``WIDTH`` words (a shorter one has one shingle of all
its words).  Two documents are linked if the multisets' Jaccard likeness (sum of
least counts over sum of greatest) is ``SIMILARITY`` or more; a class is a
connected component of links.

1. One pass over the texts: documents of equal word sequences become one vertex
   (the least id), and each gets its signature.  BagMinHash after Ertl (2018):
   the weight axis is cut at whole numbers and grouped in dyadic intervals
   [0,1), [1,2), [2,4), ...; each (shingle, interval) has a Poisson process of
   its length's rate that throws points (time, level, component); points at
   levels over the shingle's count do not exist for this document; a component
   keeps its earliest point.  Units stop as soon as their next point is later
   than all that is kept.  Two documents agree in a component with probability
   equal to their weighted Jaccard likeness.
2. ``BANDS`` bands of ``ROWS`` components: likeness 0.8 shares a bucket with
   probability 1 - 3e-6.
3. Pairs of a bucket are compared by their signatures inside tiles of at most
   ``TILE`` members, in the first bucket that they share; those that agree in
   ``AGREE`` of ``M`` components (likeness 0.8 does with probability 1 - 1e-5) are verified by exact multiset overlap of
   the texts.  At first each member names its best partner only, and then all
   of other classes than its own that are still untried.  So a group of n near copies costs some n verified pairs, the
   pairs of a bucket are never written out, and none is capped away: members
   outside a bucket's largest class meet every tile of it in the last round.

A bucket's members are counted with map-side combine and dealt to tiles before
any task gathers them.

Defined results: texts without words form one class; rows that share an id are
one document, whose near copies are those of one of its texts; a row without id has the class of the documents of equal words
(null if none has an id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PUNCTUATION, Words, begin_task, blocks, bounded, components, ensure_path, mix64, release_memory, staged, unstage, windows

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS, M = 42, 6, 256
AGREE, TILE = 177, 1024
#: Partners that a member names in a bucket's tile, by round; then all.
PARTNERS = (1,)
#: Id lists of at most so many rows are broadcast to find their texts.
ID_ROWS = 1_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a block's documents, and each one's document."""
    h = words.hashes(lower=True)
    got, first = windows(h, words.doc, width)
    owner = np.searchsorted(words.doc, first, side="right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        n = words.counts[short]
        whole = np.array([int(mix64(np.array([sum(int(x) * pow(31, j, 1 << 64) for j, x in enumerate(h[words.doc[i] : words.doc[i + 1]])) & (2**64 - 1)], np.uint64))[0]) for i in short], np.uint64)
        got, owner = np.concatenate([got, whole ^ n.astype(np.uint64)]), np.concatenate([owner, short])
    return got, owner


def multisets(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (54 bits), their counts and documents, by document; blocks have at most 1024 texts."""
    got, owner = shingles(words, width)
    key = np.sort((owner.astype(np.uint64) << np.uint64(54)) | (got >> np.uint64(10)))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return key & np.uint64((1 << 54) - 1), count, (key >> np.uint64(54)).astype(np.int64)


def signatures(element: np.ndarray, count: np.ndarray, owner: np.ndarray, n_docs: int, m: int = M) -> np.ndarray:
    """BagMinHash: each document's earliest point in each of m components (inf for an empty one)."""
    top = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    unit = np.repeat(np.arange(len(element)), top)
    level = np.arange(len(unit)) - np.repeat(np.cumsum(top) - top, top)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    rate = np.where(level > 0, low, 1.0)
    kept_share = np.minimum(1.0, (count[unit] - low) / rate)
    seed = mix64(element[unit] + (level.astype(np.uint64) << np.uint64(56)))
    doc = owner[unit]
    at = np.zeros(len(unit))
    out = np.full((n_docs, m), np.inf)
    flat = out.reshape(-1)
    live, drawn = np.arange(len(unit)), 0
    while len(live):
        some = int(np.clip(8192 // len(live), 1, 64))
        t = (np.arange(drawn, drawn + some, dtype=np.uint64) * np.uint64(2))[None]
        base = seed[live][:, None] + t * _GOLD
        a, b = mix64(base), mix64(base + _GOLD)
        wait = -np.log(((a >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / rate[live][:, None]
        when = at[live][:, None] + np.cumsum(wait, axis=1)
        component = (b & np.uint64(0xFFFF)).astype(np.int64) % m
        exists = (b >> np.uint64(32)).astype(np.float64) * 2.0**-32 < kept_share[live][:, None]
        place = doc[live][:, None] * m + component
        np.minimum.at(flat, place[exists], when[exists])
        at[live] = when[:, -1]
        latest = out.max(axis=1)
        live = live[at[live] < latest[doc[live]]]
        drawn += some
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band, its number included."""
    bits = np.ascontiguousarray(signature[:, : BANDS * ROWS]).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    h = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD, (len(signature), 1))
    for j in range(ROWS):
        h = mix64(h ^ mix64(bits[:, :, j] + np.uint64(j)))
    return h


def short(signature: np.ndarray) -> np.ndarray:
    """A byte of each component."""
    return (mix64(np.ascontiguousarray(signature).view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def text_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each document's word sequence."""
    out = []
    h, n = words.hashes(lower=True), words.counts
    for salt in (1, 2):
        key = np.full(len(n), salt, np.uint64)
        # documents of equal length are handled together
        for size in np.unique(n[n > 0]):
            some = np.flatnonzero(n == size)
            key[some] = _runs(h, words.doc[some], int(size), salt)
        out.append(mix64(key + n.astype(np.uint64)))
    return out[0], out[1]


def _runs(h: np.ndarray, first: np.ndarray, size: int, salt: int) -> np.ndarray:
    mult = np.multiply.accumulate(np.full(size, 0xD6E8FEB86659FD93 + 2 * salt, np.uint64))
    return (mix64(h[first[:, None] + np.arange(size)] + np.uint64(salt)) * mult).sum(axis=1, dtype=np.uint64)


_SIGNED = "doc_id long, k1 long, k2 long, bands array<long>, signature binary"


def _sign_task(with_bands: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        seen: set[int] = set()
        for batch in batches:
            for part in blocks(batch):
                words = Words(part.column("text").cast(pa.binary()).to_pylist(), PUNCTUATION)
                k1, k2 = text_keys(words)
                rows: list[np.ndarray | None] = [None] * len(part)
                signed: list[bytes | None] = [None] * len(part)
                if with_bands:
                    element, count, owner = multisets(words)
                    fresh = np.zeros(len(part), bool)
                    for i, k in enumerate(k1.tolist()):
                        fresh[i] = words.counts[i] > 0 and k not in seen
                        seen.add(k)
                    if len(seen) > 500_000:
                        seen.clear()
                    mine = fresh[owner]
                    number = np.cumsum(fresh) - 1
                    full = signatures(element[mine], count[mine], number[owner[mine]], int(fresh.sum()))
                    got, byte = bands(full).view(np.int64), short(full)
                    for j, i in enumerate(np.flatnonzero(fresh)):
                        rows[i], signed[i] = got[j], byte[j].tobytes()
                cols = [part.column("doc_id"), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(rows, pa.list_(pa.int64())), pa.array(signed, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "k1", "k2", "bands", "signature"])
        seen.clear()
        release_memory()

    return run


def overlap(a: list[bytes | None], b: list[bytes | None], width: int = WIDTH) -> np.ndarray:
    """Multiset Jaccard likeness of each pair of texts; 1 for two without words."""
    sides = []
    for texts in (a, b):
        got, owner = shingles(Words(texts, PUNCTUATION), width)
        sides.append((owner.astype(np.uint64) << np.uint64(54)) | (got >> np.uint64(10)))
    key, back = np.unique(np.concatenate(sides), return_inverse=True)
    n = len(sides[0])
    x, y = np.bincount(back[:n], minlength=len(key)), np.bincount(back[n:], minlength=len(key))
    doc = (key >> np.uint64(54)).astype(np.int64)
    low, high = np.bincount(doc, np.minimum(x, y), len(a)), np.bincount(doc, np.maximum(x, y), len(a))
    return np.where(high > 0, low / np.maximum(high, 1), 1.0)


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin_task()
    for batch in batches:
        for part in blocks(batch, "text_a", rows=500):
            for some in blocks(part, "text_b"):
                like = overlap(*(some.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b")))
                yield pa.RecordBatch.from_arrays([some.column("a"), some.column("b"), pa.array(like)], ["a", "b", "likeness"])
    release_memory()


def verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the likeness of their texts."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids = staged(ids, "near-ids")
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(bounded(ids, ID_ROWS), "id")
    texts = staged(texts, "near-texts")
    unstage(ids)
    both = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a").join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    out = staged(both.select("a", "b", "text_a", "text_b").mapInArrow(_verify_task, "a long, b long, likeness double"), "near-verified")
    unstage(texts)
    return out


def tile_pairs(group: np.ndarray, ids: np.ndarray, classes: np.ndarray, asks: np.ndarray, signature: np.ndarray, banded: np.ndarray, bucket: np.ndarray, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by group: pairs of one group and different classes, one of which asks, that agree enough and share no earlier bucket; most: each asker's best so many."""
    band = (banded == bucket[:, None]).argmax(1)
    size = np.diff(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)))
    begin = np.cumsum(size) - size
    out_a, out_b = [], []
    x_all = np.flatnonzero(asks)
    first, count = np.repeat(begin, size)[x_all], np.repeat(size, size)[x_all]
    at = 0
    while at < len(x_all):
        # some askers against all of their groups: about 16384 pairs at a time, one asker at least
        stop = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), 16384, side="right")) + at)
        x = np.repeat(x_all[at:stop], count[at:stop])
        c = count[at:stop]
        y = np.repeat(first[at:stop], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        ok = (classes[x] != classes[y]) & (ids[x] != ids[y])
        x, y = x[ok], y[ok]
        agree = (signature[x] == signature[y]).sum(1)
        ok = agree >= AGREE
        x, y, agree = x[ok], y[ok], agree[ok]
        ok = (banded[x] == banded[y]).argmax(1) == band[x]
        x, y, agree = x[ok], y[ok], agree[ok]
        if most is not None and len(x):
            order = np.lexsort((ids[y], -agree, x))
            x, y = x[order], y[order]
            new = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            rank = np.arange(len(x)) - np.repeat(new, np.diff(np.append(new, len(x))))
            x, y = x[rank < most], y[rank < most]
        out_a.append(np.minimum(ids[x], ids[y]))
        out_b.append(np.maximum(ids[x], ids[y]))
        at = stop
    if not out_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _tile_task(most: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: pa.Table) -> pa.RecordBatch:
            get = lambda c: rows.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(-1, M)
            banded = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            a, b = tile_pairs(get("tile"), get("id"), get("c"), get("asks"), signature, banded, get("bucket"), most)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            tile = held.column("tile").combine_chunks().to_numpy()
            cut = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on
            if cut >= 4096:
                yield emit(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None and len(held):
            yield emit(held)
        held = None
        release_memory()

    return run


def _tiled(rows: DataFrame, most: int | None) -> DataFrame:
    """Pairs (a, b) from rows (bucket, n, id, c, asks, signature, bands), bucket's members in tiles of about TILE at most.

    A member is at home in one tile; an asker visits all others if most is None.
    """
    n_tiles = F.expr(f"(n + {TILE - 1}) div {TILE}")
    home = F.pmod(F.xxhash64("id"), n_tiles)
    if most is None:
        visits = F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), n_tiles - 1)).otherwise(F.array(home))
        rows = rows.withColumn("t", F.explode(visits))
    else:
        rows = rows.withColumn("t", home)
    rows = rows.select(F.xxhash64("bucket", "t").alias("tile"), "bucket", "id", "c", "asks", "signature", "bands")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(_tile_task(most), "a long, b long").distinct()


def near_classes(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, class_id) for every row of docs: the least id of its class.

    Enough links are verified to join each class and to part it from all others;
    links within a class that are not needed for that are not looked for.
    """
    spark = docs.sparkSession
    ensure_path(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(docs.mapInArrow(_sign_task(True), _SIGNED), "near-rows")
    vertex = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.max(F.when(F.col("bands").isNotNull(), F.struct("bands", "signature"))).alias("signed"))
    vertex = staged(vertex.select("k1", "k2", "id", "signed.bands", "signed.signature"), "near-vertices")
    # an id that stands for several texts (repeated ids) is searched by one of them
    signed = vertex.where("id is not null and bands is not null").groupBy("id").agg(F.max(F.struct("signature", "bands")).alias("s"))
    signed = staged(signed.select("id", "s.*"), "near-signed")
    banded = signed.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    held = staged(banded.join(shared, "bucket"), "near-buckets")
    in_bucket = staged(signed.join(held.select("id").distinct(), "id"), "near-signatures")
    unstage(signed)

    first = held.join(in_bucket, "id").select("bucket", "n", "id", F.col("id").alias("c"), F.lit(True).alias("asks"), "signature", "bands")
    named = staged(_tiled(first, PARTNERS[0]), "near-pairs")
    tried = verify(docs, named)
    unstage(named)
    classes = staged(components(tried.where(F.col("likeness") >= SIMILARITY), "near-components"), "near-classes")
    for most in (*PARTNERS[1:], None):
        own = held.where("n > 2").join(classes, "id", "left").select("bucket", "n", "id", F.coalesce("class_id", "id").alias("c"))
        sizes = own.groupBy("bucket", "c").agg(F.count("*").alias("k"))
        largest = sizes.groupBy("bucket").agg(F.max_by("c", F.struct("k", -F.col("c"))).alias("main"), F.count("*").alias("n_classes")).where("n_classes > 1").select("bucket", "main")
        open_ = own.join(largest, "bucket").withColumn("asks", F.col("c") != F.col("main")).drop("main")
        more = _tiled(open_.join(in_bucket, "id"), most).join(tried.select("a", "b"), ["a", "b"], "left_anti")
        more = staged(more, "near-pairs")
        if more.isEmpty():
            unstage(more)
            continue
        fresh, old = verify(docs, more), (tried, classes)
        tried = staged(tried.unionByName(fresh), "near-tried")
        classes = staged(components(tried.where(F.col("likeness") >= SIMILARITY), "near-components"), "near-classes")
        for table in (more, fresh, *old):
            unstage(table)

    for table in (held, in_bucket, tried):
        unstage(table)
    known = vertex.join(classes, "id", "left").select("k1", "k2", F.coalesce("class_id", "id").alias("class_id"))
    return rows.select("doc_id", "k1", "k2").join(known, ["k1", "k2"]).select("doc_id", "class_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without all but one document of each class, all columns kept: that with the class's id, or one of equal rows without id."""
    ensure_path(docs.sparkSession)
    found = staged(near_classes(docs), "near-found")
    kept = staged(found.select(F.col("class_id").alias("kept_id")).where("kept_id is not null").distinct(), "near-kept")
    n_ids = found.agg(F.count("doc_id"), F.countDistinct("doc_id"), F.count("*")).first()
    unstage(found)
    kept = bounded(kept, ID_ROWS)
    out = docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi")
    if n_ids[0] != n_ids[1]:
        out = out.dropDuplicates(["doc_id"])
    if n_ids[0] != n_ids[2]:
        keys = lambda d: d.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign_task(False), _SIGNED).select("k1", "k2")
        lone = docs.where("doc_id is null").dropDuplicates(["text"])
        # rows without id: those whose words no row with id has, one of each
        known = keys(docs.where("doc_id is not null")).distinct()
        new = keys(lone).distinct().join(known, ["k1", "k2"], "left_anti")
        keyed = lone.select(F.struct(*lone.columns).alias("row"), "text").withColumn("doc_id", F.monotonically_increasing_id())
        keyed = staged(keyed, "near-lone")
        of = keyed.select("doc_id", "text").mapInArrow(_sign_task(False), _SIGNED).join(new, ["k1", "k2"]).groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
        out = out.unionByName(keyed.join(of, "doc_id", "left_semi").select("row.*"))
    return out

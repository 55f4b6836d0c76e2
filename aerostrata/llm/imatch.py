"""Document fingerprints: I-Match over randomised lexicon subsets.

A document's terms are its distinct words within a band of inverse document
frequency (in at least ``LEAST_DOCS`` documents and at most ``MOST_SHARE`` of
them), however many or few it has.  Document frequencies are counted exactly, for every distinct word of all documents, by a
grouped aggregation over 54-bit hashes of words; the band's words, a sorted array
that grows with the corpus (8 bytes a word), are broadcast.

Plain I-Match hashes the sorted terms once, so one changed term changes all.
Here the lexicon is split at random into parts, coarse and fine (``LEVELS``); a
fingerprint is the number of terms, the hash of their sorted list and, for each
part, 16 bits of the hash of the sorted list of the terms in it (0: none).  A part of share p agrees with
probability (1 - p) ** d when d terms differ, so the parts that agree at each
level give the likeliest d, and likeness is the Jaccard coefficient that follows
from it and the two numbers of terms; equal fingerprints have likeness 1.

Neighbours in doc_id order meet by a range partitioning of the texts (one
shuffle); each range also gets the first row of the next one.

Defined results: a null text counts as empty; a null doc_id comes first; rows
of equal doc_id follow each other by text; the fingerprint of a text without
terms in the band (no words, or frequent and single ones only) is that of no
terms, and two such are alike (1); a very long
text is handled whole, with its neighbour as a block of its own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PUNCTUATION, Powers, Words, begin_task, blocks, ensure_path, mix64, release_memory

#: A worker sums 2 ** BITS entries (a word in a document each) before it sends them on.
BITS = 21
LEAST_DOCS, MOST_SHARE = 2, 0.25
#: (parts of the lexicon, parts kept, repetitions) of each level.
LEVELS = ((4, 4, 5), (16, 16, 1), (64, 16, 1), (256, 16, 1), (1024, 16, 1))
N_PARTS = sum(kept * times for _, kept, times in LEVELS)

_MIN = -(1 << 63)


def distinct_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (54 bits) of each text's distinct words, sorted, and their texts; at most 1024 texts."""
    words = Words(texts, PUNCTUATION)
    key = np.unique((words.owner().astype(np.uint64) << np.uint64(54)) | (words.hashes(lower=True) >> np.uint64(10)))
    return key & np.uint64((1 << 54) - 1), (key >> np.uint64(54)).astype(np.int64)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and the numbers of documents that hold them, summed over about 2 ** BITS entries."""

    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int32))], ["word", "n"])

    begin_task()
    held, size = [], 0
    for batch in batches:
        for part in blocks(batch):
            held.append(distinct_words(part.column("text").cast(pa.binary()).to_pylist())[0])
            size += len(held[-1])
            if size >= 1 << BITS:
                yield summed(held)
                held, size = [], 0
    if size:
        yield summed(held)


def lexicon(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the words whose document frequency over all of docs is in the band."""
    ensure_path(docs.sparkSession)
    most = max(LEAST_DOCS, MOST_SHARE * docs.count())
    counts = docs.select("text").mapInArrow(_count_task, "word long, n int").groupBy("word").agg(F.sum("n").alias("n"))
    return np.sort(counts.where((F.col("n") >= LEAST_DOCS) & (F.col("n") <= most)).select("word").toArrow().column("word").to_numpy().view(np.uint64))


def in_lexicon(word: np.ndarray, band: np.ndarray) -> np.ndarray:
    if not len(band):
        return np.zeros(len(word), bool)
    distinct, back = np.unique(word, return_inverse=True)
    return (band[np.minimum(np.searchsorted(band, distinct), len(band) - 1)] == distinct)[back]


class Prints:
    """Fingerprints of a block's texts: numbers of terms, hashes of all terms, parts' hashes."""

    def __init__(self, n: np.ndarray, whole: np.ndarray, parts: np.ndarray):
        self.n, self.whole, self.parts = n, whole, parts

    def __getitem__(self, some) -> Prints:
        return Prints(self.n[some], self.whole[some], self.parts[some])

    def texts(self) -> list[str]:
        raw = self.parts.astype(">u2").tobytes().hex()
        width = 4 * N_PARTS
        return [f"{n:08x}{w:016x}{raw[i * width : (i + 1) * width]}" for i, (n, w) in enumerate(zip(self.n.tolist(), self.whole.tolist()))]


def list_hashes(values: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """For each key below n a hash of its values in their order (0: none); equal keys stand together."""
    out = np.zeros(n, np.uint64)
    if len(key):
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        rank = np.arange(len(key)) - np.repeat(first, size)
        up, _ = _places.upto(int(size.max()))
        out[key[first]] = np.maximum(mix64(np.add.reduceat(values * up[rank], first) + size.astype(np.uint64)), np.uint64(1))
    return out


def fingerprints(texts: list[bytes | None], band: np.ndarray) -> Prints:
    """Fingerprints, given the sorted hashes of the words in the band."""
    word, owner = distinct_words(texts)
    n_texts = len(texts)
    inside = in_lexicon(word, band)
    word, owner = word[inside], owner[inside]
    n = np.bincount(owner, minlength=n_texts)
    hashed = mix64(word + np.uint64(0x51ED270B))
    whole = list_hashes(hashed, owner, n_texts)
    parts = []
    for level, (split, kept, times) in enumerate(LEVELS):
        for t in range(times):
            part = ((mix64(word ^ np.uint64((level * 16 + t + 1) << 56)) >> np.uint64(40)) % np.uint64(split)).astype(np.uint16)
            mine = np.flatnonzero(part < kept)
            mine = mine[np.argsort(part[mine], kind="stable")]  # by part, within it by text and word
            key = part[mine].astype(np.int64) * n_texts + owner[mine]
            parts.append(list_hashes(hashed[mine], key, kept * n_texts).reshape(kept, n_texts))
    parts = np.ascontiguousarray(np.concatenate(parts).T)
    short = np.maximum(parts >> np.uint64(48), np.uint64(1)).astype(np.uint16)
    return Prints(n, whole, np.where(parts == 0, 0, short).astype(np.uint16))


_places = Powers(0xD6E8FEB86659FD93)
_GRID = np.unique(np.concatenate([np.arange(33), np.round(2 ** np.arange(5, 20, 0.125))])).astype(np.float64)
_SHARE = np.array([1 / split for split, _, _ in LEVELS])
_AGREE = np.minimum(_GRID[:, None] * np.log1p(-_SHARE), -1e-12)  # log of (1 - p) ** d
_DIFFER = np.log(-np.expm1(_AGREE))


def likeness(a: Prints, b: Prints) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, pair by pair, from the fingerprints alone."""
    same = a.parts == b.parts
    agree, size, at = np.empty((len(a.n), len(LEVELS))), np.array([k * t for _, k, t in LEVELS]), 0
    for i, s in enumerate(size):
        agree[:, i] = same[:, at : at + s].sum(1)
        at += s
    total = (a.n + b.n).astype(np.float64)
    score = agree @ _AGREE.T + (size - agree) @ _DIFFER.T
    score[_GRID[None] > np.maximum(total, 1)[:, None]] = -np.inf
    score[(_GRID[None] < np.abs(a.n - b.n)[:, None]) & (_GRID[None] > 0)] = -np.inf
    d = _GRID[score.argmax(1)]
    d = np.maximum(np.maximum(d, np.abs(a.n - b.n)), 1)
    out = np.clip((total - d) / np.maximum(total + d, 1), 0, 1)
    return np.where((a.n == b.n) & (a.whole == b.whole) & same.all(1), 1.0, out)


def parse(prints: list[str]) -> Prints:
    """Fingerprints from their strings."""
    parts = np.frombuffer(bytes.fromhex("".join(p[24:] for p in prints)), ">u2").reshape(len(prints), N_PARTS)
    return Prints(np.array([int(p[:8], 16) for p in prints], np.int64), np.array([int(p[8:24], 16) for p in prints], np.uint64), parts)


def _range_task(splits: np.ndarray, firsts: dict[int, int]):
    known = sorted(firsts)
    before = {firsts[b]: known[i - 1] for i, b in enumerate(known)}  # the first range's row goes to the last

    @F.pandas_udf("bucket int, lead_of int")
    def place(doc_id: pd.Series) -> pd.DataFrame:
        ids = doc_id.fillna(_MIN).astype("int64") if doc_id.hasnans else doc_id.astype("int64")
        bucket = np.searchsorted(splits, ids.to_numpy(), side="right").astype(np.int32)
        return pd.DataFrame({"bucket": bucket, "lead_of": ids.map(before).astype("Int32")})

    return place


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """docs (doc_id, text) in ranges: bucket, lead (1: the row after the range's last), sorted; parts bounds what the driver gets."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_MIN))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), "text")
    at = [i / parts for i in range(1, parts)] or [0.5]
    splits = np.unique(np.array(docs.agg(F.percentile_approx("key", at, 10_000)).first()[0] or [0], np.int64))
    plain = _range_task(splits, {0: _MIN})
    firsts = {r.bucket: r.first for r in docs.select("key", plain("key")["bucket"].alias("bucket")).groupBy("bucket").agg(F.min("key").alias("first")).collect()}
    placed = docs.withColumn("to", _range_task(splits, firsts)("key"))
    own = F.struct(F.col("to.bucket").alias("bucket"), F.lit(0).alias("lead"))
    ahead = F.struct(F.col("to.lead_of").alias("bucket"), F.lit(1).alias("lead"))
    goes = F.when(F.col("to.lead_of").isNull(), F.array(own)).otherwise(F.array(own, ahead))
    rows = placed.select("doc_id", "key", "text", F.explode(goes).alias("goes")).select("doc_id", "key", "text", "goes.bucket", "goes.lead")
    return rows.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket", "lead", "key", "text")


def _print_task(band):
    def finish(rows: list[tuple]) -> pa.RecordBatch:
        ids, texts, nexts = zip(*rows)
        raw = [t.encode() for t in texts]
        halves = [len(t) // 2 for t in texts]
        edited = [(t[: len(t) - h] + n[:h]).encode() for t, n, h in zip(texts, nexts, halves)]
        own, after, changed = (fingerprints(x, band.value) for x in (raw, [n.encode() for n in nexts], edited))
        cols = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(own.texts()), pa.array(changed.texts()), pa.array(likeness(own, changed)), pa.array(likeness(own, after))]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        held, size, last = [], 0, None
        for batch in batches:
            for part in blocks(batch):
                for doc_id, text, bucket, lead in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "lead"))):
                    text = text or ""
                    if last is not None and last[2] == bucket and not last[3]:
                        held.append((last[0], last[1], text))
                        size += len(last[1]) + len(text)
                        if size > 1 << 20 or len(held) == 1000:
                            yield finish(held)
                            held, size = [], 0
                    last = (doc_id, text, bucket, lead)
        if held:
            yield finish(held)
        held, last = [], None
        release_memory()

    return run


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, its edited text's, and how near the edited and the next text are."""
    spark: SparkSession = docs.sparkSession
    band = spark.sparkContext.broadcast(lexicon(docs))
    return with_next(docs, int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(_print_task(band), _OUT)

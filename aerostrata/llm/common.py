"""Pieces that the corpus operators share: word arrays, hashes, staged tables, components.

Everything here works on whole texts.  A *word* is a run of characters other
than the six ASCII white space characters (``WORD``); texts are handled as
UTF-8 bytes, and since those six are single bytes there, cutting the bytes
gives the same words as cutting the characters.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handled in blocks of about so many bytes, which bounds a worker's memory.
BLOCK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: As gaps of Words: all ASCII bytes but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_MULT = np.uint64(0x9E3779B97F4A7C15)
_ROOT = str(Path(__file__).resolve().parents[2])


#: Rows of an Arrow batch of texts, where the session has Spark's default (10,000): long texts stay within memory.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ensure_path(spark: SparkSession) -> None:
    """Let Python workers started from another folder import this package, and keep their batches small."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder."""
    ensure_path(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where none is set and all runs on this machine (tests)."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    base = base or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="aerostrata-")
        sc.setCheckpointDir(base)
    return str(base)


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(df: DataFrame | None) -> None:
    """Remove a table that staged() wrote, once nothing reads it any more."""
    path = getattr(df, "_staged_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


_resident: dict[str, object] = {}


def resident(name: str, key: str, make):
    """What make() gives, kept in this worker for later tasks of the same kind; one of each name."""
    held = _resident.get(name)
    if held is None or held[0] != key:
        _resident[name] = held = (key, make())
    return held[1]


def begin_task(keep: str = "") -> None:
    """Drop what tasks of other stages have left in this worker, but for the one named."""
    left = [name for name in _resident if name != keep]
    for name in left:
        del _resident[name]
    if left:
        release_memory()


def release_memory() -> None:
    """Give what a finished task has freed back to the system: workers stay for later stages."""
    for powers in (_powers, _word_powers):
        powers.shrink()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit numbers that spreads their bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 4096)
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]

    def shrink(self) -> None:
        """Forget what only a long text needed."""
        if len(self.up) > BLOCK_BYTES + 4096:
            self.up = self.down = np.ones(1, np.uint64)


_powers = Powers(0xD6E8FEB86659FD93)
_word_powers = Powers(0xA0761D6478BD642F)


class Words:
    """The words of a block of texts: byte spans, documents' word ranges and 64-bit hashes."""

    def __init__(self, texts: Iterable[str | bytes | None], gaps: np.ndarray = _SPACE):
        raw = [t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        begins = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in raw], out=begins[1:])
        inside = np.empty(len(self.buf) + 1, np.int8)
        inside[0] = 0
        np.logical_not(gaps[self.buf], out=inside[1:].view(bool))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.start, begins)
        self.n = len(raw)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes; lower: ASCII letters count as lower case."""
        return self.span_hashes(self.start, self.end, self.lower_code() if lower else _BYTE_CODE)

    @staticmethod
    def lower_code() -> np.ndarray:
        code = _BYTE_CODE.copy()
        code[65:91] = code[97:123]
        return code

    def span_hashes(self, start: np.ndarray, end: np.ndarray, code: np.ndarray = _BYTE_CODE) -> np.ndarray:
        up, down = _powers.upto(len(self.buf) + 1)
        total = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(code[self.buf] * up[: len(self.buf)], out=total[1:])
        return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def windows(hashes: np.ndarray, doc: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of k words within one document, and the index of its first word."""
    n = len(hashes)
    counts = np.diff(doc)
    room = np.maximum(counts - (k - 1), 0)
    if not room.sum():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.repeat(doc[:-1], room) + (np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room))
    up, down = _word_powers.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(hashes + np.uint64(salt & (2**64 - 1))) * up[:n], out=total[1:])
    return mix64((total[first + k] - total[first]) * down[first]), first


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of at most so many rows and about limit bytes of text; a longer text is a piece alone."""
    col = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and (held + size > limit or i - at == rows):
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += int(size)
    if len(sizes) > at:
        yield batch.slice(at)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast df if, counted, it has at most so many rows; else leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def crc_mod(column: str, m: int) -> Column:
    """crc32 of an id's decimal text, modulo m."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


#: Up to so many edges, one task joins them.
FEW_EDGES = 250_000


def least_joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges (a, b): the distinct ends, and for each the least that it is connected with."""
    ids, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = back[: len(a)], back[len(a) :], np.arange(len(ids))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            return ids, ids[root]
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]


def _join_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if held:
        ids, least = least_joined(*(np.concatenate(x) for x in zip(*held)))
        other = ids != least
        yield pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(least[other])], ["id", "class_id"])


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of edges (a, b): rows (id, class_id), class_id the least id of each.

    While there are more than ``FEW_EDGES`` edges, Kiveris et al.'s large-star and
    small-star steps alternate.  Every step is a min() with partial aggregation and
    a join with its result, which is written to the shared folder, so that Spark
    can split the rows of a vertex with very many neighbours; none is gathered into
    a list.  Rounds are staged in the shared folder.  Edges that are counted to be
    few are joined by one task: a round of steps is some five jobs, each of as many
    tasks as the shuffle has partitions, and the driver keeps what it knows of each.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    n, before, written = now.count(), None, []

    def joined(least: DataFrame) -> DataFrame:
        written.append(staged(least, name))
        return written[-1]

    while n > FEW_EDGES:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(joined(least), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = joined(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        nxt = staged(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
        unstage(now)
        while written:
            unstage(written.pop())
        state = tuple(nxt.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        now = nxt
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("class_id"))
        before, n = state, state[0]
    return now.coalesce(1).mapInArrow(_join_task, "id long, class_id long")

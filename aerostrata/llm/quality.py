"""Quality classifier: a convolutional network over bytes, in numpy.

A document's UTF-8 bytes are cut into half chunks of ``HALF`` bytes; two
neighbours make a chunk, so chunks overlap by half and cover the whole text.
Learned filters run over every second byte position; each filter's greatest
response in a chunk goes through a hidden layer; the chunks' hidden values are
combined, by their greatest and their mean, into one probability.

The network learns from a bounded sample of labelled rows (``training``), whole
texts, on the driver, with a fixed seed.  Scoring covers all bytes, keeps blocks
of about half a megabyte in memory, and depends on the text alone.

Defined results: null and empty texts are one half chunk of padding; a very long
text is scored and learned from whole, as a block of its own, some hundred half
chunks at a time; where no row may be learned from, or all have one label, the
score is constant (0.5, or that label's 0.001 or 0.999); equal texts have equal
scores, whatever their ids (null is one, not held out); repeated rows get a row
each; an empty table gives no rows; other columns are ignored (``accepted`` keeps
them all, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin_task, blocks, crc_mod, ensure_path, release_memory
from .training import PLACES, Adam, doubled, labelled_sample, segment_max, sigmoid

HALF, WIDTH, STRIDE = 128, 5, 2
EMBED, FILTERS, HIDDEN = 8, 32, 16
BATCH, STEPS, SEED = 32, 500, 11
#: Half chunks handled at a time.
STEP = 256
THRESHOLD = 0.3


def half_chunks(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of HALF bytes and the WIDTH - 1 that follow (0 beyond the text), and each text's first row."""
    counts = np.array([max(1, -(-len(x) // HALF)) for x in raw], np.int64)
    ends = np.cumsum(counts)
    flat = np.frombuffer(b"".join(x.ljust(int(n) * HALF, b"\0") for x, n in zip(raw, counts)) + bytes(WIDTH - 1), np.uint8)
    rows = np.lib.stride_tricks.as_strided(flat, (int(ends[-1]), HALF + WIDTH - 1), (HALF, 1)).copy()
    rows[ends - 1, HALF:] = 0
    return rows, ends - counts


class ByteNet:
    def __init__(self, params: dict[str, np.ndarray] | None = None, constant: float | None = None):
        self.p, self.constant = params, constant

    @staticmethod
    def fresh(seed: int) -> ByteNet:
        r = np.random.default_rng(seed)
        f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        return ByteNet({"emb": f(256, EMBED, scale=0.5), "w1": f(WIDTH * EMBED, FILTERS, scale=0.3), "b1": np.zeros(FILTERS, np.float32), "w2": f(FILTERS, HIDDEN, scale=0.2), "b2": np.zeros(HIDDEN, np.float32), "w3": f(2 * HIDDEN, scale=0.1), "b3": np.zeros(1, np.float32)})

    def _windows(self, rows: np.ndarray) -> np.ndarray:
        x = self.p["emb"][rows]
        a, b, c = x.strides
        return np.lib.stride_tricks.as_strided(x, (len(rows), HALF // STRIDE, WIDTH * EMBED), (a, STRIDE * b, c))

    def _responses(self, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        for i in range(0, len(rows), STEP):
            win = self._windows(rows[i : i + STEP])
            yield slice(i, i + STEP), (win.reshape(-1, WIDTH * EMBED) @ self.p["w1"]).reshape(len(win), HALF // STRIDE, FILTERS)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Each filter's greatest response in each half chunk."""
        out = np.empty((len(rows), FILTERS), self.p["w1"].dtype)
        for some, z in self._responses(rows):
            out[some] = z.max(1)
        return np.maximum(out + self.p["b1"], 0)

    def head(self, halves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Logits from half chunks; a text of one half chunk is one chunk."""
        nxt = np.minimum(np.arange(len(halves)) + 1, len(halves) - 1)
        last = np.append(first[1:], len(halves)) - 1
        nxt[last] = last
        chunk = np.maximum(halves, halves[nxt])
        hidden = np.maximum(chunk @ self.p["w2"] + self.p["b2"], 0)
        count = np.diff(np.append(first, len(halves)))
        top, mean = segment_max(hidden, first), np.add.reduceat(hidden, first, axis=0) / count[:, None]
        both = np.concatenate([top, mean], 1)
        return (both * self.p["w3"]).sum(1) + self.p["b3"][0], both, hidden, chunk, nxt, count

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        rows, first = half_chunks([(t or "").encode() for t in texts])
        wide = ByteNet(doubled(self.p, *self.p))
        return np.round(sigmoid(wide.head(wide.pooled(rows), first)[0]), PLACES)

    def gradients(self, rows: np.ndarray, first: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Of the mean loss over the texts, each taken so many times."""
        p, times = self.p, np.ones(len(y)) if times is None else times
        at, raw = np.empty((len(rows), FILTERS), np.int64), np.empty((len(rows), FILTERS), np.float32)
        for some, z in self._responses(rows):
            at[some] = z.argmax(1)
            raw[some] = np.take_along_axis(z, at[some][:, None], 1)[:, 0] + p["b1"]
        halves = np.maximum(raw, 0)
        logit, both, hidden, chunk, nxt, count = self.head(halves, first)
        d = ((sigmoid(logit) - y) * times / times.sum()).astype(np.float32)
        g = {"w3": both.T @ d, "b3": np.array([d.sum()], np.float32)}
        d_both = d[:, None] * p["w3"]
        owner = np.repeat(np.arange(len(first)), count)
        d_hidden = (d_both[:, HIDDEN:] / count[:, None])[owner]
        is_top = hidden == both[owner, :HIDDEN]
        d_hidden += is_top * (d_both[:, :HIDDEN] / np.add.reduceat(is_top, first, axis=0, dtype=np.float32))[owner]  # ties share
        d_hidden *= hidden > 0
        g["w2"], g["b2"] = chunk.T @ d_hidden, d_hidden.sum(0)
        d_chunk = d_hidden @ p["w2"].T
        own = halves >= halves[nxt]
        d_half = d_chunk * own
        np.add.at(d_half, nxt, d_chunk * ~own)
        d_half *= raw > 0
        g["b1"] = d_half.sum(0)
        g["w1"], g["emb"] = np.zeros_like(p["w1"]), np.zeros_like(p["emb"])
        for f in range(FILTERS):
            i = np.flatnonzero(d_half[:, f])
            v = d_half[i, f]
            byte = rows[i[:, None], at[i, f][:, None] * STRIDE + np.arange(WIDTH)]
            g["w1"][:, f] = v @ p["emb"][byte].reshape(len(i), -1)
            for j, w in enumerate(p["w1"][:, f].reshape(WIDTH, EMBED)):
                g["emb"] += np.bincount(byte[:, j], v, 256)[:, None].astype(np.float32) * w
        return g


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray, steps: int = STEPS, seed: int = SEED) -> ByteNet:
    if len(y) == 0:
        return ByteNet(constant=0.5)
    if len(set(y.tolist())) == 1:
        return ByteNet(constant=0.999 if y[0] else 0.001)
    net, r = ByteNet.fresh(seed), np.random.default_rng(seed)
    adam, raw = Adam(net.p), [t.encode() for t in texts]
    classes = [np.flatnonzero(y == 0), np.flatnonzero(y == 1)]
    for step in range(steps):
        # as many of each class in a step; the classes' shares come back in the last bias
        pick = np.concatenate([r.choice(c, BATCH // 2) for c in classes])
        pick, times = np.unique(pick, return_counts=True)
        rows, first = half_chunks([raw[i] for i in pick])
        adam.step(net.gradients(rows, first, y[pick], times), min(1.0, 2 * (1 - step / steps)))
    net.p["b3"] += np.float32(np.log(weight[y == 1].sum() / weight[y == 0].sum()))
    return net


def _score_task(net: ByteNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for part in blocks(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(net.scores(part.column("text").to_pylist()), pa.float64())], ["doc_id", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> ByteNet:
    texts, y, weight, _ = labelled_sample(docs, labels, "quality", crc_mod("doc_id", 5) != 0)
    net = fit(texts, y, weight)
    del texts
    release_memory()  # the driver's
    return net


def score(docs: DataFrame, net: ByteNet) -> DataFrame:
    """doc_id and score of every row."""
    ensure_path(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score_task(net), "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs, train(docs, labels))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _keep_task(net: ByteNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for part in blocks(batch):
                kept = net.scores(part.column("text").to_pylist()) >= THRESHOLD
                yield part.filter(pa.array(kept))
        release_memory()

    return run


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that the classifier does not reject."""
    ensure_path(docs.sparkSession)
    return docs.mapInArrow(_keep_task(train(docs, labels)), docs.schema)

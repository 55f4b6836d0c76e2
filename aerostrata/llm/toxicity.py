"""Toxicity: a convolutional classifier over hashed word embeddings, in numpy.

A word (run of ASCII letters and digits or of other characters, ASCII letters
in lower case) is the mean of four rows of one hashed table: its own and those of
its first three, five and seven bytes.  Filters over one, two and three
words run along the whole text; their greatest responses make one score.  Rows
of words never seen in learning keep their small first values and say little.

The model learns from all labelled rows, whole texts, with fixed seeds.  Rows are
dealt to shards of about ``SHARD_BYTES`` of text; in each of ``ROUNDS`` rounds a task
goes on from the same parameters over all texts of its shard, in steps that hold as
many of each class, and what shards changed is averaged (a table row over those
that changed it).  A class of few rows goes to several shards, so that none lacks
it.  A fifth of the rows is kept back to calibrate a threshold for each language,
the one with the best F1 there; a language of fewer than ``LANG_LEAST`` such rows of
each class (or none) takes the threshold over all languages; where a class has
fewer than ``BACK_LEAST`` rows, all are learned from and the threshold is
``THRESHOLD``.  A language chooses a threshold only: it is no input of the score.
The driver holds the parameters, and score, class and language of rows kept back.

Defined results: null and empty texts have the score of a text without words; a
very long text is scored and learned from whole, some ten thousand words at a
time; without rows to learn from the score is 0.5, with one class that label's
0.001 or 0.999, and where the texts of a class have no word at all, label 1's
share of the rows that may be learned from; equal texts have equal scores,
whatever their ids (null is one, not held out); of tied responses a text's first
counts; repeated rows get a row each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PUNCTUATION, Words, begin_task, blocks, crc_mod, ensure_path, release_memory, staged, unstage
from .training import PLACES, Adam, doubled, labelled_rows, segment_max, sigmoid

TABLE_BITS, EMBED, FILTERS, WIDTHS = 17, 12, 12, (1, 2, 3)
PREFIXES = (3, 5, 7)
BATCH, ROUNDS, LEAST_STEPS, SEED = 32, 4, 800, 7
#: Bytes of text that a task learns from, about; rows of each class that it should have at least; rows of a class from which on a fifth is kept back.
SHARD_BYTES, RARE, BACK_LEAST = 16 << 20, 50, 25
#: The table's rows are averaged in so many pieces.
PIECES = 16
#: Words handled at a time.
STEP = 1 << 14
THRESHOLD = 0.7
LANG_LEAST = 10


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word (one column for the word, one for each prefix), and each text's word range."""
    words = Words(texts, PUNCTUATION)
    cols = [words.hashes(lower=True)]
    code = words.lower_code()
    for i, n in enumerate(PREFIXES):
        cols.append(words.span_hashes(words.start, np.minimum(words.end, words.start + n), code) ^ np.uint64(i + 1 << 40))
    shift = np.uint64(64 - TABLE_BITS)
    mult = np.uint64(0x9E3779B97F4A7C15)
    return np.stack([(c * mult >> shift).astype(np.int32) for c in cols], 1), words.doc


class WordNet:
    def __init__(self, params: dict[str, np.ndarray] | None = None, constant: float | None = None):
        self.p, self.constant = params, constant

    @staticmethod
    def fresh(seed: int) -> WordNet:
        r = np.random.default_rng(seed)
        p = {"emb": (r.standard_normal((1 << TABLE_BITS, EMBED)) * 0.05).astype(np.float32), "b": np.full(FILTERS * len(WIDTHS), 0.05, np.float32), "out": (r.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32), "bias": np.zeros(1, np.float32)}
        for k in WIDTHS:
            p[f"w{k}"] = (r.standard_normal((k, EMBED, FILTERS)) * 0.4).astype(np.float32)
        return WordNet(p)

    def embed(self, rows: np.ndarray) -> np.ndarray:
        x = self.p["emb"][rows[:, 0]]
        for j in range(1, rows.shape[1]):
            x += self.p["emb"][rows[:, j]]
        return x / rows.shape[1]

    def responses(self, x: np.ndarray, left: np.ndarray, n: int) -> np.ndarray:
        """Filters' responses at the first n words of x, which have so many words left in their texts; a wide filter sees zeros beyond its text's end."""
        out = np.empty((n, FILTERS * len(WIDTHS)), self.p["w1"].dtype)
        for i, k in enumerate(WIDTHS):
            z = x[:n] @ self.p[f"w{k}"][0]
            for j in range(1, k):
                m = min(n, len(x) - j)
                z[:m] += (x[j : j + m] @ self.p[f"w{k}"][j]) * (left[:m] > j)[:, None]
            out[:, i * FILTERS : (i + 1) * FILTERS] = z
        return out

    def peaks(self, embedded, doc: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each filter's greatest response in each text (all have words), and where it first is; embedded(a, b) gives words a to b."""
        n, width = int(doc[-1]), FILTERS * len(WIDTHS)
        owner = np.repeat(np.arange(len(doc) - 1), np.diff(doc))
        top = np.full((len(doc) - 1, width), -np.inf, self.p["w1"].dtype)
        at = np.zeros(top.shape, np.int64) if places else None
        for a in range(0, n, STEP):
            b = min(n, a + STEP)
            z = self.responses(embedded(a, min(n, b + WIDTHS[-1] - 1)), doc[owner[a:b] + 1] - np.arange(a, b), b - a)
            texts = np.arange(owner[a], owner[b - 1] + 1)
            first = np.maximum(doc[texts] - a, 0)
            best = segment_max(z, first)
            if places:
                here = np.stack([z[i:j].argmax(0) + a + i for i, j in zip(first, np.append(first[1:], b - a))])
                at[texts] = np.where(best > top[texts], here, at[texts])
            top[texts] = np.maximum(top[texts], best)
        return top, at

    def logits(self, rows: np.ndarray, doc: np.ndarray) -> np.ndarray:
        out = np.full(len(doc) - 1, self.p["bias"][0], np.float64)
        full = np.flatnonzero(np.diff(doc))
        if len(full):
            top, _ = self.peaks(lambda a, b: self.embed(rows[a:b]).astype(self.p["w1"].dtype), np.append(doc[full], doc[-1]))
            out[full] += (np.maximum(top + self.p["b"], 0) * self.p["out"]).sum(1)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        wide = WordNet(doubled(self.p, *(k for k in self.p if k != "emb")))
        return np.round(sigmoid(wide.logits(*features(texts))), PLACES)

    def step(self, adam: Adam, squares: np.ndarray, rows: np.ndarray, doc: np.ndarray, y: np.ndarray, times: np.ndarray, scale: float, r: np.random.Generator) -> None:
        """One step of Adam (filters) and Adagrad (table rows in use); texts have at least a word each and count so many times."""
        p, k_all = self.p, rows.shape[1]
        keep = np.ones(rows.shape, np.float32)
        keep[:, 0] = r.random(len(rows)) > 0.3  # words' own rows drop out, so prefixes learn too
        x = sum(p["emb"][rows[:, j]] * keep[:, j : j + 1] for j in range(k_all)) / k_all
        top, place = self.peaks(lambda a, b: x[a:b], doc, places=True)
        h = np.maximum(top + p["b"], 0)
        logit = h @ p["out"] + p["bias"][0]
        d = ((sigmoid(logit) - y) * times / times.sum()).astype(np.float32)
        g = {"out": h.T @ d + 1e-4 * p["out"], "bias": np.array([d.sum()], np.float32)}
        d_h = d[:, None] * p["out"] * (h > 0)
        g["b"] = d_h.sum(0)
        text, f = np.nonzero(d_h)
        at, v = place[text, f], d_h[text, f]
        d_x = np.zeros_like(x)
        for i, k in enumerate(WIDTHS):
            mine = (f >= i * FILTERS) & (f < (i + 1) * FILTERS)
            w, g[f"w{k}"] = p[f"w{k}"], np.zeros_like(p[f"w{k}"])
            for j in range(k):
                ok = mine & (at + j < doc[text + 1])
                a, ff, vv = at[ok] + j, f[ok] - i * FILTERS, v[ok, None]
                np.add.at(g[f"w{k}"][j].T, ff, x[a] * vv)
                np.add.at(d_x, a, w[j].T[ff] * vv)
        adam.step(g, scale)
        used = np.flatnonzero(np.abs(d_x).sum(1))
        for j in range(k_all):
            ids, back = np.unique(rows[used, j], return_inverse=True)
            grad = np.zeros((len(ids), EMBED), np.float32)
            np.add.at(grad, back, d_x[used] * keep[used, j : j + 1] / k_all)
            squares[ids] += (grad**2).sum(1)
            p["emb"][ids] -= 0.5 * scale * grad / np.sqrt(squares[ids] + 1e-10)[:, None]


def _all_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """features() of a list of texts, some at a time."""
    parts = [features(texts[i : i + 100]) for i in range(0, len(texts), 100)]
    counts = np.concatenate([np.diff(doc) for _, doc in parts])
    return np.concatenate([rows for rows, _ in parts]), np.append(0, np.cumsum(counts))


class Learner:
    """A net on its way: parameters, and what Adam and Adagrad remember."""

    def __init__(self, seed: int = SEED):
        self.net, self.seed = WordNet.fresh(seed), seed
        self.adam = Adam({k: v for k, v in self.net.p.items() if k != "emb"}, 0.01)
        self.squares = np.zeros(len(self.net.p["emb"]), np.float32)

    def dense(self) -> list[np.ndarray]:
        return [x[k] for x in (self.adam.params, self.adam.m, self.adam.v) for k in sorted(self.adam.params)]

    def go_on(self, rows: np.ndarray, doc: np.ndarray, y: np.ndarray, turn: int, turns: int, shard: int = 0) -> None:
        """One round over a shard: every text with words at least once, as many of each class in a step."""
        classes = [x for x in (np.flatnonzero((y == c) & (np.diff(doc) > 0)) for c in (0, 1)) if len(x)]
        if not classes:
            return
        r, half = np.random.default_rng((self.seed, turn, shard)), BATCH // 2
        steps = max(-(-LEAST_STEPS // turns), -(-max(map(len, classes)) // half))
        order = [np.concatenate([r.permutation(c) for _ in range(-(-steps * half // len(c)))]) for c in classes]
        for step in range(steps):
            pick, times = np.unique(np.concatenate([o[step * half : (step + 1) * half] for o in order]), return_counts=True)
            words = np.concatenate([rows[doc[i] : doc[i + 1]] for i in pick])
            self.net.step(self.adam, self.squares, words, np.append(0, np.cumsum(np.diff(doc)[pick])), y[pick], times, min(1.0, 2 * (1 - (turn + step / steps) / turns)), r)

    def done(self, share: float) -> WordNet:
        """The net, with label 1's share of the rows in its bias."""
        self.net.p["bias"] += np.float32(np.log(share / (1 - share)))
        return self.net


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray, epochs: int = ROUNDS, seed: int = SEED) -> WordNet:
    """A net from texts at hand: what train() learns from one shard."""
    if len(y) == 0:
        return WordNet(constant=0.5)
    if len(set(y.tolist())) == 1:
        return WordNet(constant=0.999 if y[0] else 0.001)
    rows, doc = _all_features(texts)
    share = float(weight[y == 1].sum() / weight.sum())
    if not all(((y == c) & (np.diff(doc) > 0)).any() for c in (0, 1)):
        return WordNet(constant=share)
    learner = Learner(seed)
    for turn in range(epochs):
        learner.go_on(rows, doc, y, turn, epochs)
    return learner.done(share)


def best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The middle of the best-F1 gap between neighbouring scores; THRESHOLD itself where it is as good."""
    order = np.argsort(score, kind="stable")
    cuts, first = np.unique(score[order], return_index=True)
    hits = np.append(np.cumsum((y[order] == 1)[::-1])[::-1], 0)  # of label 1 from each place on
    at = np.append(np.searchsorted(score[order], THRESHOLD), first[1:])
    f1 = 2 * hits[at] / np.maximum(1, len(y) - at + hits[0])
    cuts = np.append(THRESHOLD, (cuts[1:] + cuts[:-1]) / 2)
    return float(cuts[np.lexsort((np.arange(len(cuts)), np.abs(cuts - THRESHOLD), -f1))[0]])


def calibrate(score: np.ndarray, y: np.ndarray, langs: np.ndarray) -> dict[str | None, float]:
    """A threshold for each language with enough rows; under None that for all others."""
    if not len(y):
        return {None: THRESHOLD}
    out: dict[str | None, float] = {None: best_threshold(score, y)}
    for lang in np.unique(langs[langs != ""]).tolist():
        own = langs == lang
        if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= LANG_LEAST:
            out[lang] = best_threshold(score[own], y[own])
    return out


def _to_bytes(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as f:
        f.write_table(table)
    return out.getvalue()


def _from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard; a row for each shard, with all of it, and how many texts of each class have words to learn from."""
    begin_task()
    shard, held = None, []

    def close() -> pa.RecordBatch:
        whole = pa.concat_tables(held)
        y, mine = whole["y"].to_numpy(), ~whole["back"].to_numpy()
        some = np.array([Words([t], PUNCTUATION).counts[0] > 0 for t in whole["text"].to_pylist()], bool) & mine
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int((some & (y == 0)).sum())]), pa.array([int((some & (y == 1)).sum())]), pa.array([_to_bytes(whole)], pa.binary())], ["shard", "n0", "n1", "rows"])

    for batch in batches:
        s = batch.column("shard").to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(s)]
        for a, b in zip(cut[:-1], cut[1:]):
            if a < b:
                if held and s[a] != shard:
                    yield close()
                    held = []
                shard = int(s[a])
                held.append(pa.Table.from_batches([batch.slice(a, b - a).select(["y", "text", "lang", "back"])]))
    if held:
        yield close()
    release_memory()


_CHANGE = "piece int, shard int, ids binary, data binary"
_CHANGE_NAMES = ["piece", "shard", "ids", "data"]


def _learn_task(learner: Learner, turn: int, turns: int):
    """What a round over each shard changes: rows of the table by piece, and (last piece) all other numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import copy

        begin_task()
        before = np.column_stack([learner.net.p["emb"], learner.squares])
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("rows")):
                table = _from_bytes(data.as_py())
                table = table.filter(pc.invert(table["back"]))
                rows, doc = _all_features(table["text"].to_pylist())
                own = copy.deepcopy(learner)
                own.go_on(rows, doc, table["y"].to_numpy().astype(np.float32), turn, turns, shard)
                change = np.column_stack([own.net.p["emb"], own.squares]) - before
                ids = np.flatnonzero(change.any(1)).astype(np.int32)
                parts = np.split(ids, np.searchsorted(ids, np.arange(1, PIECES) << (TABLE_BITS - 4)))
                dense = np.concatenate([x.ravel() for x in own.dense()])
                out = [list(range(PIECES + 1)), [shard] * (PIECES + 1), [x.tobytes() for x in parts] + [b""], [change[x].tobytes() for x in parts] + [dense.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], _CHANGE_NAMES)
        release_memory()

    return run


def _mean_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (piece, shard): the mean of each number over the shards that changed it; one piece in memory."""
    now, total, count = None, None, None

    def close() -> pa.RecordBatch:
        ids = np.flatnonzero(count).astype(np.int32)
        mean = (total[ids] / count[ids, None]).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([0], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([mean.tobytes()], pa.binary())], _CHANGE_NAMES)

    for batch in batches:
        for piece, ids, data in zip(batch.column("piece").to_pylist(), batch.column("ids"), batch.column("data")):
            x = np.frombuffer(data.as_py(), np.float32)
            ids = np.frombuffer(ids.as_py(), np.int32) if piece < PIECES else np.arange(1)
            if piece != now:
                if now is not None:
                    yield close()
                now, width = piece, EMBED + 1 if piece < PIECES else len(x)
                total, count = np.zeros((1 << TABLE_BITS if piece < PIECES else 1, width)), np.zeros(1 << TABLE_BITS if piece < PIECES else 1, np.int64)
            total[ids] += x.reshape(len(ids), -1) if len(ids) else 0
            count[ids] += 1
    if now is not None:
        yield close()


def _back_task(net: WordNet):
    """Score, class and language of the rows kept back, a row for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("rows")):
                table = _from_bytes(data.as_py())
                table = table.filter(table["back"])
                score = [net.scores(part.column("text").to_pylist()) for b in table.to_batches() for part in blocks(b)]
                out = pa.table({"score": np.concatenate([np.empty(0), *score]), "y": table["y"].cast(pa.int8()), "lang": table["lang"].cast(pa.string())})
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([_to_bytes(out)], pa.binary())], ["shard", "rows"])
        release_memory()

    return run


def train(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[WordNet, dict[str | None, float]]:
    """The net learned from all rows that may be learned from, and the languages' thresholds."""
    ensure_path(docs.sparkSession)
    constant = lambda x: (WordNet(constant=x), {None: THRESHOLD})
    known = staged(labelled_rows(docs, labels, "toxic", crc_mod("doc_id", 3) != 1), "toxicity-rows")
    n, size = {}, 0
    for r in known.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect():
        n[r.y], size = r.n, size + r.size
    if len(n) < 2:
        unstage(known)
        return constant(0.5 if not n else 0.999 if 1 in n else 0.001)
    shards = max(1, -(-size // shard_bytes))
    back = F.lit(False) if min(n.values()) < BACK_LEAST else F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 4
    copies = F.lit(1)
    for y in n:
        if n[y] < RARE * shards:
            copies = F.when((F.col("y") == y) & ~F.col("back"), F.lit(min(shards, -(-RARE * shards // n[y])))).otherwise(copies)
    dealt = known.withColumn("back", back).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id") + F.col("copy"), F.lit(shards)).cast("int"))
    dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id").select("shard", "y", "text", "lang", "back")
    packs = staged(dealt.mapInArrow(_pack_task, "shard int, n0 long, n1 long, rows binary"), "toxicity-shards")
    unstage(known)
    share = n[1] / (n[0] + n[1])
    if not all(packs.agg(F.sum("n0"), F.sum("n1")).first()):
        unstage(packs)
        return constant(share)
    learner = Learner()
    for turn in range(ROUNDS):
        change = packs.select("shard", "rows").mapInArrow(_learn_task(learner, turn, ROUNDS), _CHANGE)
        for r in change.repartitionById(PIECES + 1, "piece").sortWithinPartitions("piece", "shard").mapInArrow(_mean_task, _CHANGE).collect():
            mean = np.frombuffer(r.data, np.float32)
            if r.piece < PIECES:
                ids, mean = np.frombuffer(r.ids, np.int32), mean.reshape(-1, EMBED + 1)
                learner.net.p["emb"][ids] += mean[:, :-1]
                learner.squares[ids] += mean[:, -1]
            else:
                for x, new in zip(learner.dense(), np.split(mean, np.cumsum([x.size for x in learner.dense()])[:-1])):
                    x[...] = new.reshape(x.shape)
        # Adam counts steps to undo its first moments' start from zero, which a round's steps have done
        learner.adam.t += -(-LEAST_STEPS // ROUNDS)
    net = learner.done(share)
    kept = [_from_bytes(r.rows) for r in sorted(packs.select("shard", "rows").mapInArrow(_back_task(net), "shard int, rows binary").collect(), key=lambda r: r.shard)]
    unstage(packs)
    kept = pa.concat_tables(kept)
    return net, calibrate(kept["score"].to_numpy(), kept["y"].to_numpy(), np.array(kept["lang"].to_pylist(), object).astype(str) if len(kept) else np.empty(0, str))


def _score_task(net: WordNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for part in blocks(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(net.scores(part.column("text").to_pylist()), pa.float64())], ["doc_id", "lang", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_threshold, flagged (score at or over the language's threshold)."""
    ensure_path(docs.sparkSession)
    net, thresholds = train(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(_score_task(net), "doc_id long, lang string, score double")
    own = F.lit(thresholds[None])
    for lang, t in thresholds.items():
        if lang is not None:
            own = F.when(F.col("lang") == lang, F.lit(t)).otherwise(own)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), own.alias("lang_threshold"), (F.col("score") >= own).alias("flagged"))

"""LM scoring by cross-entropy difference.

Two bigram models of words, a target's and a background's, are matched: they
share one vocabulary (the words that occur at least twice in the target
documents; any other is one unknown word), one order and one way of smoothing
(Dirichlet: a pair's count and ``MU`` times the word's own probability, which in
turn has one count spread evenly).  The target model counts
the documents whose label says good quality, the background model counts all
documents.  A document's score is its mean loss per token under the target
model less that under the background model: the lower, the more it is like the
target.

Counts are exact, over every word of every document: nothing is pruned.  The
vocabulary and its words' counts are sorted arrays that grow with the corpus and
are broadcast (24 bytes a word).  The most frequent pairs of words (at most
``HOT``) are counted apart and broadcast, which keeps any one of them from
filling a task.  All other pairs, summed within each document, are dealt once to
parts by a hash of the pair; there they are counted, and their losses go back to
the documents.  Both ways they travel as packed arrays of a chunk of documents
(about ``HELD`` tokens), some bytes a pair.  Losses are summed as whole multiples
of 1 / ``UNIT``, so equal texts get equal sums in any order.

Defined results: null and empty texts have no tokens and losses and score 0;
documents without a label count for the background alone, and where no document
is labelled good the two models are one and scores are 0; a very long text is
counted whole, as a block of its own; repeated rows count
and are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, begin_task, blocks, bounded, ensure_path, mix64, release_memory, staged, unstage

LEAST, MU = 2, 4.0
#: Lists of at most so many labelled ids are broadcast.
LABEL_ROWS = 2_000_000
#: At most so many pairs of words are broadcast, the most frequent ones.
HOT = 1 << 14
#: Counts beyond this are not told apart where the most frequent pairs are chosen.
MOST_TOLD = 1 << 16
#: A pair may be chosen if it occurs so often in one worker's HELD tokens.
OFTEN = 8
#: A worker sums the words or pairs of so many tokens before it sends them on.
HELD = 1 << 20
#: A part's pairs get their losses about so many at a time.
RANGE = 1 << 17
UNIT = float(1 << 32)
BEGIN, UNKNOWN, FIRST = 0, 1, 2


def contexts(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The word before each, BEGIN at a document's begin."""
    left = np.empty_like(word)
    left[1:] = word[:-1]
    left[doc[:-1][np.diff(doc) > 0]] = BEGIN
    return left


def places(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key's place in a sorted array, and whether it is there."""
    if not len(among):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


def numbers(words: Words, vocabulary: np.ndarray) -> np.ndarray:
    """Words' numbers: FIRST and up in the vocabulary (sorted hashes), UNKNOWN outside."""
    distinct, back = np.unique(words.hashes().view(np.int64), return_inverse=True)
    at, there = places(distinct, vocabulary)
    return np.where(there, at + FIRST, UNKNOWN)[back]


def pairs(words: Words, vocabulary: np.ndarray) -> np.ndarray:
    """For each word, the number of the one before and its own in one."""
    word = numbers(words, vocabulary)
    return contexts(word, words.doc) << 32 | word


def _counted(key: np.ndarray, good: np.ndarray) -> pa.RecordBatch:
    """Distinct keys with their counts, in all documents and in good ones."""
    distinct, back = np.unique(key, return_inverse=True)
    n = np.bincount(back, minlength=len(distinct))
    n_good = np.bincount(back[good], minlength=len(distinct))
    return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n), pa.array(n_good)], ["key", "n", "n_good"])


def _count_task(keys, least: int = 1):
    """Counts of the keys (and their documents' places) of blocks' words, summed over about HELD words; keys of 0 and more only where they count least."""

    def sent(held: list) -> pa.RecordBatch:
        out = _counted(*(np.concatenate(x) for x in zip(*held)))
        if least == 1:
            return out
        return out.filter(pa.array((out.column("n").to_numpy() >= least) | (out.column("key").to_numpy() < 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in blocks(batch):
                words = Words(part.column("text").cast(pa.binary()).to_pylist())
                key, owner = keys(words)
                held.append((key, np.asarray(part.column("good").to_pylist(), bool)[owner]))
                size += len(key)
                if size >= HELD:
                    yield sent(held)
                    held, size = [], 0
        if size:
            yield sent(held)

    return run


def _counts(marked: DataFrame, keys, least: int = 1) -> DataFrame:
    sent = marked.mapInArrow(_count_task(keys, least), "key long, n long, n_good long")
    return sent.groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_good").alias("n_good"))


def _word_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    return words.hashes().view(np.int64), words.owner()


def _all_keys(known):
    """Pairs, and words (and documents' begins) as -1 less their numbers."""

    def keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
        pair, owner, full = pairs(words, known.value), words.owner(), np.flatnonzero(words.counts)
        return np.concatenate([pair, -1 - (pair & 0xFFFFFFFF), np.full(len(full), -1 - BEGIN)]), np.concatenate([owner, owner, full])

    return keys


def _hot_keys(known, hot):
    def keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
        pair, owner = pairs(words, known.value), words.owner()
        there = places(pair, hot.value)[1]
        return pair[there], owner[there]

    return keys


def _columns(df: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy() for c in df.toArrow().columns]


class Models:
    """Smoothed bigram probabilities of the target and of the background, from exact counts."""

    def __init__(self, words: list[np.ndarray]):
        self.words = words
        self.n_words = len(words[0]) - FIRST + 1
        self.totals = [float(w[UNKNOWN:].sum()) for w in words]

    def losses(self, key: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Losses of pairs that occur so often in target and background, in units."""
        left, word = key >> 32, key & 0xFFFFFFFF
        out = []
        for words, total, n in zip(self.words, self.totals, counts):
            one = (words[word] + 1 / self.n_words) / (total + 1)
            out.append(np.rint(-np.log((n + MU * one) / (words[left] + MU)) * UNIT).astype(np.int64))
        return out


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: small ones leave zeros in rows, which a shuffle's compression takes away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _from_planes(raw: memoryview, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T).view(kind).reshape(n)


def pack(*columns: np.ndarray) -> bytes:
    """Arrays in one piece of bytes: for each its length and kind, then its planes."""
    head = np.array([x for c in columns for x in (len(c), c.dtype.itemsize)], np.int64)
    return np.int64(len(columns)).tobytes() + head.tobytes() + b"".join(_planes(c) for c in columns)


def unpack(data: bytes | pa.Buffer, which: tuple[int, ...] | None = None) -> list[np.ndarray]:
    """The arrays, or those of some numbers."""
    view = memoryview(data)
    n = int(np.frombuffer(view, np.int64, 1)[0])
    head = np.frombuffer(view, np.int64, 2 * n, 8)
    at, out = 8 + 16 * n, []
    for i, (size, width) in enumerate(zip(head[0::2].tolist(), head[1::2].tolist())):
        if which is None or i in which:
            out.append(_from_planes(view[at:], size, f"i{width}"))
        at += size * width
    return out


_SENT = "part int, chunk long, data binary, doc_id array<long>, n_tokens array<long>, target array<long>, background array<long>"
_NAMES = ["part", "chunk", "data", "doc_id", "n_tokens", "target", "background"]


def _rows(part: list, chunk: list, data: list, doc_id=None, n_tokens=None, target=None, background=None) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    lists = [pa.array([x] if x is not None else [None] * len(part), longs) for x in (doc_id, n_tokens, target, background)]
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(chunk, pa.int64()), pa.array(data, pa.binary()), *lists], _NAMES)


def _send_task(shared, parts: int):
    """Of each chunk of documents a row with their ids, tokens and losses of frequent pairs, and for each part that pairs are dealt to one with its pairs, packed."""

    def sent(chunk: int, held: list) -> Iterator[pa.RecordBatch]:
        _, hot, target, background = shared.value
        ids = [i for x in held for i in x[0]]
        counts, key = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
        good = np.concatenate([x[3] for x in held])
        owner = np.repeat(np.arange(len(ids)), counts)
        distinct, back = np.unique(key, return_inverse=True)
        at, there = places(distinct, hot)
        ends, sums = np.append(0, np.cumsum(counts)), []
        for losses in (target, background):
            own = np.where(there, losses[at] if len(losses) else 0, 0)[back]
            total = np.zeros(len(own) + 1, np.int64)
            np.cumsum(own, out=total[1:])
            sums.append(np.diff(total[ends]))
        yield _rows([chunk % parts], [chunk], [None], ids, counts, *sums)
        cold = np.flatnonzero(~there)
        if not len(cold):
            return
        goes = (mix64(distinct[cold]) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(goes, kind="stable")
        rank = np.full(len(distinct), -1)
        rank[cold[order]] = np.arange(len(cold))
        mine = rank[back]
        entry, times = np.unique(mine[mine >= 0] * len(ids) + owner[mine >= 0], return_counts=True)
        place, doc = entry // len(ids), (entry % len(ids)).astype(np.int32)
        first = np.searchsorted(place, np.arange(len(cold) + 1))
        n_docs = np.diff(first).astype(np.int32)
        n_good = np.add.reduceat(times * good[doc], first[:-1]).astype(np.int32)
        keys, to = distinct[cold[order]], goes[order]
        cut = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
        data = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            x, y = first[a], first[b]
            data.append(pack(np.diff(keys[a:b], prepend=0), n_docs[a:b], n_good[a:b], doc[x:y], times[x:y].astype(np.int32)))
        yield _rows(to[cut[:-1]].tolist(), [chunk] * len(data), data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin_task()
        vocabulary = shared.value[0]
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in blocks(batch):
                words = Words(part.column("text").cast(pa.binary()).to_pylist())
                held.append((part.column("doc_id").to_pylist(), words.counts, pairs(words, vocabulary), np.asarray(part.column("good").to_pylist(), bool)))
                size += len(held[-1][2]) + words.n
                if size >= HELD:
                    yield from sent(chunk, held)
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield from sent(chunk, held)
        held = []
        release_memory()

    return run


def _whole_losses(key: np.ndarray, counts: tuple[np.ndarray, np.ndarray], models: Models) -> np.ndarray:
    """Losses of pairs under both models, from counts that stand at several places of a pair and are summed; about RANGE places at a time, cut by value."""
    step = max(1, RANGE // 64)
    ends = np.sort(key[::64])[step::step]
    which = np.searchsorted(ends, key, side="right").astype(np.int32)
    out = np.empty((2, len(key)), np.int64)
    for i in range(len(ends) + 1):
        some = np.flatnonzero(which == i)
        distinct, back = np.unique(key[some], return_inverse=True)
        whole = tuple(np.bincount(back, n[some], len(distinct)).astype(np.int64) for n in counts)
        for total, x in zip(out, models.losses(distinct, whole)):
            total[some] = x[back]
    return out


def _part_losses(pieces: list[tuple[int, pa.Buffer]], models: Models, alone: bool) -> Iterator[pa.RecordBatch]:
    """Of a part's pieces (a chunk's pairs each, packed): its documents' losses, packed.  Pieces stay packed; what is needed of one is unpacked when it is."""
    size = np.array([np.frombuffer(raw, np.int64, 1, 8)[0] for _, raw in pieces])
    ends = np.cumsum(size)
    key, n, n_good = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.int32), np.empty(ends[-1], np.int32)
    for (_, raw), a, b in zip(pieces, (ends - size).tolist(), ends.tolist()):
        gaps, n_docs, n_good[a:b], times = unpack(raw, (0, 1, 2, 4))
        np.cumsum(gaps, out=key[a:b])
        n[a:b] = np.add.reduceat(times, np.cumsum(n_docs) - n_docs)
    losses = _whole_losses(key, (n if alone else n_good, n), models)
    del key, n, n_good
    for (chunk, raw), a, b in zip(pieces, (ends - size).tolist(), ends.tolist()):
        n_docs, doc, times = unpack(raw, (1, 3, 4))
        order = np.argsort(doc, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(doc[order]) != 0))
        sums = [np.add.reduceat((np.repeat(x[a:b], n_docs) * times)[order], first) for x in losses]
        yield _rows([None], [chunk], [pack(doc[order][first], *sums)])


def _loss_task(models, alone: bool):
    """Counts of a part's pairs over all chunks; their losses, summed for each document, packed; other rows stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        held, batch, data = [], None, None
        for batch in batches:
            data = batch.column("data")
            plain = batch.filter(pc.is_null(data))
            if len(plain):
                yield plain
            # pieces of the batch's own memory, not copies
            held += [(chunk, raw.as_buffer()) for chunk, raw in zip(batch.column("chunk").to_pylist(), data) if raw.is_valid]
        if held:
            yield from _part_losses(held, models.value, alone)
        held, batch, data = [], None, None
        release_memory()

    return run


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk, its documents' row first: a row for each document with its whole losses."""

    def summed(row: dict, sums: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(row["doc_id"], pa.int64()), pa.array(row["n_tokens"], pa.int64()), *map(pa.array, sums)], ["doc_id", "n_tokens", "target", "background"])

    now, row, sums = None, None, []
    for batch in batches:
        for i, (chunk, raw) in enumerate(zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist())):
            if raw is None:
                if now is not None:
                    yield summed(row, sums)
                now, row = chunk, batch.slice(i, 1).to_pylist()[0]
                sums = [np.array(row[c], np.int64) for c in ("target", "background")]
            else:
                doc, *more = unpack(raw)
                for total, x in zip(sums, more):
                    total[doc] += x
    if now is not None:
        yield summed(row, sums)


def _least_hot(counted: DataFrame) -> int:
    """The least count from which on there are at most HOT pairs."""
    told = counted.groupBy(F.least("n", F.lit(MOST_TOLD)).alias("n")).agg(F.count(F.lit(1)).alias("pairs"))
    total, least = 0, MOST_TOLD
    for r in sorted(told.collect(), reverse=True):
        total += r.pairs
        if total > HOT:
            break
        least = r.n
    return least


def train(marked: DataFrame):
    """Of documents marked good or not: the vocabulary (broadcast), both models, whether the target is empty, and the frequent pairs with their counts in target and background."""
    context = marked.sparkSession.sparkContext
    seen = _counts(marked.where("good"), _word_keys)
    vocabulary = np.sort(_columns(seen.where(F.col("n") >= LEAST).select("key"))[0])
    known = context.broadcast(vocabulary)
    counted = staged(_counts(marked, _all_keys(known), OFTEN), "lm-counts")
    words = [np.zeros(len(vocabulary) + FIRST) for _ in range(2)]
    word, n, n_good = _columns(counted.where("key < 0"))
    words[0][-1 - word], words[1][-1 - word] = n_good, n
    often = counted.where("key >= 0")
    hot = np.sort(_columns(often.where(F.col("n") >= _least_hot(often)).select("key"))[0])
    pair, n, n_good = _columns(_counts(marked, _hot_keys(known, context.broadcast(hot))))
    order = np.argsort(pair)
    unstage(counted)
    alone = not words[0].any()
    if alone:
        words[0], n_good = words[1], n
    return known, Models(words), alone, pair[order], (n_good[order], n[order])


def score(docs: DataFrame, good_ids: DataFrame) -> DataFrame:
    """Every row's doc_id, n_tokens, target_loss, background_loss, score; good_ids (good_id) are the target's."""
    spark = docs.sparkSession
    ensure_path(spark)
    good_ids = staged(good_ids.where("good_id is not null").distinct(), "lm-good")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(bounded(good_ids, LABEL_ROWS), F.col("doc_id") == F.col("good_id"), "left").select("doc_id", "text", F.col("good_id").isNotNull().alias("good"))
    known, models, alone, hot, counts = train(marked.select("text", "good"))
    losses = models.losses(hot, counts)
    shared, models = spark.sparkContext.broadcast((known.value, hot, *losses)), spark.sparkContext.broadcast(models)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = marked.mapInArrow(_send_task(shared, parts), _SENT)
    counted = sent.repartition(parts, "part").mapInArrow(_loss_task(models, alone), _SENT)
    sums = counted.repartition(parts, "chunk").sortWithinPartitions("chunk", F.col("data").isNotNull()).mapInArrow(_sum_task, "doc_id long, n_tokens long, target long, background long")
    n, t, b = F.greatest("n_tokens", F.lit(1)) * UNIT, F.col("target"), F.col("background")
    return sums.select("doc_id", "n_tokens", (t / n).alias("target_loss"), (b / n).alias("background_loss"), ((t - b) / n).alias("score"))


def good_documents(labels: DataFrame) -> DataFrame:
    return labels.where("quality > 0").select(F.col("doc_id").alias("good_id"))

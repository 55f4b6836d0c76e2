"""Substring dedup by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document.  Each word covered by
a window whose word sequence also starts in a document with a smaller doc_id is
removed; windows are judged on the input.

1. One pass over all texts writes each as a stream of word codes (a byte of each
   word's hash) and picks from every window the ``PHRASE``-word phrase of least
   hash (winnowing): two equal windows have the same one.  It also takes a key of
   the whole word sequence; a document equal to one of smaller id needs no
   further look, all its windows recur.
2. Picked phrases (as codes) are confirmed to recur: documents of different ids
   pick them, a grouped aggregate with map-side combine.
3. The recurring phrases are dealt to shards of at most about ``SHARD_PHRASES``,
   each compiled to an Aho-Corasick automaton, which bounds a worker's memory.  A
   phrase's shard follows from the ``GRAM`` of its codes that hash least, so every
   place of every stream (of each different text) has one shard whose phrases may
   begin there.  Streams are cut into runs of places of one shard and each run is
   sent through that shard's automaton; the hits alone say where phrases occur.
   Runs overlap by a phrase, so some four times the streams' bytes are read,
   however many shards there are.
4. Windows whose least phrase was hit are candidates, confirmed by a 96-bit hash
   of their words: the least doc_id of each is an aggregate with map-side
   combine, written out and then joined, so that Spark can split a hot passage.
5. Confirmed windows mark words; what is left is hashed.

Codes may agree where words differ; that costs a candidate, no word.

Defined results: null and empty texts have no words (and the digest of the empty
string); very long texts are handled whole, each as a block of its own; a null
doc_id is smaller than none and none is smaller than it, so its row keeps its
words and costs no other row any; rows that share a doc_id are judged each by
itself and do not remove one another's words; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bagminhash import ID_ROWS
from .common import Words, begin_task, blocks, bounded, ensure_path, mix64, release_memory, staged, unstage, windows

WINDOW, PHRASE = 50, 8
#: Codes of a phrase that choose its shard.
GRAM = 4
#: Phrases that one automaton holds at most, about; some 200 MB.
SHARD_PHRASES = 1 << 19

_NO_WORDS = hashlib.sha256(b"").hexdigest()


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value in each run of width values."""
    done, at = 1, np.arange(len(x))
    while done < width:
        step = min(done, width - done)
        a, b = at[:-step], at[step:]
        at = np.where(x[b] < x[a], b, a)
        done += step
    return at


def least_phrases(phrases: np.ndarray, first: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the place of its least phrase among the phrases, and its first word."""
    counts = np.diff(doc)
    room = np.maximum(counts - (window - 1), 0)
    if not room.sum():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    per_doc = np.maximum(counts - (PHRASE - 1), 0)
    begin = np.cumsum(per_doc) - per_doc  # of each document's phrases
    least = sliding_argmin(phrases, window - PHRASE + 1)
    at = np.repeat(begin, room) + (np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room))
    return least[at], first[at]


def word_codes(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(56)).astype(np.uint8)


def phrase_codes(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The codes of the PHRASE words from each place on, as one number."""
    out = np.zeros(len(first), np.uint64)
    for j in range(PHRASE):
        out |= codes[first + j].astype(np.uint64) << np.uint64(8 * j)
    return out.view(np.int64)


def sequence_keys(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each document's words."""
    counts = np.diff(doc)
    out = []
    for salt in (11, 12):
        key = np.full(len(counts), salt, np.uint64)
        full = np.flatnonzero(counts)
        if len(full):
            place = np.arange(len(h)) - np.repeat(doc[:-1], counts)
            mixed = mix64(mix64(h + np.uint64(salt)) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            key[full] = np.add.reduceat(mixed, doc[:-1][full])
        out.append(mix64(key + counts.astype(np.uint64)))
    return out[0], out[1]


_SCANNED = "doc_id long, n_words long, digest binary, k1 long, k2 long, codes binary, picks array<long>"


def _scan_task(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for part in blocks(batch):
                raw = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                words = Words(raw)
                h = words.hashes()
                k1, k2 = sequence_keys(h, words.doc)
                codes = word_codes(h)
                phrases, first = windows(h, words.doc, PHRASE)
                place, _ = least_phrases(phrases, first, words.doc, window)
                new = place[np.append(True, place[1:] != place[:-1])] if len(place) else place
                ends = np.searchsorted(np.searchsorted(words.doc, first[new], side="right") - 1, np.arange(len(raw) + 1))
                picks = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(phrase_codes(codes, first[new])))
                flat = codes.tobytes()
                streams = [flat[a:b] for a, b in zip(words.doc[:-1].tolist(), words.doc[1:].tolist())]
                # bytes.split() cuts at the same six characters
                digests = [hashlib.sha256(b" ".join(t.split())).digest() for t in raw]
                cols = [part.column("doc_id"), pa.array(words.counts), pa.array(digests, pa.binary()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(streams, pa.binary()), picks]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "digest", "k1", "k2", "codes", "picks"])
        release_memory()

    return run


def automaton(phrases: bytes):
    """An Aho-Corasick automaton of phrases of word codes, laid end to end; None of none."""
    import ahocorasick

    machine, text = ahocorasick.Automaton(ahocorasick.STORE_INTS), phrases.decode("latin-1")
    for i in range(0, len(text), PHRASE):
        machine.add_word(text[i : i + PHRASE], 1)
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def occurrences(machine, codes: bytes) -> list[int]:
    """Where the automaton's phrases begin in a stream."""
    if machine is None or len(codes) < PHRASE:
        return []
    return [end - PHRASE + 1 for end, _ in machine.iter(codes.decode("latin-1"))]


def shard_of(codes: np.ndarray, first: np.ndarray, shards: int) -> np.ndarray:
    """The shard of the phrase at each place: a hash of the GRAM codes in it that hash least, so neighbouring phrases often share theirs."""
    if not len(first):
        return np.empty(0, np.int64)
    wide = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        wide |= codes[j : j + len(wide)].astype(np.uint64) << np.uint64(8 * j)
    wide = mix64(wide)
    least = wide[: len(codes) - PHRASE + 1].copy()
    for j in range(1, PHRASE - GRAM + 1):
        np.minimum(least, wide[j : j + len(least)], out=least)
    return (mix64(least[first]) % np.uint64(shards)).astype(np.int64)


def _planes(*columns: np.ndarray, dtype: str) -> bytes:
    """Columns of numbers, the first bytes of all, then the second ones: those that are all zero shrink to nothing in a shuffle."""
    return np.stack(columns).astype(dtype).view(np.uint8).reshape(len(columns), -1, np.dtype(dtype).itemsize).transpose(0, 2, 1).tobytes()


def _from_planes(data: bytes, n: int, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(n, size, -1).transpose(0, 2, 1)).view(dtype)[:, :, 0]


_DEALT = "shard int, kind int, data binary, pieces binary, docs binary"


def _pack_task(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrase = batch.column("phrase").to_numpy()
            shard = shard_of(phrase.view(np.uint8), np.arange(len(phrase)) * PHRASE, shards)
            order = np.argsort(shard, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else order
            packs = [phrase[x].tobytes() for x in np.split(order, cut[1:])][: len(cut)]
            yield pa.RecordBatch.from_arrays([pa.array(shard[order][cut], pa.int32()), pa.array([0] * len(cut), pa.int32()), pa.array(packs, pa.binary()), pa.nulls(len(cut), pa.binary()), pa.nulls(len(cut), pa.binary())], ["shard", "kind", "data", "pieces", "docs"])

    return run


def _deal_task(shards: int):
    """Streams cut into runs of places whose phrases have one shard, each sent there with the codes to its last phrase's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for part in blocks(batch, "codes"):
                streams = part.column("codes").to_pylist()
                codes = np.frombuffer(b"".join(streams), np.uint8)
                size = np.array([len(x) for x in streams], np.int64)
                begin = np.cumsum(size) - size
                room = np.maximum(size - (PHRASE - 1), 0)
                first = np.repeat(begin - (np.cumsum(room) - room), room) + np.arange(room.sum())
                if not len(first):
                    continue
                shard = shard_of(codes, first, shards)
                cut = np.flatnonzero(np.append(True, (np.diff(shard) != 0) | (np.diff(first) != 1)))
                n = np.diff(np.append(cut, len(first)))
                order = np.argsort(shard[cut], kind="stable")
                cut, n = cut[order], n[order]
                shard, at = shard[cut], first[cut]
                owner = np.searchsorted(begin + size, at, side="right")
                long = n + (PHRASE - 1)
                ends = np.cumsum(long)
                data = codes[np.repeat(at - (ends - long), long) + np.arange(ends[-1])]
                doc_id, k1 = (part.column(c).to_numpy() for c in ("doc_id", "k1"))
                edge = np.append(np.flatnonzero(np.append(True, np.diff(shard) != 0)), len(shard))
                cols = [[], [], []]
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    docs, pieces = np.unique(owner[a:b], return_counts=True)
                    cols[0].append(data[ends[a] - long[a] : ends[b - 1]].tobytes())
                    cols[1].append(_planes(n[a:b], at[a:b] - begin[owner[a:b]], dtype="<i4"))
                    cols[2].append(_planes(doc_id[docs], k1[docs], pieces, dtype="<i8"))
                yield pa.RecordBatch.from_arrays([pa.array(shard[edge[:-1]], pa.int32()), pa.array([1] * len(cols[0]), pa.int32()), *(pa.array(c, pa.binary()) for c in cols)], ["shard", "kind", "data", "pieces", "docs"])
        release_memory()

    return run


def piece_hits(machine, data: bytes, pieces: bytes, docs: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """doc_id, k1 and hits of the documents of a dealt row where the automaton's phrases occur."""
    n, begin = _from_planes(pieces, 2, "<i4").astype(np.int64)
    doc_id, k1, n_pieces = _from_planes(docs, 3, "<i8")
    at = np.array(occurrences(machine, data), np.int64)
    start = np.cumsum(n + (PHRASE - 1)) - (n + (PHRASE - 1))
    piece = np.searchsorted(start, at, side="right") - 1
    inside = at - start[piece] < n[piece]  # not from one piece into the next
    at, piece = at[inside], piece[inside]
    owner = np.repeat(np.arange(len(doc_id)), n_pieces)[piece]
    edge = np.flatnonzero(np.append(True, np.diff(owner) != 0)) if len(owner) else owner
    return doc_id[owner[edge]], k1[owner[edge]], np.split(at - start[piece] + begin[piece], edge[1:])[: len(edge)]


def _stream_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, kind): a shard's phrases, then the pieces of streams dealt to it."""
    begin_task()
    group, phrases, machine = None, [], None
    for batch in batches:
        ids, keys, hits = [], [], []
        for shard, kind, *row in zip(*(batch.column(c) for c in ("shard", "kind", "data", "pieces", "docs"))):
            if shard != group:
                group, phrases, machine = shard, [], None
            row = [x.as_py() for x in row]
            if kind.as_py() == 0:
                phrases.append(row[0])
                continue
            if phrases:
                machine, phrases = automaton(b"".join(sorted(phrases))), []
            if machine is not None:
                for out, x in zip((ids, keys, hits), piece_hits(machine, *row)):
                    out.extend(x)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(hits, pa.list_(pa.int32()))], ["doc_id", "k1", "hits"])
    release_memory()


def locate(streams: DataFrame, phrases: DataFrame, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """Every occurrence of the phrases in the streams (doc_id, k1, codes): rows (doc_id, k1, hits), hits from 0 on."""
    parts = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, -(-phrases.count() // shard_phrases))
    packs = phrases.select("phrase").mapInArrow(_pack_task(shards), _DEALT)
    rows = packs.unionByName(streams.select("doc_id", "k1", "codes").mapInArrow(_deal_task(shards), _DEALT))
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")
    return rows.mapInArrow(_stream_task, "doc_id long, k1 long, hits array<int>")


def _key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks(batch):
            words = Words(part.column("text").cast(pa.binary()).to_pylist())
            k1, _ = sequence_keys(words.hashes(), words.doc)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(k1.view(np.int64))], [*part.schema.names, "k1"])


def candidate_windows(words: Words, h: np.ndarray, hits: list, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (by number, and by first word) of a block whose least phrase is among the hits of its document."""
    phrases, first = windows(h, words.doc, PHRASE)
    place, at = least_phrases(phrases, first, words.doc, window)
    per_doc = np.maximum(words.counts - (PHRASE - 1), 0)
    begin = np.cumsum(per_doc) - per_doc
    hit = np.zeros(len(phrases) + 1, bool)
    for b, x in zip(begin.tolist(), hits):
        hit[b + np.asarray(x, np.int64)] = True
    some = np.flatnonzero(hit[place])
    return some, at[some]


def _window_task(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            for part in blocks(batch):
                words = Words(part.column("text").cast(pa.binary()).to_pylist())
                h = words.hashes()
                some, at = candidate_windows(words, h, part.column("hits").to_pylist(), window)
                w1, _ = windows(h, words.doc, window)
                w2, _ = windows(h, words.doc, window, salt=3)
                owner = np.searchsorted(words.doc, at, side="right") - 1
                tag = (np.asarray(part.column("k1")) & 0x7FFFFFFF)[owner] << 32
                ids = np.asarray(part.column("doc_id"))[owner]
                cols = [pa.array(w1[some].view(np.int64)), pa.array((w2[some] >> np.uint64(33)).astype(np.int32)), pa.array(ids), pa.array(tag | (at - words.doc[owner]))]
                yield pa.RecordBatch.from_arrays(cols, ["w1", "w2", "doc_id", "spot"])
        release_memory()

    return run


def _remove_task(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                n_removed, digests = [], []
                tags = (np.asarray(part.column("k1")) & 0x7FFFFFFF).tolist()
                for text, tag, spots in zip(part.column("text").cast(pa.binary()).to_pylist(), tags, part.column("spots").to_pylist()):
                    own = text.split()
                    spots = np.asarray(spots, np.int64)
                    at = spots[spots >> 32 == tag] & 0xFFFFFFFF
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    n_removed.append(int(gone.sum()))
                    digests.append(hashlib.sha256(b" ".join([w for w, g in zip(own, gone.tolist()) if not g])).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k1"), pa.array(n_removed, pa.int64()), pa.array(digests)], ["doc_id", "k1", "cut", "cut_digest"])
        release_memory()

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256) for every row of docs."""
    ensure_path(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = staged(docs.mapInArrow(_scan_task(window), _SCANNED), "repeats-scan")
    leader = scanned.where("doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    leader = staged(leader, "repeats-leaders")
    few = leader.count() <= ID_ROWS
    rows = scanned.join(F.broadcast(leader) if few else leader, ["k1", "k2"], "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
    rows = rows.drop("least", "k2")
    if not few:  # one shuffle, not one for each use
        rows = staged(rows, "repeats-rows")
        unstage(scanned)

    streams = rows.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull() & ~F.col("copy"))
    picked = streams.select("doc_id", F.explode("picks").alias("phrase"))
    again = staged(picked.groupBy("phrase").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("phrase"), "repeats-phrases")
    hits = staged(locate(streams.select("doc_id", "k1", "codes"), again, shard_phrases), "repeats-hits")
    unstage(again)
    ids = staged(hits.select("doc_id").distinct(), "repeats-ids")
    texts = docs.join(bounded(ids, ID_ROWS), "doc_id", "left_semi").mapInArrow(_key_task, "doc_id long, text string, k1 long")
    hits_of = hits.groupBy("doc_id", "k1").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    texts = staged(texts.join(hits_of, ["doc_id", "k1"]), "repeats-texts")
    unstage(ids)
    unstage(hits)

    found = staged(texts.mapInArrow(_window_task(window), "w1 long, w2 int, doc_id long, spot long"), "repeats-windows")
    confirmed = staged(found.groupBy("w1", "w2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("w1", "w2", "a"), "repeats-confirmed")
    spots = staged(found.join(confirmed, ["w1", "w2"]).where("doc_id > a").groupBy("doc_id").agg(F.collect_list("spot").alias("spots")), "repeats-spots")
    unstage(found)
    unstage(confirmed)
    cut = texts.select("doc_id", "text", "k1").join(spots, "doc_id").mapInArrow(_remove_task(window), "doc_id long, k1 long, cut long, cut_digest string").dropDuplicates(["doc_id", "k1"])
    cut = staged(cut, "repeats-cut")
    unstage(texts)
    unstage(spots)

    out = rows.select("doc_id", "k1", "n_words", "digest", "copy").join(cut, ["doc_id", "k1"], "left")
    whole = F.col("copy") & (F.col("n_words") >= window)
    n_removed = F.when(whole, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0).cast("long")))
    kept = F.when(whole, F.lit(_NO_WORDS)).otherwise(F.coalesce("cut_digest", F.lower(F.hex("digest"))))
    return out.select("doc_id", "n_words", n_removed.alias("n_removed"), kept.alias("kept_sha256"))

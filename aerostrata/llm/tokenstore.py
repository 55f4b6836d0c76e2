"""Token ids in a content-addressed store.

``write_store`` encodes whole texts, appends an end id to each, cuts every
document's id stream where a rolling hash of its last ids says so, and writes

* ``objects`` of kind 0: each distinct chunk once, under the digest of its bytes
  (ids as little-endian unsigned 16-bit numbers where the vocabulary allows, or
  32-bit ones);
* ``recipes`` of kind 0: a row for each document in ascending doc_id order (null
  first; equal ids in an order of their own): its chunks' digests, its Merkle
  root, its place in its part; kind 1: totals and root of each block of
  ``BLOCK_DOCS`` documents in a row; kind 2: those of each part, over its blocks;
* ``manifest``: the root over all parts, totals, and the format's facts.

``read_documents`` and ``read_ids`` check the files before they read them
(``verify``): every block against its documents, every part against its blocks
and the manifest against the parts, in roots, counts and places, so that a recipe
that is lost, repeated or moved is an error.  ``read_documents`` then checks every
chunk against its digest and every document against its root and count, and
derives counts and checksums from the chunks; ``read_ids`` rebuilds the ids
themselves.  A chunk that is lost is an error in both.

Chunks are made distinct within a task before they are shuffled, so that a
group of copies, however large, sends a chunk once from each task.  One shuffle
moves the chunks; the recipes and checksums that follow are narrow.

Defined results: a null text counts as empty and has the end id alone; a very long
text is encoded whole, as a block of its own; repeated rows are documents like others; an empty table gives no rows and an empty
store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Powers, Words, begin_task, blocks, ensure_path, mix64, release_memory, resident

END_ID = 0
#: Shortest, mean (a power of two) and longest chunk, in ids; the rolling hash's window.
MIN_IDS, MEAN_IDS, MAX_IDS, WINDOW = 64, 256, 1024, 16
DIGEST = 16
#: Documents under one inner node of a part's tree.
BLOCK_DOCS = 4096
#: A worker remembers the ids of 0.6 * 2 ** TABLE_BITS distinct pieces, and the digests of so many chunks that it has sent.
TABLE_BITS = 21
CACHE = 250_000
#: Unknown pieces encoded in one call.
GROUP = 200

_OBJECT = "kind int, key binary, payload binary, rid long, doc_id long, n_tokens long, chunks array<binary>"
_RECIPE = "kind int, part int, block long, idx long, doc_id long, in_part long, n_tokens long, n_docs long, chunks array<binary>, root binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts, as bytes, by the tokenizers library.

    A byte-level pre-tokenizer always cuts before a space that stands between
    characters other than white space, so pieces from one such space to the next
    can be encoded alone.  It also cuts between an ASCII letter and ASCII punctuation,
    so pieces are cut there too, and a word has one piece whatever mark follows it.
    Each distinct piece is encoded once and remembered in a table under a 64-bit hash
    of its bytes and length.  Texts where a space touches
    other white space (of ASCII or not), with a space at the end or an added token's
    content are encoded whole.
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks take the cores
        from tokenizers import Tokenizer

        facts = json.loads(spec)
        self.tok = Tokenizer.from_str(spec)
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        pre = facts.get("pre_tokenizer") or {}
        self.by_piece = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not facts.get("normalizer")
        self.added = [t["content"].encode() for t in facts.get("added_tokens", [])]
        space = self.tok.encode("  ", add_special_tokens=False).tokens[0][:1] if self.by_piece else ""
        self.leads = np.zeros(self.tok.get_vocab_size(), bool)
        if self.by_piece:
            self.leads[[i for t, i in self.tok.get_vocab().items() if t.startswith(space)]] = True
        self.letter_ids = len(self.tok.encode(" a", add_special_tokens=False).ids)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)
        self.at = np.zeros(1 << TABLE_BITS, np.int32)
        self.n = np.zeros(1 << TABLE_BITS, np.int32)
        self.ids, self.held, self.used = np.empty(1 << 16, self.dtype), 0, 0

    def _fresh(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces with a space before each, many in one call (a space starts a token, and no token holds another), and their counts."""
        groups = [(b" " + b" ".join(pieces[i : i + GROUP])).decode() for i in range(0, len(pieces), GROUP)]
        ids = np.concatenate(self._fresh(groups) or [np.empty(0, self.dtype)])
        return ids, np.diff(np.append(np.flatnonzero(self.leads[ids]), len(ids)))

    def _marked(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that begin with ASCII punctuation and have no space before, many in one call: each behind a letter, whose ids go again."""
        ids, count = self._spaced([b"a" + p for p in pieces])
        own = np.ones(len(ids), bool)
        own[((np.cumsum(count) - count)[:, None] + np.arange(self.letter_ids)).ravel()] = False
        return ids[own], count - self.letter_ids

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The table's slot of each key: where it is, or the free one where it ends its search."""
        mask = np.int64((1 << TABLE_BITS) - 1)
        slot = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        here = self.keys[slot]
        todo = np.flatnonzero((here != keys) & (here != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & mask
            here = self.keys[slot[todo]]
            todo = todo[(here != keys[todo]) & (here != 0)]
        return slot

    def _learn(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Add distinct keys that the table lacks."""
        while self.held + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        first = self.held + np.cumsum(count) - count
        self.ids[self.held : self.held + len(ids)] = ids
        self.held += len(ids)
        self.used += len(keys)
        left = np.arange(len(keys))
        while len(left):
            slot = self._slots(keys[left])
            mine = np.unique(slot, return_index=True)[1]  # one newcomer for each free slot; the rest search on
            put = left[mine]
            self.keys[slot[mine]], self.at[slot[mine]], self.n[slot[mine]] = keys[put], first[put], count[put]
            left = np.delete(left, mine)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        whole, cut, words = [], [], None
        for i, t in enumerate(texts):
            plain = self.by_piece and b"  " not in t and not t.endswith(b" ") and not any(a in t for a in self.added)
            (cut if plain else whole).append(i)
        if cut:
            words = Words([texts[i] for i in cut], _ONE_SPACE)
            touching = _touching(words)
            if touching.any():
                whole += [i for i, bad in zip(cut, touching) if bad]
                cut = [i for i, bad in zip(cut, touching) if not bad]
                words = Words([texts[i] for i in cut], _ONE_SPACE)
        for i, ids in zip(whole, self._fresh([texts[i].decode() for i in whole])):
            out[i] = ids.tobytes()
        if not cut:
            return out
        begins = np.cumsum([0] + [len(texts[i]) + 1 for i in cut[:-1]])
        rest = _cut_at_marks(words)
        keys = words.hashes() | np.uint64(1)
        full = np.flatnonzero(words.counts)
        head = words.doc[:-1][full]
        head = head[words.start[head] == begins[full]]
        head = np.concatenate([head, rest])  # pieces without a space before
        keys[head] = mix64(keys[head]) | np.uint64(1)
        slot = self._slots(keys)
        lacking = np.flatnonzero(self.keys[slot] == 0)
        if len(lacking):
            is_head = np.zeros(len(keys), bool)
            is_head[head] = True
            fresh = lacking[np.unique(keys[lacking], return_index=True)[1]]
            if self.used + len(fresh) > (1 << TABLE_BITS) * 0.6:
                self._forget()
                fresh = np.unique(keys, return_index=True)[1]
            raw = words.buf.tobytes()
            marked = _MARK[words.buf[words.start[fresh]]]
            for some, many in ((fresh[~is_head[fresh]], self._spaced), (fresh[is_head[fresh] & marked], self._marked), (fresh[is_head[fresh] & ~marked], None)):
                pieces = [raw[a:b] for a, b in zip(words.start[some].tolist(), words.end[some].tolist())]
                if many and pieces:
                    self._learn(keys[some], *many(pieces))
                elif pieces:
                    got = self._fresh([p.decode() for p in pieces])
                    self._learn(keys[some], np.concatenate(got), np.array([len(g) for g in got]))
            slot = self._slots(keys)
        count = self.n[slot]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(self.at[slot] - before[:-1], count) + np.arange(before[-1])].tobytes()
        ends = before[words.doc] * np.dtype(self.dtype).itemsize
        for i, a, b in zip(cut, ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = ids[a:b]
        return out


_ONE_SPACE = np.arange(256) == 0x20
#: White space characters (Unicode's, as the pre-tokenizer's regex has them) but the space: their bytes as one number, first and last bytes.
_WHITE = [chr(c).encode() for c in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_CODES = np.array([int.from_bytes(w, "big") for w in _WHITE])
_FIRST, _LAST = (np.isin(np.arange(256), [w[i] for w in _WHITE]) for i in (0, -1))


_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_MARK = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)])


def _cut_at_marks(words: Words) -> np.ndarray:
    """Cut words between an ASCII letter and ASCII punctuation; the numbers of those that then begin at a cut."""
    at = np.flatnonzero(_LETTER[words.buf[:-1]] & _MARK[words.buf[1:]]) + 1
    after = np.searchsorted(words.start, at)
    words.start, words.end = np.insert(words.start, after, at), np.insert(words.end, after - 1, at)
    words.doc = words.doc + np.searchsorted(after, words.doc, side="right")
    return after + np.arange(len(at))


def _touching(words: Words) -> np.ndarray:
    """For each text, whether a piece between spaces begins or ends with other white space."""
    out = np.zeros(words.n, bool)
    buf, last = words.buf, len(words.buf) - 1
    for maybe, side in ((np.flatnonzero(_FIRST[buf[words.start]]), words.start), (np.flatnonzero(_LAST[buf[words.end - 1]]), words.end)):
        for size in (1, 2, 3) if len(maybe) else ():
            at = side[maybe] - (size if side is words.end else 0)
            code = sum(buf[np.clip(at + j, 0, last)].astype(np.int64) << (8 * (size - 1 - j)) for j in range(size))
            out[np.searchsorted(words.doc, maybe[np.isin(code, _CODES)], side="right") - 1] = True
    return out


def encoder(spec: str) -> Encoder:
    """This worker's encoder, kept from task to task of the stage that encodes."""
    return resident("encoder", hashlib.sha256(spec.encode()).hexdigest(), lambda: Encoder(spec))


_rolling = Powers(0x9E3779B97F4A7C15)
_gear = mix64(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def cut_points(ids: np.ndarray, doc_end: np.ndarray) -> list[list[int]]:
    """For each document (its ids end at doc_end), the ends of its chunks.

    The hash at a position covers the WINDOW ids up to it, which all lie within
    the chunk since no chunk is shorter; so cuts depend on content alone.
    """
    if not len(ids):
        return []
    up, down = _rolling.upto(len(ids))
    total = np.cumsum(_gear[ids & 0xFFFF] * down)
    total[WINDOW:] -= total[:-WINDOW].copy()
    value = total * up
    marks = (np.flatnonzero((value >> np.uint64(33)) % np.uint64(MEAN_IDS - MIN_IDS) == 0) + 1).tolist()
    out, at, m = [], 0, 0
    for end in doc_end.tolist():
        ends = []
        while end - at > MIN_IDS:
            while m < len(marks) and marks[m] < at + MIN_IDS:
                m += 1
            nxt = min(at + MAX_IDS, marks[m] if m < len(marks) else end, end)
            ends.append(nxt)
            at = nxt
        if at < end:
            ends.append(end)
        at = end
        out.append(ends)
    return out


def digest(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=DIGEST).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; leaves and inner nodes are hashed apart, an odd node moves up."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"\2").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _encode_task(spec: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin_task("encoder")
        enc = encoder(spec)
        end = np.array([end_id], enc.dtype).tobytes()
        width = len(end)
        base, row, sent = TaskContext.get().partitionId() << 40, 0, set()
        schema = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("payload", pa.binary()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("chunks", pa.list_(pa.binary()))])
        for batch in batches:
            for part in blocks(batch):
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                encoded = [x + end for x in enc.encode(texts)]
                stream = b"".join(encoded)
                sizes = np.array([len(x) // width for x in encoded], np.int64)
                chunks, fresh, at = [], [], 0
                for ends in cut_points(np.frombuffer(stream, enc.dtype), np.cumsum(sizes)):
                    mine = []
                    for e in ends:
                        payload = stream[at * width : e * width]
                        key = digest(payload)
                        mine.append(key)
                        if key not in sent:
                            if len(sent) >= CACHE:
                                sent.clear()
                            sent.add(key)
                            fresh.append((key, payload))
                        at = e
                    chunks.append(mine)
                n, m = len(fresh), len(texts)
                rids = [base + row + i for i in range(m)]
                row += m
                keys = [x[0] for x in fresh] + [digest(struct.pack("<q", r)) for r in rids]
                cols = [[0] * n + [1] * m, keys, [x[1] for x in fresh] + [None] * m, [None] * n + rids, [None] * n + part.column("doc_id").to_pylist(), [None] * n + sizes.tolist(), [None] * n + chunks]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
        release_memory()

    return run


_RECIPE_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("idx", pa.int64()), ("doc_id", pa.int64()), ("in_part", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("chunks", pa.list_(pa.binary())), ("root", pa.binary())])


def _recipe_task(block_docs: int):
    """A part's documents in order; after each block of them a row for it, and one for the part at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin_task()
        part, idx, before, block_from, nodes, roots = TaskContext.get().partitionId(), 0, 0, 0, [], []
        rows = lambda cols: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RECIPE_SCHEMA)], schema=_RECIPE_SCHEMA)
        close = lambda: rows([[x] for x in (1, part, len(nodes), None, None, block_from, before - block_from, len(roots), None, merkle_root(roots))])
        for batch in batches:
            at = 0
            while at < len(batch):
                some = batch.slice(at, block_docs - len(roots))
                at += len(some)
                n = some.column("n_tokens").to_numpy()
                chunks = some.column("chunks").to_pylist()
                own = [merkle_root(c) for c in chunks]
                roots += own
                place = before + np.cumsum(n) - n
                before += int(n.sum())
                size = len(some)
                yield rows([[0] * size, [part] * size, [len(nodes)] * size, range(idx, idx + size), some.column("doc_id").to_pylist(), place, n, [1] * size, chunks, own])
                idx += size
                if len(roots) == block_docs:
                    yield close()
                    nodes.append(merkle_root(roots))
                    block_from, roots = before, []
        if roots:
            yield close()
            nodes.append(merkle_root(roots))
        if idx:
            yield rows([[x] for x in (2, part, None, None, None, 0, before, idx, None, merkle_root(nodes))])
        release_memory()

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_docs: int = BLOCK_DOCS) -> dict:
    """Write docs (doc_id, text) as a store under path; returns the manifest."""
    spark = docs.sparkSession
    ensure_path(spark)
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        spec = f.read()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode_task(spec, end_id), _OBJECT)
    # equal keys are in one partition already: one sort, and the first row with each stays
    rows = rows.repartition(parts, "key").withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("kind"))).where("nth = 1").drop("nth")
    rows.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(f"{path}/objects")

    recipes = spark.read.schema(_OBJECT).parquet(f"{path}/objects").where("kind = 1").select("doc_id", "rid", "n_tokens", "chunks")
    recipes = recipes.repartitionByRange(parts, "doc_id", "rid").sortWithinPartitions("doc_id", "rid").mapInArrow(_recipe_task(block_docs), _RECIPE)
    recipes.write.option("compression", "zstd").parquet(f"{path}/recipes")

    # a row for each part, as many as shuffle partitions
    totals = spark.read.schema(_RECIPE).parquet(f"{path}/recipes").where("kind = 2").orderBy("part").select("n_tokens", "n_docs", "root").collect()
    facts = {"n_docs": sum(r.n_docs for r in totals), "n_tokens": sum(r.n_tokens for r in totals), "dtype": Encoder(spec).dtype, "end_id": end_id, "tokenizer_sha256": hashlib.sha256(spec.encode()).hexdigest(), "root": merkle_root([bytes(r.root) for r in totals]).hex()}
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.text(f"{path}/manifest")
    return facts


def manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()[0])


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is wrong with nodes of the tree, given what lies under them: rows (part, block, wrong)."""
    for batch in batches:
        out = []
        for node in batch.to_pylist():
            under = sorted(node["under"] or [], key=lambda x: x["place"])
            wrong = None
            if node["root"] is None or not under:
                wrong = "has no row of its own" if under else "has nothing under it"
            elif sum(x["n_docs"] for x in under) != node["n_docs"] or sum(x["n_tokens"] for x in under) != node["n_tokens"]:
                wrong = "does not hold as many documents or ids as it should"
            elif [x["place"] - under[0]["place"] for x in under] != list(range(len(under))) or node["block"] is None and under[0]["place"]:
                wrong = "lacks a row or has one twice"
            elif [x["in_part"] for x in under] != (node["in_part"] + np.cumsum([0] + [x["n_tokens"] for x in under[:-1]])).tolist():
                wrong = "has rows out of their places"
            elif merkle_root([x["root"] for x in under]) != node["root"]:
                wrong = "does not match its Merkle root"
            if wrong:
                out.append((node["part"], node["block"], wrong))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.string()))], ["part", "block", "wrong"])


def verify(spark: SparkSession, path: str) -> dict:
    """Check recipes and manifest against each other; the manifest.  A node's children, BLOCK_DOCS documents or a part's blocks, are gathered at a time."""
    ensure_path(spark)
    facts, recipes = manifest(spark, path), spark.read.schema(_RECIPE).parquet(f"{path}/recipes").drop("chunks")
    # a row for each part, as many as shuffle partitions
    parts = recipes.where("kind = 2").select("part", "n_docs", "n_tokens", "root").orderBy("part").collect()
    if sum(r.n_docs for r in parts) != facts["n_docs"] or sum(r.n_tokens for r in parts) != facts["n_tokens"] or merkle_root([bytes(r.root) for r in parts]).hex() != facts["root"]:
        raise ValueError(f"{path}: the parts do not match the manifest")
    wrong = None
    for kind, key, place in ((1, ["part", "block"], "idx"), (2, ["part"], "block")):
        under = recipes.where(F.col("kind") == kind - 1).groupBy(*key).agg(F.collect_list(F.struct(F.col(place).alias("place"), "in_part", "n_docs", "n_tokens", "root")).alias("under"))
        own = recipes.where(F.col("kind") == kind).select(*key, "in_part", "n_docs", "n_tokens", "root")
        nodes = own.join(under, key, "full").select("part", F.col("block") if kind == 1 else F.lit(None).cast("long").alias("block"), "in_part", "n_docs", "n_tokens", "root", "under")
        found = nodes.mapInArrow(_verify_task, "part int, block long, wrong string")
        wrong = found if wrong is None else wrong.unionByName(found)
    for r in wrong.take(1):
        raise ValueError(f"{path}: part {r.part}, block {r.block} of the recipes {r.wrong}")
    return facts


_POLY = 0xEDB88320


def _gf_times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b modulo the CRC-32 polynomial (reflected)."""
    a, b, out = a.astype(np.uint64), b.astype(np.uint64), np.zeros(len(a), np.uint64)
    for bit in range(31, -1, -1):
        out ^= np.where(a >> np.uint64(bit) & np.uint64(1), b, np.uint64(0))
        b = np.where(b & np.uint64(1), (b >> np.uint64(1)) ^ np.uint64(_POLY), b >> np.uint64(1))
    return out


def _gf_shift(n_bytes: np.ndarray) -> np.ndarray:
    """x to the power 8 * n_bytes modulo the polynomial."""
    left = n_bytes.astype(np.uint64) * np.uint64(8)
    out = np.full(len(left), 1 << 31, np.uint64)
    power = np.full(len(left), 1 << 30, np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), _gf_times(power, out), out)
        power = _gf_times(power, power)
        left >>= np.uint64(1)
    return out


def join_crcs(crcs: list[list[int]], lengths: list[list[int]]) -> np.ndarray:
    """For each list, the crc32 of the parts' bytes one after another, from the parts' own."""
    known, back = np.unique(np.array([n for x in lengths for n in x] or [0]), return_inverse=True)
    shift = _gf_shift(known)
    size = np.array([len(x) for x in crcs], np.int64)
    first = np.cumsum(size) - size
    flat = np.array([c for x in crcs for c in x] or [0], np.uint64)
    out = np.zeros(len(crcs), np.uint64)
    for j in range(int(size.max()) if len(size) else 0):
        has = np.flatnonzero(size > j)
        at = first[has] + j
        out[has] = _gf_times(shift[back[at]], out[has]) ^ flat[at]
    return out


def _check_task(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, crcs, sizes = [], [], []
            for key, payload in zip(batch.column("key").to_pylist(), batch.column("payload").to_pylist()):  # objects are a few KB
                if digest(payload) != key:
                    raise ValueError(f"chunk {key.hex()} does not match its digest")
                ids = np.frombuffer(payload, dtype)
                keys.append(key)
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(crcs, pa.int64()), pa.array(sizes, pa.int64())], ["key", "crc", "n"])

    return run


def _join_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("got").to_pylist()
        sizes = [[g["n"] for g in got] for got in rows]
        for root, n, got, size in zip(batch.column("root").to_pylist(), batch.column("n_tokens").to_pylist(), rows, sizes):
            if None in size:
                raise ValueError("a document's chunk is missing")
            if merkle_root([g["key"] for g in got]) != root or sum(size) != n:
                raise ValueError("a document's chunks do not match its Merkle root or its number of ids")
        crc = join_crcs([[g["crc"] for g in got] for got in rows], [[4 * n for n in x] for x in sizes])
        cols = [batch.column("part"), batch.column("idx"), batch.column("doc_id"), batch.column("in_part"), batch.column("n_tokens"), pa.array(crc.astype(np.int64)), pa.array([len(x) for x in sizes], pa.int32())]
        yield pa.RecordBatch.from_arrays(cols, ["part", "idx", "doc_id", "in_part", "n_tokens", "ids_crc32", "n_chunks"])


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: as many rows as parts."""
    rows, before = [], 0
    for r in spark.read.schema(_RECIPE).parquet(f"{path}/recipes").where("kind = 2").select("part", "n_tokens").orderBy("part").collect():
        rows.append((r.part, before))
        before += r.n_tokens
    return F.broadcast(spark.createDataFrame(rows, "part int, base long"))


def _refs(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.schema(_RECIPE).parquet(f"{path}/recipes").where("kind = 0")
    return docs.select("part", "idx", "doc_id", "in_part", "n_tokens", "root", F.posexplode("chunks").alias("pos", "key"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold of each document: doc_id, start, n_tokens, ids_crc32, n_chunks."""
    facts = verify(spark, path)
    held = spark.read.schema(_OBJECT).parquet(f"{path}/objects").where("kind = 0").select("key", "payload")
    held = held.mapInArrow(_check_task(facts["dtype"]), "key binary, crc long, n long")
    got = _refs(spark, path).join(held, "key", "left").groupBy("part", "idx", "doc_id", "in_part", "n_tokens", "root").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "crc", "n"))).alias("got"))
    docs = got.mapInArrow(_join_task, "part int, idx long, doc_id long, in_part long, n_tokens long, ids_crc32 long, n_chunks int")
    docs = docs.join(_parts(spark, path), "part")
    return docs.select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32", "n_chunks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents' ids: doc_id, start, ids (little-endian, as stored)."""
    verify(spark, path)
    held = spark.read.schema(_OBJECT).parquet(f"{path}/objects").where("kind = 0").select("key", "payload")
    got = _refs(spark, path).join(held, "key", "left").groupBy("part", "idx", "doc_id", "in_part").agg(F.array_sort(F.collect_list(F.struct("pos", "payload"))).alias("got"))
    whole = F.aggregate("got", F.lit(b""), lambda acc, g: F.concat(acc, F.coalesce(g["payload"], F.raise_error(F.lit("a document's chunk is missing")))))
    return got.join(_parts(spark, path), "part").select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), whole.alias("ids"))


def store_and_read(docs: DataFrame, path: str, tokenizer: str | None = None) -> DataFrame:
    write_store(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerostrata.llm import mixing, tokenstore
from aerostrata.llm.common import Words, stage_path, windows

SF = "/root/testdata/sf0.001"


def encoded(rows):
    tok = Tokenizer.from_file(tokenstore.default_tokenizer())
    out, start = [], 0
    for i, t in sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_store_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = encoded([(r.doc_id, r.text) for r in docs.collect()])
    path = stage_path(spark, "test-store")
    facts = tokenstore.write_store(docs, path)
    got = sorted((tuple(r) for r in tokenstore.read_documents(spark, path).collect()))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    ids = {r.doc_id: np.frombuffer(r.ids, facts["dtype"]).tolist() for r in tokenstore.read_ids(spark, path).collect()}
    assert ids == {w[0]: w[4] for w in want}
    held = spark.read.parquet(f"{path}/objects").where("kind = 0")
    assert held.count() == held.select("key").distinct().count() < sum(g[4] for g in got)
    assert facts["n_tokens"] == sum(w[2] for w in want) and facts == tokenstore.manifest(spark, path)


def test_store_odd_rows_and_tables(spark, odd, odd_rows, none):
    got = tokenstore.store_and_read(odd, stage_path(spark, "test-store")).collect()
    want = encoded([r[:2] for r in odd_rows])
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted((w[0], *w[2:4]) for w in want if w[0] is not None)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(w[2:4] for w in want)
    assert sorted(r.start for r in got)[0] == 0 and len({r.start for r in got}) == len(got)
    assert {r.doc_id for r in sorted(got, key=lambda r: r.start)[:2]} == {None}
    assert tokenstore.store_and_read(none, stage_path(spark, "test-store")).count() == 0


def test_damage_is_found(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    path = str(tmp_path / "store")
    tokenstore.write_store(docs, path)
    bad = spark.read.parquet(f"{path}/objects").withColumn("payload", F.when(F.col("kind") == 0, F.concat("payload", F.unhex(F.lit("0100")))))
    bad.write.parquet(str(tmp_path / "bad"))
    (tmp_path / "store" / "objects").rename(tmp_path / "old")
    (tmp_path / "bad").rename(tmp_path / "store" / "objects")
    with pytest.raises(Exception, match="does not match its digest"):
        tokenstore.read_documents(spark, path).collect()


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a\n\n b", "a\n  b", "a \n b", "\n", "\n\n a", "a\tb c", "x  y", "a <|endoftext|> b", "<|endoftext|>", "don't we'll ' s", "日本 語 ü  ß", "a\r\n b", " \n a", "a  b", "1 234 5.6 %%% !!"]


def test_pieces_encode_as_whole_texts():
    enc = tokenstore.Encoder(open(tokenstore.default_tokenizer(), encoding="utf-8").read())
    want = [np.array(enc.tok.encode(t, add_special_tokens=False).ids, enc.dtype).tobytes() for t in ODD]
    assert enc.encode([t.encode() for t in ODD]) == want
    enc._forget()
    assert enc.encode([t.encode() for t in reversed(ODD)]) == want[::-1]


def test_spaces_within_white_space_encode_as_whole_texts():
    """Alternating spaces and other white space, also where such pieces are learned beside others."""
    enc = tokenstore.Encoder(open(tokenstore.default_tokenizer(), encoding="utf-8").read())
    texts = [f"a {w} {w} b x" for w in ("\u00a0", "\n", "\t", "\u3000", "\u2003", "\u0085")]
    texts += ["a \u00a0 \u00a0", "a \n\u00a0 b", "\u00a0 a", "c \u00a0 \u00a0d e", "plain à la ‰ text", "x\u00a0y z", "日 全 ”a “b"]
    want = [np.array(enc.tok.encode(t, add_special_tokens=False).ids, enc.dtype).tobytes() for t in texts]
    assert enc.encode([t.encode() for t in texts]) == want
    assert [enc.encode([t.encode()])[0] for t in texts] == want


def test_cuts_depend_on_content():
    r = np.random.default_rng(1)
    ids = r.integers(0, 50_000, 20_000).astype("<u2")
    cut = lambda x: tokenstore.cut_points(x, np.array([len(x)]))[0]
    whole = cut(ids)
    sizes = np.diff([0, *whole])
    assert sizes[:-1].min() >= tokenstore.MIN_IDS and sizes.max() <= tokenstore.MAX_IDS and 150 < sizes.mean() < 400
    moved = {len(ids) + 37 - c for c in cut(np.concatenate([ids[:37], ids]))}
    assert len(moved & {len(ids) - c for c in whole}) > 0.8 * len(whole)


def test_joined_checksums():
    r = np.random.default_rng(2)
    parts = [[r.bytes(int(n)) for n in r.integers(0, 300, k)] for k in (1, 2, 7, 30)]
    got = tokenstore.join_crcs([[zlib.crc32(p) for p in x] for x in parts], [[len(p) for p in x] for x in parts])
    assert got.tolist() == [zlib.crc32(b"".join(x)) for x in parts]


def fair_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        share = left / sum(w[s] for s in free)
        over = {s for s in free if share * w[s] > 2 * sizes[s]}
        if not over:
            target |= {s: share * w[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_mix(spark, odd, which):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if which == "documents" else odd
    rows = mixing.mix_counts(docs).collect()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want, took = fair_targets(sizes), collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        took[r.source] += r.taken
    assert len(rows) == docs.count()
    for s, t in want.items():
        assert took[s] == pytest.approx(t, rel=0.05, abs=2 * mixing.BLOCK_WORDS)
    again = mixing.mix_counts(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_odd_tables(spark, none, odd):
    assert mixing.mix_counts(none).count() == 0 and mixing.mix_blocks(none).count() == 0
    empty = mixing.mix_counts(odd.where("doc_id in (1, 2, 5)")).collect()
    assert len(empty) == 3 and all(r.taken == r.target == 0 for r in empty)


def test_blocks_hold_the_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blocks = mixing.mix_blocks(docs, block_words=mixing.BLOCK_WORDS)
    assert blocks.columns == docs.columns
    rows = blocks.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.n_chars == len(r.text) for r in rows)
    by_source = collections.Counter()
    for r in rows:
        by_source[r.source] += len(r.text.split())
    counted = collections.Counter()
    for r in mixing.mix_counts(docs).collect():
        counted[r.source] += r.taken
    assert by_source == counted


def test_slots_are_permutations(spark):
    sources = spark.createDataFrame([(0, 1000, 2000), (1, 7, 10), (2, 1, 2)], "sid int, n_blocks long, n_slots long")
    seen = collections.defaultdict(list)
    for r in mixing.slots(sources).collect():
        seen[r.sid, r.epoch].append(r.block)
    assert sorted(seen[0, 0]) == sorted(seen[0, 1]) == list(range(1000)) and seen[0, 0] != sorted(seen[0, 0])
    assert sorted(seen[1, 0]) == list(range(7)) and len(set(seen[1, 1])) == 3 and seen[2, 0] == seen[2, 1] == [0]


def test_words_and_windows():
    texts = ["a b  c", None, "", "\x0b\x0c x y ", "é é é é"]
    w = Words(texts)
    assert w.counts.tolist() == [3, 0, 0, 1, 4]
    h, first = windows(w.hashes(), w.doc, 2)
    assert first.tolist() == [0, 1, 4, 5, 6] and len({int(x) for x in h}) == 3


def _moved(tmp_path, spark, path, part, change):
    """Put a changed copy in the place of a store's objects or recipes."""
    change(spark.read.parquet(f"{path}/{part}")).write.parquet(str(tmp_path / "bad"))
    (tmp_path / "store" / part).rename(tmp_path / "old")
    (tmp_path / "bad").rename(tmp_path / "store" / part)


@pytest.mark.parametrize(
    "part, change, said",
    [
        ("recipes", lambda r: r.where("kind <> 0 or idx <> 3"), "does not hold as many"),
        ("recipes", lambda r: r.where("kind <> 0 or idx <> 3").unionByName(r.where("kind = 0 and idx = 4")), "Merkle|twice|places|as many"),
        ("recipes", lambda r: r.where("kind <> 1 or block <> 1"), "no row of its own|as many"),
        ("recipes", lambda r: r.where("kind <> 2 or part <> 1"), "do not match the manifest"),
        ("recipes", lambda r: r.withColumn("n_tokens", F.when(F.expr("kind = 0 and idx = 2"), F.col("n_tokens") + 1).otherwise(F.col("n_tokens")))  , "as many"),
        ("objects", lambda o: o.where("kind = 1").unionByName(o.where("kind = 0").orderBy("key").limit(5)), "chunk is missing"),
    ],
)
def test_what_is_lost_is_found(spark, tmp_path, part, change, said):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    path = str(tmp_path / "store")
    tokenstore.write_store(docs, path, block_docs=3)
    whole = tokenstore.read_documents(spark, path).count()
    assert whole == 60
    _moved(tmp_path, spark, path, part, change)
    with pytest.raises(Exception, match=said):
        tokenstore.read_documents(spark, path).collect()


def test_blocks_of_odd_rows(spark, odd, odd_rows):
    """Whatever the order of rows, equal blocks; each word is in one block of each epoch."""
    rows = mixing.mix_blocks(odd, block_words=16).collect()
    again = mixing.mix_blocks(odd.repartition(5), block_words=16).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len({r.doc_id for r in rows}) == len(rows)
    words = collections.Counter(w for r in odd_rows for w in re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    taken = collections.Counter(w for r in rows for w in r.text.split(" "))
    assert set(taken) <= set(words) and all(n <= 2 * words[w] for w, n in taken.items())


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(k, i, (i * 7 + k) % 11) for k in range(3) for i in range(0, 50, k + 1)]
    got = mixing.running(spark.createDataFrame(rows, "k int, at long, n long"), ["k"], "at", "n").collect()
    assert {(r.k, r["at"]): r.before for r in got} == {(k, i): sum(n for a, j, n in rows if a == k and j < i) for k, i, _ in rows}


def test_marks_cut_words():
    """A word has one piece whatever mark follows it; ids equal the tokenizer's on whole texts."""
    import json

    with open(tokenstore.default_tokenizer(), encoding="utf-8") as f:
        spec = f.read()
    enc = tokenstore.Encoder(spec)
    marks = [*"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\", "'s", "'ll.", "'re,x", ".\nNext", ".\n", "***\tb", "\u2019s", "1.", "é.", ".é", "..9a-b"]
    texts = ["'s a", "-", "", "a", ".x y. Z", "don't WE'LL x'S", "e\u0301. \u00bd, ab\u00a0c.", "a's'", "日本.語, x"]
    texts += [f"Word{m} word{m} inn{m}x y" for m in marks] + [f"{m}word wordly{m}" for m in marks]
    for _ in range(2):
        got = enc.encode([t.encode() for t in texts])
        assert [np.frombuffer(x, enc.dtype).tolist() for x in got] == [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert json.loads(spec)["pre_tokenizer"] and enc.by_piece
    used = enc.used
    enc.encode([("x " + " ".join(f"unheardofword{m}" for m in ",;:!?")).encode()])
    assert enc.used - used <= 2

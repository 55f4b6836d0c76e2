import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostrata.llm import bagminhash, common, decontam, imatch, repeats

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    lower = "".join(c.lower() if c < "\x80" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def classes_by_brute_force(rows):
    bags = {i: bag(t) for i, t in rows}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = bags[a], bags[b]
            high = sum((x | y).values())
            if (sum((x & y).values()) / high if high else 1.0) >= 0.8:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def test_signatures_are_unbiased():
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split() * 3
    texts = [" ".join(base), " ".join(base + base[:40]), " ".join(base[:50]), " ".join(f"w{i}" for i in range(70))]
    words = common.Words([t.encode() for t in texts], common.PUNCTUATION)
    s = bagminhash.signatures(*bagminhash.multisets(words), len(texts), m=8192)
    for i, t in enumerate(texts):
        want = bagminhash.overlap([texts[0].encode()], [t.encode()])[0]
        assert abs((s[0] == s[i]).mean() - want) < 0.02
        x, y = bag(texts[0]), bag(t)
        assert np.isclose(want, sum((x & y).values()) / sum((x | y).values()))


def test_near_classes_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = classes_by_brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.class_id for r in bagminhash.near_classes(docs).collect()} == want


def test_a_large_group_of_near_copies(spark):
    """One edit each: copies are alike or not, and all classes must be those of brute force."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        w = list(base)
        for j in range(1 + i % 3):
            w[(i * 7 + j * 20) % 60] = f"e{i}.{j}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(300)]
    got = {r.doc_id: r.class_id for r in bagminhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got == classes_by_brute_force(rows)


def test_tiles_lose_no_pair():
    r = np.random.default_rng(0)
    n = 50
    sig = np.tile(r.integers(0, 256, bagminhash.M, dtype=np.uint8), (n, 1))
    sig[25:, :100] = r.integers(0, 256, (25, 100), dtype=np.uint8)
    banded = np.arange(n * bagminhash.BANDS).reshape(n, -1)
    banded[:, 0] = 7
    ids = np.arange(n)
    args = (np.zeros(n, np.int64), ids, ids, np.ones(n, bool), sig, banded, np.full(n, 7))
    a, b = bagminhash.tile_pairs(*args, None)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if (sig[i] == sig[j]).sum() >= bagminhash.AGREE}
    assert set(zip(a.tolist(), b.tolist())) == want
    a, b = bagminhash.tile_pairs(*args, 2)
    assert len(a) <= 2 * n and set(zip(a.tolist(), b.tolist())) <= want


def test_near_odd_rows_and_tables(spark, odd, odd_rows, none):
    rows = bagminhash.near_classes(odd).collect()
    assert len(rows) == len(odd_rows)
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[7] == by[9] == by[12] == {7} and by[None] == {7, None}
    assert by[1] == by[2] == by[5] == {1} and by[30] == by[31] == {30} and by[20] == {20}
    assert bagminhash.near_classes(none).count() == 0
    kept = bagminhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 7, 20, 21, 30, 40, None], key=str)
    assert bagminhash.one_of_each(none).count() == 0


@pytest.mark.parametrize("few", [0, common.FEW_EDGES])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_EDGES", few)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 300), (50, 50)] + [(500, 500 + i) for i in range(1, 30)]
    got = {r.id: r.class_id for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[300] == 100 and got[529] == 500 and 50 not in got


@pytest.mark.parametrize("few", [20, common.FEW_EDGES])
def test_components_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_EDGES", few)
    r = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (170, 2)) - 100] + [(i, i + 1) for i in range(1000, 1060)] + [(2000 + i % 7, 2000 + i) for i in range(50)]
    least = {x: x for e in edges for x in e}
    while (now := {x: min([least[x], *(least[b] for a, b in edges if a == x), *(least[a] for a, b in edges if b == x)]) for x in least}) != least:
        least = now
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(g.id, g.class_id) for g in got} == {(x, y) for x, y in least.items() if x != y} and len(got) == len({g.id for g in got})


def test_few_edges_take_few_tasks(spark):
    """The driver keeps figures of every task: rounds of joins over few edges filled its memory."""
    context, parts = spark.sparkContext, int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").coalesce(1)
    context.setJobGroup("few-edges", "components of few edges")
    try:
        assert {r.class_id for r in common.components(edges).collect()} == {0}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-edges") for s in tracker.getJobInfo(j).stageIds}
    assert sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s))) <= 2 * parts + 6


def removed_by_brute_force(rows, window):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for j in range(len(w) - window + 1):
                k = tuple(w[j : j + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first.get(tuple(w[j : j + window]), i) < i:
                gone[j : j + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


def test_repeats_against_brute_force(spark, odd, odd_rows, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in repeats.without_repeats(docs).collect()), key=str)
    assert got == removed_by_brute_force([(r.doc_id, r.text) for r in docs.collect()], 50)
    got = sorted((tuple(r) for r in repeats.without_repeats(odd).collect()), key=str)
    assert got == removed_by_brute_force([r[:2] for r in odd_rows], 50)
    assert repeats.without_repeats(none).count() == 0


def test_repeats_in_many_documents(spark):
    passage = [f"p{i}" for i in range(80)]
    rows = [(i, " ".join([f"a{i}.{j}" for j in range(i % 9)] + passage[i % 5 : 80 - i % 7] + [f"z{i}"])) for i in range(300)]
    got = sorted((tuple(r) for r in repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()), key=str)
    assert got == removed_by_brute_force(rows, 50)


def leaks_by_brute_force(docs, items):
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    held = [(i, shingles(cut(t))) for i, t in docs]
    return sorted(((d, q, len(s), len(s & h)) for q, t in items for s in [shingles(cut(t))] if s for d, h in held if len(s & h) >= 0.8 * len(s) - 1e-9), key=str)


def test_leaks_against_brute_force(spark, odd, odd_rows, none):
    items = [(1, odd_rows[10][1]), (2, None), (3, ""), (4, "one two"), (5, odd_rows[10][1].upper() + " more"), (None, odd_rows[0][1]), (6, "a b c d e f"), (1, odd_rows[10][1])]
    bench = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")
    got = sorted((tuple(r)[:4] for r in decontam.leaks(odd, bench).collect()), key=str)
    assert got == leaks_by_brute_force([r[:2] for r in odd_rows], items)
    kept = decontam.clean(odd, bench)
    assert kept.columns == odd.columns and kept.where("doc_id in (21, 22, 23, 9, 7)").count() == 0 and kept.where("doc_id in (1, 2, 5, 20, 40)").count() == 5
    assert decontam.leaks(none, bench).count() == 0 and decontam.leaks(odd, bench.where("false")).count() == 0


def test_sketches_cannot_miss(spark):
    """An item of n shingles that lacks the fifth it may lack still hits its sketch often enough."""
    items = spark.createDataFrame([(n, " ".join(f"w{n}.{i}" for i in range(n + 4))) for n in (1, 2, 4, 5, 9, 10, 31, 32, 63, 64, 200)], "item_key long, text string")
    rows = decontam.sketches(items.select("item_key", decontam._words(items.text).alias("words"))).groupBy("item_key").agg(F.first("n").alias("n"), F.first("need").alias("need"), F.collect_list("h").alias("hs")).collect()
    assert len(rows) == 11
    for r in rows:
        may_lack = int(0.2 * r.n + 1e-9)
        # the worst case: all that lacks is in the sketch
        assert 1 <= r.need <= len(r.hs) == len(set(r.hs)) and len(r.hs) - may_lack >= r.need


def test_fingerprints(spark, odd, odd_rows, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for frame, rows in ((docs, [(r.doc_id, r.text) for r in docs.collect()]), (odd, [r[:2] for r in odd_rows])):
        rows = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        want = []
        for k, (i, t) in enumerate(rows):
            n, after = len(t) // 2, rows[(k + 1) % len(rows)][1]
            want.append((i, len(t), hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest()))
        got = imatch.fingerprint_documents(frame).collect()
        assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        prints = collections.defaultdict(set)
        text = dict(rows)
        for r in got:
            if r.doc_id is not None:
                prints[text[r.doc_id]].add(r.fingerprint)
        assert all(len(p) == 1 for p in prints.values())
    assert imatch.fingerprint_documents(none).count() == 0
    got = imatch.fingerprint_documents(docs).collect()
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.9
    a, b = ([imatch.parse([r[c]]) for r in got] for c in ("fingerprint", "edited_fingerprint"))
    assert np.allclose([imatch.likeness(x, y)[0] for x, y in zip(a, b)], [r.near_edited for r in got])


def test_lexicon_is_exact(spark):
    """Words of one document stay out of fingerprints and words of two stay in, however many words there are."""
    n, own = 300, 1000
    shared = [[f"s{i // 2}x{j}" for j in range(20)] for i in range(n)]
    docs = spark.createDataFrame([(i, " ".join(w + [f"u{i}x{j}" for j in range(own)])) for i, w in enumerate(shared)], "doc_id long, text string")
    got = imatch.fingerprint_documents(docs).collect()
    assert [imatch.parse([r.fingerprint]).n[0] for r in got] == [20] * n
    prints = {r.doc_id: r.fingerprint for r in got}
    assert all(prints[i] == prints[i + 1] for i in range(0, n, 2)) and len(set(prints.values())) == n // 2


def test_likeness_follows_jaccard():
    for n, shared in ((40, 30), (400, 200), (2000, 1000), (2000, 1900)):
        a = " ".join(f"w{i}" for i in range(n)).encode()
        b = " ".join([f"w{i}" for i in range(shared)] + [f"v{i}" for i in range(n - shared)]).encode()
        x = imatch.fingerprints([a, b, a], np.unique(imatch.distinct_words([a, b])[0]))
        want = shared / (2 * n - shared)
        assert abs(imatch.likeness(x[0:1], x[1:2])[0] - want) < 0.2
        assert imatch.likeness(x[0:1], x[2:3])[0] == 1


def test_automata_find_every_occurrence():
    """Against a scan of every place, phrases that overlap and repeat included; without phrases nothing is found."""
    r = np.random.default_rng(5)
    stream = bytes(r.integers(0, 3, 3000, dtype=np.uint8))
    phrases = {stream[i : i + repeats.PHRASE] for i in (0, 7, 8, 500, 1200)} | {b"\0" * repeats.PHRASE, b"\xff" * repeats.PHRASE}
    want = [i for i in range(len(stream) - repeats.PHRASE + 1) if stream[i : i + repeats.PHRASE] in phrases]
    assert repeats.occurrences(repeats.automaton(b"".join(sorted(phrases))), stream) == want and len(want) > 5
    assert repeats.occurrences(repeats.automaton(b""), stream) == [] == repeats.occurrences(repeats.automaton(b"".join(sorted(phrases))), stream[:5])


def test_only_hits_make_candidates():
    words = common.Words([" ".join(f"w{i}" for i in range(200)), "a b c", " ".join(f"w{i}" for i in range(90))])
    h = words.hashes()
    assert len(repeats.candidate_windows(words, h, [[], [], []], 50)[0]) == 0
    _, at = repeats.candidate_windows(words, h, [list(range(193)), [], []], 50)
    assert at.tolist() == list(range(151))
    _, at = repeats.candidate_windows(words, h, [[], [], [60]], 50)
    assert all(203 + 60 + 8 - 50 <= x <= 203 + 60 for x in at)


def test_repeats_over_many_shards(spark):
    """Phrases dealt to many small automata, each of which sees every document."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    want = removed_by_brute_force([(r.doc_id, r.text) for r in docs.collect()], 20)
    assert sum(w[2] for w in want) > 100
    got = sorted((tuple(r) for r in repeats.without_repeats(docs, window=20, shard_phrases=40).collect()), key=str)
    assert got == want


def test_streams_are_dealt_once_whatever_the_shards():
    """Every place of every stream meets the one shard that would hold its phrase, and the bytes dealt do not grow with the shards."""
    import pyarrow as pa

    r = np.random.default_rng(8)
    streams = [bytes(r.integers(0, 40, n, dtype=np.uint8)) for n in (0, 7, 8, 9, 5000, 300)] + [b"\5" * 400]
    ids = [None if i == 1 else 3 * i for i in range(len(streams))]
    batch = pa.record_batch([pa.array([i or 0 for i in ids]), pa.array(range(-3, len(streams) - 3)), pa.array(streams, pa.binary())], ["doc_id", "k1", "codes"])
    places = {(k, i): streams[k][i : i + repeats.PHRASE] for k in range(len(streams)) for i in range(len(streams[k]) - repeats.PHRASE + 1)}
    phrases = np.frombuffer(b"".join(sorted(set(places.values()))), np.int64)
    sizes = {}
    for shards in (1, 7, 500):
        machines, seen, sizes[shards] = {}, [], 0
        for b in repeats._pack_task(shards)([pa.record_batch([pa.array(phrases)], ["phrase"])]):
            for shard, pack in zip(b.column("shard").to_pylist(), b.column("data").to_pylist()):
                machines[shard] = repeats.automaton(pack)
        for b in repeats._deal_task(shards)([batch]):
            for shard, data, pieces, docs in zip(*(b.column(c).to_pylist() for c in ("shard", "data", "pieces", "docs"))):
                sizes[shards] += len(data)
                for _, k1, hits in zip(*repeats.piece_hits(machines[shard], data, pieces, docs)):
                    seen += [(int(k1) + 3, int(i)) for i in hits]
        assert sorted(seen) == sorted(places)
    assert sizes[500] < 5 * sum(map(len, streams))


def terms_of(text):
    lower = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return set(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower))


def test_fingerprints_against_sets(spark):
    """Terms, equality and likeness of fingerprints against the band's words as sets, short texts included."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect()) + [(10_000 + i, " ".join(t)) for i, t in enumerate([["unheard"], ["und"], ["und", "the"], ["the", "und"], []])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen = collections.Counter(w for _, t in rows for w in terms_of(t))
    band = {w for w, n in seen.items() if imatch.LEAST_DOCS <= n <= max(imatch.LEAST_DOCS, imatch.MOST_SHARE * len(rows))}
    terms = {i: frozenset(terms_of(t) & band) for i, t in rows}
    got = {r.doc_id: r for r in imatch.fingerprint_documents(frame).collect()}
    assert {i: int(imatch.parse([r.fingerprint]).n[0]) for i, r in got.items()} == {i: len(t) for i, t in terms.items()}
    assert len({r.fingerprint for r in got.values()}) == len(set(terms.values()))
    by = collections.defaultdict(set)
    for i, r in got.items():
        by[terms[i]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by.values())
    errors = []
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)], len(t) // 2
        edited = frozenset(terms_of(t[: len(t) - half] + after[1][:half]) & band)
        for other, like in ((terms[after[0]], got[i].near_next), (edited, got[i].near_edited)):
            both = terms[i] | other
            errors.append(abs(like - (len(terms[i] & other) / len(both) if both else 1.0)))
    assert np.mean(errors) < 0.08 and np.quantile(errors, 0.95) < 0.25  # an estimate from 84 parts; 0.060 when this was written

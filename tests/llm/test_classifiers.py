import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostrata.llm import langid, lm, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("run, mod, hit", [(quality.quality, 5, 0), (toxicity.toxicity, 3, 1)])
def test_odd_rows_and_tables(spark, odd, odd_rows, none, labels, no_labels, run, mod, hit):
    rows = run(odd, labels).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == hit)
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[7]) == 1 and by[30] == by[31] and by[9] & by[None]
    assert run(none, labels).count() == 0
    assert {r.score for r in run(odd, no_labels).collect()} == {0.5}


def test_text_alone_decides(spark, odd, labels):
    net = quality.train(odd, labels)
    texts = ["one two three", "", "x" * 5000, None]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts])
    words = toxicity.WordNet.fresh(1)
    assert np.allclose(words.scores(texts), [words.scores([t])[0] for t in texts])


def test_gradients_match_differences():
    net = quality.ByteNet.fresh(3)
    noise = np.random.default_rng(9).integers(32, 127, 700, dtype=np.uint8).tobytes()
    rows, first = quality.half_chunks([noise[:500], noise[500:], noise[100:103]])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p = quality.sigmoid(net.head(net.pooled(rows), first)[0].astype(np.float64))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = net.gradients(rows, first, y)
    r = np.random.default_rng(0)
    for name in ("w1", "w2", "w3", "emb", "b2"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        direction = r.standard_normal(len(flat)).astype(np.float32)
        before, eps = flat.copy(), 3e-4
        flat += eps * direction
        up = loss()
        flat[:] = before - eps * direction
        down = loss()
        flat[:] = before
        assert (up - down) / (2 * eps) == pytest.approx(float(g @ direction), rel=0.08, abs=2e-3), name


@pytest.mark.parametrize("run, label, least", [(quality.quality, "quality", 0.95), (toxicity.toxicity, "toxic", 0.85)])
def test_held_out_accuracy(spark, run, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = run(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(got) > 40 and np.mean([r[0] == r[1] for r in got]) >= least


def test_thresholds_by_language():
    score = np.array([0.1, 0.2, 0.4, 0.6])
    assert 0.2 < toxicity.best_threshold(score, np.array([0, 0, 1, 1])) < 0.4
    assert toxicity.best_threshold(np.array([0.1, 0.9]), np.array([0, 1])) == toxicity.THRESHOLD


def test_lm_odd_rows_and_tables(spark, odd, odd_rows, none, labels):
    rows = lm.score(odd, lm.good_documents(labels)).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        assert r.score == pytest.approx(r.target_loss - r.background_loss)
    assert by[1][0].n_tokens == by[2][0].n_tokens == by[5][0].n_tokens == 0 and by[2][0].score == 0
    assert by[7][0].score == by[7][1].score == by[9][0].score < 0
    assert lm.score(none, lm.good_documents(labels)).count() == 0
    assert all(r.score == 0 for r in lm.score(odd, lm.good_documents(labels).where("false")).collect())


def test_lm_against_brute_force(spark):
    import collections
    import math
    import re

    docs, labels = (spark.read.parquet(f"{SF[:-4]}0.001/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.score for r in lm.score(docs, lm.good_documents(labels)).collect()}
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text) for r in docs.collect()}
    good = {r.good_id for r in lm.good_documents(labels).collect()}
    seen = collections.Counter(w for i in good for w in words[i])
    known = {w for w, n in seen.items() if n >= lm.LEAST}

    def model(ids):
        one, two = collections.Counter(), collections.Counter()
        for i in ids:
            left = "^"
            one["^"] += bool(words[i])
            for w in (x if x in known else None for x in words[i]):
                one[w] += 1
                two[left, w] += 1
                left = w
        return one, two, sum(one.values()) - one["^"]

    def loss(m, ws):
        one, two, total = m
        out, left = 0.0, "^"
        for w in (x if x in known else None for x in ws):
            p = (one[w] + 1 / (len(known) + 1)) / (total + 1)
            out -= math.log((two[left, w] + lm.MU * p) / (max(one[left], two[left, w]) + lm.MU))
            left = w
        return out

    target, background = model(good), model(words)
    errors = [abs((loss(target, w) - loss(background, w)) / max(1, len(w)) - got[i]) for i, w in words.items()]
    assert max(errors) < 1e-6


@pytest.mark.parametrize("hot", [0, 50, lm.HOT])
def test_lm_counts_are_exact(spark, monkeypatch, hot):
    """Equal counts by hand, however many pairs are broadcast; more distinct pairs than hashed cells would tell apart."""
    import collections
    import math

    monkeypatch.setattr(lm, "HOT", hot)
    r = np.random.default_rng(4)
    texts = {i: [f"w{x}" for x in r.zipf(1.3, 400) % 3000] for i in range(300)}
    texts[300] = texts[7]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    good = set(range(0, 300, 3))
    got = {x.doc_id: x for x in lm.score(docs, spark.createDataFrame([(i,) for i in good], "good_id long")).collect()}
    seen = collections.Counter(w for i in good for w in texts[i])
    known = {w for w, n in seen.items() if n >= lm.LEAST}
    want = {i: [0.0, 0.0] for i in texts}
    for at, ids in enumerate((good, texts)):
        one, two = collections.Counter(), collections.Counter()
        line = {i: ["^"] + [w if w in known else None for w in texts[i]] for i in texts}
        for i in ids:
            one.update(line[i])
            two.update(zip(line[i], line[i][1:]))
        total = sum(one.values()) - one["^"]
        for i in texts:
            for left, w in zip(line[i], line[i][1:]):
                p = (one[w] + 1 / (len(known) + 1)) / (total + 1)
                want[i][at] -= math.log((two[left, w] + lm.MU * p) / (one[left] + lm.MU)) / len(texts[i])
    assert len(got) == len(texts) and got[300].score == got[7].score
    for i, (target, background) in want.items():
        assert got[i].target_loss == pytest.approx(target, abs=1e-8) and got[i].background_loss == pytest.approx(background, abs=1e-8)


def test_a_part_takes_little_more_than_its_pieces(monkeypatch):
    """Losses of a part's documents against sums one by one, in less than twice the memory of its packed pairs."""
    import collections
    import tracemalloc
    from types import SimpleNamespace

    monkeypatch.setattr(lm, "RANGE", 1 << 13, raising=False)
    r, data, docs_of = np.random.default_rng(8), [], []
    words = [r.integers(1, 50, 4000).astype(float) for _ in range(2)]
    for _ in range(30):
        key = np.unique(r.integers(0, 4000, 30_000) << 32 | r.integers(0, 4000, 30_000))
        n_docs, n_good = r.integers(1, 3, len(key)).astype(np.int32), r.integers(0, 2, len(key)).astype(np.int32)
        doc = np.concatenate([r.choice(500, k, replace=False) for k in n_docs]).astype(np.int32)
        docs_of.append((key, n_docs, n_good, doc, r.integers(1, 4, len(doc)).astype(np.int32)))
        data.append(lm.pack(np.diff(key, prepend=0), *docs_of[-1][1:]))
    batch = lm._rows([0] * len(data), list(range(len(data))), data)
    size, models = sum(map(len, data)), lm.Models(words)
    del data
    tracemalloc.start()
    try:
        got = list(lm._loss_task(SimpleNamespace(value=models), False)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * size
    n, good = collections.Counter(), collections.Counter()
    for key, n_docs, n_good, _, times in docs_of:
        for k, a, b in zip(key.tolist(), np.add.reduceat(times, np.cumsum(n_docs) - n_docs).tolist(), n_good.tolist()):
            n[k] += a
            good[k] += b
    every = np.array(sorted(n))
    losses = models.losses(every, (np.array([good[k] for k in every.tolist()]), np.array([n[k] for k in every.tolist()])))
    for chunk, (out, (key, n_docs, _, doc, times)) in enumerate(zip(got, docs_of)):
        found, *sums = lm.unpack(out.column("data")[0].as_py())
        assert out.column("chunk")[0].as_py() == chunk
        for x, total in zip(losses, sums):
            want = np.zeros(500, np.int64)
            np.add.at(want, doc, np.repeat(x[np.searchsorted(every, key)], n_docs) * times)
            assert (total == want[found]).all() and not np.delete(want, found).any()


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, score double, host string")


def test_language_of_pages(spark, none):
    docs = spark.read.parquet(f"{SF[:-4]}0.001/documents.parquet")
    texts = {r.lang: r.text[:1500] for r in docs.where("n_chars > 1500").orderBy("doc_id").collect()}
    rows = [(i, f"http://h{i % 3}.example.{'de' if lang == 'de' else 'com'}/x", f"<html><body><script>var a='<p>';</script><p>{t}</p></body></html>", 0.0, "h") for i, (lang, t) in enumerate(sorted(texts.items()))]
    want = {i: lang for i, lang in enumerate(sorted(texts))}
    got = langid.identify(_pages(spark, rows), docs).collect()
    assert {r.page_id: r.lang for r in got} == want and all(r.probability > 0.9 for r in got)

    # declarations and hosts speak where texts do not
    said = [(100 + i, "https://Sub.seite.example.de:80/", f'<html xml:lang="de-AT"><p>{texts["de"]}</p>', 0.0, "h") for i in range(30)]
    said += [(1, "https://sub.seite.example.de/", "", 0.0, "h"), (2, None, '<HTML LANG="de">', 0.0, "h"), (3, "not a url", None, 0.0, "h"), (None, None, None, None, None), (1, "https://sub.seite.example.de/", "", 0.0, "h")]
    got = langid.identify(_pages(spark, said), docs).collect()
    assert len(got) == len(said)
    by = {r.page_id: r for r in got}
    assert by[1].lang == "de" and by[1].host == "sub.seite.example.de" and by[1].text_lang is None
    assert by[2].lang == "de" and by[2].declared == "de" and by[3].host == "" and by[None].n_trigrams == 0
    assert langid.identify(_pages(spark, []), docs).count() == 0
    assert {r.lang for r in langid.identify(_pages(spark, said), none).collect()} == {None}


def test_page_parts():
    assert langid.host_levels("http://a.b.example.org/x?y") == ("a.b.example.org", "example.org", "org")
    assert langid.host_levels("mailto:x") == ("", "", "")
    assert langid.declared_language(b'<meta http-equiv="Content-Language" content="fr-CA">') == "fr"
    assert langid.visible_text(b"a<!-- x -->b<style>p{}</style>c &amp; d").split() == [b"a", b"b", b"c", b"&", b"d"]


def test_quality_scores_one_by_one():
    """Against a plain evaluation, a filter's place at a time."""
    net = quality.ByteNet.fresh(5)
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = ["", "short", "a text of more than one half chunk. " * 9, "ü日本 " * 60, None]
    for text, got in zip(texts, net.scores(texts)):
        raw = (text or "").encode()
        n = max(1, -(-len(raw) // quality.HALF))
        raw = raw.ljust(n * quality.HALF, b"\0") + bytes(quality.WIDTH - 1)
        halves = []
        for i in range(n):
            best = np.full(quality.FILTERS, -np.inf)
            for at in range(i * quality.HALF, (i + 1) * quality.HALF, quality.STRIDE):
                best = np.maximum(best, np.concatenate([p["emb"][b] for b in raw[at : at + quality.WIDTH]]) @ p["w1"])
            halves.append(np.maximum(best + p["b1"], 0))
        chunks = [np.maximum(halves[i], halves[min(i + 1, n - 1)]) for i in range(n)]
        hidden = np.array([np.maximum(c @ p["w2"] + p["b2"], 0) for c in chunks])
        logit = np.concatenate([hidden.max(0), hidden.mean(0)]) @ p["w3"] + p["b3"][0]
        assert got == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-8)


def test_toxicity_scores_one_by_one(monkeypatch):
    """Against a plain evaluation, a word at a time; pieces of few words change nothing."""
    net = toxicity.WordNet.fresh(5)
    texts = ["", "one", "one two", "Several words, and MORE of them " * 20, None, "wörter 日本"]
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    want = []
    for text in texts:
        rows, _ = toxicity.features([text])
        x = [sum(net.p["emb"][i] for i in r) / len(r) for r in rows]
        logit = p["bias"][0]
        if x:
            best = []
            for k in toxicity.WIDTHS:
                best.append(np.max([sum(x[i + j].astype(np.float64) @ p[f"w{k}"][j] for j in range(k) if i + j < len(x)) for i in range(len(x))], axis=0))
            logit += np.maximum(np.concatenate(best) + p["b"], 0) @ p["out"]
        want.append(1 / (1 + np.exp(-logit)))
    for step in (toxicity.STEP, 7, 1):
        monkeypatch.setattr(toxicity, "STEP", step)
        assert np.allclose(net.scores(texts), want, atol=1e-7)


@pytest.mark.parametrize("shard_bytes", [toxicity.SHARD_BYTES, 50_000])
def test_toxicity_learns_from_all_rows(spark, shard_bytes):
    """What only the last rows of a class say, in the order of a hash, beyond any 1,500, is learned too; a class of few rows is in every shard."""
    ids = [r.doc_id for r in spark.range(6000).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id")).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    toxic = ids[::2]
    late = set(toxic[1600:])
    assert len(late) > 300
    word = {i: "late" if i in late else "bad" for i in toxic}
    if shard_bytes < toxicity.SHARD_BYTES:  # few toxic rows, most of them late
        toxic = toxic[1590:]
    rows = [(i, f"w{i % 7} x{i % 11} {word.get(i, 'good')} y{i % 5}", "en") for i in (*ids[1::2], *toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(w in ("late", "bad"))) for i, w in ((i, t.split()[2]) for i, t, _ in rows)], "doc_id long, toxic int")
    net, thresholds = toxicity.train(docs, labels, shard_bytes=shard_bytes)
    likely, not_likely = net.scores(["w1 x2 late y3", "w1 x2 good y3"])
    assert likely > thresholds[None] > not_likely and likely > 0.5 > not_likely and "en" in thresholds


def test_best_threshold_against_all_cuts():
    r = np.random.default_rng(2)
    for n in (1, 2, 5, 60):
        for _ in range(20):
            score, y = r.integers(0, 12, n) / 11, r.integers(0, 2, n)
            f1 = lambda t: 2 * (y[score >= t] == 1).sum() / max(1, (score >= t).sum() + (y == 1).sum())  # noqa: E731, B023
            cuts = np.unique(score)
            want = max([toxicity.THRESHOLD, *((cuts[1:] + cuts[:-1]) / 2)], key=lambda t: (f1(t), -abs(t - toxicity.THRESHOLD)))
            assert toxicity.best_threshold(score, y) == pytest.approx(want)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_learns_from_the_end_of_long_texts(module):
    """What parts the classes stands beyond the first thousands of words."""
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    text = lambda end: " ".join([*r.choice(words, 2500), *[end] * 6, *r.choice(words, 20)])
    texts = [text(("zzgood", "qqbad")[i % 2]) for i in range(24)]
    y = np.array([i % 2 for i in range(24)], np.float32)
    net = module.fit(texts, y, np.ones(24, np.float32), **({"steps": 150} if module is quality else {"epochs": 1}))
    assert ((net.scores(texts) >= 0.5) == y).all()


def test_wordless_classes(spark):
    net = toxicity.fit(["", " ", "a b"], np.array([1, 1, 0], np.float32), np.ones(3, np.float32))
    assert net.scores(["anything", ""]).tolist() == pytest.approx([2 / 3, 2 / 3])


def test_samples_are_bounded(spark):
    from aerostrata.llm import training

    docs = spark.createDataFrame([(i, "x" * 100, "en") for i in range(50)] + [(7, "y" * 100, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    texts, y, weight, _ = training.labelled_sample(docs, labels, "quality", F.lit(True), per_class=20, class_bytes=950)
    assert len(texts) == 20 and y.sum() == 10
    texts, *_ = training.labelled_sample(docs, labels, "quality", F.lit(True))
    assert len(texts) == 50 and sum(t[0] == "y" for t in texts) == 1


def languages_by_brute_force(pages, docs):
    import html
    import math
    import re

    langs = sorted({lang for lang, _ in docs if lang})
    cell = lambda a, b, c: (((a << 16 | b << 8 | c) * 0x9E3779B1) & 0xFFFFFFFF) >> 16
    low = lambda b: 32 if b < 33 else b + 32 if 65 <= b < 91 else b

    def grams(raw):
        x = [low(b) for b in b" " + raw + b" "]
        return [cell(*x[i : i + 3]) for i in range(len(x) - 2)]

    logs = {}
    for lang in langs:
        counts = np.full(langid.CELLS, langid.SMOOTHING)
        for c in grams(b" ".join(t.encode() for own, t in docs if own == lang and t)):
            counts[c] += 1
        logs[lang] = np.log(counts / counts.sum())
    seen = []
    for page_id, url, page in pages:
        raw = re.sub(rb"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>", b" ", (page or "").encode())
        raw = html.unescape(raw.decode()).encode()
        g = grams(raw) if raw.strip() else []
        e = [WEIGHT * math.sqrt(len(g)) * sum(logs[x][c] for c in g) / len(g) if g else 0.0 for x in langs]
        post = np.exp(np.array(e) - max(e))
        host = re.match(r"[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
        host = host[1].lower().rstrip(".") if host else ""
        said = re.search(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})""", page or "")
        seen.append((page_id, [host, ".".join(host.split(".")[-2:]), host.split(".")[-1], ""], said and said[1].lower(), np.array(e), post / post.sum()))
    total = lambda some: np.sum([s[4] for s in some], axis=0) if some else np.zeros(len(langs))
    names = {s[2] for s in seen if s[2]}
    out = {}
    for page_id, levels, said, e, own in seen:
        prior = (np.maximum(total(seen) - own, 0) + 1) / (max(len(seen) - 1, 0) + len(langs))
        for i, strength in ((2, langid.SUFFIX_PRIOR), (1, langid.DOMAIN_PRIOR), (0, langid.HOST_PRIOR)):
            group = [s for s in seen if s[1][i:3] == levels[i:3]]
            prior = (np.maximum(total(group) - own, 0) + strength * prior) / (max(len(group) - 1, 0) + strength)
        score = e + np.log(prior)
        if said:
            before = np.array([langid.DECLARED_TRUST if x == said else (1 - langid.DECLARED_TRUST) / len(names) for x in langs])
            of = total([s for s in seen if s[2] == said])
            every = total([s for s in seen if s[2]])
            score = score + np.log((np.maximum(of - own, 0) + langid.DECLARED_PRIOR * before) / (np.maximum(every - own, 0) + langid.DECLARED_PRIOR))
        p = np.exp(score - score.max())
        out[page_id] = (langs[int(score.argmax())], float(p.max() / p.sum()))
    return out


WEIGHT = langid.WEIGHT


def test_languages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF[:-4]}0.001/documents.parquet").where("doc_id % 3 = 0")
    pages = spark.read.parquet(f"{SF[:-4]}0.001/pages.parquet").select("page_id", "url", "html")
    short = spark.createDataFrame([(9000 + i, u, h) for i, (u, h) in enumerate([("http://a.example.de/x", "ja"), ("http://a.example.de/y", '<html lang="de">'), ("http://b.example.fr", "<p>le"), (None, None), ("http://c.example.fr", '<html lang="fr"><p>' + "le mot juste " * 5000)])], "page_id long, url string, html string")
    both = pages.unionByName(short)
    want = languages_by_brute_force([tuple(r) for r in both.collect()], [(r.lang, r.text) for r in docs.collect()])
    got = {r.page_id: (r.lang, r.probability) for r in langid.identify(both, docs).collect()}
    assert got.keys() == want.keys()
    for i, (lang, p) in want.items():
        assert got[i][0] == lang and got[i][1] == pytest.approx(p, abs=2e-6)

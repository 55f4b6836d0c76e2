"""Language of web pages by Bayesian fusion of evidence.

* Text: bytes' trigrams (ASCII letters in lower case) of the page without markup,
  under a smoothed model of each language, counted over all labelled documents.
  Neighbouring trigrams are no independent evidence, so the mean log likelihood
  of n counts ``WEIGHT`` times the square root of n: longer pages say more, ever
  more slowly.
* Markup: the language declared by the page (html's lang or xml:lang, else a
  content-language meta).  How far a declaration can be trusted is learned from
  the pages: P(declared | language) from soft counts over all pages.
* Address: a prior for the page's host, smoothed by that of its domain, which is
  smoothed by that of its address suffix, and that by all pages.  Each level's
  soft counts are grouped aggregates of the text-only posteriors, a page's own
  part taken out.  The suffix enters here alone, so it counts once.

The languages are those of the documents.  Results are probabilities of them.

Defined results: a null or empty page has no text evidence, an undeclared one no
markup evidence; a very long page is read whole, as a block of its own; a null or malformed url is the host ''; without any labelled
document lang and probability are null; ties go to the first language in code
point order; repeated pages get a row each; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin_task, blocks, bounded, ensure_path, staged, unstage

CELLS = 1 << 16
WEIGHT = 2.0
#: Strength of each level's prior, in pages; trust put in a declaration before any page is seen.
HOST_PRIOR, DOMAIN_PRIOR, SUFFIX_PRIOR, DECLARED_PRIOR, DECLARED_TRUST = 4.0, 4.0, 8.0, 10.0, 0.8
SMOOTHING = 0.1
#: Tables of at most so many rows are broadcast.
SMALL_ROWS = 50_000

_MARKUP = re.compile(rb"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>")
_HTML_LANG = re.compile(rb"""(?is)<html\b[^>]*?\b(?:xml:)?lang\s*=\s*["']?\s*([a-z]{2,3})""")
_META_LANG = re.compile(rb"""(?is)<meta\b(?=[^>]*http-equiv\s*=\s*["']?content-language)[^>]*?content\s*=\s*["']?\s*([a-z]{2,3})""")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)")

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[:33] = 32


def trigrams(raw: bytes) -> np.ndarray:
    """Cells of a text's byte trigrams, with a space at either end."""
    x = _LOWER[np.frombuffer(b" " + raw + b" ", np.uint8)]
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def visible_text(page: bytes) -> bytes:
    text = _MARKUP.sub(b" ", page)
    return html_lib.unescape(text.decode("utf-8", "replace")).encode() if b"&" in text else text


def declared_language(page: bytes) -> str | None:
    found = _HTML_LANG.search(page) or _META_LANG.search(page)
    return found[1].decode().lower() if found else None


def host_levels(url: str | None) -> tuple[str, str, str]:
    """Host, domain (its last two labels) and suffix (its last label)."""
    found = _HOST.match(url or "")
    host = found[1].lower().rstrip(".") if found else ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def _count_task(langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(langs)}
        table = np.zeros((len(langs), CELLS), np.int64)
        for batch in batches:
            for part in blocks(batch):
                by: dict[int, list[bytes]] = {}
                for text, lang in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("lang").to_pylist()):
                    if text and lang in place:
                        by.setdefault(place[lang], []).append(text)
                for i, texts in by.items():
                    table[i] += np.bincount(trigrams(b" ".join(texts)), minlength=CELLS)
        for i, counts in enumerate(table):
            if counts.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["i", "counts"])

    return run


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, counts in zip(batch.column("i").to_pylist(), batch.column("counts").to_pylist()):
            total[i] = total.get(i, 0) + np.frombuffer(counts, np.int64)
    for i, counts in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["i", "counts"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of docs (lang, text), and each cell's log probability in each (CELLS numbers a language)."""
    ensure_path(docs.sparkSession)
    langs = sorted(r.lang for r in docs.where("lang is not null").select("lang").distinct().collect())
    if not langs:
        return [], np.empty((0, CELLS))
    counted = docs.select("lang", "text").mapInArrow(_count_task(langs), "i int, counts binary")
    table = np.zeros((len(langs), CELLS))
    for row in counted.repartition(len(langs), "i").mapInArrow(_sum_task, "i int, counts binary").collect():
        table[row.i] = np.frombuffer(row.counts, np.int64)
    table += SMOOTHING
    return langs, np.log(table / table.sum(1, keepdims=True))


def mean_rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The mean of the table's rows at these places, some at a time."""
    return sum(table[at[i : i + 65536]].sum(0) for i in range(0, len(at), 65536)) / len(at)


def _page_task(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.ascontiguousarray(model.T)
        begin_task()
        for batch in (part for batch in batches for part in blocks(batch, "html")):
            out: list[list] = [[] for _ in range(8)]
            for page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                page = (page or "").encode()
                text = visible_text(page)
                grams = trigrams(text) if text.strip() else np.empty(0, np.int64)
                evidence = np.zeros(cells.shape[1])
                if len(grams):
                    evidence = mean_rows(cells, grams) * WEIGHT * len(grams) ** 0.5
                    evidence -= evidence.max()
                post = np.exp(evidence)
                for column, value in zip(out, (page_id, *host_levels(url), declared_language(page), len(grams), evidence.tolist(), (post / post.sum()).tolist())):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["page_id", "host", "domain", "suffix", "declared", "n_trigrams", "evidence", "post"])

    return run


def _sums(of: str, n: int) -> Column:
    return F.array(*[F.sum(F.col(of)[i]) for i in range(n)])


def fuse(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """Rows (page_id, lang, probability, text_lang, declared, host, n_trigrams) for every page."""
    ensure_path(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    if not langs:
        return pages.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("declared"), F.lit("").alias("host"), F.lit(0).cast("long").alias("n_trigrams"))
    n = len(langs)
    seen = staged(pages.mapInArrow(_page_task(model), "page_id long, host string, domain string, suffix string, declared string, n_trigrams long, evidence array<double>, post array<double>"), "langid-pages")
    hosts = staged(seen.groupBy("suffix", "domain", "host").agg(_sums("post", n).alias("of_host")), "langid-hosts")
    domains = hosts.groupBy("suffix", "domain").agg(_sums("of_host", n).alias("of_domain"))
    suffixes = domains.groupBy("suffix").agg(_sums("of_domain", n).alias("of_suffix"))
    everywhere = suffixes.agg(_sums("of_suffix", n).alias("of_all"))
    levels = hosts.join(domains, ["suffix", "domain"]).join(suffixes, "suffix").crossJoin(F.broadcast(everywhere))  # one row
    levels = staged(levels.select("host", "of_host", "of_domain", "of_suffix", "of_all"), "langid-levels")
    unstage(hosts)
    trust = staged(seen.where("declared is not null").groupBy("declared").agg(_sums("post", n).alias("of_declared")), "langid-declared")
    totals = seen.where("declared is not null").agg(_sums("post", n).alias("t")).first().t
    n_names = trust.count()

    rows = seen.join(bounded(levels, SMALL_ROWS), "host").join(bounded(trust, SMALL_ROWS), "declared", "left")

    def log_posterior(i: int) -> Column:
        own = F.col("post")[i]
        part = lambda c: F.greatest(F.col(c)[i] - own, F.lit(0.0))
        whole = lambda c: F.greatest(F.aggregate(c, F.lit(0.0), lambda a, x: a + x) - 1, F.lit(0.0))
        prior = (part("of_all") + 1) / (whole("of_all") + n)
        for c, strength in (("of_suffix", SUFFIX_PRIOR), ("of_domain", DOMAIN_PRIOR), ("of_host", HOST_PRIOR)):
            prior = (part(c) + strength * prior) / (whole(c) + strength)
        before = F.when(F.col("declared") == langs[i], DECLARED_TRUST).otherwise((1 - DECLARED_TRUST) / max(1, n_names))
        said = (F.greatest(F.col("of_declared")[i] - own, F.lit(0.0)) + DECLARED_PRIOR * before) / (F.greatest(F.lit(float(totals[i] or 0)) - own, F.lit(0.0)) + DECLARED_PRIOR)
        return F.col("evidence")[i] + F.log(prior) + F.when(F.col("declared").isNotNull(), F.log(said)).otherwise(0.0)

    rows = rows.withColumn("score", F.array(*[log_posterior(i) for i in range(n)]))
    rows = rows.withColumn("top", F.array_max("score"))
    names = F.array(*[F.lit(x) for x in langs])
    at = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    share = 1 / F.aggregate(F.transform("score", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    text_lang = F.when(F.col("n_trigrams") > 0, at("post"))
    return rows.select("page_id", at("score").alias("lang"), F.round(share, 6).alias("probability"), text_lang.alias("text_lang"), "declared", "host", "n_trigrams")


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    return fuse(pages, *train(docs))

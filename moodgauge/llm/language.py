"""Language of web pages by Bayesian fusion of evidence.

For each page the posterior of a language is proportional to: the likelihood of its visible text under character trigrams (tempered, as
trigrams overlap); the likelihoods of the declared markup language and of the address suffix; and the prior of its host. Trigrams
are counted over all documents whose language is known. The other tables come from the pages by grouped aggregation of the
text's own verdicts, which are kept apart from them: declared language and suffix per language with additive smoothing; host priors
smoothed towards their domain's, and those towards the global one, each without the page's own share. A hot host is summed
before the shuffle.

Defined cases: a null or empty page, or one without text, has a flat text likelihood; a null address has the empty host; a missing
declaration is a value like any other; without documents of a known language there is no row to choose from and lang is null;
rows that repeat count each; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.text import resolve_entities
from moodgauge.llm import text as tx
from moodgauge.llm.tables import stored

GRAM, BUCKETS = 3, 1 << 15
TEMPER = 1.0 / GRAM
# elements whose content is not shown, up to their end tag
OPENED = re.compile(r"<(script|style|noscript|template)\b", re.I)
CLOSED = {name: re.compile(rf"</{name}\s*+>", re.I) for name in ("script", "style", "noscript", "template")}
ROOT = re.compile(r"<html\b", re.I)
LANG = re.compile(r"\blang\s*+=\s*+(?:[\"']\s*+)?+([A-Za-z]+)", re.I)
# a task sends its counts on when it holds so many languages
HELD_LANGUAGES = 64


def visible(page: str | None) -> str:
    """The text of a page between its tags, without scripts, styles and comments.

    One pass over the places of `<`. An end that is not found once is not there further on either, and is not looked for again, so
    the time is proportional to the page, whatever it leaves open.
    """
    if not page:
        return ""
    shown, at, absent = [], 0, set()
    while True:
        begin = page.find("<", at)
        close = page.find(">", begin + 1) if begin >= 0 else -1
        if close < 0:
            shown.append(page[at:])
            return resolve_entities(" ".join(shown))
        shown.append(page[at:begin])
        at = close + 1
        opened = OPENED.match(page, begin)
        if page.startswith("<!--", begin) and "comment" not in absent:
            end = page.find("-->", begin + 4)
            if end >= 0:
                at = end + 3
            else:
                absent.add("comment")
        elif opened and (name := opened[1].casefold()) not in absent:
            end = CLOSED[name].search(page, opened.end())
            if end:
                at = end.end()
            else:
                absent.add(name)


def declared(page: str | None) -> str:
    """The language that the page's root element declares, in lower case; '' if none does."""
    root = ROOT.search(page) if page else None
    while root:
        # a tag reaches to the next `>`; another root within it has no more to offer
        close = page.find(">", root.end())
        end = close if close >= 0 else len(page)
        found = LANG.search(page, root.end(), end)
        if found:
            return found[1].lower()
        root = ROOT.search(page, end)
    return ""


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each byte trigram within a text, and its text."""
    lowered = tx.LOWER[data]
    places, text = tx.whole_windows(np.diff(offsets), GRAM)
    mixed = (lowered[places].astype(np.uint64) << np.uint64(16)) | (lowered[places + 1].astype(np.uint64) << np.uint64(8)) | lowered[places + 2].astype(np.uint64)
    return (tx.mix(mixed) % np.uint64(BUCKETS)).astype(np.int64), text


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all documents with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for name, n in sums.items():
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "bucket", "n"])
            sums.clear()

        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                buckets, text = gram_buckets(data, offsets)
                names = rows.column("lang").dictionary_encode()
                which = names.indices.to_numpy(zero_copy_only=False)[text]
                for k, name in enumerate(names.dictionary.to_pylist()):
                    sums[name] = sums.get(name, 0) + np.bincount(buckets[which == k], minlength=BUCKETS)
                    if len(sums) >= HELD_LANGUAGES:
                        yield from give()
        yield from give()

    found = docs.select("text", F.col("lang").cast("string").alias("lang")).filter("lang is not null").mapInArrow(tx.tidy(count), "lang string, bucket long, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def gram_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log-probabilities of buckets, languages x BUCKETS: as large as the number of languages."""
    held = gram_counts(docs).toPandas()
    names = sorted(held["lang"].unique())
    counts = np.full((len(names), BUCKETS), 0.1)
    counts[[names.index(x) for x in held["lang"]], held["bucket"]] += held["n"]
    return names, np.log(counts / counts.sum(1, keepdims=True))


def evidence(pages: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """page_id, host, domain, suffix, declared, and the text's log-likelihood and posterior per language."""
    shared = pages.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for rows, _, _ in tx.chunks(batch, "html"):
                page = rows.column("html").to_pylist()
                data, offsets = tx.flat(pa.array([visible(p) for p in page], pa.string()))
                buckets, text = gram_buckets(data, offsets)
                like = np.stack([np.bincount(text, row[buckets].astype(np.float64), len(page)) for row in own], 1) * TEMPER
                like -= like.max(1, keepdims=True)
                chance = np.exp(like)
                chance /= chance.sum(1, keepdims=True)
                lists = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in (like, chance)]
                yield pa.RecordBatch.from_arrays([rows.column("page_id").cast(pa.int64()), rows.column("host").cast(pa.string()), pa.array([declared(p) for p in page]), *lists], ["page_id", "host", "declared", "like", "chance"])

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    found = pages.select("page_id", "html", host.alias("host")).mapInArrow(tx.tidy(read), "page_id long, host string, declared string, like array<double>, chance array<double>")
    parts = F.split("host", r"\.")
    return found.select("*", F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".").alias("domain"), F.element_at(parts, -1).alias("suffix"))


def summed(pages: DataFrame, key: str, n: int) -> DataFrame:
    """Per value of the key the sums of the text's posteriors, by language."""
    return pages.groupBy(key).agg(F.array(*[F.sum(F.col("chance")[i]) for i in range(n)]).alias(f"of_{key}"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def posterior(pages: DataFrame, names: list[str], strength: float = 5.0) -> DataFrame:
    """page_id, host, declared, suffix, text_lang, lang, probability. pages: as `evidence` gives them."""
    n = len(names)
    overall = pages.agg(F.array(*[F.coalesce(F.sum(F.col("chance")[i]), F.lit(0.0)) for i in range(n)]).alias("overall"))
    joined = pages
    for key in ("host", "domain", "declared", "suffix"):
        joined = joined.join(summed(pages, key, n), key)
    everything = overall.first()["overall"]
    kinds = {key: max(1, pages.select(key).distinct().count()) for key in ("declared", "suffix")}
    of_all = F.array(*[F.lit((x + 1.0) / (sum(everything) + n)) for x in everything])

    def without_own(sums: str) -> Column:
        return F.zip_with(sums, "chance", lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def smoothed(sums: Column, towards: Column) -> Column:
        rest = total(sums) + strength
        return F.zip_with(sums, towards, lambda a, b: (a + strength * b) / rest)

    fused = joined.withColumn("of_all", of_all).withColumn("prior", smoothed(without_own("of_host"), smoothed(without_own("of_domain"), F.col("of_all"))))
    score = F.zip_with("like", "prior", lambda a, b: a + F.log(b))
    for key in ("declared", "suffix"):
        all_of = F.array(*map(F.lit, everything))
        given = F.zip_with(without_own(f"of_{key}"), F.zip_with(all_of, "chance", lambda a, b: F.greatest(a - b, F.lit(0.0))), lambda a, b: F.log((a + 1.0) / (b + kinds[key])))
        score = F.zip_with(score, given, lambda a, b: a + b)
    fused = fused.withColumn("score", score).withColumn("score", F.transform("score", lambda x: F.exp(x - F.array_max("score"))))
    named = F.array(*map(F.lit, names))
    best = F.array_max(F.zip_with("score", named, lambda s, name: F.struct(s.alias("s"), name.alias("name"))))
    by_text = F.array_max(F.zip_with("chance", named, lambda s, name: F.struct(s.alias("s"), name.alias("name"))))
    return fused.select("page_id", "host", "declared", "suffix", by_text["name"].alias("text_lang"), best["name"].alias("lang"), (best["s"] / total(F.col("score"))).alias("probability"))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, host, declared, suffix, text_lang, lang, probability for every page."""
    names, model = gram_model(docs)
    if not names:
        return pages.select("page_id", *[F.lit(None).cast(kind).alias(name) for name, kind in (("host", "string"), ("declared", "string"), ("suffix", "string"), ("text_lang", "string"), ("lang", "string"), ("probability", "double"))])
    return posterior(stored(evidence(pages, names, model), "pages"), names)

"""URL filter: rules first, else naive Bayes on the words of host and path.

Host names are often several words written together.  A unigram model, counted over the titles of all pages, the words
of all paths and the words of all hosts that hyphens set apart, splits them by Viterbi's algorithm into their most
likely words.  The top-level domain is one word as it stands.  Multinomial naive Bayes then scores the words of host and path.  Its classes are learned from all urls: those with a word of a short list of
unwanted words (``seeds``) against the others, so that words which go along with these count as well.

Null urls and such without "://" have an empty host and path; without words the prior decides (allow, unless most
urls are unwanted).  Rows with equal or null ids each get their own row, an empty table gives an empty result, and
further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import broadcast_checked, ship_code, stage

#: Words whose urls teach the classifier what is unwanted.
SEEDS = ("ads", "adult", "bets", "casino", "escort", "gambling", "payday", "pills", "porn", "sex", "spam", "viagra", "warez", "xxx")
#: Longest word of the unigram model.
WORD = 20
#: Tables of hosts, paths and words are broadcast up to this many rows, else joined by sorting.
SMALL = 100_000
#: ... and up to this many bytes, as paths and hosts may be long.
SMALL_BYTES = 64 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host's last label, without a port or the root's dot.
_TOP = r"\.([^.:]*)\.?(?::[^.]*)?$"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct of rule and verdict of the longest rule (verdict, host, path) that fits, else null."""
    kind = "struct<rule:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def path_words(path: Column) -> Column:
    """Letters-only words and one mark for numbers."""
    parts = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)
    return F.transform(parts, lambda w: F.when(w.rlike(r"^\p{N}+$"), F.lit("<number>")).otherwise(w))


def host_parts(host: Column) -> Column:
    """The host's runs of letters without those of the top-level domain, which isn't split into words."""
    names = F.when(host.contains("."), F.regexp_replace(host, _TOP, "")).otherwise(host)
    return F.filter(F.split(names, r"[^\p{L}]+"), lambda w: F.length(w) > 0)


def hyphened_words(host: Column) -> Column:
    """Words that a hyphen sets apart in the host's labels, without the top-level domain."""
    labels = F.filter(F.split(F.regexp_replace(host, _TOP, ""), r"\."), lambda label: label.contains("-"))
    return F.filter(F.flatten(F.transform(labels, lambda label: F.split(label, r"[^\p{L}]+"))), lambda w: F.length(w) > 0)


def top_level(host: Column) -> Column:
    """The top-level domain as an array of one word; empty if the host has none, or a number (of an address) there."""
    label = F.regexp_extract(host, _TOP, 1)
    return F.when(label.rlike(r"\p{L}"), F.array(label)).otherwise(F.array().cast("array<string>"))


def best_words(part: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """Viterbi: the most likely split into words; ``known``: counts by start and length.

    An unknown word of n letters has the probability 10 / (total * 10**n).
    """
    best, back = [0.0], [0]
    for end in range(1, len(part) + 1):
        options = []
        for start in range(max(0, end - WORD), end):
            n = end - start
            count = known.get((start, n))
            chance = math.log(count / total) if count else math.log(10 / total) - n * math.log(10)
            options.append((best[start] + chance, start))
        score, start = max(options)
        best.append(score)
        back.append(start)
    out, end = [], len(part)
    while end:
        out.append(part[back[end] : end])
        end = back[end]
    return out[::-1]


def segmented(parts: DataFrame, unigrams: DataFrame) -> DataFrame:
    """part, words of every distinct ``part``; ``unigrams``: word, n.

    Substrings up to WORD letters are looked up by a join, so the unigram table may have any size.
    """
    ship_code(parts.sparkSession)
    total = max(1, unigrams.agg(F.sum("n")).first()[0] or 0)
    places = parts.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("part") - 1)))
    places = places.withColumn("len", F.explode(F.sequence(F.lit(1), F.least(F.lit(WORD), F.length("part") - F.col("start")))))
    places = places.withColumn("word", F.col("part").substr(F.col("start") + 1, F.col("len")))
    found = places.join(unigrams, "word").groupBy("part").agg(F.collect_list(F.struct("start", "len", "n")).alias("known"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [best_words(p, {(k["start"], k["len"]): k["n"] for k in (ks if ks is not None else [])}, total) for p, ks in zip(b["part"], b["known"], strict=True)]
            yield pd.DataFrame({"part": b["part"], "words": words})

    return parts.join(found, "part", "left").mapInPandas(run, "part string, words array<string>")


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """id, host, path, rule, verdict, log_odds (of unwanted) and words of the host of every row."""
    url = F.col(url_col).cast("string")
    urls = stage(pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path")), "urls")
    paths = stage(urls.groupBy("path").agg(F.count("*").alias("n")).withColumn("words", path_words(F.col("path"))), "paths")
    titles = pages.select(F.explode(F.split(F.lower(F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), "(?is)<title>([^<]*)", 1)), r"[^\p{L}]+")).alias("word"))
    hosts = stage(urls.groupBy("host").agg(F.count("*").alias("n")).withColumn("parts", host_parts(F.col("host"))), "hosts")
    said = titles.groupBy("word").agg(F.count("*").alias("n")).union(paths.select(F.explode("words").alias("word"), "n"))
    said = said.union(hosts.select(F.explode(hyphened_words(F.col("host"))).alias("word"), "n"))
    unigrams = said.where(F.length("word").between(1, WORD)).groupBy("word").agg(F.sum("n").alias("n"))
    listed = urls.sparkSession.createDataFrame([(w, 1) for w in seeds], "word string, n long")
    unigrams = stage(unigrams.union(listed).groupBy("word").agg(F.sum("n").alias("n")), "unigrams")

    every = hosts.select("host", F.posexplode("parts").alias("at", "part"))
    split = stage(segmented(every.select("part").distinct(), unigrams), "split")
    words = every.join(broadcast_checked(split, SMALL, SMALL_BYTES), "part").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w"))
    words = words.select("host", F.flatten(F.col("w.words")).alias("words"))
    hosts = hosts.select("host").join(words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    hosts = hosts.withColumn("words", F.concat("words", top_level(F.col("host"))))
    bad = F.arrays_overlap("words", F.array(*map(F.lit, seeds)))
    hosts = stage(hosts.withColumn("bad", bad), "host-words")
    marked = paths.select("path", bad.alias("path_bad"))

    # classes of all urls, counted by word
    small = lambda t: broadcast_checked(t, SMALL, SMALL_BYTES)
    seen = urls.join(small(hosts.select("host", "bad")), "host").join(small(marked), "path").withColumn("class", (F.col("bad") | F.col("path_bad")).cast("int"))
    seen = stage(seen.groupBy("host", "path").agg(F.sum("class").alias("bad"), F.count("*").alias("n")), "classes")
    by = lambda key, t: seen.groupBy(key).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).join(small(t.select(key, "words")), key).select(F.explode("words").alias("word"), "bad", "n")
    counts = by("host", hosts).union(by("path", paths)).groupBy("word").agg(F.sum("bad").alias("bad"), F.sum(F.col("n") - F.col("bad")).alias("good"))
    counts = stage(counts, "counts")
    size = counts.agg(F.count("*"), F.sum("bad"), F.sum("good")).first()
    rows = seen.agg(F.sum("bad"), F.sum("n")).first()
    v, n_bad, n_good = size[0] or 1, size[1] or 0, size[2] or 0
    prior = math.log(((rows[0] or 0) + 1) / ((rows[1] or 0) - (rows[0] or 0) + 1))
    odds = F.log((F.col("bad") + 1) / (n_bad + v)) - F.log((F.col("good") + 1) / (n_good + v))
    table = stage(counts.select("word", odds.alias("odds")), "odds")

    def scored(t: DataFrame, key: str, name: str) -> DataFrame:
        each = t.select(key, F.explode("words").alias("word")).join(small(table), "word")
        return stage(each.groupBy(key).agg(F.sum("odds").alias(name)), "scores")

    of_host, of_path = scored(hosts, "host", "host_odds"), scored(paths, "path", "path_odds")
    out = urls.join(small(of_host), "host", "left").join(small(of_path), "path", "left").join(small(hosts.select("host", F.col("words").alias("host_words"))), "host", "left")
    out = out.withColumn("log_odds", F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)))
    out = out.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("r.verdict", F.when(F.col("log_odds") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("_id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "log_odds", "host_words")

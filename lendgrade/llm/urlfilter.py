"""URL verdicts: rules first, then segmented host names and naive Bayes.

A rule (verdict, host, path) fits its host and all subdomains where the url's
path starts with the rule's; the longest rule wins. Other urls are judged by
their words: host labels are split by unigram Viterbi into the words of a
lexicon, and a multinomial naive Bayes scores the words of host and path.

The lexicon counts the words of the pages' own texts, of paths, and of host
labels that a hyphen already splits (a name written together is no evidence of
words). Each distinct label looks up its own substrings by a join, so the
lexicon is never sent anywhere whole. The classifier learns from all urls: a
url is an example of ``block`` if a word of its host is a seed word, and of
``allow`` otherwise, and so carries the verdict to the words seen with them.

Work is done per distinct host and per distinct path wording; the frequent
ones, which may hold a third of all urls, are counted before the shuffle and
joined back by skew-split joins.

Results at the edges: a null url, or one without ``://``, has empty host and
path; without any word the more frequent class is the verdict. Repeated rows
get equal verdicts; an empty table gives an empty result; only the columns
named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendgrade.llm.common import landed

#: Words whose presence in a host makes a url an example of ``block``.
SEEDS = "adult ads bet bets betting casino gambling malware nude phishing pills poker porn sex slots spam track tracker tracking viagra warez xxx".split()
#: Longest word of the lexicon, in letters; longer pieces stay unsplit.
WORD_LETTERS = 24
#: Letters of a label that are looked up at a time.
RUN_LETTERS = 256


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both "" without ``://``."""
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host = F.regexp_extract(F.coalesce(url, F.lit("")), parts, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(F.coalesce(url, F.lit("")), parts, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, as host/path text, and its verdict; null if
    none fits. ``rules``: (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):  # the longest is tried first
        h, _, p = r.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(f"/{p}"))
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of ``label``; unknown words cost more the
    longer they are."""
    unknown = -math.log(total + 1.0)
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for begin in range(max(0, end - WORD_LETTERS), end):
            n = counts.get(label[begin:end], 0)
            cost = math.log(n / total) if n else unknown - 2.3 * (end - begin)
            options.append((best[begin][0] + cost, begin))
        best.append(max(options))
    words, end = [], len(label)
    while end:
        begin = best[end][1]
        words.append(label[begin:end])
        end = begin
    return words[::-1]


def lexicon(pages: DataFrame, hosts: DataFrame, text: str, seeds: list[str]) -> DataFrame:
    """(word, n): occurrences in page texts, in paths and in hyphenated host
    labels; each seed once more."""
    plain = F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(plain), r"[^\p{L}]+")).alias("word"), F.lit(1).cast("bigint").alias("n"))
    named = hosts.select(F.explode(F.filter(F.split("host", r"\."), lambda x: F.contains(x, F.lit("-")))).alias("label"), "n")
    named = named.select(F.explode(F.split("label", r"[^\p{L}]+")).alias("word"), "n")
    known = hosts.sparkSession.createDataFrame([(s, 1) for s in seeds], "word string, n bigint")
    every = words.union(named).union(known).where(F.length("word").between(1, WORD_LETTERS))
    return every.groupBy("word").agg(F.sum("n").alias("n"))


def split_labels(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """Distinct letter runs of host labels and their words: (label, words)."""
    import pyarrow as pa

    total = int(words.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0])
    labels = hosts.select(F.explode(F.split("host", r"[^\p{L}]+")).alias("label")).where("label != ''").distinct()
    labels = landed(labels.withColumn("no", F.monotonically_increasing_id()), "labels")
    # a label is looked up in runs of bounded length, so its length bounds no row
    last = F.floor((F.length("label") - 1) / RUN_LETTERS).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("label"), i * RUN_LETTERS + 1, F.lit(RUN_LETTERS + WORD_LETTERS - 1)))
    runs = labels.select("no", F.explode(pieces).alias("run"))
    n = F.length("run")
    spots = F.flatten(F.transform(F.sequence(F.lit(1), F.least(n, F.lit(RUN_LETTERS))), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(WORD_LETTERS), n - i + 1)), lambda k: F.substring(F.col("run"), i, k))))
    parts = runs.select("no", F.explode(F.array_distinct(spots)).alias("word"))
    own = parts.join(words, "word").groupBy("no").agg(F.collect_set(F.struct("word", "n")).alias("own"))
    own = labels.join(own, "no", "left").select("label", F.coalesce("own", F.array().cast("array<struct<word:string,n:bigint>>")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            split = [segment(x, {w["word"]: w["n"] for w in own}, total) for x, own in zip(names, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string()))], names=["label", "words"])

    return own.mapInArrow(run, "label string, words array<string>")


def judge(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", text: str = "html", keep: list[str] | None = None, seeds: list[str] | None = None) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict, and ``score``, the log-odds
    of ``block`` by the words (null where a rule decides)."""
    seeds = seeds or SEEDS
    host, path = host_path(F.col(f"`{url}`"))
    split = pages.select(*[F.col(f"`{c}`") for c in keep or []], host.alias("host"), path.alias("path"))
    wording = F.array_join(F.filter(F.split(F.lower("path"), r"[^\p{L}]+"), lambda x: x != ""), " ")
    urls = split.withColumn("wording", wording)
    pairs = landed(urls.groupBy("host", "wording").agg(F.count("*").alias("n")), "url-words")
    hosts = landed(pairs.groupBy("host").agg(F.sum("n").alias("n")), "hosts")
    words = landed(lexicon(pages, hosts, text, seeds), "lexicon")
    labels = split_labels(hosts, words)

    # words of each distinct host; labels are looked up one by one
    pieces = hosts.select("host", "n", F.explode(F.split("host", r"[^\p{L}]+")).alias("label")).where("label != ''")
    host_words = pieces.join(labels, "label").select("host", "n", F.explode("words").alias("word"))
    host_words = landed(host_words, "host-words")
    flagged = host_words.where(F.col("word").isin(seeds)).select("host").distinct().withColumn("blocked", F.lit(1))
    classes = landed(hosts.join(flagged, "host", "left").select("host", "n", F.coalesce("blocked", F.lit(0)).alias("blocked")), "classes")

    # counts of words by class, over all urls
    path_words = pairs.join(classes.select("host", "blocked"), "host").groupBy("wording", "blocked").agg(F.sum("n").alias("n"))
    path_words = path_words.select(F.explode(F.split("wording", " ")).alias("word"), "blocked", "n").where("word != ''")
    counted = host_words.join(classes.select("host", "blocked"), "host").select(F.concat(F.lit("h "), "word").alias("word"), "blocked", "n")
    counted = counted.union(path_words.select(F.concat(F.lit("p "), "word").alias("word"), "blocked", "n"))
    block, allow = F.sum(F.col("n") * F.col("blocked")).alias("block"), F.sum(F.col("n") * (1 - F.col("blocked"))).alias("allow")
    counted = landed(counted.groupBy("word").agg(block, allow), "word-counts")
    sums = counted.agg(F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0)), F.count("*")).first()
    prior = classes.agg(F.coalesce(F.sum(F.col("n") * F.col("blocked")), F.lit(0)), F.coalesce(F.sum(F.col("n") * (1 - F.col("blocked"))), F.lit(0))).first()
    weight = F.log((F.col("block") + 1.0) / F.lit(float(sums[0] + sums[2] + 1))) - F.log((F.col("allow") + 1.0) / F.lit(float(sums[1] + sums[2] + 1)))
    weights = counted.select("word", weight.alias("w"))
    base = math.log((prior[0] + 1.0) / (prior[1] + 1.0))

    by_host = host_words.select("host", F.concat(F.lit("h "), "word").alias("word")).join(weights, "word").groupBy("host").agg(F.sum("w").alias("host_score"))
    wordings = pairs.select("wording").distinct()
    by_path = wordings.select("wording", F.explode(F.split("wording", " ")).alias("word")).select("wording", F.concat(F.lit("p "), "word").alias("word")).join(weights, "word").groupBy("wording").agg(F.sum("w").alias("path_score"))
    scored = urls.join(landed(by_host, "by-host"), "host", "left").join(landed(by_path, "by-path"), "wording", "left")
    score = F.lit(base) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select(
        *[F.col(f"`{c}`") for c in keep or []],
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(verdict.isNull(), score).alias("score"),
    )

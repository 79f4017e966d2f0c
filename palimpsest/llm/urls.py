"""URL filters: host names are split into words by a unigram Viterbi search, then a multinomial naive Bayes model scores
the words of host and path.

Rules of a host and a path come first: a rule fits its host and all subdomains if the url's path starts with the rule's,
and the longest rule decides. Urls without a rule get the model's verdict.

Word counts come from the whole text of all pages (without tags), from paths and from the names of all distinct hosts. Names are
split once per distinct name: all its pieces of lengths that counted words have are joined with the table of words, so no
task holds that table.

The naive Bayes model is taught by the rules: urls that a rule decides count as examples of its verdict, with the words
of their hosts and paths, which are hashed into BUCKETS counts. Urls without a rule then take part in EM_ROUNDS rounds:
each counts for both classes by the model's probabilities so far, with UNLABELLED of the weight of an example, and the model
is fitted again. Probabilities are rounded to SHARES parts, so sums are whole numbers and do not depend on the order of rows.

* A null url, or one without `://`, has an empty host and an empty path, and the model's verdict (allow without words).
* Rows are judged one by one, so repeated rows and repeated ids give repeated results. An empty table gives an empty
  result, and without any rule that fits the model knows the prior only. Equal scores of two ways to split a name: the
  longer last word wins. Other columns of the input, whatever their names, take no part.
* Very long names: a name of n letters has n pieces for each length that counted words have, and names without words
  stay whole. Texts are taken apart by built-in functions, in some ten times the size of the longest.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.skew import hot_join
from palimpsest.storage import Scratch

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BUCKETS = 1 << 16
EM_ROUNDS = 2  # In which urls without a rule take part.
SHARES, UNLABELLED = 1000, 0.1  # Parts that probabilities are rounded to; weight of a url without a rule.
FOLDS = 5  # One of these is held out when accuracy is measured.
SMOOTHING = 0.05  # Added to both classes for each bucket in use.
RESULT = "page_id long, host string, path string, rule string, verdict string, words string, score double"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = re.compile("[a-z]+")


def parts(pages: DataFrame, id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path)."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise("")
    return pages.select(
        F.col(id).cast("long").alias("page_id"),
        F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def words_of(column) -> F.Column:
    """The runs of letters a-z of a text, lower-cased."""
    return F.filter(F.split(F.translate(column, _UPPER, _LOWER), "[^a-z]+"), lambda w: w != "")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over a table of one column `text`."""
    words = texts.select(F.explode(words_of(F.coalesce("text", F.lit("")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


UNKNOWN, PER_LETTER = 10, 2.4  # A piece that is no word costs as much as this count, and so much more for each letter.


def split_name(name: str, pieces: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of a name. pieces: (start, end) to the count of that word.

    A piece that is no word costs more the longer it is, so names without words stay whole. The best such piece that ends
    at a letter either begins there or is the best one that ends a letter before, and one letter longer.
    """
    by_end: dict[int, list[tuple[int, int]]] = {}
    for (start, end), n in pieces.items():
        by_end.setdefault(end, []).append((start, n))
    best, back, unknown = [0.0], [0], (-math.inf, 0)
    for end in range(1, len(name) + 1):
        unknown = max((unknown[0] - PER_LETTER, unknown[1]), (best[-1] + math.log(UNKNOWN / total) - PER_LETTER, -(end - 1)))
        options = [(best[start] + math.log(n / total), -start) for start, n in by_end.get(end, ())]
        score, start = max([*options, unknown])
        best.append(score)
        back.append(-start)
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def _split_batches(total: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for name, found in zip(batch.column("name").to_pylist(), batch.column("found").to_pylist(), strict=True):
                pieces = {(p["at"], p["at"] + p["length"]): p["n"] for p in found}
                words.append(split_name(name, pieces, total))
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return work


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) for a table of distinct names of letters a-z; `counts` is a table of (word, n)."""
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    # Lengths that words have: as many as the root of twice the letters of all distinct words at most.
    lengths = sorted(r["length"] for r in counts.select(F.length("word").alias("length")).distinct().collect())
    starts = F.posexplode(F.sequence(F.lit(1), F.length("name")))
    some = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("name") - F.col("at"))
    pieces = names.where("name <> ''").select("name", starts.alias("at", "one")).select("name", "at", F.explode(some).alias("length"))
    pieces = pieces.withColumn("word", F.expr("substring(name, at + 1, length)"))
    known = pieces.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("at", "length", "n")).alias("found"))
    every = names.where("name <> ''").join(known, "name", "left")
    kind = known.schema["found"].dataType.simpleString()
    return every.select("name", F.coalesce("found", F.array().cast(kind)).alias("found")).mapInArrow(
        _split_batches(total), "name string, words array<string>"
    )


def bucket_of(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def log_odds(counts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, float]:
    """Log odds of a block for each bucket, and of the prior. counts: by class (0 allow, 1 block) and bucket; classes: urls."""
    counts = counts.astype(float)
    used = counts.any(axis=0)
    counts[:, used] += SMOOTHING
    totals = np.maximum(counts.sum(axis=1, keepdims=True), SMOOTHING)
    odds = np.where(used, np.log(np.where(used, counts, 1.0)[1] / totals[1]) - np.log(np.where(used, counts, 1.0)[0] / totals[0]), 0.0)
    return odds, math.log((classes[1] + 1) / (classes[0] + 1))


def all_words(path: str, words: list[str]) -> list[str]:
    """Those of the host, then those of the path."""
    return [*words, *_LETTERS.findall(path.translate(_FOLD))]


def _class_counts(rows: DataFrame, weigh: Callable[[str | None, list[int]], tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums over rows of (verdict, path, words): weights of both classes by bucket, and alone. A task sends a row per bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, classes = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("verdict", "path", "words")), strict=True):
                buckets = [bucket_of(w) for w in all_words(row[1], row[2])]
                weights = weigh(row[0], buckets)
                classes += weights
                np.add.at(counts, (slice(None), buckets), np.array(weights)[:, None])
        used = np.flatnonzero(counts.any(axis=0))
        arrays = [pa.array([*used.tolist(), -1], pa.int32())] + [pa.array([*counts[c, used].tolist(), int(classes[c])], pa.int64()) for c in (0, 1)]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "allow", "block"])

    sent = rows.select("verdict", "path", "words").mapInArrow(work, "bucket int, allow long, block long")
    counts, classes = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    for bucket, allow, block in sent.groupBy("bucket").agg(F.sum("allow"), F.sum("block")).collect():  # At most BUCKETS and one.
        if bucket < 0:
            classes += [allow, block]
        else:
            counts[:, bucket] = allow, block
    return counts, classes


def fit(known: DataFrame, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float]:
    """Log odds of a block by bucket and of the prior, from a table of (verdict, path, words); verdict is null without a rule."""
    labelled = _class_counts(known.where("verdict is not null"), lambda verdict, _: (0, SHARES) if verdict == "block" else (SHARES, 0))
    odds, prior = log_odds(labelled[0] / SHARES, labelled[1] / SHARES)
    for _ in range(rounds):

        def shares(_, buckets: list[int], odds: np.ndarray = odds, prior: float = prior) -> tuple[int, int]:
            block = share_of(prior + sum(odds[b] for b in buckets))
            return SHARES - block, block

        counts, classes = _class_counts(known.where("verdict is null"), shares)
        odds, prior = log_odds((labelled[0] + UNLABELLED * counts) / SHARES, (labelled[1] + UNLABELLED * classes) / SHARES)
    return odds, prior


def share_of(score: float) -> int:
    """The probability of a block, in SHARES parts."""
    return round(SHARES / (1 + math.exp(-max(-50.0, min(50.0, score)))))


def held_out_accuracy(known: DataFrame, fold: int = 1) -> tuple[int, int]:
    """(right, all): verdicts on urls that rules decide and whose host falls to a fold that the model was not taught with."""
    held = F.col("verdict").isNotNull() & (F.crc32("host") % FOLDS == fold)
    odds, prior = fit(known.where(~held))
    judged = known.where(held).select("page_id", "host", "path", "words", F.col("verdict").alias("truth"))
    found = judged.select("page_id", "host", "path", "words").mapInArrow(_judge(odds, prior, ()), RESULT)
    right = found.select("host", "path", "verdict").distinct().join(judged.select("host", "path", "truth"), ["host", "path"])
    return right.where("verdict = truth").count(), right.count()


def rule_of(host: str, path: str, rules: dict[str, list[tuple[str, str]]]) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits. rules: by host, (path, verdict)."""
    best, verdict, at = None, None, 0
    while host:
        name = host[at:]
        for start, decides in rules.get(name, ()):
            if path.startswith(start) and (best is None or len(name + start) > len(best)):
                best, verdict = name + start, decides
        at = host.find(".", at) + 1
        if not at:
            break
    return best, verdict


def _by_host(rules: tuple) -> dict[str, list[tuple[str, str]]]:
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, []).append((path, verdict))
    return by_host


def _judge(odds: np.ndarray, prior: float, rules: tuple):
    by_host = _by_host(rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            found, verdicts, texts, scores = [], [], [], []
            for host, path, words in zip(hosts, paths, batch.column("words").to_pylist(), strict=True):
                words = all_words(path, words)
                score = prior + sum(odds[bucket_of(w)] for w in words)
                rule, verdict = rule_of(host, path, by_host)
                found.append(rule)
                verdicts.append(verdict or ("block" if score > 0 and words else "allow"))
                texts.append(" ".join(words))
                scores.append(float(score))
            arrays = [batch.column(n) for n in ("page_id", "host", "path")] + [pa.array(found, pa.string()), pa.array(verdicts), pa.array(texts), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in RESULT.split(", ")])

    return work


_FOLD = str.maketrans(_UPPER, _LOWER)


def with_words(pages: DataFrame, scratch: Scratch, id: str, url: str, html: str | None, rules: tuple) -> DataFrame:
    """(page_id, host, path, words, verdict): the words of the host's name, and what a rule says of the url, else null."""
    urls = scratch.keep(parts(pages, id, url), "urls")
    texts = urls.select(F.col("path").alias("text"))
    if html:
        texts = texts.union(pages.select(F.regexp_replace(F.coalesce(F.col(html).cast("string"), F.lit("")), "<[^>]*>", " ")))
    hosts = scratch.keep(urls.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    named = scratch.keep(hosts.select("host", F.posexplode(words_of("host")).alias("place", "name")), "names")
    counts = scratch.keep(word_counts(texts.union(named.select("name"))), "words")

    split = scratch.keep(split_names(named.select("name").distinct(), counts), "split")
    usage = scratch.keep(named.groupBy("name").agg(F.count("*").alias("uses")).join(split, "name"), "usage")
    listed = hot_join(named, usage, "name", "uses").groupBy("host").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "words"))), lambda p: p["words"])).alias("words")
    )
    words = F.coalesce("words", F.array().cast("array<string>")).alias("words")
    hosts = scratch.keep(hosts.join(listed, "host", "left").select("host", "n", words), "hosts-split")
    known = hot_join(urls, hosts, "host", "n").select("page_id", "host", "path", "words")
    return scratch.keep(known.mapInArrow(_decided(rules), "page_id long, host string, path string, words array<string>, verdict string"), "known")


def _decided(rules: tuple):
    by_host = _by_host(rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            verdicts = pa.array([rule_of(host, path, by_host)[1] for host, path in urls], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, verdicts], [*batch.schema.names, "verdict"])

    return work


def judge(pages: DataFrame, scratch: Scratch, id: str = "page_id", url: str = "url", html: str | None = "html", rules: tuple = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, words, score (log odds of a block)."""
    known = with_words(pages, scratch, id, url, html, rules)
    odds, prior = fit(known)
    return known.select("page_id", "host", "path", "words").mapInArrow(_judge(odds, prior, rules), RESULT)

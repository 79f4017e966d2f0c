import random
import re

from helpers_llm import awkward, documents
from pyspark.sql import functions as F

from palimpsest.llm import licenses


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_random_texts_against_word_search():
    draw = random.Random(1)
    words = [*"under the mit license apache version 2 cc by nc É x".split(), ""]
    for _ in range(10_000):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "-", ", ", "\n", "\x7f"]) for _ in range(draw.randint(0, 25)))
        text = text.upper() if draw.random() < 0.5 else text
        assert licenses.scan_text(text)[:5] == brute(text), text


def test_rows(spark):
    docs = awkward(spark).select("doc_id", "text")
    docs = docs.union(documents(spark, ["Under the MIT License. CC BY-NC 4.0", "cc by nc cc by nc"]).select("doc_id", "text"))
    texts = [r.text for r in docs.collect()]
    for text, row in zip(texts, licenses.scan(docs).collect(), strict=True):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute(text)
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_expressions():
    assert licenses.parse("mit or gpl-3.0-only and bsd-3-clause") == (["mit", "gpl-3", "bsd"], 0.9)
    assert licenses.parse("(mit or gpl-3.0-only) and gpl-2.0+")[1] == 0.4
    assert licenses.parse("gpl-2.0 with classpath-exception-2.0 or cc0-1.0")[1] == 1.0
    for broken in ("", "or mit", "mit and", "(mit", "mit or (", "()"):
        assert licenses.parse(broken) is None
    found = licenses.scan_text("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;")
    assert found[5] == "apache-2,mit" and found[6] == 0.9


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).count() == 0


def test_clashing_names(spark):
    docs = awkward(spark).withColumns({"n_words": F.lit("x"), "labels": F.lit("y"), "score": F.lit(None).cast("string")})
    texts = [r.text for r in docs.collect()]
    found = licenses.scan(docs)
    assert found.columns == [f.split()[0] for f in licenses.RESULT.split(", ")]
    for text, row in zip(texts, found.collect(), strict=True):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute(text)


def test_long_expressions():
    """In time proportional to their length, chained or nested."""
    names = [f"lic{k}" for k in range(100_000)]
    assert licenses.parse(" or ".join(names)) == (names, licenses.UNKNOWN)
    assert licenses.parse(" or (".join(names[:50_000]) + ")" * 49_999) == (names[:50_000], licenses.UNKNOWN)
    assert licenses.parse("mit with a and (isc with b or cc0)") == (["mit", "isc", "cc0"], 0.9)

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import AWKWARD, awkward, documents, prose

from palimpsest.llm import resample
from palimpsest.storage import Scratch

LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    grams = [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(rows, target):
    of_docs = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in of_docs for b in f), Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    out = []
    for i, n, f in of_docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(order[: 5 * len(order) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=repr)


def items(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


def check(spark, texts, target):
    found = resample.resample(documents(spark, texts), items(spark, target), Scratch(spark)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(list(enumerate(texts)), target)


def test_same_as_brute_force(spark):
    texts = [prose(5 + k % 60, k) for k in range(400)] + AWKWARD + ["É日本 X_x-y " * 10, "w" * 70 + " " + "v" * 5000 + " a b" * 20]
    check(spark, texts, [prose(50, 3), prose(50, 999), None, "", "É日本 x x y"])


def test_equal_scores_and_repeated_rows(spark):
    """Equal ids and texts give equal scores; ranks are still 1, 2, 3 ... and only the ids decide."""
    texts, ids = [prose(30, k % 3) for k in range(200)], [k // 50 for k in range(200)]
    found = resample.resample(documents(spark, texts, ids), items(spark, [prose(30, 1)]), Scratch(spark)).collect()
    expected = brute(list(zip(ids, texts, strict=True)), [prose(30, 1)])
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted((r[:4] for r in expected), key=repr)
    ranked = {r.rank: (r.score, r.id) for r in found if r.rank}
    assert ranked == {r[4]: (r[3], r[0]) for r in expected if r[4]} and sorted(ranked) == list(range(1, 11))


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = resample.resample(docs, items(spark, ["one two"]), Scratch(spark), carry=True).collect()
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], ["one two"])
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted((r[:4] for r in expected), key=repr)
    assert {r.row.id for r in found} == {"id"}


def test_empty_tables(spark):
    assert resample.resample(documents(spark, []), items(spark, ["a"]), Scratch(spark)).count() == 0
    check(spark, [prose(30, k) for k in range(40)], [])


def test_approximate_cut_is_checked(spark, monkeypatch):
    """A quantile that is far off costs time only."""
    monkeypatch.setattr(resample.F, "percentile_approx", lambda *a: resample.F.max("score"))
    check(spark, [prose(30, k) for k in range(100)], [prose(30, 1)])


@pytest.mark.parametrize("at_once", [1, 2, 3, 7, 1000])
def test_runs_of_words(at_once):
    texts = [prose(9, 1), "", "one", "a" * 100 + " b c", "É日本 x y z"] * 3
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    found = [Counter() for _ in texts]
    words = np.zeros(len(texts), int)
    for word_rows, rows, buckets in resample.features(data, offsets, resample.Checksums(), at_once):
        words += np.bincount(word_rows, minlength=len(texts))
        for row, bucket in zip(rows.tolist(), buckets.tolist(), strict=True):
            found[row][bucket] += 1
    expected = [features(t) for t in texts]
    assert words.tolist() == [n for n, _ in expected] and found == [Counter(f) for _, f in expected]


def test_many_distinct_words(monkeypatch):
    monkeypatch.setattr(resample, "DISTINCT", 5)
    text = prose(300, 4)
    data = np.frombuffer(text.encode(), np.uint8)
    found = Counter()
    for _, _, buckets in resample.features(data, np.array([0, len(data)]), resample.Checksums(), 10):
        found.update(buckets.tolist())
    assert found == Counter(features(text)[1])

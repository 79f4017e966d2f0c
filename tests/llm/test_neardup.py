import random
import time
from collections import Counter

import numpy as np
import pytest
from helpers_llm import awkward, documents, edited, prose

from palimpsest.llm import neardup
from palimpsest.llm.blocks import hash_spans, word_spans
from palimpsest.llm.skew import components
from palimpsest.storage import Scratch


def grams(text):
    words = text.split()
    size = min(5, max(1, len(words)))
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] if words else []


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def similarity(a, b):
    a, b = grams(a), grams(b)
    m = subsequence(a, b)
    return 1.0 if not a and not b else m / (len(a) + len(b) - m)


def classes_of(texts):
    """Components by comparing every pair."""
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if texts[i].split() == texts[j].split() or similarity(texts[i], texts[j]) >= neardup.SIMILARITY:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(k) for k in range(len(texts))]


def family(seed, copies, edits, length=90):
    draw = random.Random(seed)
    text = prose(length, seed)
    return [text] + [edited(text, draw.sample(range(length), draw.randint(1, edits))) for _ in range(copies)]


def test_classes_against_all_pairs(spark):
    texts = [t for seed in range(14) for t in family(seed, 5, 3)]
    texts += family(99, 1, 1) * 4 + ["", " ", "a b", "a b", "a c", "a b c d e", "a b c d f"]
    texts.append(" ".join(texts[0].split()[40:] + texts[0].split()[:40]))  # Moved passages are no small edit.
    random.Random(1).shuffle(texts)
    found = neardup.near_duplicates(documents(spark, texts).repartition(5), Scratch(spark)).collect()
    expected = classes_of(texts)
    sizes = Counter(expected)
    assert {(r.id, r.class_id, r.class_size) for r in found} == {(k, c, sizes[c]) for k, c in enumerate(expected)}
    assert Counter(r.class_id for r in found if r.kept) == dict.fromkeys(sizes, 1)


def test_large_group_without_a_centre(spark, monkeypatch):
    """Copies of copies: neighbours are similar, the ends are not, and blocks are smaller than the group."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
    text, chain = prose(80, 5), []
    for k in range(40):
        chain.append(text)
        text = edited(text, [2 * k % 80])
    other = [edited(chain[0], list(range(3, 80, 6 + k % 3))) for k in range(10)]
    texts = chain + other + [prose(80, 50 + k) for k in range(20)]
    found = neardup.near_duplicates(documents(spark, texts), Scratch(spark)).collect()
    assert {(r.id, r.class_id) for r in found} == set(enumerate(classes_of(texts)))


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = neardup.near_duplicates(docs, Scratch(spark), carry=True).collect()
    assert len(found) == docs.count()
    by_words = {}
    for row in found:
        by_words.setdefault(tuple((row.row.text or "").split()), set()).add((row.class_id, row.class_size))
        assert row.row.seq == "seq"
    assert all(len(v) == 1 for v in by_words.values())
    assert sum(r.kept for r in found) == len(by_words)


def test_alignment_against_table():
    draw = random.Random(2)
    for _ in range(3000):
        a = [draw.randint(1, 12 if draw.random() < 0.5 else 400) for _ in range(draw.randint(0, 30))]
        b = list(a)
        for _ in range(draw.randint(0, 6)):
            if b:
                b[draw.randrange(len(b))] = draw.randint(1, 400)
            if draw.random() < 0.3:
                b.insert(draw.randint(0, len(b)), draw.randint(1, 12))
        m = subsequence(a, b)
        expected = not a and not b if not a or not b else m / (len(a) + len(b) - m) >= 0.8
        assert neardup.similar(np.array(a, np.int64), np.array(b, np.int64)) == expected


def test_parities_never_rule_out_a_similar_pair():
    draw = random.Random(3)
    for seed in range(60):
        one = prose(draw.randint(20, 900), seed)
        two = edited(one, draw.sample(range(20), draw.randint(0, 4)))
        hashed = []
        for text in (one, two):
            data = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = word_spans(data, np.array([0, len(data)]))
            hashed.append(neardup.shingles(hash_spans(data, starts, ends)))
        x, y = (neardup.parity(g).view(np.uint64) for g in hashed)
        shared = sum((Counter(hashed[0].tolist()) & Counter(hashed[1].tolist())).values())
        assert np.bitwise_count(x ^ y).sum() <= len(hashed[0]) + len(hashed[1]) - 2 * shared


def test_components(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(300, 380)]
    links += [(400, k) for k in range(401, 450)]
    parent = list(range(450))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    nodes = spark.createDataFrame([(k, k) for k in range(450)], "v long, c long")
    found = components(nodes, spark.createDataFrame(links, "a long, b long"), Scratch(spark), "t")
    assert {(r.v, r.c) for r in found.collect()} == {(k, root(k)) for k in range(450)}


def test_empty_table(spark):
    assert neardup.near_duplicates(documents(spark, []), Scratch(spark)).count() == 0


@pytest.mark.parametrize("few", [0, 2, 32])
@pytest.mark.parametrize("cache", [1 << 29, 100])
def test_alignment_of_repeated_shingles(monkeypatch, few, cache):
    """Random sequences of few different shingles, at lengths on both sides of the threshold."""
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "CACHE_BITS", cache)
    draw = np.random.default_rng(few + cache)
    verdicts = set()
    for _ in range(600):
        a = draw.integers(0, draw.integers(2, 12), draw.integers(1, 60))
        b = list(a)
        for _ in range(draw.integers(0, 9)):
            at = int(draw.integers(0, len(b) + 1))
            b[at : at + int(draw.integers(0, 3))] = draw.integers(0, 12, draw.integers(0, 3)).tolist()
        b = np.array(b or [0])
        m = subsequence(a.tolist(), b.tolist())
        expected = m / (len(a) + len(b) - m) >= 0.8 - 1e-12
        assert neardup.similar(a.astype(np.int64), b.astype(np.int64)) == expected
        verdicts.add(expected)
    assert verdicts == {True, False}


@pytest.mark.parametrize("words", [20_000, 200_000])
def test_long_repeated_texts_align_fast(words):
    """Equal words with other ends: all matches are repeated, and nothing can be trimmed."""
    a, b = (np.concatenate([np.full(3, k), np.full(words, 7), np.full(3, k + 1)]).astype(np.int64) for k in (1, 3))
    began = time.perf_counter()
    assert neardup.similar(a, b)
    assert not neardup.similar(a, np.concatenate([b[: words // 2], np.arange(100, 100 + words // 2)]))
    assert time.perf_counter() - began < (1 if words == 20_000 else 60)


def apart(n, own):
    """Texts that share most of their words, but not enough, each with words of its own spread over it."""
    core = prose(300, 1).split()
    texts = []
    for k in range(n):
        words = list(core)
        for j in range(own):
            words[j * (300 // own)] = f"own{k}x{j}"
        texts.append(" ".join(words))
    return texts


def test_families_below_the_threshold_stay_proportional(spark):
    """Texts with more than a fifth of their shingles of their own meet nobody, however many there are."""
    for n in (200, 1000):
        docs = documents(spark, apart(n, 20)).selectExpr("doc_id AS seq", "text")
        left = docs.selectExpr("seq AS v", "seq AS c")
        assert neardup._rare_shared(docs, left, Scratch(spark)).count() == 0


def test_prefix_filter_loses_no_pair(spark):
    """Random pairs of texts on both sides of the threshold, compared with all of them."""
    draw = np.random.default_rng(8)
    texts = []
    for k in range(60):
        base = prose(int(draw.integers(6, 120)), k)
        texts += [base, edited(base, draw.integers(0, len(base.split()), int(draw.integers(1, 4))).tolist())]
    docs = documents(spark, texts).selectExpr("doc_id AS seq", "text")
    rare = neardup._rare_shared(docs, docs.selectExpr("seq AS v", "seq AS c"), Scratch(spark)).collect()
    keys = {}
    for row in rare:
        keys.setdefault(row.v, set()).add(row.key)
    grams = {k: shingle_numbers(t) for k, t in enumerate(texts)}
    similar = [(a, b) for a in grams for b in grams if a < b and neardup.similar(grams[a], grams[b])]
    assert len(similar) > 15
    for a, b in similar:
        assert texts[a] == texts[b] or keys.get(a, set()) & keys.get(b, set()), (a, b)


def shingle_numbers(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = neardup.word_spans(data, np.array([0, len(data)]))
    return neardup.shingles(neardup.hash_spans(data, starts, ends)).view(np.int64)


def test_recall_against_all_pairs(spark):
    """All pairs of the documents of scale factor 0.01 whose shared shingles allow the similarity, aligned one by one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.id: r.class_id for r in neardup.near_duplicates(docs, Scratch(spark)).collect()}
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    grams = {i: shingle_numbers(t) for i, t in rows}
    counts = {i: Counter(neardup.labelled(g.view(np.uint64)).tolist()) for i, g in grams.items()}
    holders = {}
    for i, c in counts.items():
        for gram in c:
            holders.setdefault(gram, []).append(i)
    shared = Counter((a, b) for some in holders.values() for k, a in enumerate(some) for b in some[k + 1 :])
    pairs = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(grams[a]) + len(grams[b])) / 1.8 - 1e-6]
    links = [(a, b) for a, b in pairs if neardup.similar(grams[a], grams[b])]
    assert len(links) > 20
    assert sum(found[a] == found[b] for a, b in links) >= 0.999 * len(links)

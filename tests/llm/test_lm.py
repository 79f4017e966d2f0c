import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import awkward, documents, prose

from palimpsest.llm import lm
from palimpsest.storage import Scratch


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


@pytest.mark.parametrize("limit", [None, 20])
def test_base_against_counting(spark, limit):
    """With a small table of frequent words most counts come from the join."""
    docs = awkward(spark).select("doc_id", "text").union(documents(spark, [prose(60, k) for k in range(200, 260)], range(100, 160)).select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 5 == 1
    counts = Counter(t for key, text in rows if not held(key) for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    found = sorted(lm.score(docs, Scratch(spark), limit=limit).collect(), key=repr)
    expected = []
    for key, text in rows:
        found_tokens = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in found_tokens)
        expected.append((key, held(key), len(found_tokens), sum(counts[t] > 0 for t in found_tokens), total, round(base, 5)))
    got = [(r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 for r in found)


def test_model_beats_unigrams_on_held_out_texts(spark):
    """Texts in two made-up languages: a word tells which one goes on."""
    found = lm.score(documents(spark, languages(400)).coalesce(2), Scratch(spark)).where("held_out").groupBy().sum("score", "base_score").first()
    assert found[0] > 0.9 * found[1]  # Both are negative; knowing the language is worth a fifth of the log.


def random_model(leaves, branch=lm.BRANCH, seed=3):
    draw = np.random.default_rng(seed)
    frequencies = np.sort(draw.integers(1, 1000, leaves))[::-1].astype(float)
    model = lm.Model.initial(lm.Tree(frequencies, branch))
    for group in model.groups:
        group += draw.normal(0, 0.2, group.shape).astype(np.float32)
    return model


@pytest.mark.parametrize("leaves, branch", [(1, 256), (2, 256), (200, 256), (3000, 256), (3000, 4), (40_000, 16)])
def test_probabilities_sum_to_one(leaves, branch):
    model = random_model(leaves, branch)
    words = np.arange(leaves)
    for w1, w2 in np.random.default_rng(5).integers(0, leaves, (5, 2)):
        logs = model.log_chances(np.full(leaves, w1), np.full(leaves, w2), words)
        assert abs(np.exp(logs).sum() - 1) < 1e-3


@pytest.mark.parametrize("leaves, branch", [(1, 256), (300, 256), (5000, 256), (5000, 6)])
def test_tree_has_all_leaves_once(leaves, branch):
    frequencies = np.sort(np.random.default_rng(1).integers(0, 50, leaves))[::-1].astype(float)
    tree = lm.Tree(frequencies, branch)
    assert (tree.last - tree.first).max() <= max(branch, 1)
    last = np.array([path[path >= 0][-1] for path in tree.paths])
    assert len(np.unique(last)) == leaves
    of_first = np.bincount(tree.paths[:, 0], frequencies, tree.last[0])
    assert np.allclose(np.diff(tree.mass)[: tree.last[0]], of_first + 0.5)


@pytest.mark.parametrize("branch", [256, 8])
def test_training_raises_the_probability(branch):
    """Every leaf is followed by one other, at all depths of the tree."""
    draw = np.random.default_rng(4)
    model = lm.Model.initial(lm.Tree(np.ones(200), branch))
    w1 = draw.integers(0, 200, 4000)
    words = (w1 * 7 + 3) % 200
    chance = lambda: np.exp(model.log_chances(w1, np.zeros_like(w1), words)).mean()
    before = chance()
    for _ in range(150):
        model.train(w1, np.zeros_like(w1), words, draw)
    assert chance() > 20 * before


def languages(n, words=80):
    """Texts in two made-up languages."""
    texts = []
    for k in range(n):
        draw = np.random.default_rng(k)
        texts.append(" ".join(f"{('north', 'south')[k % 2]}{draw.integers(0, 12)}" for _ in range(words)))
    return texts


@pytest.mark.parametrize("shards", [None, 3])
def test_scores_do_not_depend_on_tasks(spark, shards):
    docs = documents(spark, languages(120))
    found = []
    for partitions in (1, 4, 32):
        rows = lm.score(docs.repartition(partitions), Scratch(spark), shards=shards).collect()
        found.append({r.id: (r.score, r.base_score) for r in rows})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        assert all(other[k] == pytest.approx(found[0][k], rel=1e-6) for k in other)


def test_gain_on_held_out_texts_with_many_tasks(spark):
    """On whole documents of scale factor 0.01, dealt to 32 tasks."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(32)
    total = lm.score(docs, Scratch(spark)).where("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert (total[0] - total[1]) / total[2] > 0.1


def test_scores_of_a_plain_version(spark):
    """Probabilities of whole texts by a walk down the tree with plain sums, words that are only known to the join included."""
    texts = [*languages(60, 30), "", None, "North1 never seen before", "a b c a b c", "rare1 rare2 rare3"] + [prose(40, k) for k in range(30)]
    docs, limit = documents(spark, texts), 30
    narrow = lm._narrow(docs, "doc_id", "text")
    scratch = Scratch(spark)
    words = lm.vocabulary(lm.count(narrow, scratch), limit)
    model = lm.train(scratch.keep(lm.encode(narrow, words), "encoded"), words)
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    counts = Counter(t for h, text in zip(held, texts, strict=True) if not h for t in tokens(text))
    hash_of = lambda t: lm.END if t is None else lm.tokens_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0][0]
    hashes = {t: np.uint64(hash_of(t)) for text in texts for t in tokens(text)}
    own = {int(k): int(leaf) for k, leaf in zip(words.keys, words.leaves, strict=True) if leaf not in set(words.of_bucket.tolist())}
    n = len(words.of_bucket)
    bucket = {t: int(h.view(np.int64)) % n for t, h in hashes.items() if int(h) not in own and t is not None}
    total = [sum(counts[t] + (0.5 if counts[t] else 0) for t, b in bucket.items() if b == k) + 0.5 for k in range(n)]

    def log10(w1, w2, leaf):
        predicted = [model.context[w1][i] * model.scale[0][i] + model.context[w2][i] * model.scale[1][i] for i in range(lm.SIZE)]
        logit = lambda node: float(sum(p * v for p, v in zip(predicted, model.node[node], strict=True)) + model.tree.chances[node])
        result = 0.0
        for node in model.tree.paths[leaf]:
            if node >= 0:
                siblings = range(model.tree.first[node], model.tree.last[node])
                result += logit(node) - math.log(sum(math.exp(logit(k)) for k in siblings))
        return result / math.log(10)

    found = {r.id: r.score for r in lm.score(docs, Scratch(spark), limit=limit).collect()}
    for k, text in list(enumerate(texts))[::4] + [(60, ""), (61, None), (62, texts[62]), (64, texts[64])]:
        w1 = w2 = words.end
        expected = 0.0
        for token in tokens(text):
            leaf = words.end if token is None else own[int(hashes[token])] if token not in bucket else int(words.of_bucket[bucket[token]])
            expected += log10(w1, w2, leaf)
            if token in bucket:
                expected += math.log10((counts[token] + 0.5) / total[bucket[token]])
            w1, w2 = leaf, w1
        assert found[k] == pytest.approx(expected, rel=1e-4, abs=1e-4)


def test_empty_and_untrained(spark):
    assert lm.score(documents(spark, []), Scratch(spark)).count() == 0
    held_out = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    row = lm.score(documents(spark, ["some words"], [held_out]), Scratch(spark)).first()
    assert row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0 and row.score < 0


def test_words_outside_the_most_frequent_have_an_order(spark):
    """2,500 words of equal count: each is followed by its successor, so the order of any of them tells."""
    texts = []
    for k in range(300):
        start = k * 37 % 2500
        texts.append(" ".join(f"w{(start + j) % 2500}" for j in range(400)))
    probe = [f"w{j} w{j + 1} w{j + 2} w{j + 3}" for j in range(0, 2400, 6)]
    turned = [" ".join(text.split()[::-1]) for text in probe]
    held = [k for k in range(10_000, 20_000) if zlib.crc32(str(k).encode()) % 5 == 1][: 2 * len(probe)]
    docs = documents(spark, [*texts, *probe, *turned], [*range(300), *held]).coalesce(1)
    found = {r.id: r.score for r in lm.score(docs, Scratch(spark)).collect()}
    pairs = [(found[a], found[b]) for a, b in zip(held, held[len(probe) :], strict=False)]
    assert sum(a == b for a, b in pairs) == 0


def test_vocabulary_grows_with_the_corpus():
    """Leaves grow with the root of the tokens, and all words are in them."""
    sizes = []
    for n in (10_000, 1_000_000):
        keys = np.sort(np.random.default_rng(n).choice(1 << 60, n, replace=False).astype(np.uint64))
        of = lm.bucket_of(keys, lm.leaves_for(5 * n, lm.BUCKETS))
        buckets = np.bincount(of).astype(float)
        found = lm.Vocabulary.of(keys, np.full(n, 5), 5 * n, n, 5 * buckets, buckets.astype(int), lm.leaves_for(5 * n, lm.OWN))
        assert found.frequencies.sum() == 5 * n and (np.diff(found.frequencies) <= 0).all()
        sizes.append(len(found.frequencies))
    assert 9 < sizes[1] / sizes[0] < 11


def test_long_texts_are_cut_for_training(spark, monkeypatch):
    """One text that is longer than the cut and the pool trains as its parts do."""
    monkeypatch.setattr(lm, "CUT", 50)
    text = " ".join(languages(40))
    found = lm.score(documents(spark, [text, *languages(9)]), Scratch(spark), shards=2).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_extra_columns_with_clashing_names(spark):
    docs = awkward(spark)
    for name in ("h", "c", "held_out", "turn", "words", "n_tokens", "base"):
        docs = docs.withColumn(name, docs["lang"])
    assert lm.score(docs, Scratch(spark)).count() == docs.count()


@pytest.mark.parametrize("shards", [3, 12, 39])
def test_each_shard_has_a_task(spark, shards):
    schema = "key long, words binary"
    rows = spark.createDataFrame([(k * 7919, bytearray(np.arange(3, dtype=np.int32).tobytes())) for k in range(40 * shards)], schema)
    tasks = lm.deal(rows, shards, 0).select("shard").rdd.glom().map(lambda part: len({r.shard for r in part})).collect()
    assert tasks == [1] * shards


def test_many_short_texts_fill_pools_in_time():
    """What training does for a text must not grow with the texts that wait with it."""
    model = random_model(50)
    held = type("Held", (), {"value": lm._packed(model)})
    n = 40_000
    rows = pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array([np.arange(4, dtype=np.int32).tobytes()] * n)], ["shard", "words"])
    start = time.process_time()
    assert list(lm._train_shards(held, 0)(iter([rows])))
    assert time.process_time() - start < 10

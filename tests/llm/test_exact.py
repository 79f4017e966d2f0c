import hashlib
import re
from collections import defaultdict

import pytest
from helpers_llm import AWKWARD, awkward, documents, prose

from palimpsest.llm import exact
from palimpsest.llm.oracle import ORACLE
from palimpsest.storage import Scratch


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((i, text or ""))
    best = {k: min(v, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0] for k, v in groups.items()}
    return {k: (best[k], len(v), hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items()}


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = exact.dedup(docs, Scratch(spark), carry=True).collect()
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(found) == docs.count()
    for row in found:
        key = re.sub(r"[\x20\x09-\x0D]", "", row.row.text or "")
        assert (row.keep_id, row.group_size, row.text_sha256) == expected[key]
        assert row.row.id == "id"
    kept = [r.text_sha256 for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len(expected)


def test_hot_group_among_many(spark):
    texts = [prose(5, k) for k in range(3000)] + ["hot text"] * 1500
    docs = documents(spark, texts)
    found = exact.dedup(docs, Scratch(spark)).collect()
    expected = brute(list(enumerate(texts)))
    assert {(r.id, r.keep_id, r.group_size) for r in found} == {
        (k, *expected[re.sub(r"\s", "", t)][:2]) for k, t in enumerate(texts)
    }


def test_small_filter_gives_the_same(spark, monkeypatch):
    """A filter that is far too small only moves more rows."""
    monkeypatch.setattr(exact, "MIN_WORDS", 1)
    monkeypatch.setattr(exact, "ROWS_PER_WORD", 600)
    texts = [prose(4, k % 400) for k in range(600)]
    found = exact.dedup(documents(spark, texts), Scratch(spark)).collect()
    expected = brute(list(enumerate(texts)))
    assert {(r.id, r.group_size) for r in found} == {(k, expected[t.replace(" ", "")][1]) for k, t in enumerate(texts)}


def test_many_slices_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(exact, "MIN_WORDS", 1)
    monkeypatch.setattr(exact, "SLICE_WORDS", 16)
    monkeypatch.setattr(exact, "BLOCK", 8)
    texts = [prose(4, k % 400) for k in range(600)] + [None, "", "hot"] + ["hot"] * 300
    found = exact.dedup(documents(spark, texts), Scratch(spark), carry=True).collect()
    expected = brute(list(enumerate(texts)))
    key = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert len(found) == len(texts)
    assert {(r.id, r.keep_id, r.group_size) for r in found} == {(k, *expected[key(t)][:2]) for k, t in enumerate(texts)}
    assert all(r.row.doc_id == r.id for r in found)


@pytest.mark.parametrize("slice_words", [1 << 22, 1000])
def test_filter_passes_unique_rows(spark, monkeypatch, slice_words):
    """However many slices there are, fewer than 1 % of unique rows are taken for repeats, and no repeat is missed."""
    monkeypatch.setattr(exact, "SLICE_WORDS", slice_words)
    texts = [f"text {k}" for k in range(40_000)] + ["text 7"] + ["text 8"] * 500
    scratch = Scratch(spark)
    words = exact.words_for(len(texts))
    rows = scratch.keep(exact.numbered_for_probing(exact.fingerprints(documents(spark, texts), "doc_id", "text", False), words), "f")
    found = scratch.keep(exact.repeated_bits(rows, words), "filter")
    probed = exact.probe(rows, found, words, scratch, "probed")
    maybe = {r.id for r in probed.where("maybe").collect()}
    assert {7, 8, *range(40_000, 40_501)} <= maybe and len(maybe) < 503 + 400
    assert probed.count() == len(texts)


def test_first_pass_moves_words_only(spark):
    """What is shuffled to build the filter: a word's number and bits, added up before."""
    rows = exact.fingerprints(documents(spark, AWKWARD), "doc_id", "text", False)
    plan = exact.repeated_bits(rows, 1024)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanged) == 2 and all("hashpartitioning(word" in line for line in exchanged) and "Generate" not in plan


def test_empty_table(spark):
    assert exact.dedup(documents(spark, []), Scratch(spark)).count() == 0


def test_no_python_in_plan(spark):
    plan = exact.dedup(documents(spark, AWKWARD), Scratch(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_has_sql():
    assert "op2_exact_dedup" in ORACLE

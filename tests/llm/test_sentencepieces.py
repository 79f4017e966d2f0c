import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import sentencepiece
from helpers_llm import awkward, documents, prose

from palimpsest.llm import queries
from palimpsest.llm import sentencepieces as sp


def test_agrees_with_library_on_random_texts():
    library = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
    coder = sp.Coder(sp.Vocabulary.load(sp.model_path()), capacity=500)
    draw = random.Random(3)
    letters = [" ", " ", "\n", "▁", "é", "ß", "日", "😀", "\t", "　", "ａ", ".", "1", "2", "'", *"etaoinshrdlu", "ing", "the", "tion", "    ", "\x00"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += [prose(60, k) for k in range(50)]
    for at in range(0, len(texts), 100):
        for text, code in zip(texts[at : at + 100], coder.encode(texts[at : at + 100]), strict=True):
            ids = np.frombuffer(code, "<i4")
            assert ids.tolist() == library.encode(text), text
            assert coder.decode(ids) == text.replace("▁", " ")


def test_unigram_finds_the_best_sequence():
    draw = random.Random(5)
    pieces = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "▁abca"]
    scores = {p: -draw.random() * 5 for p in pieces}
    vocabulary = sp.Vocabulary({p: 300 + k for k, p in enumerate(pieces)}, scores, list(range(256)), merges=False)
    words = sorted({"▁" + "".join(draw.choice("abc") for _ in range(draw.randint(1, 9))) for _ in range(200)})

    def best(word):
        found = []
        for k in range(len(word)):
            for cuts in combinations(range(1, len(word)), k):
                parts = [word[i:j] for i, j in zip((0, *cuts), (*cuts, len(word)), strict=True)]
                if all(p in scores for p in parts):
                    found.append(sum(scores[p] for p in parts))
        return max(found)

    for word, parts in zip(words, vocabulary.encode_sorted(words), strict=True):
        assert "".join(parts) == word
        assert abs(sum(scores[p] for p in parts) - best(word)) < 1e-9


def test_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
    docs = awkward(spark)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    found = sp.decode(sp.encode(docs)).collect()
    assert len(found) == len(texts)
    for (key, text), row in zip(texts, found, strict=True):
        assert row.id == key and row.decoded == text
        assert len(text) > 10_000 or row.ids == library.encode(text)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<i4").tobytes())


def test_empty_table(spark):
    assert sp.decode(sp.encode(documents(spark, []))).count() == 0


def test_round_trip_holds_tables_once(spark, tmp_path):
    """The query's encoder and decoder share a process, and give what they give one after the other."""
    docs = awkward(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op4_sentencepiece(spark, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    alone = sp.decode(sp.encode(docs)).collect()
    assert sorted(sp.round_trip(docs).collect(), key=repr) == sorted(alone, key=repr)
    assert found.count() == len(alone) and found.where("round_trip").count() == len(alone)


def test_decoder_goes_by_slices():
    tool = sp.coder(sp.model_path(), True)
    texts = [f"line {k}" for k in range(1000)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["id", "text"])
    whole = pa.Table.from_batches(sp._encode_batches(iter([batch]), tool)).combine_chunks().to_batches()
    assert len(whole) == 1
    parts = list(sp._decode_batches(iter(whole), tool))
    assert max(part.num_rows for part in parts) <= 256
    assert [t for part in parts for t in part.column("decoded").to_pylist()] == [t or "" for t in texts]

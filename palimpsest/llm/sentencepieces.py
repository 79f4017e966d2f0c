"""SentencePiece encoding and decoding by a Viterbi search that shares prefixes.

A text is cut at its white space into marked words: a word with the marks (U+2581) before it. No piece reaches over the
end of a marked word, nor over a line break unless some piece has one, so words are encoded one by one. The distinct new words of a block are sorted, which is a
depth-first walk through their trie: the forward scores of a prefix are computed once and stay for all words below it.

Two kinds of models: in a unigram model every sequence of pieces is admissible and the best sum of scores wins. In a BPE
model a piece may follow another one only if merging the two pieces' letters by score gives back just these two;
then exactly one sequence is admissible, the one that merging the whole word gives. So ids are those of the
library for either kind. Letters without a piece become the pieces of their UTF-8 bytes.

* Null text counts as empty: no ids, decoded to an empty text. An empty table gives an empty result.
* Rows are encoded one by one, so repeated rows give repeated results. Other columns of the input take no part.
* A text of any length is encoded whole. The mark itself in a text is decoded as a space, as the library does.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
KNOWN_WORDS = 400_000  # Of a worker's table of encoded words, and of checked pairs; a full table starts anew.
WITHOUT = -1e6  # Score of a letter without a piece.
ENCODED = "id long, text string, ids array<int>, ids_crc32 long"
_CHUNKS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_WHOLE_CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")  # If some piece has a line break.


@dataclass
class Vocabulary:
    """Pieces with ids and scores; the ids of the 256 byte pieces; whether pieces are merged by score (BPE)."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes: list[int]
    merges: bool
    endings: frozenset[str] = field(init=False)  # All ends of pieces, whole ones too.
    pairs: dict[int, bool] = field(default_factory=dict)  # Of ids: whether one may follow the other.

    def __post_init__(self):
        self.endings = frozenset(piece[k:] for piece in self.ids for k in range(len(piece)))

    @classmethod
    def load(cls, path: str, merges: bool = True) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
        ids = {model.id_to_piece(k): k for k in plain}
        scores = {piece: model.get_score(k) for piece, k in ids.items()}
        return cls(ids, scores, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], merges)

    def merged(self, word: str) -> list[str]:
        """Pieces of a word by merging neighbours, best score first, leftmost of equals first."""
        parts = list(word)
        while True:
            options = [(-self.scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores]
            if not options:
                return parts
            _, k = min(options)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _check(self, key: int, first: str, second: str) -> bool:
        if len(self.pairs) > KNOWN_WORDS:
            self.pairs.clear()
        found = self.pairs[key] = self.merged(first + second) == [first, second]
        return found

    def encode_sorted(self, words: list[str]) -> list[list[str]]:
        """Pieces of each of some sorted distinct words."""
        step = self._merge_step if self.merges else self._best_step
        forward = [0.0]  # By position: the best score up to it,
        last = [""]  # and the piece that ends there.
        numbers = [-1]  # Its id, -1 for a letter without a piece.
        previous, result = "", []
        for word in words:
            shared = 0
            limit = min(len(previous), len(word))
            while shared < limit and previous[shared] == word[shared]:
                shared += 1
            del forward[shared + 1 :], last[shared + 1 :], numbers[shared + 1 :]
            step(word, shared, forward, last, numbers)
            pieces, end = [], len(word)
            while end:
                piece = last[end]
                pieces.append(piece)
                end -= len(piece)
            pieces.reverse()
            result.append(pieces)
            previous = word
        return result

    def _best_step(self, word: str, shared: int, forward: list[float], last: list[str], numbers: list[int]) -> None:
        for end in range(shared + 1, len(word) + 1):
            start = end - 1
            piece = chosen = word[start:end]
            best = forward[start] + self.scores.get(piece, WITHOUT)
            while start and piece in self.endings:
                start -= 1
                piece = word[start:end]
                if piece in self.scores and forward[start] + self.scores[piece] >= best:  # Of equals the longest.
                    best, chosen = forward[start] + self.scores[piece], piece
            forward.append(best)
            last.append(chosen)
            numbers.append(self.ids.get(chosen, -1))

    def _merge_step(self, word: str, shared: int, forward: list[float], last: list[str], numbers: list[int]) -> None:
        ids, endings, pairs = self.ids, self.endings, self.pairs
        for end in range(shared + 1, len(word) + 1):
            start = end - 1
            piece = word[start:end]
            options = [piece]
            while start and piece in endings:
                start -= 1
                piece = word[start:end]
                if piece in ids:
                    options.append(piece)
            while True:  # Long pieces first; one is always admissible.
                piece = options.pop()
                start = end - len(piece)
                number = ids.get(piece, -1)
                before = numbers[start]
                if not options or before < 0 or number < 0:
                    break
                key = before << 32 | number
                admitted = pairs.get(key)
                if admitted or admitted is None and self._check(key, last[start], piece):
                    break
            forward.append(forward[start] + self.scores.get(piece, WITHOUT))
            last.append(piece)
            numbers.append(number)


class Coder:
    """Encodes and decodes texts; words seen before are looked up."""

    def __init__(self, vocabulary: Vocabulary, capacity: int = KNOWN_WORDS):
        self.vocabulary = vocabulary
        self.capacity = capacity
        self.known: dict[str, bytes] = {}
        self.codes: dict[str, bytes] = {}
        self.chunks = _WHOLE_CHUNKS if any("\n" in piece for piece in vocabulary.ids) else _CHUNKS
        self.parts = {k: piece.replace(MARK, " ").encode() for piece, k in vocabulary.ids.items()}
        self.parts |= {k: bytes([b]) for b, k in enumerate(vocabulary.bytes)}

    def _code(self, piece: str) -> bytes:
        number = self.vocabulary.ids.get(piece)
        numbers = [self.vocabulary.bytes[b] for b in piece.encode()] if number is None else [number]
        code = self.codes[piece] = np.array(numbers, "<i4").tobytes()
        return code

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, four bytes each, little-endian."""
        cut = [self.chunks.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {w for words in cut for w in words if w not in self.known}
        if len(self.known) + len(new) > self.capacity:
            self.known = {}
            new = {w for words in cut for w in words}
        new, codes = sorted(new), self.codes
        for word, pieces in zip(new, self.vocabulary.encode_sorted(new), strict=True):
            self.known[word] = b"".join([codes.get(p) or self._code(p) for p in pieces])
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that encoding puts before it."""
        return b"".join(map(self.parts.__getitem__, ids.tolist())).decode(errors="replace").removeprefix(" ")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_coders: dict[tuple[str, bool], Coder] = {}


def coder(path: str, merges: bool) -> Coder:
    """One for each worker process, so that its tables serve many tasks."""
    if (path, merges) not in _coders:
        _coders[path, merges] = Coder(Vocabulary.load(path, merges))
    return _coders[path, merges]


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _encode_batches(batches: Iterator[pa.RecordBatch], tool: Coder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            coded = tool.encode([t or "" for t in part.column("text").to_pylist()])
            bounds = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(coded), "<i4")))
            crc = pa.array(map(zlib.crc32, coded), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text"), ids, crc], ["id", "text", "ids", "ids_crc32"])


def _decode_batches(batches: Iterator[pa.RecordBatch], tool: Coder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            column = part.column("ids")
            bounds, values = np.asarray(column.offsets), np.asarray(column.values)
            texts = [tool.decode(values[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])


def _narrow(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, merges: bool = True) -> DataFrame:
    """One row per document: id, text, ids, ids_crc32 (of the ids as little-endian 32-bit numbers)."""
    path = path or model_path()
    return _narrow(docs, id, text).mapInArrow(lambda batches: _encode_batches(batches, coder(path, merges)), ENCODED)


def decode(coded: DataFrame, path: str | None = None, merges: bool = True) -> DataFrame:
    """With the column `decoded`. `coded` is what `encode` returns."""
    path = path or model_path()
    return coded.mapInArrow(lambda batches: _decode_batches(batches, coder(path, merges)), f"{ENCODED}, decoded string")


def round_trip(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, merges: bool = True) -> DataFrame:
    """What `decode` returns for what `encode` returns. Both work in one process for each task, which holds the
    tables once, and ids go from one to the other in slices."""
    path = path or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(path, merges)
        return _decode_batches(_encode_batches(batches, tool), tool)

    return _narrow(docs, id, text).mapInArrow(work, f"{ENCODED}, decoded string")

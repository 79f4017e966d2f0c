"""Best-fit packing by minimum bin slack: documents as token pieces in as few full sequences as possible.

How pieces fit together depends on their lengths only, and there are at most `capacity` different ones. So the plan is
made from the histogram of lengths: a bitset subset-sum over the lengths still available finds the fullest sequence
that holds the longest of them, which is then removed as often as the counts allow. Each such pattern leaves fewer
pieces of some length than it uses of it, so there are at most the sum of capacity / length patterns over all lengths
(under 17,000 for 2048), whatever the size of the corpus.

Pieces find their places by their rank among pieces of equal length. Ranks come from counts per task, not from
a sort of a length, so a length that a third of all pieces share is no hot group.

* Null text counts as empty: a document is then its end token alone.
* Rows are packed one by one, so repeated rows and repeated ids give repeated pieces at places of their own.
* An empty table gives an empty result. Other columns of the input take no part.
* Only a document longer than a sequence is cut; all its pieces but the first are full sequences.
* A text is encoded in one piece: very long ones need some 60 times their size in memory.
* The table of ranks has a row per length and task. Beyond Spark's broadcast threshold its join shuffles the pieces, which
  are narrow rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.blocks import SPACES, blocks, hash_spans, word_spans
from palimpsest.storage import Scratch

CAPACITY = 2048
END = 0  # The id that ends a document.
KNOWN_WORDS = 1_000_000  # Of a worker's table of words already encoded; a full table starts anew.

PIECES = "id long, piece int, start long, length long, ids_crc32 long, block long, local long"
PLACES = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts; words seen before are looked up by their hashes.

    The tokenizer cuts a text before every single space or line break that follows a word and is followed by one.
    So a text whose white space is single spaces and line breaks is the sum of its words, each with the mark
    before it. Other texts are encoded as they are, and so are texts with blanks beyond ASCII, which the tokenizer takes
    for white space too, and all texts by tokenizers that cut in another way.
    """

    def __init__(self, path: str, capacity: int = KNOWN_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = _cuts_at_words(json.loads(self.tokenizer.to_str()))
        self.capacity = capacity
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)  # Where the ids of a key are, by the order of `keys`.
        self.size = np.zeros(0, np.int64)
        self.ids = [np.zeros(0, np.uint32)]
        self.filled = 0
        self.signs: dict[str, list[int]] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > self.capacity:
            self.forget()
        found, ids, newline = [], [], self.encode("\n").tolist()
        for word in words:
            unit = _UNITS.fullmatch(word)
            if unit:  # Units of the tokenizer, so its model can be asked at once.
                line, letters, signs = unit.groups()
                new = self._unit(letters)
                if line:
                    new = newline + new
                if signs:
                    if signs not in self.signs:
                        self.signs[signs] = self._unit(signs)
                    new = new + self.signs[signs]
            else:
                new = self.tokenizer.encode(word, add_special_tokens=False).ids
            found.append(len(new))
            ids += new
        size = np.array(found, np.int64)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.place = np.insert(self.place, at, self.filled + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.ids.append(np.array(ids, np.uint32))
        self.filled += len(ids)

    def _unit(self, unit: str) -> list[int]:
        if unit.isascii():
            unit = unit.replace(" ", self.letters[0x20])
        else:
            unit = unit.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.tokenizer.model.tokenize(unit)]

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each row."""
        starts, ends, rows = word_spans(data, offsets)
        n = len(offsets) - 1
        count = np.bincount(rows, minlength=n)
        size = np.diff(offsets)
        # White space is plain if there is one mark between words, none around them, and it is a space or line break.
        white = SPACES[data]
        marks = np.searchsorted(np.flatnonzero(white), offsets)
        odd = np.searchsorted(np.flatnonzero(white & (data != 0x20) & (data != 0x0A)), offsets)
        plain = (count > 0) & (np.diff(marks) == count - 1) & (np.diff(odd) == 0)
        edge = np.zeros(n, bool)
        full = size > 0
        edge[full] = white[offsets[:-1][full]] | white[offsets[1:][full] - 1]
        plain &= ~edge & (np.diff(np.searchsorted(_blanks(data), offsets)) == 0) & self.by_words

        use = plain[rows]
        starts, ends, rows = starts[use], ends[use], rows[use]
        before = np.where(starts > offsets[rows], data[np.maximum(starts - 1, 0)], 0)  # 0, a space or a line break.
        keys = hash_spans(data, starts, ends)
        keys ^= _MARKS[before]  # The same word after a space, a line break or nothing is three words.
        unique, inverse = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inner = at < len(self.keys)
        known[inner] = self.keys[at[inner]] == unique[inner]
        if not known.all():
            first = np.zeros(len(unique), np.int64)
            first[inverse[::-1]] = np.arange(len(inverse))[::-1]
            new = unique[~known] if len(self.keys) + (~known).sum() <= self.capacity else unique
            pick = first[~known] if len(new) < len(unique) or not known.any() else first
            raw = data.tobytes()
            words = [
                raw[starts[k] - (before[k] > 0) : ends[k]].decode() for k in pick.tolist()
            ]
            self._learn(new, words)
            at = np.searchsorted(self.keys, unique)
        ids = np.concatenate(self.ids)
        self.ids = [ids]
        size = self.size[at][inverse]
        ends_at = np.cumsum(size)
        out = ids[np.repeat(self.place[at][inverse] - ends_at + size, size) + np.arange(ends_at[-1] if len(size) else 0)]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, size, minlength=n).astype(np.int64))])
        result = []
        for k in range(n):
            if plain[k]:
                result.append(out[bounds[k] : bounds[k + 1]])
            else:
                result.append(self.encode(data[offsets[k] : offsets[k + 1]].tobytes().decode()))
        return result


_UNITS = re.compile(r"(\n?)(\x20?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?|#$%&*()]*)")
_MARKS = np.zeros(256, np.uint64)
_MARKS[[0x20, 0x0A]] = 0x94D049BB133111EB, 0xBF58476D1CE4E5B9


def _cuts_at_words(parts: dict) -> bool:
    """Whether a tokenizer, as its own description says, cuts texts by the usual expression of byte-level vocabularies."""
    model, cutter = parts["model"], parts["pre_tokenizer"] or {}
    return (
        (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex", True)) == ("ByteLevel", False, True)
        and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and parts["normalizer"] is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in parts["added_tokens"])
    )


def _blanks(data: np.ndarray) -> np.ndarray:
    """Where blanks begin that are white space but not one of [\\x20\\x09-\\x0D], in UTF-8; U+001C to U+001F included."""
    after = np.concatenate([data[1:], np.zeros(2, np.uint8)])
    second, third = after[: len(data)], np.concatenate([after[1:], np.zeros(1, np.uint8)])[: len(data)]
    general = (second == 0x80) & ((third >= 0x80) & (third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
    found = (data >= 0x1C) & (data <= 0x1F)
    found |= (data == 0xC2) & ((second == 0x85) | (second == 0xA0))  # U+0085, U+00A0
    found |= (data == 0xE1) & (second == 0x9A) & (third == 0x80)  # U+1680
    found |= (data == 0xE2) & (general | (second == 0x81) & (third == 0x9F))  # U+2000-200A, 2028, 2029, 202F, 205F
    found |= (data == 0xE3) & (second == 0x80) & (third == 0x80)  # U+3000
    return np.flatnonzero(found)


def _byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process, so that its table serves many tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first takes the remainder."""
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def tokenised(docs: DataFrame, id: str, text: str, path: str, capacity: int) -> DataFrame:
    """One row per piece, with the task it came from and its rank among the task's pieces of its length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        block = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                rows = []
                for key, ids in zip(part.column("id").to_pylist(), tool.encode_rows(data, offsets), strict=True):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        crc = zlib.crc32(ids[start : start + length].tobytes())
                        rows.append((key, piece, start, length, crc, block, int(seen[length])))
                        seen[length] += 1
                columns = [list(c) for c in zip(*rows, strict=True)]
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                names = ["id", "piece", "start", "length", "ids_crc32", "block", "local"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(work, PIECES)


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """Lengths, longest first, of the fullest sequence that holds the longest available length.

    Among equally full ones, long pieces are preferred.
    """
    longest = max(counts)
    room = capacity - longest
    steps = []  # (length, sums reachable with it and all longer ones)
    reached = 1
    limit = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        copies = counts[length] - (length == longest)
        if length > room or copies <= 0:
            continue
        steps.append((length, reached))
        copies = min(copies, room // length)
        k = 1
        while copies > 0:
            k = min(k, copies)
            reached |= (reached << (length * k)) & limit
            copies -= k
            k *= 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    chosen = []
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            chosen.append(length)
    return [longest, *reversed(chosen)]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths) of all patterns; together they hold every piece."""
    counts = {k: n for k, n in counts.items() if n}
    patterns = []
    while counts:
        lengths = fullest(counts, capacity)
        need = {k: lengths.count(k) for k in set(lengths)}
        times = min(counts[k] // n for k, n in need.items())
        patterns.append((times, lengths))
        for k, n in need.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return patterns


def _slots(patterns: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, copies in a sequence, first sequence, offset of the first copy)."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            copies = lengths.count(length)
            slots.setdefault(length, []).append((used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + copies * times
            offset += copies * length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def _placer(slots: dict[int, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                mine = lengths == length
                table = slots[length]
                first, copies, base, start = table[np.searchsorted(table[:, 0], ranks[mine], "right") - 1].T
                since = ranks[mine] - first
                sequence[mine] = base + since // copies
                offset[mine] = start + since % copies * length
            kept = [batch.column(name) for name in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], [f.split()[0] for f in PLACES.split(", ")]
            )

    return work


def pack(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = scratch.keep(tokenised(docs, id, text, path or tokenizer_path(), capacity), "pieces")
    counts = scratch.keep(pieces.groupBy("length", "block").agg(F.count("*").alias("n")), "counts")
    histogram = dict(counts.groupBy("length").agg(F.sum("n")).collect())  # At most `capacity` rows.
    slots = _slots(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["length", "block"]).withColumn("rank", F.col("first") + F.col("local"))
    return ranked.mapInArrow(_placer(slots), PLACES)

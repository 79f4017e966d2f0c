"""License scans: an Aho-Corasick automaton finds identifier tags and notice phrases, a shunting-yard parser reads the
licence expressions behind tags.

Phrases are matched as runs of words, whatever stands between them: texts are lower-cased (A-Z only) and cut into the
words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+. Every place of a base phrase counts, also places that overlap. Tags are looked
for in the text itself, as an expression needs its brackets and hyphens.

The score says how far the text allows use: of the labels found it is the mean freedom, and an expression counts as
its freest choice under `or`, as its strictest part under `and`. Without any label it is 0.

* Null text counts as empty: no words, null places, empty labels, score 0.
* Rows are scanned one by one, so repeated rows give repeated results. An empty table gives an empty result.
* Other columns of the input take no part. A text of any length is scanned whole, in time proportional to its length
  and some 40 times its size of memory (a Python object for each word).
* An expression that does not parse adds no label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
PHRASES = {  # Further notices.
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution 4 0 international": "cc-by",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
FREEDOM = {  # From 1, any use, to 0, none.
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 0.9, "bsd": 0.9, "isc": 0.9, "zlib": 0.9,
    "apache-2": 0.9, "cc-by": 0.8, "mpl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl-2": 0.4, "gpl-3": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0,
}
UNKNOWN = 0.3  # Freedom of a licence that only a tag names.

RESULT = (
    "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)
_SEPARATE = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
_TOKEN = re.compile(r"[\x20\t]*(\(|\)|[a-z0-9][a-z0-9.+-]*)")
_PLACED = {  # By phrase between spaces: the phrase's spaces, its label, whether it is a base phrase.
    f" {phrase} ": (phrase.count(" "), label, base)
    for phrases, base in ((PHRASES, False), (BASE_PHRASES, True))
    for phrase, label in phrases.items()
}


@cache
def _automaton(name: str) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, value in (_PLACED if name == "phrases" else dict.fromkeys(TAGS, True)).items():
        found.add_word(word, value)
    found.make_automaton()
    return found


def phrase_places(words: list[bytes]) -> list[tuple[int, str, bool]]:
    """(first word, label, whether a base phrase) of all places."""
    text = (b" " + b" ".join(words) + b" ").decode()
    places, word, seen = [], 0, 0
    for last, (spaces, label, base) in _automaton("phrases").iter(text):
        word += text.count(" ", seen, last)  # Spaces before the last one: words up to the end of the phrase.
        seen = last
        places.append((word - 1 - spaces, label, base))
    return places


def label_of(name: str) -> str:
    """The label for a licence identifier."""
    name = name.removesuffix("+").removesuffix("-or-later").removesuffix("-only")
    for stem in ("apache-2", "gpl-2", "gpl-3", "agpl", "lgpl", "mpl", "bsd", "cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by", "cc0"):
        if name == stem or name.startswith((f"{stem}.", f"{stem}-")):
            return stem
    return name


def parse(text: str, at: int = 0) -> tuple[list[str], float] | None:
    """Labels and freedom of the licence expression that begins at `at` of a lower-case text and ends with its line.

    Shunting yard: `with` binds closest, then `and`, then `or`. None if it does not parse. Operands lie side by side, so
    the labels of all are one list, of which the topmost operand has the end.
    """
    ranks = {"or": 1, "and": 2, "with": 3}
    labels: list[str] = []
    values: list[tuple[int, float]] = []  # Of each operand: where its labels begin, its freedom.
    operators: list[str] = []
    wants_value = True

    def apply() -> None:
        operator, (middle, right), (first, left) = operators.pop(), values.pop(), values.pop()
        if operator == "with":  # An exception adds leave, so it does not take any away.
            del labels[middle:]
            values.append((first, left))
        else:
            values.append((first, (max if operator == "or" else min)(left, right)))

    while token := _TOKEN.match(text, at):
        word = token[1]
        if wants_value:
            if word == "(":
                operators.append(word)
            elif word == ")" or word in ranks:
                return None
            else:
                label = label_of(word)
                values.append((len(labels), FREEDOM.get(label, UNKNOWN)))
                labels.append(label)
                wants_value = False
        elif word in ranks:
            while operators and operators[-1] != "(" and ranks[operators[-1]] >= ranks[word]:
                apply()
            operators.append(word)
            wants_value = True
        elif word == ")" and "(" in operators:
            while operators[-1] != "(":
                apply()
            operators.pop()
        else:
            break
        at = token.end()
    if wants_value or "(" in operators:
        return None
    while operators:
        apply()
    return labels, values[0][1]


def scan_text(text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    raw = text.encode()
    words = raw.translate(_SEPARATE).split(b" ") if raw else []
    words = [w for w in words if w]
    places = phrase_places(words)
    base = [p for p in places if p[2]]
    starts = [p[0] for p in base]
    labels = {p[1] for p in places}
    freedoms = [FREEDOM[label] for label in labels]
    lower = raw.lower().decode()
    for last, _ in _automaton("tags").iter(lower):
        if expression := parse(lower, last + 1):
            labels.update(expression[0])
            freedoms.append(expression[1])
    score = sum(freedoms) / len(freedoms) if freedoms else 0.0
    first, final = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(base), first, final, ",".join(sorted({p[1] for p in base})), ",".join(sorted(labels)), score


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and what `scan_text` finds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]
        for batch in batches:
            found = [scan_text(value.as_py() or "") for value in batch.column("text")]
            columns = zip(*found, strict=True) if found else [[]] * len(types)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], [f.split()[0] for f in RESULT.split(", ")])

    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(work, RESULT)

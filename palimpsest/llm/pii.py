"""Personal data: an Aho-Corasick automaton finds anchors, local parsers expand each one and check its boundaries.

One pass of the automaton over a text gives the places of at-signs, scheme separators, plus signs, digits and
identifier cues. Only there does a parser look at the text, to both sides as far as the span may reach.

Base kinds, leftmost and not overlapping per kind; spans that fail their check are dropped without another try:
email, ip (parts at most 255), card (14 to 19 digits, Luhn), phone (10 to 15 digits). Further kinds: url (an address
with user data before its host), iban (after its name, check digits right), secret (a value given to a token, key or
password). Offsets are code points, ends exclusive.

* Null text counts as empty: no spans. Rows are scanned one by one, so repeated rows give repeated results.
* An empty table gives an empty result. Other columns, whatever their names, can be carried along in `row`.
* A text of any length is scanned whole, in time proportional to its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "secret")
CUES = {  # Words after which an identifier may follow.
    "iban": ("iban", "IBAN", "Iban"),
    "secret": ("token", "Token", "TOKEN", "secret", "Secret", "SECRET", "api_key", "API_KEY", "apikey", "password", "Password"),
}
RESULT = (
    "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_extra long"
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT_RUN = re.compile(r"[0-9]+")
_PHONE_RUN = re.compile(r"[\x20().0-9-]+")
_USERINFO = re.compile(r"[^\s/?#@\"'<>]+@[A-Za-z0-9.-]+[^\s\"'<>]*")
_IBAN = re.compile(r"[\x20:#]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)")
_SECRET = re.compile(r"[\"']?\x20{0,3}[=:]\x20{0,3}[\"']?([A-Za-z0-9_./+-]{16,})")

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
    for kind, mark in (("email", "@"), ("url", "://"), ("phone", "+")):
        automaton.add_word(mark, (kind, len(mark)))
    for kind, cues in CUES.items():
        for cue in cues:
            automaton.add_word(cue, (kind, len(cue)))
    automaton.make_automaton()
    return automaton


_automaton = None


def automaton() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        _automaton = _anchors()
    return _automaton


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _phone(text: str, at: int) -> tuple[int, int] | None:
    if text[at + 1 : at + 2] not in _DIGITS:
        return None
    run = _PHONE_RUN.match(text, at + 2)
    end = run.end() if run else 0
    while end >= at + 4 and text[end - 1] not in _DIGITS:
        end -= 1
    return (at, end) if end >= at + 4 else None


def _url(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _SCHEME:  # No scheme holds `://`, so a text is walked over once.
        start -= 1
    rest = _USERINFO.match(text, at + 3)
    return (start, rest.end()) if rest and start < at else None


def _iban_holds(number: str) -> bool:
    number = number.replace(" ", "")
    return 15 <= len(number) <= 34 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) << (k & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _octet(part: str) -> bool:
    return len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255


def _numbers(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    """Addresses and cards among the runs of digits."""
    k = 0
    while k + 3 < len(runs):
        parts = runs[k : k + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(parts, parts[1:], strict=False)):
            if all(_octet(text[a:b]) for a, b in parts):
                yield parts[0][0], 1, parts[3][1]
            k += 4
        else:
            k += 1
    k = 0
    while k < len(runs):
        last = k
        while last + 1 < len(runs) and runs[last + 1][0] == runs[last][1] + 1 and text[runs[last][1]] in " -":
            last += 1
        count = sum(b - a for a, b in runs[k : last + 1])
        if 14 <= count <= 19 and luhn("".join(text[a:b] for a, b in runs[k : last + 1])):
            yield runs[k][0], 2, runs[last][1]
        k = last + 1


def find(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    spans: list[Span] = []
    runs: list[tuple[int, int]] = []
    after = dict.fromkeys(("digit", *KINDS), 0)  # No span of a kind begins before the end of the last one.
    for last, (kind, length) in automaton().iter(text):
        at = last - length + 1
        if at < after[kind]:
            continue
        if kind == "digit":
            runs.append(_DIGIT_RUN.match(text, at).span())
            after[kind] = runs[-1][1]
        elif kind == "email":
            if found := _email(text, at, after[kind]):
                spans.append((found[0], 0, found[1]))
                after[kind] = found[1]
        elif kind == "phone":
            if found := _phone(text, at):
                if 10 <= sum(map(text.count, _DIGITS, [found[0]] * 10, [found[1]] * 10)) <= 15:
                    spans.append((found[0], 3, found[1]))
                after[kind] = found[1]
        elif kind == "url":
            if found := _url(text, at, after[kind]):
                spans.append((found[0], 4, found[1]))
                after[kind] = found[1]
        else:
            found = (_IBAN if kind == "iban" else _SECRET).match(text, last + 1)
            if found and (kind == "secret" or _iban_holds(found[1])):
                spans.append((found.start(1), KINDS.index(kind), found.end(1)))
                after[kind] = found.end(1)
    spans += _numbers(text, runs)
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one, named after the first."""
    parts, done, k = [], 0, 0
    while k < len(spans):
        start, kind, end = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < end:
            k += 1
            end = max(end, spans[k][2])
        parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done, k = end, k + 1
    return "".join([*parts, text[done:]])


def clean(text: str) -> str:
    """The text masked until nothing is found: a span may end only where the one before it was."""
    while spans := find(text):
        text = mask(text, spans)
    return text


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: id, counts of the base kinds, base_sha256, spans, n_extra.

    With `carry` also `masked`, the text without its personal data (null stays null), and `row`, all its columns.
    """
    narrow = docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *[F.struct("*").alias("row")] * carry
    )
    schema = StructType.fromDDL(RESULT)
    if carry:
        schema.add("masked", "string").add(narrow.schema["row"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: [] for name in schema.names}
            for value in batch.column("text"):
                value = value.as_py()
                spans = find(value or "")
                base = [s for s in spans if s[1] < len(BASE_KINDS)]
                for k, kind in enumerate(BASE_KINDS):
                    columns[f"n_{kind}"].append(sum(s[1] == k for s in base))
                columns["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                columns["spans"].append(written(spans))
                columns["n_extra"].append(len(spans) - len(base))
                if carry:
                    columns["masked"].append(clean(value) if spans else value)
            kept = {"id": batch.column("id")} | {name: batch.column(name) for name in ["row"] * carry}
            types = {"string": pa.string(), "bigint": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [kept.get(f.name, None) if f.name in kept else pa.array(columns[f.name], types[f.dataType.simpleString()]) for f in schema],
                schema.names,
            )

    return narrow.mapInArrow(work, schema)

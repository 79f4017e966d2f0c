"""A small table of documents with every awkward case, and helpers."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the of and to in is was for on with as by at from that this it are be or an which you have not".split()


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "er", "ing", "ed"]) for _ in range(n))


def edited(text: str, places: list[int]) -> str:
    words = text.split(" ")
    for k in places:
        words[k] = f"changed{k}"
    return " ".join(words)


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


AWKWARD = [
    None,
    "",
    " ",
    "\n\t\x0b\x0c\r ",
    "one",
    "one",
    "One two three four",
    "é à ü ß 日本 😀 x",
    "a\n\na\na \n a",
    "\x00 odd \x1f \x7f\x1c",
    "x" * 300_000,
    prose(400, 1),
    prose(400, 1),
    "  " + prose(400, 1).replace(" ", "  "),
    "word " * 3000,
]


def awkward(spark):
    """Awkward texts, with a null id, a repeated id, a repeated row, and extra columns with the names used inside."""
    from pyspark.sql import functions as F

    docs = documents(spark, [*AWKWARD, "one", "one"], [*range(len(AWKWARD) - 1), None, 4, 4])
    return docs.withColumns({name: F.lit(name) for name in ("id", "row", "seq", "key", "label", "kept", "masked", "class", "v")})

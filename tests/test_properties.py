"""Results on many random inputs, each against a plain model. Seeds are fixed."""

import random
import re
from xml.sax.saxutils import escape

import pytest
from helpers import revdocs
from pyspark.sql import functions as F
from test_xml import HEAD, page, revision

from palimpsest.functions import valid_dump_day
from palimpsest.operators.metadata import metadata, project_metadata
from palimpsest.sources import manifest_entries, manifest_pattern, read_pages, read_revisions
from palimpsest.storage import Scratch


def valid_by_the_book(day):
    found = re.search(r"(\d{4})(\d\d)(\d\d)", day, re.ASCII)
    if not found:
        return False
    year, month, dom = map(int, found.groups())
    longest = {2: 29, 4: 30, 6: 30, 9: 30, 11: 30}.get(month, 31)
    return year > 2010 and 1 <= month <= 12 and 1 <= dom <= longest


def test_day_rule(spark):
    rng = random.Random(1)
    days = []
    for _ in range(5000):
        day = f"{rng.randint(2008, 2026)}{rng.randint(0, 13):02d}{rng.randint(0, 33):02d}"
        cut = rng.choice([0, 0, 0, 1, 3])
        days.append(rng.choice(["", "", "x", "20", "é"]) + day[cut:] + rng.choice(["", "", "1", " ", "-"]))
    df = spark.createDataFrame([(d,) for d in days], "d string").select("d", valid_dump_day(F.col("d")).alias("v"))
    wrong = [(r["d"], r["v"]) for r in df.collect() if r["v"] != valid_by_the_book(r["d"])]
    assert wrong == []


def test_manifest_rule(spark):
    rng = random.Random(2)
    pattern = manifest_pattern("enwiki", "20150923")
    lines = []
    for _ in range(3000):
        md5 = "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 32, 32, 31, 33])))
        gap = rng.choice(["  ", "  ", "  ", " ", "\t"])
        wiki = rng.choice(["enwiki", "enwiki", "frwiki"])
        family = rng.choice(["pages-meta-history", "pages-meta-history", "pages-articles", "stub"])
        suffix = rng.choice([".xml.bz2", ".xml-p1p2.bz2", ".xml.7z", ".xml.bz2.torrent", ".bz2"])
        lines.append(f"{rng.choice(['', '# '])}{md5}{gap}{wiki}-20150923-{family}{rng.randint(1, 40)}{suffix}")
    expected = {}
    for line in lines:
        if found := re.search(pattern, line, re.ASCII):
            expected[found.group(2)] = found.group(1)
    df = spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")
    assert {r["filename"]: r["md5"] for r in manifest_entries(df, pattern).collect()} == expected
    assert len(expected) > 20


@pytest.mark.parametrize("grain", ["pages", "revisions"])
def test_text_survives_xml(spark, tmp_path, grain):
    rng = random.Random(3)
    alphabet = ["a", "é", "漢", "😀", "<", ">", "&", '"', "'", " ", "\n", "\t", "]]>", "</page>", "<revision>", "&lt;", "null"]
    texts = ["", " ", "\n", "null", "  x", "x  "] + [
        "".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(1500)
    ]
    pages, number = [], 0
    while number < len(texts):
        size = rng.randint(1, 9)
        members = range(number, min(number + size, len(texts)))
        pages.append(
            page(
                len(pages),
                escape(f"T<{len(pages)}>"),
                *[revision(i, f"<comment>{escape(texts[i])}</comment>", text=f"<text>{escape(texts[i])}</text>") for i in members],
            )
        )
        number += size
    (tmp_path / "part.xml").write_text(HEAD + "".join(pages) + "</export>\n", encoding="utf-8")
    if grain == "pages":
        read = read_pages(spark, str(tmp_path))
    else:
        read = read_revisions(spark, str(tmp_path), Scratch(spark))
    rows = {r["id"]: r for r in read.collect()}
    assert sorted(rows) == list(range(len(texts)))
    wrong = [
        i for i, t in enumerate(texts)
        if (rows[i]["text"], rows[i]["comment"], rows[i]["bytes"]) != (t, t, len(t.encode()))
    ]
    assert [(texts[i], rows[i]["text"], rows[i]["malformed"]) for i in wrong] == []


def test_metadata_is_idempotent_and_order_free(spark):
    rng = random.Random(4)
    rows = [
        {"id": rng.randint(1, 30), "comment": rng.choice([None, "", "c"]), "text": str(rng.random()),
         "page_restrictions": rng.choice([None, [], ["a"], ["a", "b"]])}
        for _ in range(600)
    ]
    once = metadata(revdocs(spark, *rows))
    other = metadata(revdocs(spark, *sorted(rows, key=lambda r: r["text"]), *rows[:50]))
    assert once.exceptAll(other).isEmpty() and other.exceptAll(once).isEmpty()
    assert once.count() == project_metadata(revdocs(spark, *rows)).distinct().count() == once.distinct().count()
    assert once.count() == len({(r["id"], r["comment"], tuple(r["page_restrictions"] or ())) for r in rows})

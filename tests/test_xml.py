import pytest
from pyspark.sql import functions as F

from palimpsest.schemas import REVDOC
from palimpsest.sources import read_pages, read_revisions
from palimpsest.storage import Scratch

HEAD = "<export xml:lang='en'>\n  <siteinfo><sitename>S</sitename></siteinfo>\n"


def revision(id, *elements, text='<text bytes="4">text</text>'):
    return "    <revision>\n      " + "\n      ".join([f"<id>{id}</id>", *elements, text]) + "\n    </revision>\n"


def page(id, title, *revisions, extra=""):
    return f"  <page>\n    <title>{title}</title>\n    <ns>0</ns>\n    <id>{id}</id>\n{extra}{''.join(revisions)}  </page>\n"


DUMP = HEAD + "".join(
    [
        page(1, "A &amp; B", revision(11, "<contributor><ip>1.2.3.4</ip></contributor>", "<minor />")),
        page(
            2,
            "Two",
            revision(
                21,
                "<parentid>20</parentid>",
                "<timestamp>2015-09-23T01:02:03Z</timestamp>",
                "<contributor><username>Ann</username><id>5</id></contributor>",
                "<comment>  padded &lt;b&gt; </comment>",
                "<model>wikitext</model>",
                "<format>text/x-wiki</format>",
                "<sha1>abc</sha1>",
                text='<text xml:space="preserve" bytes="30">  lead &lt;/page&gt; &lt;revision&gt;\n</text>',
            ),
            revision(22, text='<text bytes="0"></text>'),
            revision(23, '<contributor deleted="deleted" />', '<comment deleted="deleted" />', text='<text deleted="deleted" bytes="9" />'),
            revision(24, "<comment></comment>", text="<text />"),
            revision(25, "<comment> </comment>", text='<text bytes="3"> \n </text>'),
            revision(26, text="<text>é no size</text>"),
            extra='    <redirect title="To &quot;there&quot;" />\n    <restrictions>edit=sysop</restrictions>\n',
        ),
        page(3, "No revisions"),
        page(4, "After an empty page", revision(41, text='<text bytes="4">null</text>'), revision(42, text="")),
        page(5, "Malformed", revision("five"), revision(52)),
    ]
) + "</export>\n"


@pytest.fixture(params=["pages", "revisions"])
def read(request, spark, tmp_path):
    def read_text(text=DUMP):
        (tmp_path / "dump").mkdir(exist_ok=True)
        (tmp_path / "dump" / "part1.xml").write_text(text)
        path = str(tmp_path / "dump")
        if request.param == "pages":
            return read_pages(spark, path)
        return read_revisions(spark, path, Scratch(spark))

    return read_text


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_fields(read):
    rows = by_id(read())
    assert set(rows) == {11, 21, 22, 23, 24, 25, 26, 41, 42, None, 52}
    full = rows[21].asDict()
    full.pop("seq", None)
    assert full == {
        "id": 21,
        "timestamp": "2015-09-23T01:02:03Z",
        "page_id": 2,
        "page_title": "Two",
        "page_namespace": 0,
        "page_redirect": 'To "there"',
        "page_restrictions": ["edit=sysop"],
        "user_id": 5,
        "user_text": "Ann",
        "minor": False,
        "comment": "  padded <b> ",
        "bytes": 30,
        "text": "  lead </page> <revision>\n",
        "sha1": "abc",
        "parent_id": 20,
        "model": "wikitext",
        "format": "text/x-wiki",
        "malformed": None,
    }


def test_anonymous_minor_and_absent_elements(read):
    row = by_id(read())[11]
    assert (row["page_title"], row["user_id"], row["user_text"], row["minor"]) == ("A & B", None, "1.2.3.4", True)
    assert (row["comment"], row["parent_id"], row["page_redirect"], row["page_restrictions"]) == (None, None, None, [])


def test_empty_blank_and_hidden_text(read):
    rows = by_id(read())
    assert {id: (rows[id]["text"], rows[id]["bytes"], rows[id]["comment"]) for id in (22, 23, 24, 25, 26, 41, 42)} == {
        22: ("", 0, None),
        23: (None, 9, None),
        24: ("", 0, ""),
        25: (" \n ", 3, " "),
        26: ("é no size", 10, None),
        41: ("null", 4, None),
        42: (None, None, None),
    }
    assert rows[23]["user_text"] is None and rows[23]["user_id"] is None


def test_page_without_revisions_lends_its_header_to_nobody(read):
    rows = by_id(read())
    assert rows[41]["page_title"] == rows[42]["page_title"] == "After an empty page"


def test_malformed_revision_is_kept_and_told(read):
    row = by_id(read())[None]
    assert "<id>five</id>" in row["malformed"]
    assert (row["page_id"], row["text"], row["minor"]) == (5, None, None)
    assert by_id(read())[52]["malformed"] is None


def test_schema(read):
    columns = read().drop("malformed", "seq")
    assert [(f.name, f.dataType) for f in columns.schema] == [(f.name, f.dataType) for f in REVDOC]


def test_revision_before_any_page_is_told(spark, tmp_path):
    (tmp_path / "cut.xml").write_text(revision(1) + page(2, "T", revision(21)))
    rows = by_id(read_revisions(spark, str(tmp_path), Scratch(spark)))
    assert rows[1]["malformed"] == "no page before revision 1"
    assert rows[21]["malformed"] is None


BIG, SMALL, FILES = 250, 600, 2  # Revisions of the one large page, and pages of three revisions, per file.


@pytest.fixture(scope="module", params=["bzip2", "none"])
def large_dump(request, spark, tmp_path_factory):
    """Two files, each with a page many splits long in its middle. Returns the path and (id, page_id)."""
    path = str(tmp_path_factory.mktemp("large") / "dump")
    per_file, half = 3 * SMALL + BIG, 3 * SMALL // 2 // 3 * 3
    k = F.col("k")
    rows = spark.range(0, FILES * per_file, 1, FILES).withColumn("k", F.col("id") % per_file)
    in_big = (k >= half) & (k < half + BIG)
    small = F.when(k < half, k).otherwise(k - BIG)
    page_id = F.expr(f"id div {per_file}") * 1_000_000 + F.when(in_big, 999_999).otherwise((small / 3).cast("long"))
    first = F.when(in_big, k == half).otherwise(small % 3 == 0)
    last = F.when(in_big, k == half + BIG - 1).otherwise(small % 3 == 2)
    rows = rows.withColumn("page_id", page_id)
    # Digests do not compress, so the file is about as long as its text. Three lengths vary where splits fall.
    text = F.array_join(
        F.transform(F.sequence(F.lit(1), 8 + F.col("id") % 3 * 20), lambda i: F.sha2(F.concat_ws("-", "id", i), 256)), ""
    )
    xml = F.concat(
        F.when(k == 0, HEAD).otherwise(""),
        F.when(first, F.format_string("  <page>\n    <title>P%1$d</title><ns>0</ns><id>%1$d</id>\n", "page_id")).otherwise(""),
        F.format_string('    <revision><id>%d</id><text bytes="1">', "id"),
        text,
        F.lit("</text></revision>"),
        F.when(last, "\n  </page>").otherwise(""),
        F.when(k == per_file - 1, "\n</export>").otherwise(""),
    )
    rows.select(xml).write.option("compression", request.param).text(path)
    return path, rows.select("id", "page_id")


@pytest.mark.parametrize("split", ["70k", "333k", "5m"])
@pytest.mark.parametrize("grain", ["pages", "revisions"])
def test_no_split_loses_doubles_or_misplaces_a_revision(spark, large_dump, split, grain):
    path, expected = large_dump
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        scratch = Scratch(spark)
        read = read_pages(spark, path) if grain == "pages" else read_revisions(spark, path, scratch)
        got = scratch.keep(read, "result")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got.where("malformed IS NOT NULL").isEmpty()
    pairs = got.select("id", "page_id")
    assert pairs.count() == expected.count()
    assert pairs.exceptAll(expected).isEmpty()
    if grain == "revisions":
        assert got.select("seq").distinct().count() == got.count()


def test_carry_in_too_large_to_broadcast_is_joined_all_the_same(spark, large_dump):
    path, expected = large_dump
    settings = {"spark.sql.files.maxPartitionBytes": "150k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        read = read_revisions(spark, path, Scratch(spark))
        assert "SortMergeJoin" in read._jdf.queryExecution().executedPlan().toString()
        got = [tuple(r) for r in read.select("id", "page_id").collect()]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted(got) == sorted(tuple(r) for r in expected.collect())


def test_revision_reader_does_not_shuffle_text(spark, large_dump):
    """The whole result is scans of scratch tables; rows without a header meet the small carry-in by broadcast."""
    result = read_revisions(spark, large_dump[0], Scratch(spark))
    physical = result._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in physical
    assert "BroadcastHashJoin" in physical

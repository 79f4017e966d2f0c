import hashlib

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import hex_digest, null_if_empty, valid_dump_day
from palimpsest.naming import Dump, dump_locations


def test_null_if_empty(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, ["edit=sysop"])], "k int, a array<string>")
    rows = {r["k"]: r["a"] for r in df.select("k", null_if_empty(F.col("a")).alias("a")).collect()}
    assert rows == {1: None, 2: None, 3: ["edit=sysop"]}


@pytest.mark.parametrize(
    "day, lenient, strict",
    [
        ("20150923", True, True),
        ("20150229", True, False),
        ("20160229", True, True),
        ("20150230", False, False),
        ("20151301", False, False),
        ("20150001", False, False),
        ("20150431", False, False),
        ("20150430", True, True),
        ("20150532", False, False),
        ("20150500", False, False),
        ("20100101", False, False),
        ("20110101", True, True),
        ("2009", False, False),
        ("x20150923", True, False),
        ("ab20120630cd", True, False),
        ("2015-09-23", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_valid_dump_day(spark, day, lenient, strict):
    row = spark.createDataFrame([(day,)], "d string").select(
        valid_dump_day(F.col("d")).alias("lenient"), valid_dump_day(F.col("d"), strict=True).alias("strict")
    ).first()
    assert (row["lenient"], row["strict"]) == (lenient, strict)


def test_hex_digest(spark):
    df = spark.createDataFrame([(b"abc",)], "content binary")
    row = df.select(*[hex_digest(F.col("content"), a).alias(a) for a in ("md5", "sha1")]).first()
    assert row["md5"] == hashlib.md5(b"abc").hexdigest()
    assert row["sha1"] == hashlib.sha1(b"abc").hexdigest()
    with pytest.raises(ValueError):
        hex_digest(F.col("content"), "crc")


@pytest.mark.parametrize("database, prefix", [(None, ""), ("db", "db.")])
def test_dump_names(spark, database, prefix):
    dump = Dump("enwiki", "20150923", "/base/", database)
    assert dump.xml_path == "/base/enwiki-20150923/xmlbz2"
    assert dump.json_path == "/base/enwiki-20150923/jsonbz2"
    assert dump.metadata_path == "/base/enwiki-20150923/meta_parquet"
    assert dump.metadata_table == prefix + "enwiki_20150923"
    assert dump.fulltext_table == prefix + "enwiki_20150923_fulltext"


def test_dump_locations_agree_with_dump(spark):
    row = spark.range(1).select(*dump_locations(F.lit("enwiki"), F.lit("20150923"), "/base/")).first().asDict()
    dump = Dump("enwiki", "20150923", "/base/")
    assert row == {name: getattr(dump, name) for name in row}

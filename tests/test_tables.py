"""Ordering, metadata, sinks and their markers."""

import glob

import pytest
from helpers import plan, revdocs
from pyspark.sql import functions as F

from palimpsest import storage
from palimpsest.operators import sinks
from palimpsest.operators.metadata import metadata, project_metadata
from palimpsest.operators.ordering import SLICE_BYTES, hot_page_cuts, order_by_page
from palimpsest.schemas import METADATA, REVDOC
from palimpsest.sources import read_metadata, read_revdocs, register_fulltext, register_metadata


def numbered(spark, n, page, minutes="id", partitions=8):
    """`n` revisions with a row number; `page` and `minutes` are expressions of the id."""
    time = F.date_format(F.timestamp_seconds(1_420_070_400 + 60 * F.expr(minutes).cast("double")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    columns = {"id": F.col("id"), "timestamp": time, "page_id": F.expr(page), "bytes": F.lit(100), "text": F.lit("t")}
    return spark.range(0, n, 1, partitions).select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REVDOC],
        F.monotonically_increasing_id().alias("row"),
    )


@pytest.fixture
def scratch(spark):
    with storage.Scratch(spark) as opened:
        yield opened


@pytest.fixture(scope="module")
def json_revdocs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("json") / "rows")
    numbered(spark, 2000, "id % 10").drop("row").write.json(path)
    return read_revdocs(spark, path)


def pieces(df):
    """Per page and partition: first and last time and number of rows; and whether partitions are sorted."""
    found = {}
    for part, rows in enumerate(df.rdd.glom().collect()):
        keys = [((r["page_id"] is not None, r["page_id"] or 0), r["timestamp"], r["id"]) for r in rows]
        assert keys == sorted(keys)
        for r in rows:
            first, last, n = found.get((r["page_id"], part), (r["timestamp"], r["timestamp"], 0))
            found[r["page_id"], part] = (min(first, r["timestamp"]), max(last, r["timestamp"]), n + 1)
    return found


def test_pages_stay_whole_and_sorted(spark, scratch):
    found = pieces(order_by_page(numbered(spark, 5000, "id % 400", "5000 - id"), 8, "row", scratch))
    assert len(found) == 400
    assert sum(n for _, _, n in found.values()) == 5000


def test_partitions_are_never_more_than_files(spark, scratch):
    assert order_by_page(numbered(spark, 1000, "id % 100"), 3, "row", scratch).rdd.getNumPartitions() == 3
    assert len(pieces(order_by_page(numbered(spark, 1000, "id % 100"), 1, "row", scratch))) == 100


def test_hot_page_is_cut_into_slices_of_time(spark, scratch):
    """A third of all rows belong to one page; no partition gets much more than its share of them."""
    df = numbered(spark, 30_000, "CASE WHEN id % 3 = 0 THEN 7 ELSE 1000 + id % 900 END", "id * 7919 % 30000")
    found = pieces(order_by_page(df, 16, "row", scratch, slice_bytes=0))
    hot = sorted(piece for (page, _), piece in found.items() if page == 7)
    assert sum(n for _, _, n in hot) == 10_000
    assert 5 <= len(hot) <= 7
    assert max(n for _, _, n in hot) < 2 * 30_000 / 16
    assert all(before[1] <= after[0] for before, after in zip(hot, hot[1:]))
    assert all(len([p for page, p in found if page == cold]) == 1 for cold in {page for page, _ in found} - {7})


def test_light_pages_are_not_cut_however_few_there_are(spark):
    weight = 1000 * (100 + 256)
    for slice_bytes, slices in ((SLICE_BYTES, 1), (0, 8), (weight // 3 + 1, 3)):
        with storage.Scratch(spark) as scratch:
            ordered = order_by_page(numbered(spark, 1000, "1"), 8, "row", scratch, slice_bytes)
            assert len(pieces(ordered)) == slices


def test_number_of_files_follows_the_bytes_if_left_open(spark):
    df = numbered(spark, 1000, "id")
    for each, partitions in ((100, 1), (10_000_000, 10)):
        with storage.Scratch(spark) as scratch:
            weighty = df.withColumn("bytes", F.lit(each).cast("bigint"))
            assert order_by_page(weighty, None, "row", scratch).rdd.getNumPartitions() == partitions


def test_copies_of_one_revision_are_dealt_out(spark, scratch):
    df = numbered(spark, 30_000, "CASE WHEN id % 3 = 0 THEN 7 ELSE 1000 + id % 900 END", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END")
    df = df.withColumn("id", F.when(F.col("page_id") == 7, 0).otherwise(F.col("id")))
    hot = [piece for (page, _), piece in pieces(order_by_page(df, 16, "row", scratch, slice_bytes=0)).items() if page == 7]
    assert sum(n for _, _, n in hot) == 10_000
    assert len(hot) >= 5
    assert max(n for _, _, n in hot) < 2 * 30_000 / 16


def test_rows_without_page_or_time_are_kept(spark, scratch):
    df = numbered(spark, 3000, "CASE WHEN id % 2 = 0 THEN NULL ELSE id % 50 END").withColumn(
        "timestamp", F.when(F.col("id") % 5 == 0, F.lit("not a time")).otherwise(F.col("timestamp"))
    )
    ordered = order_by_page(df, 8, "row", scratch, slice_bytes=0)
    assert ordered.exceptAll(df).isEmpty()
    assert ordered.count() == 3000
    assert ordered.where("page_id IS NULL").select(F.spark_partition_id()).distinct().count() > 1


def test_cuts_are_bounded(spark, scratch):
    """Ten pages share everything; with four files none is hot, with forty each gets cut in four."""
    df = numbered(spark, 4000, "id % 10")
    total = 4000 * (100 + 256)
    assert hot_page_cuts(df, total / 4, storage.Scratch(spark)) is None
    cuts = {r["hot_page"]: r["cuts"] for r in hot_page_cuts(df, total / 40, scratch).collect()}
    assert len(cuts) == 10
    assert sum(map(len, cuts.values())) < 2 * 40


@pytest.mark.parametrize("slice_bytes", [0, 1 << 26])
def test_ordering_shuffles_rows_once(spark, tmp_path, scratch, slice_bytes):
    numbered(spark, 1000, "id % 10").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    physical = plan(order_by_page(rows, 40, "row", scratch, slice_bytes))
    assert physical.count(" Exchange") == 1 and "shufflepartitionidpassthrough" in physical
    assert physical.count("BroadcastExchange") == (1 if slice_bytes == 0 else 0)


def test_metadata_schema_and_order(spark):
    df = project_metadata(revdocs(spark, {}))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in METADATA]
    assert "text" not in METADATA.names and "user_user_text" in METADATA.names


def test_metadata_removes_whole_row_duplicates(spark):
    nulls = {name: None for name in REVDOC.names if name not in ("id", "text")}
    df = revdocs(
        spark,
        {"id": 1},
        {"id": 1},
        {"id": 1, "text": "another text"},
        {"id": 1, "comment": ""},
        {"id": 1, "page_restrictions": None},
        {"id": 2, "page_restrictions": ["edit=sysop"]},
        {"id": 2, "page_restrictions": ["move=sysop"]},
        {"id": 3, **nulls},
        {"id": 3, **nulls},
    )
    once = metadata(df)
    assert sorted(r["id"] for r in once.collect()) == [1, 1, 2, 2, 3]
    assert {tuple(r["page_restrictions"] or ()) for r in once.collect()} == {(), ("edit=sysop",), ("move=sysop",)}
    assert once.distinct().count() == once.count()


def test_metadata_collapses_copies_before_its_only_shuffle(spark, tmp_path):
    revdocs(spark, {}).write.json(str(tmp_path / "rows"))
    physical = plan(metadata(read_revdocs(spark, str(tmp_path / "rows"))))
    assert physical.count("Exchange") == 1
    assert physical.count("HashAggregate") == 2
    assert physical.rindex("HashAggregate") > physical.index("Exchange")
    assert "text:string" not in physical.replace("user_text:string", "")


@pytest.mark.parametrize("compression, suffix", [("SNAPPY", "snappy"), ("gzip", "gz")])
def test_metadata_files_and_compression(spark, tmp_path, json_revdocs, compression, suffix):
    path = str(tmp_path / "meta")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sinks.write_metadata(json_revdocs, path, files=5, compression=compression)
    assert len(glob.glob(f"{path}/part-*.{suffix}.parquet")) == 5
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert read_metadata(spark, path).count() == 2000


def test_metadata_file_count_left_to_spark(spark, tmp_path, json_revdocs):
    path = str(tmp_path / "meta")
    sinks.write_metadata(json_revdocs, path, files=None)
    assert len(glob.glob(f"{path}/part-*")) == 1


def test_metadata_compression_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_metadata(revdocs(spark, {}), str(tmp_path), compression="lzo")


def test_load_metadata_replaces_all(spark, tmp_path):
    json, meta = str(tmp_path / "json"), str(tmp_path / "meta")
    sinks.write_revdocs(revdocs(spark, {"id": 1}, {"id": 1}, {"id": 2}), json, files=2)
    register_fulltext(spark, "t_full", json)
    register_metadata(spark, "t_meta", meta)
    for _ in range(2):
        sinks.load_metadata(spark, "t_full", "t_meta", files=3, compression="gzip")
        assert sorted(r["id"] for r in spark.table("t_meta").collect()) == [1, 2]
    assert {r["user_user_text"] for r in spark.table("t_meta").collect()} == {"user"}
    assert all(".gz." in name for name in glob.glob(f"{meta}/part-*"))
    assert storage.has_marker(spark, meta)


def test_registering_again_keeps_the_files(spark, tmp_path):
    json = str(tmp_path / "json")
    sinks.write_revdocs(revdocs(spark, {"id": 1}), json, files=1)
    register_fulltext(spark, "t_again", json)
    register_fulltext(spark, "t_again", json)
    assert spark.table("t_again").count() == 1
    assert [(f.name, f.dataType) for f in spark.table("t_again").schema] == [(f.name, f.dataType) for f in REVDOC]


def test_revdocs_come_back_as_they_were(spark, tmp_path):
    df = revdocs(
        spark,
        {"id": 1, "text": 'quote " and\nline  é', "page_restrictions": []},
        {"id": 2, "text": "", "page_restrictions": None, "comment": ""},
        {"id": 3, "text": None, "user_id": None, "minor": None},
    )
    path = str(tmp_path / "json")
    sinks.write_revdocs(df, path, files=4)
    back = read_revdocs(spark, path)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert glob.glob(f"{path}/part-*.json.bz2")


def test_written_files_hold_sorted_pages(spark, tmp_path):
    path = str(tmp_path / "json")
    sinks.write_revdocs(numbered(spark, 3000, "id % 100", "3000 - id").drop("row"), path, files=4)
    assert len(glob.glob(f"{path}/part-*.bz2")) == 4
    rows = read_revdocs(spark, path).select("page_id", "timestamp", F.col("_metadata.file_name").alias("f")).collect()
    files = {}
    for r in rows:
        files.setdefault(r["f"], []).append((r["page_id"], r["timestamp"]))
    assert all(keys == sorted(keys) for keys in files.values())
    pages = [page for keys in files.values() for page in {k[0] for k in keys}]
    assert len(pages) == len(set(pages)) == 100


def guarded(spark, df, path, **options):
    return sinks.write_guarded(spark, lambda: sinks.write_revdocs(df, path, files=1), path, **options)


def test_guarded_write(spark, tmp_path):
    path = str(tmp_path / "out")
    first, second = revdocs(spark, {"id": 1}), revdocs(spark, {"id": 2})

    def ids():
        return [r["id"] for r in read_revdocs(spark, path).collect()]

    assert guarded(spark, first, path) == sinks.WRITTEN and ids() == [1]
    assert guarded(spark, second, path) == sinks.SKIPPED and ids() == [1]
    assert guarded(spark, second, path, force=True) == sinks.WRITTEN and ids() == [2]
    (tmp_path / "out" / "_SUCCESS").unlink()
    assert guarded(spark, first, path) == sinks.WRITTEN and ids() == [1]


def test_guarded_write_needs_marked_input(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no _SUCCESS in input"):
        guarded(spark, revdocs(spark, {}), str(tmp_path / "out"), input=str(tmp_path))
    storage.touch(spark, f"{tmp_path}/_SUCCESS")
    assert guarded(spark, revdocs(spark, {}), str(tmp_path / "out"), input=str(tmp_path)) == sinks.WRITTEN


def test_guarded_write_with_another_marker(spark, tmp_path):
    path = str(tmp_path / "out")
    assert guarded(spark, revdocs(spark, {}), path, marker="_DONE") == sinks.WRITTEN
    assert guarded(spark, revdocs(spark, {}), path, marker="_DONE") == sinks.SKIPPED


def test_write_without_marker_fails(spark, tmp_path):
    with pytest.raises(RuntimeError, match="after writing"):
        sinks.write_guarded(spark, lambda: None, str(tmp_path / "out"))


def test_scratch_is_removed_and_shared_folder_is_used(spark):
    with storage.Scratch(spark) as scratch:
        kept = scratch.keep(spark.range(10).toDF("id"), "ten")
        assert kept.count() == 10
        assert scratch.root.startswith(spark.conf.get("spark.checkpoint.dir"))
        assert storage.exists(spark, scratch.root)
    assert not storage.exists(spark, scratch.root)

"""Whole runs over small staged dumps."""

import bz2
import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_xml import HEAD, page, revision

from palimpsest import storage
from palimpsest.naming import Dump
from palimpsest.operators import sinks
from palimpsest.plans import ingest
from palimpsest.plans import Options, check_staged_files, convert, run
from palimpsest.schemas import METADATA
from palimpsest.sources import read_revdocs

SMALL = Options(revdoc_files=2, metadata_files=2)
SMALL_CURRENT = Options(revdoc_files=2, metadata_files=2, kind="current")


def time(minute):
    return f"<timestamp>2015-09-23T00:{minute:02d}:00Z</timestamp>"


FILES = {
    "1": HEAD + page(1, "One", revision(12, time(2)), revision(11, time(1))) + "</export>\n",
    "2": HEAD + page(2, "Two", revision(21, time(1)), revision(22, time(5)), revision(23, time(3))) + "</export>\n",
}


@pytest.fixture
def dump(tmp_path):
    return stage(Dump("enwiki", "20150923", str(tmp_path)))


def stage(dump, family="pages-meta-history", files=FILES):
    """Compressed XML files, their manifest and a status document."""
    folder = Path(dump.xml_path)
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{'0' * 32}  enwiki-20150901-{family}1.xml.bz2"]
    for number, text in files.items():
        content = bz2.compress(text.encode())
        name = f"enwiki-20150923-{family}{number}.xml-p{number}.bz2"
        (folder / name).write_bytes(content)
        lines.append(f"{hashlib.md5(content).hexdigest()}  {name}")
    Path(dump.path, "enwiki-20150923-md5sums.txt").write_text("\n".join(lines) + "\n")
    Path(dump.path, "status.html").write_text("<p>Dump complete</p>")
    return dump


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def marker(dump):
    return Path(dump.xml_path, "_SUCCESS")


@pytest.mark.parametrize("family, options", [("pages-meta-history", SMALL), ("pages-articles", SMALL_CURRENT)])
def test_all_stages(spark, tmp_path, family, options):
    dump = stage(Dump("enwiki", "20150923", str(tmp_path)), family)
    assert run(spark, dump, options) == {
        "check_files": "checked",
        "unexpected_files": "0",
        "convert_xml": "written",
        "fulltext_table": "registered",
        "metadata_table": "registered",
        "metadata_load": "loaded",
    }
    assert ids(spark.table("enwiki_20150923")) == ids(spark.table("enwiki_20150923_fulltext")) == [11, 12, 21, 22, 23]
    order = {}
    for r in spark.table("enwiki_20150923_fulltext").collect():
        order.setdefault(r["page_id"], []).append(r["id"])
    assert order == {1: [11, 12], 2: [21, 23, 22]}
    assert run(spark, dump, options)["convert_xml"] == "skipped"


def test_metadata_is_the_same_from_columns_and_from_json(spark, dump, monkeypatch):
    """The first run takes it from the parsed columns, the second, with nothing to convert, from the JSON table."""
    load, loads = sinks.load_metadata, []
    monkeypatch.setattr(sinks, "load_metadata", lambda *args: (loads.append(args), load(*args)))
    run(spark, dump, SMALL)
    assert not loads
    early = spark.createDataFrame(spark.table("enwiki_20150923").collect(), METADATA)
    run(spark, dump, SMALL)
    assert len(loads) == 1
    late = spark.table("enwiki_20150923")
    assert late.count() == early.count() == 5
    assert late.exceptAll(early).isEmpty()


def test_each_stage_can_be_left_out(spark, dump):
    nothing = {"check_files", "convert_xml", "fulltext_table", "metadata_table", "metadata_load"}
    for stage_name in ("check_files", "convert_xml", "fulltext_table", "metadata_table", "metadata_load"):
        switches = {name: name == stage_name for name in nothing}
        outcome = set(run(spark, dump, Options(revdoc_files=2, metadata_files=2, **switches)))
        assert outcome - {"unexpected_files"} == {stage_name}
    assert ids(spark.table("enwiki_20150923")) == [11, 12, 21, 22, 23]


def test_tables_in_a_database(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS dumps")
    dump = stage(Dump("enwiki", "20150923", str(tmp_path), database="dumps"))
    run(spark, dump, SMALL)
    assert ids(spark.table("dumps.enwiki_20150923")) == [11, 12, 21, 22, 23]


def test_check_counts_and_marks(spark, dump):
    Path(dump.xml_path, "stray.txt").write_text("x")
    assert check_staged_files(spark, dump) == {"present": 2, "unexpected": 1}
    assert marker(dump).exists() and Path(dump.xml_path, "stray.txt").exists()
    check_staged_files(spark, dump, delete_unexpected=True)
    assert not Path(dump.xml_path, "stray.txt").exists()
    assert sorted(p.name for p in Path(dump.xml_path).glob("*.bz2")) == sorted(
        f"enwiki-20150923-pages-meta-history{n}.xml-p{n}.bz2" for n in FILES
    )


def spoil(dump, how):
    name = Path(dump.xml_path, "enwiki-20150923-pages-meta-history1.xml-p1.bz2")
    if how == "missing":
        name.unlink()
    elif how == "corrupt":
        name.write_bytes(b"x")
    elif how == "empty":
        name.write_bytes(b"")
    return name


@pytest.mark.parametrize("how", ["missing", "corrupt", "empty"])
def test_bad_files_stop_the_run_and_clear_the_marker(spark, dump, how):
    check_staged_files(spark, dump)
    name = spoil(dump, how)
    with pytest.raises(RuntimeError, match="1 files missing or corrupt, listed in"):
        run(spark, dump, SMALL)
    listed = spark.read.parquet(f"{dump.path}/problems/files_missing_or_corrupt").collect()
    assert [(r["filename"], r["status"]) for r in listed] == [(name.name, "ABSENT" if how == "missing" else "CORRUPT")]
    assert not marker(dump).exists()
    stage(dump)
    assert run(spark, dump, SMALL)["check_files"] == "checked"


def test_unreadable_file_stops_the_run(spark, dump, monkeypatch):
    read = ingest.digests
    blind = F.when(F.col("filename").contains("history2"), None).otherwise(F.col("digest"))
    monkeypatch.setattr(ingest, "digests", lambda *args, **more: read(*args, **more).withColumn("digest", blind))
    with pytest.raises(RuntimeError, match="1 files that could not be checked, listed in"):
        check_staged_files(spark, dump)
    assert not marker(dump).exists()


def test_without_check_being_there_is_enough(spark, dump):
    spoil(dump, "corrupt")
    assert check_staged_files(spark, dump, check=None)["present"] == 2
    spoil(dump, "missing")
    with pytest.raises(RuntimeError, match="missing or corrupt"):
        check_staged_files(spark, dump, check=None)


def test_manifest_without_entries_is_an_error_and_deletes_nothing(spark, dump):
    with pytest.raises(RuntimeError, match="lists no current file"):
        check_staged_files(spark, dump, kind="current", delete_unexpected=True)
    assert len(list(Path(dump.xml_path).glob("*.bz2"))) == 2


def test_unfinished_dump_is_an_error(spark, dump):
    Path(dump.path, "status.html").write_text("in progress")
    with pytest.raises(RuntimeError, match="does not say"):
        check_staged_files(spark, dump)


def test_day_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="is not a day"):
        run(spark, Dump("enwiki", "20151301", str(tmp_path)))


def test_nothing_staged_at_all(spark, dump):
    for name in Path(dump.xml_path).glob("*"):
        name.unlink()
    Path(dump.xml_path).rmdir()
    with pytest.raises(RuntimeError, match="2 files missing or corrupt"):
        check_staged_files(spark, dump)


def test_conversion_needs_marked_input(spark, dump):
    with pytest.raises(RuntimeError, match="no _SUCCESS in input"):
        convert(spark, dump.xml_path, dump.json_path)


@pytest.mark.parametrize("kind", ["history", "current"])
def test_malformed_input_stops_the_conversion_unless_allowed(spark, dump, kind):
    Path(dump.xml_path, "more.xml").write_text(page(3, "Bad", revision("x"), revision(32)))
    storage.touch(spark, f"{dump.xml_path}/_SUCCESS")
    with pytest.raises(RuntimeError, match="1 malformed"):
        convert(spark, dump.xml_path, dump.json_path, kind=kind, files=2)
    assert not Path(dump.json_path).exists()
    convert(spark, dump.xml_path, dump.json_path, kind=kind, files=2, allow_malformed=True)
    assert sorted(str(r["id"]) for r in read_revdocs(spark, dump.json_path).collect()) == sorted(
        ["11", "12", "21", "22", "23", "32", "None"]
    )


def test_converter_and_force(spark, dump):
    storage.touch(spark, f"{dump.xml_path}/_SUCCESS")
    convert(spark, dump.xml_path, dump.json_path, files=2)
    odd = {"converter": lambda df: df.where("id % 2 = 1"), "files": 2}
    assert convert(spark, dump.xml_path, dump.json_path, **odd) == "skipped"
    assert convert(spark, dump.xml_path, dump.json_path, force=True, **odd) == "written"
    assert ids(read_revdocs(spark, dump.json_path)) == [11, 21, 23]


def test_own_marker_is_written_and_looked_for(spark, dump):
    run(spark, dump, Options(marker="_DONE", revdoc_files=2, metadata_files=2))
    assert Path(dump.xml_path, "_DONE").exists() and Path(dump.json_path, "_DONE").exists()
    assert not marker(dump).exists()


def test_options_are_checked_before_anything_runs(spark, dump):
    with pytest.raises(ValueError, match="unknown dump type"):
        Options(kind="all")
    with pytest.raises(ValueError, match="unknown compression"):
        Options(metadata_compression="lzo")
    with pytest.raises(ValueError, match="unknown dump type"):
        convert(spark, dump.xml_path, dump.json_path, kind="all")


def test_scratch_tables_are_gone_after_a_run(spark, dump):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    run(spark, dump, SMALL)
    assert set(shared.iterdir()) == before


def test_stray_files_are_counted_but_not_converted(spark, dump):
    stray = HEAD + page(9, "Nine", revision(991, time(1))) + "</export>\n"
    Path(dump.xml_path, "enwiki-20150923-pages-articles9.xml-p9.bz2").write_bytes(bz2.compress(stray.encode()))
    Path(dump.xml_path, "stray.xml").write_text(stray)
    Path(dump.xml_path, "notes.txt").write_text(stray)
    assert run(spark, dump, SMALL)["unexpected_files"] == "3"
    assert ids(spark.table("enwiki_20150923")) == ids(spark.table("enwiki_20150923_fulltext")) == [11, 12, 21, 22, 23]


def test_stray_files_are_not_converted_by_a_later_run(spark, dump):
    stray = HEAD + page(9, "Nine", revision(991, time(1))) + "</export>\n"
    Path(dump.xml_path, "stray.xml").write_text(stray)
    only_check = Options(convert_xml=False, fulltext_table=False, metadata_table=False, metadata_load=False)
    assert run(spark, dump, only_check)["unexpected_files"] == "1"
    run(spark, dump, Options(check_files=False, revdoc_files=2, metadata_files=2))
    assert ids(spark.table("enwiki_20150923")) == ids(spark.table("enwiki_20150923_fulltext")) == [11, 12, 21, 22, 23]


@pytest.mark.parametrize("check", ["sha1", "size"])
def test_other_checks(spark, dump, check):
    lines = []
    for path in sorted(Path(dump.xml_path).glob("*.bz2")):
        content = path.read_bytes()
        lines.append(f"{hashlib.sha1(content).hexdigest() if check == 'sha1' else len(content)}  {path.name}")
    Path(dump.path, "other.txt").write_text("\n".join(lines))
    listed = {"manifest_path": f"{dump.path}/other.txt", "check": check}
    assert check_staged_files(spark, dump, **listed) == {"present": 2, "unexpected": 0}
    name = spoil(dump, "corrupt")
    with pytest.raises(RuntimeError, match="missing or corrupt"):
        check_staged_files(spark, dump, delete_corrupt=True, **listed)
    assert not name.exists()


def test_status_must_be_of_this_dump(spark, dump, tmp_path):
    other = tmp_path / "dewiki-20150923"
    other.mkdir()
    (other / "status.html").write_text("Dump complete")
    with pytest.raises(RuntimeError, match="does not say"):
        check_staged_files(spark, dump, status_path=str(other / "status.html"))
    Path(dump.path, "status.html").write_text("in progress")
    with pytest.raises(RuntimeError, match="does not say"):
        check_staged_files(spark, dump, status_path=f"{tmp_path}/*/status.html")


def test_refused_input_leaves_an_earlier_output_alone(spark, dump):
    storage.touch(spark, f"{dump.xml_path}/_SUCCESS")
    convert(spark, dump.xml_path, dump.json_path, files=2)
    Path(dump.xml_path, "more.xml").write_text(page(3, "Bad", revision("x")))
    with pytest.raises(RuntimeError, match="1 malformed revisions"):
        convert(spark, dump.xml_path, dump.json_path, files=2, force=True)
    assert ids(read_revdocs(spark, dump.json_path)) == [11, 12, 21, 22, 23]
    assert spark.read.parquet(f"{dump.json_path}_malformed").count() == 1


def test_settings_stay_as_they_are(spark, dump):
    seen = []

    def converter(df):
        seen.append(spark.conf.get("spark.sql.shuffle.partitions"))
        return df

    before = dict(spark.conf.getAll)
    run(spark, dump, Options(revdoc_files=2, metadata_files=1, converter=converter, metadata_compression="gzip"))
    assert dict(spark.conf.getAll) == before and seen == ["8"]
    assert len(list(Path(dump.metadata_path).glob("*.gz.parquet"))) == 1


def add_current(dump):
    """Files of the other dump type in the same folder and manifest."""
    manifest = Path(dump.path, "enwiki-20150923-md5sums.txt")
    before = manifest.read_text()
    files = {"1": HEAD + page(9, "Nine", revision(91, time(1))) + "</export>\n"}
    stage(dump, "pages-articles", files)
    manifest.write_text(before + manifest.read_text())


def test_verified_lists_are_kept_by_dump_type(spark, dump):
    add_current(dump)
    check_staged_files(spark, dump)
    later = Options(check_files=False, kind="current", revdoc_files=2, metadata_files=2)
    with pytest.raises(RuntimeError, match="checked for history files"):
        run(spark, dump, later)
    check_staged_files(spark, dump, kind="current")
    run(spark, dump, later)
    assert ids(spark.table("enwiki_20150923")) == ids(spark.table("enwiki_20150923_fulltext")) == [91]


def test_output_of_another_dump_type_is_not_skipped(spark, dump):
    add_current(dump)
    run(spark, dump, SMALL)
    with pytest.raises(RuntimeError, match="another dump type"):
        run(spark, dump, SMALL_CURRENT)
    assert ids(read_revdocs(spark, dump.json_path)) == [11, 12, 21, 22, 23]
    run(spark, dump, Options(revdoc_files=2, metadata_files=2, kind="current", force=True))
    assert ids(spark.table("enwiki_20150923")) == [91]


def test_files_changed_after_the_check_are_refused(spark, dump):
    check_staged_files(spark, dump)
    first = sorted(Path(dump.xml_path).glob("*.bz2"))[0]
    content = first.read_bytes()
    first.write_bytes(content[:-1] + b"x")  # The same name and length.
    os.utime(first, (1, 1))
    with pytest.raises(RuntimeError, match="changed since they were checked"):
        run(spark, dump, Options(check_files=False, revdoc_files=2, metadata_files=2))
    first.unlink()
    with pytest.raises(RuntimeError, match="changed since they were checked"):
        run(spark, dump, Options(check_files=False, revdoc_files=2, metadata_files=2))
    first.write_bytes(content)
    assert run(spark, dump, SMALL)["convert_xml"] == "written"


def test_skip_knows_its_input(spark, dump):
    """Files staged again with the same content are the same input; other content is not."""
    run(spark, dump, SMALL)
    record = {r["filename"]: r["digest"] for r in spark.read.parquet(f"{dump.json_path}_input").collect()}
    assert record == {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in Path(dump.xml_path).glob("*.bz2")}
    for path in Path(dump.xml_path).glob("*.bz2"):
        os.utime(path, (5, 5))
    assert run(spark, dump, SMALL)["convert_xml"] == "skipped"
    stage(dump, files={**FILES, "3": HEAD + page(3, "Three", revision(31, time(1))) + "</export>\n"})
    with pytest.raises(RuntimeError, match="made from other files"):
        run(spark, dump, SMALL)
    assert run(spark, dump, Options(revdoc_files=2, metadata_files=2, force=True))["convert_xml"] == "written"
    assert ids(spark.table("enwiki_20150923")) == [11, 12, 21, 22, 23, 31]


def test_without_any_check_names_tell_the_dump_type(spark, dump):
    add_current(dump)
    storage.touch(spark, f"{dump.xml_path}/_SUCCESS")
    options = Options(check_files=False, kind="current", revdoc_files=2, metadata_files=2)
    run(spark, dump, options)
    assert ids(spark.table("enwiki_20150923")) == [91]

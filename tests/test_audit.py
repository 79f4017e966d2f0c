import pytest

from palimpsest.operators import audit

MANIFEST = [("ok", "1"), ("absent", "2"), ("corrupt", "3"), ("unreadable", "4"), ("no_md5", None)]
FILES = [("ok", "1", 10), ("corrupt", "9", 10), ("unreadable", None, 10), ("no_md5", "5", 10), ("extra", "6", 10)]


@pytest.fixture
def manifest(spark):
    return spark.createDataFrame(MANIFEST, "filename string, md5 string")


@pytest.fixture
def files(spark):
    return spark.createDataFrame(FILES, "filename string, digest string, length bigint")


def as_dict(df, column):
    return {r["filename"]: r[column] for r in df.collect()}


def test_file_status(manifest, files):
    assert as_dict(audit.file_status(manifest, files), "status") == {
        "ok": audit.PRESENT,
        "absent": audit.ABSENT,
        "corrupt": audit.CORRUPT,
        "unreadable": audit.ERROR,
        "no_md5": audit.ERROR,
    }


def test_file_status_without_check_needs_no_digest(manifest, files):
    statuses = as_dict(audit.file_status(manifest, files.select("filename"), check=False), "status")
    assert statuses == {name: audit.ABSENT if name == "absent" else audit.PRESENT for name, _ in MANIFEST}


def test_status_codes(manifest, files):
    statuses = audit.file_status(manifest, files)
    codes = as_dict(statuses.withColumn("code", audit.status_code(statuses["status"])), "code")
    assert codes == {"ok": 0, "absent": 1, "corrupt": 2, "unreadable": 3, "no_md5": 3}


def test_pending_unexpected_unverified(manifest, files):
    statuses = audit.file_status(manifest, files)
    assert set(as_dict(audit.pending_files(statuses), "md5")) == {"absent", "corrupt", "unreadable", "no_md5"}
    assert set(as_dict(audit.unexpected_files(files, manifest), "length")) == {"extra"}
    verified = statuses.where("status = 'PRESENT'")
    missing = as_dict(audit.unverified_files(manifest, verified), "md5")
    assert set(missing) == {"absent", "corrupt", "unreadable", "no_md5"}


def test_any_error(manifest, files):
    statuses = audit.file_status(manifest, files)
    assert audit.any_error(statuses).first()["any_error"] is True
    assert audit.any_error(statuses.where("status <> 'ERROR'")).first()["any_error"] is False
    assert audit.any_error(statuses.where("false")).first()["any_error"] is False


def test_statuses_are_total_and_inventory_splits_in_two(spark):
    """Every manifest row gets one status; unexpected and matched files make up the inventory."""
    manifest = spark.range(500).selectExpr("concat('f', id * 7 % 1000) AS filename", "md5(string(id)) AS md5")
    files = spark.range(600).selectExpr("concat('f', id * 3 % 1000) AS filename", "md5(string(id % 50)) AS digest")
    statuses = audit.file_status(manifest, files)
    assert statuses.count() == 500
    assert statuses.where("status IS NULL").isEmpty()
    unexpected = audit.unexpected_files(files, manifest)
    matched = files.join(manifest, "filename", "left_semi")
    assert unexpected.unionByName(matched).exceptAll(files).isEmpty()
    assert unexpected.count() + matched.count() == 600


@pytest.mark.parametrize(
    "check, expected, verdicts",
    [
        (None, {"ok": None, "gone": "x"}, {"ok": "OK", "gone": "OK"}),
        ("md5", {"ok": "1", "corrupt": "3", "gone": "1", "no_md5": None}, ["OK", "MISMATCH", "ERROR", "ERROR"]),
        ("sha1", {"ok": "1", "unreadable": "3", "extra": ""}, ["OK", "ERROR", "ERROR"]),
        ("size", {"ok": "10", "corrupt": "11", "gone": "10"}, ["OK", "MISMATCH", "ERROR"]),
    ],
)
def test_verify_files(spark, files, check, expected, verdicts):
    wanted = spark.createDataFrame(list(expected.items()), "filename string, expected string")
    if isinstance(verdicts, list):
        verdicts = dict(zip(expected, verdicts))
    assert as_dict(audit.verify_files(files, wanted, check), "verdict") == verdicts


def test_verify_files_rejects_unknown_check_at_once(files):
    with pytest.raises(ValueError):
        audit.verify_files(files, files, "crc")

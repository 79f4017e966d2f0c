"""All five stages, each of which can be left out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from palimpsest import storage
from palimpsest.naming import Dump
from palimpsest.operators import sinks
from palimpsest.operators.audit import CHECKS, MD5
from palimpsest.operators.ordering import SLICE_BYTES
from palimpsest.plans.convert import Converter, convert
from palimpsest.plans.ingest import check_staged_files, inputs
from palimpsest.sources import register_fulltext, register_metadata
from palimpsest.sources.manifest import require_kind

CHECKED, REGISTERED, LOADED = "checked", "registered", "loaded"


@dataclass(frozen=True)
class Options:
    """What to run and how. Cluster resources are not here: they belong to spark-submit."""

    check_files: bool = True
    convert_xml: bool = True
    fulltext_table: bool = True
    metadata_table: bool = True
    metadata_load: bool = True

    kind: str = "history"
    check: str | None = MD5
    exclude_multistream: bool = False
    delete_unexpected: bool = False
    delete_corrupt: bool = False
    manifest_path: str | None = None
    status_path: str | None = None
    marker: str = storage.SUCCESS_MARKER
    converter: Converter | None = None
    allow_malformed: bool = False
    revdoc_files: int | None = sinks.REVDOC_FILES
    slice_bytes: int = SLICE_BYTES  # Pages of less text are never cut into several files.
    metadata_files: int | None = sinks.METADATA_FILES
    metadata_compression: str = "snappy"
    force: bool = False  # Convert again even if the output is marked; staged files are never touched.

    def __post_init__(self):
        require_kind(self.kind)
        if self.check is not None and self.check not in CHECKS:
            raise ValueError(f"unknown check {self.check!r}, expected one of {CHECKS} or None")
        sinks.require_compression(self.metadata_compression)


def run(spark: SparkSession, dump: Dump, options: Options = Options()) -> dict[str, str]:
    """Take a staged dump to its two tables. Returns what each stage that ran came to.

    Stages hand over through files and markers, so each can be run again on its own. If XML is converted in
    the same run, the metadata is taken from the parsed columns on the way, which spares decompressing and
    parsing all of the full text again; the rows are the same. If files of the dump type were checked, in this run or an
    earlier one, only those listed and right are converted, whatever else lies in the folder, and none that has changed since.
    """
    outcome = {}
    metadata_settings = (options.metadata_files, options.metadata_compression)
    load_early = options.metadata_table and options.metadata_load

    def write_metadata(revdocs: DataFrame) -> None:
        sinks.write_metadata(revdocs, dump.metadata_path, *metadata_settings)

    if options.check_files:
        counts = check_staged_files(
            spark,
            dump,
            manifest_path=options.manifest_path,
            status_path=options.status_path,
            kind=options.kind,
            check=options.check,
            exclude_multistream=options.exclude_multistream,
            delete_unexpected=options.delete_unexpected,
            delete_corrupt=options.delete_corrupt,
            marker=options.marker,
        )
        outcome["check_files"] = CHECKED
        outcome["unexpected_files"] = str(counts["unexpected"])
    if options.convert_xml:
        outcome["convert_xml"] = convert(
            spark,
            dump.xml_path,
            dump.json_path,
            kind=options.kind,
            files=options.revdoc_files,
            converter=options.converter,
            allow_malformed=options.allow_malformed,
            force=options.force,
            marker=options.marker,
            also=write_metadata if load_early else None,
            only=inputs(spark, dump, options.kind) if storage.has_marker(spark, dump.xml_path, options.marker) else None,
            slice_bytes=options.slice_bytes,
        )
    if options.fulltext_table:
        register_fulltext(spark, dump.fulltext_table, dump.json_path)
        outcome["fulltext_table"] = REGISTERED
    if options.metadata_table:
        register_metadata(spark, dump.metadata_table, dump.metadata_path)
        outcome["metadata_table"] = REGISTERED
    if options.metadata_load:
        if not (load_early and outcome.get("convert_xml") == sinks.WRITTEN):
            sinks.load_metadata(spark, dump.fulltext_table, dump.metadata_table, *metadata_settings)
        outcome["metadata_load"] = LOADED
    return outcome

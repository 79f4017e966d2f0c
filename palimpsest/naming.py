"""Where a dump lives: its folders and tables, for one dump or for a column of dumps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder names below a dump's directory, and the suffix of the full-text table.
XML_FOLDER = "xmlbz2"
JSON_FOLDER = "jsonbz2"
METADATA_FOLDER = "meta_parquet"
FULLTEXT_SUFFIX = "_fulltext"


@dataclass(frozen=True)
class Dump:
    """One wiki's dump of one day (`day` as yyyyMMdd) below `base`."""

    wiki: str
    day: str
    base: str
    database: str | None = None

    @property
    def path(self) -> str:
        return f"{self.base.rstrip('/')}/{self.wiki}-{self.day}"

    @property
    def xml_path(self) -> str:
        return f"{self.path}/{XML_FOLDER}"

    @property
    def json_path(self) -> str:
        return f"{self.path}/{JSON_FOLDER}"

    @property
    def metadata_path(self) -> str:
        return f"{self.path}/{METADATA_FOLDER}"

    @property
    def metadata_table(self) -> str:
        name = f"{self.wiki}_{self.day}"
        return f"{self.database}.{name}" if self.database else name

    @property
    def fulltext_table(self) -> str:
        return self.metadata_table + FULLTEXT_SUFFIX


def dump_locations(wiki: Column, day: Column, base: str) -> list[Column]:
    """The same names as columns, one row per dump: path, xml_path, json_path, metadata_path and tables."""
    path = F.format_string(f"{base.rstrip('/')}/%s-%s", wiki, day)
    table = F.format_string("%s_%s", wiki, day)
    return [
        path.alias("path"),
        F.concat_ws("/", path, F.lit(XML_FOLDER)).alias("xml_path"),
        F.concat_ws("/", path, F.lit(JSON_FOLDER)).alias("json_path"),
        F.concat_ws("/", path, F.lit(METADATA_FOLDER)).alias("metadata_path"),
        table.alias("metadata_table"),
        F.concat(table, F.lit(FULLTEXT_SUFFIX)).alias("fulltext_table"),
    ]

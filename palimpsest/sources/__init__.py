"""Readers: manifests, status documents, directory listings, XML dumps and the two tables."""

from palimpsest.sources.inventory import digests, inventory
from palimpsest.sources.manifest import manifest_entries, manifest_pattern, read_manifest
from palimpsest.sources.status import ready_dumps
from palimpsest.sources.tables import read_metadata, read_revdocs, register_fulltext, register_metadata
from palimpsest.sources.xml_dump import read_pages, read_revisions

__all__ = [
    "digests",
    "inventory",
    "manifest_entries",
    "manifest_pattern",
    "read_manifest",
    "read_metadata",
    "read_pages",
    "read_revdocs",
    "read_revisions",
    "ready_dumps",
    "register_fulltext",
    "register_metadata",
]

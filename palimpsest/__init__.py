"""Edit-history dumps as Spark tables: check the files, read the XML, keep the text, derive the metadata."""

from palimpsest.naming import Dump
from palimpsest.schemas import METADATA, REVDOC

__all__ = ["METADATA", "REVDOC", "Dump"]

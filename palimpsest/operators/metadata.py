"""From full text to metadata: everything about a revision but its text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import null_if_empty
from palimpsest.schemas import METADATA_DROPS, METADATA_RENAMES, REVDOC


def project_metadata(revdocs: DataFrame) -> DataFrame:
    """The metadata columns in order; an empty list of restrictions becomes NULL."""
    restrictions = {"page_restrictions": null_if_empty(F.col("page_restrictions"))}
    return revdocs.select(
        *[
            restrictions.get(name, F.col(name)).alias(METADATA_RENAMES.get(name, name))
            for name in REVDOC.names
            if name != METADATA_DROPS
        ]
    )


def metadata(revdocs: DataFrame) -> DataFrame:
    """Metadata with whole-row duplicates removed; NULLs equal each other, and text plays no part.

    Copies collapse before the shuffle, in the task that read them, and rows spread by all their columns, so
    neither a revision copied without bound nor a page with most of the revisions loads one task.
    """
    return project_metadata(revdocs).distinct()

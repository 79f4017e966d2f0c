"""Small revision documents for tests."""

from palimpsest.schemas import REVDOC

DEFAULTS = {
    "id": 1,
    "timestamp": "2015-09-23T00:00:00Z",
    "page_id": 1,
    "page_title": "Title",
    "page_namespace": 0,
    "page_redirect": None,
    "page_restrictions": [],
    "user_id": 7,
    "user_text": "user",
    "minor": False,
    "comment": None,
    "bytes": 4,
    "text": "text",
    "sha1": "abc",
    "parent_id": None,
    "model": "wikitext",
    "format": "text/x-wiki",
}


def revdocs(spark, *rows: dict):
    return spark.createDataFrame([tuple({**DEFAULTS, **row}[name] for name in REVDOC.names) for row in rows], REVDOC)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

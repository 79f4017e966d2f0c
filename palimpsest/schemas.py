"""The two table contracts: full-text revision documents and their metadata."""

from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

# Column names, order and types of the full-text table.
REVDOC = StructType(
    [
        StructField("id", LongType()),
        StructField("timestamp", StringType()),
        StructField("page_id", LongType()),
        StructField("page_title", StringType()),
        StructField("page_namespace", LongType()),
        StructField("page_redirect", StringType()),
        StructField("page_restrictions", ArrayType(StringType())),
        StructField("user_id", LongType()),
        StructField("user_text", StringType()),
        StructField("minor", BooleanType()),
        StructField("comment", StringType()),
        StructField("bytes", LongType()),
        StructField("text", StringType()),
        StructField("sha1", StringType()),
        StructField("parent_id", LongType()),
        StructField("model", StringType()),
        StructField("format", StringType()),
    ]
)

# The metadata table leaves this column out and renames that one.
METADATA_DROPS = "text"
METADATA_RENAMES = {"user_text": "user_user_text"}

METADATA = StructType(
    [
        StructField(METADATA_RENAMES.get(field.name, field.name), field.dataType)
        for field in REVDOC
        if field.name != METADATA_DROPS
    ]
)


def ddl(schema: StructType) -> str:
    """Column list of a CREATE TABLE statement."""
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)

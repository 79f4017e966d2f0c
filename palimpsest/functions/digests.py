from pyspark.sql import Column
from pyspark.sql import functions as F

DIGESTS = {"md5": F.md5, "sha1": F.sha1}


def hex_digest(content: Column, algorithm: str) -> Column:
    """Lower-case hex digest of binary or UTF-8 content."""
    if algorithm not in DIGESTS:
        raise ValueError(f"unknown digest {algorithm!r}, expected one of {sorted(DIGESTS)}")
    return DIGESTS[algorithm](content)

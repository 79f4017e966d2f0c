"""Column expressions. All are Spark built-ins, so they stay inside generated code."""

from palimpsest.functions.arrays import null_if_empty
from palimpsest.functions.days import valid_dump_day
from palimpsest.functions.digests import DIGESTS, hex_digest

__all__ = ["DIGESTS", "hex_digest", "null_if_empty", "valid_dump_day"]

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day pattern (searched for, not anchored) and the last year that is too early.
DAY_PATTERN = r"(\d{4})(\d\d)(\d\d)"
YEAR_BEFORE_FIRST = 2010


def valid_dump_day(day: Column, strict: bool = False) -> Column:
    """Whether a yyyyMMdd text names a day a dump can be of; NULL counts as no.

    The lenient form looks for the digits anywhere in the text and lets 29 February pass in every
    year. `strict` accepts exactly eight digits that form a real date.
    """
    year, month, dom = (F.regexp_extract(day, DAY_PATTERN, g).try_cast("int") for g in (1, 2, 3))
    longest = F.when(month == 2, 29).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (year > YEAR_BEFORE_FIRST) & month.between(1, 12) & dom.between(1, longest)
    if strict:
        valid = valid & day.rlike(r"^\d{8}$") & F.try_to_date(day, "yyyyMMdd").isNotNull()
    return F.coalesce(valid, F.lit(False))

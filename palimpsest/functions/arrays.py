from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_empty(array: Column) -> Column:
    """An empty array becomes NULL; NULL and filled arrays stay as they are."""
    return F.when(F.size(array) == 0, F.lit(None)).otherwise(array)

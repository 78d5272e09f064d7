"""The cluster table as one array that every row can look things up in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CLUSTERS = 10_000  # the clustering's k is a parameter; a table of topics is far smaller


def book(df: DataFrame, order: str, max_rows: int = MAX_CLUSTERS) -> Column:
    """The whole table as one array of structs, sorted by the ``order`` column, as a scalar.

    At most ``max_rows`` + 1 rows are read for it, so a table that was never meant to be an array
    ends with a message before anything is gathered.
    """
    columns = [order, *[c for c in df.columns if c != order]]
    rows = F.sort_array(F.collect_list(F.struct(*columns)))
    too_many = F.raise_error(F.lit(f"more than {max_rows} rows in a table of clusters"))
    checked = F.when(F.count(F.lit(1)) <= max_rows, rows).otherwise(too_many)
    return df.limit(max_rows + 1).agg(checked).scalar()

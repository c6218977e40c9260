"""What query outputs have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six places (no negative zero), floats as doubles."""
    return df.select(*[(F.round(F.col(f"`{c}`").cast("double"), digits) + 0.0).alias(c) if k in ("double", "float") else F.col(f"`{c}`") for c, k in df.dtypes])


class Registry:
    def __init__(self):
        self.queries, self.sql = {}, {}

    def add(self, sql: str | None = None):
        def put(f):
            name = f.__name__
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return put

"""Keep a computed column computed once.

Catalyst pushes a filter below a projection by substituting the expression
into the filter. For a long chain (split, parse, classify) over a message that
is itself an expression, that copies the chain into every use until the
generated method passes the 64 KB limit and the stage drops to interpretation.
A generator row is not substituted: filters on its output stay above it, and
filters on other columns still move below it to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose results later operators can only refer to."""
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [F.col(name) for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.array(row)))

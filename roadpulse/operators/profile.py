"""First look at a table: some rows, and its columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows in a sample.
SAMPLE_ROWS = 5


def sample_head(df: DataFrame, order: str | Sequence[str] | None = None, n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` rows: in the order given, or as stored (reads one split only)."""
    if order is None:
        return df.limit(n)
    return df.orderBy(*([order] if isinstance(order, str) else order)).limit(n)


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: position, name, type and number of non-null values.

    One pass for all columns; the single row of counts is then turned.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).cast("long").alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("non_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(rows))

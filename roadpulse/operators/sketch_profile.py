"""A column profile from sketches that can be kept and merged.

One pass gives, per column, the number of values and sketches of bounded size: of
its different values, of its quantiles if it holds numbers, and of its frequent
values. Sketches of parts (a state, a day's files) merge into that of the whole, so
a table that grows is profiled from what is new and the sketches kept so far.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

#: Logarithm of the registers for different values (error about 1.6 %), size of the quantile
#: sketch (rank error under 1 %), and frequent values that a sketch follows.
REGISTERS_LOG2 = 12
QUANTILE_SIZE = 400
FOLLOWED = 1_000

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
MOST_FREQUENT = 5


def _as_number(column: Column, kind: DataType) -> Column:
    """Numbers as doubles, NaN as none; other kinds have no quantiles."""
    return F.nullif(column.cast("double"), F.lit(float("nan"))) if isinstance(kind, NumericType) else F.lit(None).cast("double")


def column_sketches(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Per group of ``by`` (one for all without) and column: ``non_null`` and the sketches, in one pass.

    Returns (``by``..., ``ordinal``, ``column_name``, ``data_type``, ``non_null``,
    ``different``, ``ordered``, ``frequent``). Values are told apart by their text.
    """
    fields = [f for f in df.schema.fields if (f.name in columns if columns is not None else f.name not in by)]
    sums, rows = [], []
    for i, f in enumerate(fields):
        value, text = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").cast("string")
        sums += [
            F.count(value).alias(f"n{i}"),
            F.hll_sketch_agg(text, REGISTERS_LOG2).alias(f"d{i}"),
            F.call_function("kll_sketch_agg_double", _as_number(value, f.dataType), F.lit(QUANTILE_SIZE)).alias(f"q{i}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(FOLLOWED)).alias(f"t{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(i).cast("long").alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("non_null"),
                F.col(f"d{i}").alias("different"),
                F.col(f"q{i}").alias("ordered"),
                F.col(f"t{i}").alias("frequent"),
            )
        )
    grouped = df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(*sums)
    return grouped.select(*[F.col(f"`{b}`") for b in by], F.inline(F.array(*rows)))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the same column put together, per group of ``by``."""
    return sketches.groupBy(*by, "ordinal", "column_name", "data_type").agg(
        F.sum("non_null").alias("non_null"),
        F.hll_union_agg("different").alias("different"),
        F.call_function("kll_merge_agg_double", F.col("ordered")).alias("ordered"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(FOLLOWED)).alias("frequent"),
    )


def estimates(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES, most: int = MOST_FREQUENT) -> DataFrame:
    """What sketches say: ``different`` values, ``quantiles`` of numbers (else null), ``frequent`` values with their counts.

    Counts of frequent values are never too low, and exact while a column has
    fewer different values than a sketch follows; a column in which no value
    stands out has none.
    """
    some = F.call_function("kll_sketch_get_n_double", F.col("ordered")) > 0
    at = F.array(*[F.call_function("kll_sketch_get_quantile_double", F.col("ordered"), F.lit(float(q))) for q in quantiles])
    kept = [c for c in sketches.columns if c not in ("different", "ordered", "frequent")]
    return sketches.select(
        *kept,
        F.hll_sketch_estimate("different").alias("different"),
        F.when(some, at).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(most)).alias("frequent"),
    )


def against_exact(df: DataFrame, found: DataFrame, quantiles: Sequence[float] = QUANTILES, different: float = 0.05, rank: float = 0.02) -> DataFrame:
    """Per column of the ``estimates``, whether they hold within these bounds (an action, then a pass over ``df`` and one over each column).

    ``different_holds``: values counted to ``different`` of their number;
    ``quantiles_hold``: the rank of each quantile is within ``rank`` of the one asked
    for; ``frequent_holds``: every frequent value occurs no more often than said,
    and as often to within a thousandth of the rows. The driver holds a row per column.
    Different values are counted column by column, so that a task holds those of
    one column of its rows and not of all columns.
    """
    rows = found.orderBy("ordinal").collect()
    sums = []
    for i, r in enumerate(rows):
        value, text = F.col(f"`{r['column_name']}`"), F.col(f"`{r['column_name']}`").cast("string")
        number = _as_number(value, df.schema[r["column_name"]].dataType)
        sums.append(F.count(number).alias(f"m{i}"))
        sums += [F.count_if(number < q).alias(f"below{i}_{k}") for k, q in enumerate(r["quantiles"] or [])]
        sums += [F.count_if(number <= q).alias(f"upto{i}_{k}") for k, q in enumerate(r["quantiles"] or [])]
        sums += [F.count_if(text.eqNullSafe(F.lit(v["item"]))).alias(f"t{i}_{k}") for k, v in enumerate(r["frequent"])]
    # Two rows with columns of their own, put into one.
    parts = {"sums": df.agg(*sums), "different": _different(df, [r["column_name"] for r in rows])}
    both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.select(F.struct("*").alias(n)) for n, p in parts.items()])
    exact = both.agg(*[F.first(n, ignorenulls=True).alias(n) for n in parts]).select(*[f"{n}.*" for n in parts])
    out = []
    for i, r in enumerate(rows):
        ranks = [
            (F.col(f"below{i}_{k}") <= (q + rank) * F.col(f"m{i}")) & (F.col(f"upto{i}_{k}") >= (q - rank) * F.col(f"m{i}"))
            for k, q in enumerate(quantiles)
            if r["quantiles"]
        ]
        counts = [F.col(f"t{i}_{k}").between(v["count"] - r["non_null"] // 1000 - 1, v["count"]) for k, v in enumerate(r["frequent"])]
        out.append(
            F.struct(
                F.lit(r["ordinal"]).alias("ordinal"),
                F.lit(r["column_name"]).alias("column_name"),
                F.lit(r["non_null"]).alias("non_null"),
                (F.abs(F.col(f"d{i}") - r["different"]) <= different * F.col(f"d{i}") + 1).alias("different_holds"),
                _all(ranks).alias("quantiles_hold"),
                (_all(counts) if counts else F.lit(True)).alias("frequent_holds"),
            )
        )
    return exact.select(F.inline(F.array(*out)))


def _different(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of different texts of each column, ``d0``, ``d1``, ..."""
    texts = [df.select(F.lit(i).alias("_column"), F.col(f"`{c}`").cast("string").alias("_text")) for i, c in enumerate(columns)]
    every = functools.reduce(DataFrame.unionAll, [t.filter("_text IS NOT NULL").distinct() for t in texts])
    counts = every.groupBy("_column").agg(F.count("*").alias("_n"))
    return counts.agg(*[F.coalesce(F.max(F.when(F.col("_column") == i, F.col("_n"))), F.lit(0)).alias(f"d{i}") for i in range(len(columns))])


def _all(tests: list[Column]) -> Column:
    """Null where there is nothing to test."""
    return F.forall(F.array(*tests), lambda t: t) if tests else F.lit(None).cast("boolean")

"""Typed CSV ingest that keeps the lines it rejects."""

from __future__ import annotations

import csv
import functools
import operator
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.csv_records import read_records
from roadpulse.sources.layout import CLUSTER_KEYS, ClusteredTable, cluster_parquet
from roadpulse.sources.shared_dir import remove_path, scratch_path, written

# Declared column types. Times stay text, as their formats vary;
# a column that is not named here is text as well, unless types are inferred.
DECLARED_TYPES = {
    "Start_Lat": "double",
    "Start_Lng": "double",
    "End_Lat": "double",
    "End_Lng": "double",
    "Severity": "bigint",
    "Number": "double",
    "Wind_Speed(mph)": "double",
    "Precipitation(in)": "double",
    "Visibility(mi)": "double",
    "Temperature(F)": "double",
    "Humidity(%)": "double",
    "Pressure(in)": "double",
    "Start_Time": "string",
    "End_Time": "string",
    "Weather_Timestamp": "string",
}

# Spellings read as null, in every column.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Types tried on undeclared columns, the narrowest first.
INFERRED_TYPES = ("bigint", "double", "boolean", "date", "timestamp_ntz")

INFERRED_AT_ONCE = 12

# What a value has to look like besides passing the cast, which alone would take
# "y" for true and the first part of a longer text.
_SHAPES = {
    "boolean": r"^(?i:true|false)$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp_ntz": r"^\d{4}-\d{2}-\d{2}[ T]",
}

_BOM = "\ufeff"

# Helper columns, named apart from any column of a file.
_CORRUPT, _LINE, _REASON = "_corrupt", "_line", "_reject_reason"


class Ingested(NamedTuple):
    clean: DataFrame
    rejects: DataFrame


class NoHeader(ValueError):
    """There is no line at all in the files."""


class Converted(NamedTuple):
    table: ClusteredTable
    rejects: DataFrame
    staged: str


def snake_case(name: str) -> str:
    """``Precipitation(in)`` to ``precipitation_in``, ``Humidity(%)`` to ``humidity_pct``."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower().replace("%", "pct")).strip("_")


def split_lines(lines: DataFrame, columns: Sequence[str], line: str = "value") -> DataFrame:
    """CSV text lines to text columns, plus the line and ``_corrupt``.

    The raw line stays at hand for the rejects, and ``_corrupt`` is set where
    the number of fields is wrong, whichever columns a later step reads.
    """
    slots = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{s} STRING" for s in [*slots, _CORRUPT])
    parsed = F.from_csv(
        line,
        schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": '"'},
    )
    fields = lines.select(F.col(line).alias(_LINE), parsed.alias("p"))
    return _evaluated(
        fields,
        F.col(_LINE),
        F.col(f"p.{_CORRUPT}").alias(_CORRUPT),
        *[_null_if_token(F.col(f"p.{s}")).alias(name) for s, name in zip(slots, columns)],
    )


def _evaluated(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns, worked out here once, however often later steps mention them.

    They are inlined and not merely selected: the optimizer puts the expression of
    a selected column in place of every mention, and pushes filters below it,
    but moves nothing past a generator. So each step's code grows with the number
    of columns and not with that of mentions.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def _null_if_token(value: Column) -> Column:
    return F.when(~value.isin(*NULL_TOKENS), value)


def _java_number(value: Column) -> Column:
    """Spellings that Java parses and no CSV writer means: 1.5d, 2f, 0x1p3."""
    text = F.lower(F.rtrim(value))
    return text.endswith("d") | (text.endswith("f") & ~text.endswith("inf")) | text.contains("x")


def _cast(name: str, type_: str) -> Column:
    value = F.col(f"`{name}`")
    if type_ == "string":
        return value
    cast = value.try_cast(type_)
    if type_ in ("double", "float"):
        return F.when(~_java_number(value), cast)
    return F.when(value.rlike(_SHAPES[type_]), cast) if type_ in _SHAPES else cast


def infer_types(split: DataFrame, declared: Mapping[str, str] = DECLARED_TYPES) -> dict[str, str]:
    """Types for undeclared columns: the first that fits *all* their values.

    Aggregations over the whole input (an action for every ``INFERRED_AT_ONCE``
    columns), so no late value can contradict the result. With more columns to
    an aggregation its code outgrows what the JVM compiles; ``split`` should be
    written down, so that each reads its own columns and none parses text.
    """
    names = [c for c in split.columns if c not in (_LINE, _CORRUPT) and c not in declared]
    found = {}
    for at in range(0, len(names), INFERRED_AT_ONCE):
        found |= _fitting_types(split, names[at : at + INFERRED_AT_ONCE])
    return found


def _fitting_types(split: DataFrame, names: Sequence[str]) -> dict[str, str]:
    tests = []
    for i, name in enumerate(names):
        tests.append(F.count(F.col(f"`{name}`")).alias(f"n{i}"))
        tests += [F.count(_cast(name, t)).alias(f"n{i}_{t}") for t in INFERRED_TYPES]
    counts = split.filter(F.col(_CORRUPT).isNull()).agg(*tests).first()
    found = {}
    for i, name in enumerate(names):
        present = counts[f"n{i}"]
        fits = [t for t in INFERRED_TYPES if present and counts[f"n{i}_{t}"] == present]
        found[name] = fits[0] if fits else "string"
    return found


def apply_types(split: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed columns, and the raw line with a reason on rows to reject."""
    names = [c for c in split.columns if c not in (_LINE, _CORRUPT)]
    slots = {c: f"_t{i}" for i, c in enumerate(names)}
    misfits = {
        c: F.col(f"`{c}`").isNotNull() & F.col(slots[c]).isNull()
        for c in names
        if types.get(c, "string") != "string"
    }
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("field_count"))
    if misfits:
        columns = F.concat_ws(",", *[F.when(misfit, F.lit(c)) for c, misfit in misfits.items()])
        any_misfit = functools.reduce(operator.or_, misfits.values())
        reason = reason.when(any_misfit, F.concat(F.lit("bad_value:"), columns))
    typed = split.select("*", *[_cast(c, types.get(c, "string")).alias(slots[c]) for c in names])
    judged = typed.withColumn(_REASON, reason)
    # The final names are given in the struct. As aliases in one more projection
    # they would double, one by one, what the optimizer derives from the casts.
    rejected_line = F.when(F.col(_REASON).isNotNull(), F.col(_LINE)).alias(_LINE)
    return _evaluated(judged, rejected_line, F.col(_REASON), *[F.col(t).alias(c) for c, t in slots.items()])


def split_clean_and_rejects(typed: DataFrame) -> Ingested:
    clean = typed.filter(F.col(_REASON).isNull()).drop(_LINE, _REASON)
    rejects = typed.filter(F.col(_REASON).isNotNull()).select(
        F.col(_LINE).alias("line"), F.col(_REASON).alias("reject_reason")
    )
    return Ingested(clean, rejects)


def ingest_lines(
    lines: DataFrame,
    columns: Sequence[str],
    types: Mapping[str, str] = DECLARED_TYPES,
    line: str = "value",
) -> Ingested:
    """Typed rows and rejected lines out of a text column. Lazy.

    Empty lines are skipped. A line goes to the rejects with a reason if its
    number of fields is wrong or a value does not fit its declared type.
    """
    return split_clean_and_rejects(
        apply_types(split_lines(lines.filter(F.col(line) != ""), columns, line), types)
    )


def _lines_by_header(spark: SparkSession, path: str, copy: str) -> list[tuple[list[str], DataFrame]]:
    """Header and data lines, once for every different header among the files.

    A header is the first line of a file that is not empty; an equal line further
    down is data. With one file it costs a look at its beginning. The text of
    several is written to ``copy`` with the place of each line, as a line's id is
    another one when files are dealt to tasks anew; headers are found there and
    data is read from there. The driver holds one line per file, as it holds the
    list of files.
    """
    value = F.col("value")
    text = spark.read.text(path).select(
        F.when(value.startswith(_BOM), F.substr(value, F.lit(2))).otherwise(value).alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_at"),
        F.input_file_block_start().alias("_block"),
    )
    lines = text.filter(value != "")
    if len(spark.read.text(path).inputFiles()) == 1:
        first = lines.select("value", "_at", "_file").first()
        heads = [first] if first else []
    else:
        lines.write.option("compression", "zstd").parquet(copy)
        lines = spark.read.schema(lines.schema).parquet(copy)
        in_file = F.struct("_block", "_at", "value")
        heads = lines.groupBy("_file").agg(F.min(in_file).alias("first")).select("_file", "first.value", "first._at").collect()
    if not heads:
        raise NoHeader(f"no header line in {path}")
    data = lines.join(F.broadcast(spark.createDataFrame([(h["_file"], h["_at"]) for h in heads], "_file string, _head long")), "_file")
    data = data.filter(F.col("_at") != F.col("_head"))
    by_header: dict[str, list[str]] = {}
    for h in sorted(heads, key=lambda h: h["_file"]):
        by_header.setdefault(h["value"], []).append(h["_file"])
    if len(by_header) == 1:
        return [(next(csv.reader([header])), data.select("value")) for header in by_header]
    return [
        (next(csv.reader([header])), data.filter(F.col("_file").isin(files)).select("value")) for header, files in by_header.items()
    ]


def _records_by_header(spark: SparkSession, path: str) -> list[tuple[list[str], DataFrame]]:
    """Header and data records, which may run over several lines, once for every different header."""
    rows, heads = read_records(spark, path)
    if not heads:
        raise NoHeader(f"no header line in {path}")
    by_header: dict[str, list[str]] = {}
    for file, header in sorted(heads.items()):
        by_header.setdefault(header, []).append(file)
    data = {h: rows if len(by_header) == 1 else rows.filter(F.col("file").isin(files)) for h, files in by_header.items()}
    return [(next(csv.reader([header])), part.select("value")) for header, part in data.items()]


def _split_csv(spark: SparkSession, path: str, copy: str, multiline: bool = False) -> DataFrame:
    """Text columns of all files, matched by name where headers differ in their order.

    Of several files the result reads the lines from ``copy``, which is written here,
    unless records of several lines are looked for.
    """
    parts = _records_by_header(spark, path) if multiline else _lines_by_header(spark, path, copy)
    columns = parts[0][0]
    for other, _ in parts[1:]:
        if sorted(other) != sorted(columns):
            raise ValueError(f"files in {path} differ in their columns: {columns} and {other}")
    names = [_LINE, _CORRUPT, *columns]
    splits = [split_lines(lines, header).select(*[F.col(f"`{c}`") for c in names]) for header, lines in parts]
    return functools.reduce(DataFrame.unionAll, splits)


def _typed(split: DataFrame, types: Mapping[str, str], infer: bool, rename: bool) -> DataFrame:
    if infer:
        types = {**infer_types(split, types), **types}
    typed = apply_types(split, types)
    names = [c for c in split.columns if c not in (_LINE, _CORRUPT)]
    return typed.withColumnsRenamed({c: snake_case(c) for c in names}) if rename else typed


def ingest_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] = DECLARED_TYPES,
    infer: bool = False,
    rename: bool = True,
    multiline: bool = False,
) -> Ingested:
    """Typed rows and rejected lines of CSV file(s) with a header.

    ``multiline`` takes line breaks inside quoted fields as part of the value
    (``csv_records``); without it they end the record, which is then rejected.

    Of one file only the header is read at once, the text of several is written to
    the scratch folder and read from there; ``infer=True`` also writes the split
    text there, from which types are found and rows are read. Files split between tasks at line ends. Several files
    have to share their columns, if in different orders; others are refused.
    """
    copy = scratch_path(spark, "csv-lines")
    split = _split_csv(spark, path, copy, multiline)
    if infer:
        split = written(split, "csv-split")
        remove_path(spark, copy)
    return split_clean_and_rejects(_typed(split, types, infer, rename))


def stage_csv(
    spark: SparkSession, path: str | Sequence[str], out: str, types: Mapping[str, str] = DECLARED_TYPES, multiline: bool = False
) -> list[str]:
    """Rows and rejects of CSV file(s) into one Parquet folder, in place of what is there; returns the columns (an action).

    The text is parsed once; ``read_staged`` tells rows and rejects apart. A folder
    that a failed try left half written is replaced by the next.
    """
    copy = scratch_path(spark, "csv-lines")
    try:
        staged = _typed(_split_csv(spark, path, copy, multiline), types, infer=False, rename=True)
        staged.write.mode("overwrite").option("compression", "zstd").parquet(out)
    finally:
        remove_path(spark, copy)
    return [c for c in staged.columns if c not in (_LINE, _REASON)]


def read_staged(staged: DataFrame) -> Ingested:
    """Rows and rejects out of what ``stage_csv`` wrote."""
    return split_clean_and_rejects(staged)


def convert_csv(
    spark: SparkSession,
    path: str,
    out: str,
    keys: Sequence[str] = CLUSTER_KEYS,
    types: Mapping[str, str] = DECLARED_TYPES,
    infer: bool = False,
    multiline: bool = False,
    **layout,
) -> Converted:
    """CSV to a clustered Parquet table at ``out``; returns it with the rejects.

    The text is parsed once, into Parquet text columns in the shared scratch
    folder, also with ``infer``: typing, the sampling and the sort of the
    clustering read that copy, and the rejects are a filter on it. The folder is
    ``staged``; ``shared_dir.remove_path`` deletes it once the rejects are read.
    A table with none of the ``keys`` is written as it comes.
    """
    copy, split_path, staged = (scratch_path(spark, f"csv-{label}") for label in ("lines", "split", "staged"))
    split = _split_csv(spark, path, copy, multiline)
    if infer:
        # Read by inference and again by typing.
        split.write.option("compression", "zstd").parquet(split_path)
        split = spark.read.schema(split.schema).parquet(split_path)
    _typed(split, types, infer, rename=True).write.option("compression", "zstd").parquet(staged)
    remove_path(spark, copy)
    if infer:
        remove_path(spark, split_path)
    stage = spark.read.parquet(staged)
    keys = [k for k in keys if k in stage.columns]
    table = cluster_parquet(
        spark, staged, out, keys, where=F.col(_REASON).isNull(), drop=(_LINE, _REASON), **layout
    )
    return Converted(table, split_clean_and_rejects(stage).rejects, staged)

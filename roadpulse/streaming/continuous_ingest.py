"""CSV files taken in as they arrive, each of them once.

A Structured Streaming query follows the folder. It streams names and not lines,
as a header is known only by its place in its file: every micro-batch hands the
files it is made of to the batch ingest. The checkpoint fixes which files belong to
which micro-batch before it runs; its rows go to a folder that bears its number and
is replaced if it has to run again. So a restart repeats no file and loses none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sources.csv_ingest import DECLARED_TYPES, Ingested, NoHeader, read_staged, stage_csv
from roadpulse.sources.shared_dir import path_exists, remove_path

FILES_PER_BATCH = 1_000

_BATCH = "batch"
_GLOB = re.compile(r"([\\*?\[\]{}])")


def follow_csv(
    spark: SparkSession,
    source: str,
    out: str,
    types: Mapping[str, str] = DECLARED_TYPES,
    files_per_batch: int = FILES_PER_BATCH,
    available_now: bool = True,
    multiline: bool = False,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start taking the CSV files below ``source`` into Parquet below ``out``; ``taken_in`` reads it.

    With ``available_now`` the query takes what is there, in as many micro-batches
    as it needs, and ends; without, it goes on until stopped. Started again with
    the same ``out`` it goes on where it ended. Types are the declared ones, as
    types inferred from one batch would not bind the next. Files must be complete
    when they appear and are known by name: one that is written again is not read
    again. Empty files bring nothing; one with other columns than those before
    ends the query. ``before_commit`` is called with the number of each batch once
    its rows are written. The driver holds the names of one batch.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
    )

    def take(batch: DataFrame, number: int) -> None:
        files = sorted(r["path"] for r in batch.collect())
        if files:
            _take_files(batch.sparkSession, files, out, number, types, multiline)
        if before_commit:
            before_commit(number)

    writer = names.writeStream.foreachBatch(take).option("checkpointLocation", f"{out}/_checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _take_files(spark: SparkSession, files: list[str], out: str, number: int, types: Mapping[str, str], multiline: bool) -> None:
    known = set(taken_in(spark, out).clean.columns) if number and path_exists(spark, f"{out}/rows") else None
    place = f"{out}/rows/{_BATCH}={number}"
    try:
        columns = stage_csv(spark, [_GLOB.sub(r"\\\1", f) for f in files], place, types, multiline)
    except NoHeader:
        return
    if known is not None and known != set(columns):
        remove_path(spark, place)
        raise ValueError(f"the files of batch {number} have other columns than those before: {sorted(columns)} and {sorted(known)}")


def taken_in(spark: SparkSession, out: str) -> Ingested:
    """The rows and rejects that came in so far.

    Those of a batch that was not committed are among them once it is written
    whole; run again, it replaces them by the same.
    """
    return read_staged(spark.read.parquet(f"{out}/rows").drop(_BATCH))

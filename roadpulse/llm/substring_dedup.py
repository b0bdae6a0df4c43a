"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes of each text and cuts where it is small, so the
cuts depend on the last ``_REACH`` bytes alone: what is inserted before a passage
moves its chunks and does not change them. Chunks are compared by digest.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.llm.common import small_batches, utf8_texts
from roadpulse.sources.shared_dir import written

#: One byte in so many is a cut; cuts nearer than the second to the one before are none; longest chunk.
ONE_IN = 24
SHORTEST = 12
LONGEST = 1024

#: Fewest bytes of consecutive repeated chunks that make a passage.
PASSAGE = 100

_REACH = 16


def _gear_table() -> np.ndarray:
    """256 numbers of 32 random-looking bits, by a multiplicative mix of the byte."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear_table()


def cuts(text: bytes, one_in: int = ONE_IN, shortest: int = SHORTEST, longest: int = LONGEST) -> np.ndarray:
    """Ends of the chunks of a text, in bytes; the last is its length."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    rolled = GEAR[np.frombuffer(text, np.uint8)]
    # Sum of gear[byte] << age over the last 16 bytes, by doubling the bytes summed.
    for age in (1, 2, 4, 8):
        older = np.zeros(n, np.uint32)
        older[age:] = rolled[:-age] << np.uint32(age) if age < n else 0
        rolled = rolled + older
    rolled[: _REACH - 1] = 0xFFFFFFFF
    found = np.flatnonzero(rolled < np.uint32((1 << 32) // one_in)) + 1
    if len(found):
        found = found[np.diff(found, prepend=-shortest) >= shortest]
    ends = np.append(found[found < n], n)
    starts = np.append(0, ends[:-1])
    if (ends - starts).max() > longest:
        ends = np.unique(np.concatenate([ends, *(np.arange(a + longest, b, longest) for a, b in zip(starts, ends) if b - a > longest)]))
    return ends


def chunk_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per document its id, the digests, ends and sizes of its chunks, and ``row``.

    ``row`` is the place of its first chunk among all chunks; the next chunks have
    the places after it, and one more is left free, so that rows without chunks differ.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in small_batches(batches, "_text", 4 << 20):
            digests, ends, sizes, places = [], [], [], []
            for text in utf8_texts(batch.column(1)):
                at = cuts(text)
                start, found = 0, []
                for end in at.tolist():
                    found.append(xxhash.xxh3_64_intdigest(text[start:end]))
                    start = end
                digests.append(np.array(found, np.uint64).view(np.int64))
                ends.append(at)
                sizes.append(np.diff(at, prepend=0))
                places.append(place)
                place += len(at) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32())), pa.array(places, pa.int64())],
                names=["doc_id", "digests", "ends", "sizes", "row"],
            )

    return rows.mapInArrow(work, f"doc_id {id_type}, digests array<long>, ends array<int>, sizes array<int>, row long")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """One row per passage that other documents hold too (an action, then lazy).

    Columns: ``doc_id``, ``start`` and ``length`` in bytes of the UTF-8 text,
    ``n_chunks``, ``n_copies`` (rows that hold its most frequent chunk), ``is_first``
    (the copy to keep). A chunk is repeated if it stands in two rows or more; at the
    first of all its places it is first, at the others later. A run of later chunks
    of ``passage`` bytes or more is one passage that is not first. What is between
    those, first chunks and shorter runs of later ones, is a passage that is first, if
    it has ``passage`` bytes. So the first place of every chunk is kept, and no
    later copy of a passage. Equal rows are copies of each other. Null and empty texts
    have no chunks, a null id is returned as it is, an empty table gives an empty
    result, and other columns are not read.

    A digest that many rows hold is counted on the map side first. It comes back
    to its chunks by a join whose skewed partitions Spark splits.
    """
    rows = written(chunk_rows(docs, doc_id, text), "chunks")
    chunks = rows.select("row", F.posexplode(F.arrays_zip("digests", "ends", "sizes")).alias("k", "chunk")).select(
        "row", "k", F.col("chunk.digests").alias("digest"), F.col("chunk.ends").alias("end"), F.expr("chunk.ends - chunk.sizes").alias("start")
    )
    # The first place is in the last row, or after its beginning, if that row alone has the chunk.
    repeated = (
        chunks.groupBy("digest")
        .agg(F.min(F.col("row") + F.col("k")).alias("first"), F.max("row").alias("last"), F.count("*").alias("n"))
        .filter("first < last")
        .select("digest", "first", "n")
    )
    chunk_before, part_before = Window.partitionBy("row").orderBy("k"), Window.partitionBy("row").orderBy("start")
    parts = (
        chunks.join(repeated, "digest")
        .withColumn("is_first", F.col("first") == F.col("row") + F.col("k"))
        .withColumn("part", _numbered((F.col("k") != F.lag("k").over(chunk_before) + 1) | (F.col("is_first") != F.lag("is_first").over(chunk_before)), chunk_before))
        .groupBy("row", "part", "is_first")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"), F.max("n").alias("n_copies"))
    )
    passages = (
        parts.withColumn("is_first", F.col("is_first") | (F.col("end") - F.col("start") < passage))
        .withColumn("span", _numbered((F.col("start") != F.lag("end").over(part_before)) | (F.col("is_first") != F.lag("is_first").over(part_before)), part_before))
        .groupBy("row", "span", "is_first")
        .agg(
            F.min("start").alias("start"),
            (F.max("end") - F.min("start")).alias("length"),
            F.sum("n_chunks").alias("n_chunks"),
            F.max("n_copies").alias("n_copies"),
        )
        .filter(F.col("length") >= passage)
    )
    return passages.join(rows.select("row", "doc_id"), "row").select(
        "doc_id", F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"), "n_chunks", "n_copies", "is_first"
    )


def _numbered(begins: Column, window: WindowSpec) -> Column:
    """Number of the group that a row is in, where ``begins`` says that a group begins (null: the first)."""
    return F.sum(F.coalesce(begins, F.lit(False)).cast("int")).over(window)

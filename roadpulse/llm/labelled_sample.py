"""What classifiers share: the bounded sample they are fitted on, and scoring all documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import small_batches

#: Labelled rows that a fit reads at most, and characters of a text it may have; both bound what the driver holds.
FIT_ROWS = 6_000
FIT_CHARS = 20_000

_PARTS = 1 << 20


def remainder(doc_id: str, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    training: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    balanced: bool = False,
    rows: int = FIT_ROWS,
    chars: int = FIT_CHARS,
) -> list[tuple[str, int]]:
    """(text, label) of at most ``rows`` labelled training documents of at most ``chars`` characters.

    Chosen by a hash of the id, so reruns agree. ``balanced`` takes as many of
    either label as there are, up to half of ``rows``. Labels are chosen before
    texts are read: the join's small side holds ``rows`` ids at most.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")).filter(training).filter("_id IS NOT NULL AND label IN (0, 1)")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("_id"), F.lit(_PARTS))
    if balanced:
        chosen = [known.filter(F.col("label") == k).filter(place < _share(rows // 2, n)).limit(rows // 2) for k, n in counts.items()]
        chosen = chosen[0].unionByName(chosen[1]) if len(chosen) == 2 else known.limit(rows)
    else:
        chosen = known.filter(place < _share(rows, sum(counts.values()))).limit(rows)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).filter(F.length("text") <= chars)
    found = texts.join(F.broadcast(chosen), "_id").select("_id", "text", "label").limit(2 * rows).collect()
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: (r["_id"], r["text"], r["label"]))]


def _share(rows: int, of: int) -> int:
    """Of ``_PARTS``, those that hold a little under ``rows`` of ``of`` rows."""
    return _PARTS if of <= rows else int(_PARTS * 0.95 * rows / of)


def scored(rows: DataFrame, scorer: Callable[[], Callable[[str | None], float]], least: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of (doc_id, held_out, _text); ``scorer`` is called once per task.

    If what it returns has ``prepare``, that sees the texts of a batch before they are scored.
    """
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        score = scorer()
        for batch in small_batches(batches, "_text"):
            texts = batch.column(2).to_pylist()
            if hasattr(score, "prepare"):
                score.prepare(texts)
            found = [score(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array([int(s >= least) for s in found], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(work, f"doc_id {id_type}, held_out boolean, score double, predicted int")

"""Exact deduplication behind a Bloom filter of repeated hashes, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import SPACE, carried
from roadpulse.sources.shared_dir import written

ADDED = ("keep_id", "group_size", "kept", "text_sha256")

# A filter of more 64-bit words than this is joined by shuffle and not broadcast.
MOST_BROADCAST_WORDS = 4_000_000


def normalised(text: Column) -> Column:
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def repeated_slots(hashes: DataFrame, slot_bits: int) -> DataFrame:
    """Bloom filter of the slots that two rows or more fall into: (``word``, ``bits``).

    Slots are summed on the map side first; empty 64-bit words are not stored.
    """
    twice = hashes.groupBy(F.shiftrightunsigned("_hash", 64 - slot_bits).alias("slot")).count().filter("count >= 2")
    return twice.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")
    )


def exact_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    slots_per_row: int = 64,
    most_broadcast_words: int = MOST_BROADCAST_WORDS,
) -> DataFrame:
    """Every row with the row that stays for its text (two actions, then lazy).

    Texts are equal when they are after normalising white space; a null text is
    empty. The first pass puts a 64-bit hash of each text into a bitmap of at
    least ``slots_per_row`` slots a row and keeps the slots hit twice. In the
    second pass rows whose slot was hit once have no equal: they go straight
    through, with no shuffle. The others (equal texts, and about one row in
    ``slots_per_row`` by chance) are written out and grouped by SHA-256.

    The filter is broadcast if it has at most ``most_broadcast_words`` words.
    Beyond that it is partitioned, and rows meet it by their slots, with the same
    result: they are shuffled with their digest, id and the carried columns and not
    with their text, so carry the id and not the text of such a table.

    Added columns: ``keep_id`` (smallest id of the group), ``group_size``,
    ``kept``, ``text_sha256``. ``carry`` names the columns of ``docs`` to return
    (all by default); one that has the name of an added column is left out.
    Exactly one row of a group is kept: with null ids, the ids that are not null
    go first; among rows repeated with the smallest id it is any one of them. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    columns = carried(docs, docs.columns if carry is None else carry, ADDED)
    rows = docs.count()
    slot_bits = min(60, max(12, math.ceil(math.log2(max(1, rows) * slots_per_row))))
    the_text = normalised(F.col(text))
    bloom = written(repeated_slots(docs.select(F.xxhash64(the_text).alias("_hash")), slot_bits), "repeated-slots")
    names = [f"_carried{i}" for i in range(len(columns))]
    probed = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], F.col(doc_id).alias("_id"), the_text.alias("_norm")
    ).withColumn("_slot", F.shiftrightunsigned(F.xxhash64("_norm"), 64 - slot_bits))
    digest = F.sha2("_norm", 256).alias("text_sha256")
    in_filter = F.shiftright("_slot", 6) == F.col("word")
    if bloom.count() <= most_broadcast_words:
        probed = probed.join(F.broadcast(bloom), in_filter, "left")
    else:
        # A slot that many rows have is a hot key; the join splits it, as it has no aggregate above.
        narrow = probed.select(*names, "_id", "_slot", digest)
        probed, digest = written(narrow.join(bloom, in_filter, "left"), "probed"), F.col("text_sha256")
    hit = F.expr("coalesce(shiftright(bits, CAST(_slot & 63 AS INT)) & 1L, 0L) = 1L")

    single = probed.filter(~hit).select(
        *names, F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest
    )
    # A number per row, written down, so that a retried task finds the same one.
    maybe = written(
        probed.filter(hit).select(*names, "_id", digest).withColumn("_row", F.monotonically_increasing_id()), "maybe-repeated"
    )
    groups = written(
        maybe.groupBy("text_sha256")
        .agg(F.min(F.struct(F.isnull("_id").alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("first"), F.count("*").alias("group_size"))
        .filter("group_size >= 2")
        .select("text_sha256", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"),
        "repeated-texts",
    )
    grouped = maybe.join(groups, "text_sha256", "left").select(
        *names,
        F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(grouped).select(*[F.col(n).alias(c) for c, n in zip(columns, names)], *ADDED)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    names = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{i}" for i, n in enumerate(names)}
    kept = exact_dedup(renamed, at[doc_id], at[text]).filter("kept")
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])

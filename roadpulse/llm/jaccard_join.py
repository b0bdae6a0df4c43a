"""Similarity join on word shingles by T-occurrence search.

Two documents link when their shingle sets overlap in a share of their union.
Then they overlap in at least ``T = ceil(share * n)`` shingles of either set of
``n``. The inverted lists of a document are divided (DivideSkip): the shortest
``n - T + 1`` are merged to find candidates, as every partner stands in one of
them; the longer lists, such as those of a passage that many documents hold, are
only probed, by binary search, for the candidates.

Beforehand a cheaper form of the same count leaves out documents without a
partner: of the shingles with the smallest hashes. And documents that are
connected already are not compared: each list is first matched against its most
central document, and only documents that are in different components after that
are compared with each other. So a group of thousands of near copies costs one
comparison per member, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import small_batches, utf8_texts, word_hashes
from roadpulse.llm.components import connected_components
from roadpulse.sources.shared_dir import collected, hand_over, remove_paths, written

# Words of a shingle, percent of the union that links.
WORDS = 4
PERCENT = 85

#: Percent of a set by which the first selection reads on, so that it can ask for more than one shared shingle.
EXTRA_PERCENT = 8

#: Rows of a table of keys up to which it is broadcast; beyond, it is joined by shuffle.
MOST_BROADCAST_KEYS = 1_000_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, given those of its words."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    size = min(words, len(hashes))
    count = len(hashes) - size + 1
    with np.errstate(over="ignore"):
        at = np.full(count, size, np.uint64)
        for k in range(size):
            at = (at ^ hashes[k : k + count]) * _FACTOR
            at ^= at >> np.uint64(29)
    return np.unique(at)


def needed(n, percent: int = PERCENT):
    """Fewest shingles that a set of ``n`` shares with a partner."""
    return -(-percent * n // 100)


def _extra(n):
    return 1 + EXTRA_PERCENT * n // 100


def shingle_rows(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """Per document: id, key of its text, ``n``, digest of its set, smallest hashes of its set."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in small_batches(batches, "_text", 4 << 20):
            n, digest, first = [], [], []
            for hashes in word_hashes([t.lower() for t in utf8_texts(batch.column(2))]):
                found = shingle_hashes(hashes, words)
                n.append(len(found))
                digest.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                first.append(found[: len(found) - needed(len(found), percent) + _extra(len(found))].view(np.int64))
            offsets = np.zeros(len(first) + 1, np.int32)
            np.cumsum([len(f) for f in first], out=offsets[1:])
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(first) if first else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), lists],
                names=["doc_id", "key", "n", "digest", "first"],
            )

    return rows.mapInArrow(work, f"doc_id {id_type}, key long, n long, digest binary, first array<long>")


def _bounded(df: DataFrame, most: int = MOST_BROADCAST_KEYS) -> DataFrame:
    """A written table, marked for broadcast if it is small."""
    return F.broadcast(df) if df.count() <= most else df


def _shared(entries: DataFrame) -> DataFrame:
    """Those of (``h``, ...) whose ``h`` occurs twice or more, with ``df``."""
    lists = entries.groupBy("h").agg(F.count("*").alias("df")).filter("df >= 2")
    return entries.join(lists, "h")


def whole_sets(docs: DataFrame, doc_id: str, text: str, chosen: DataFrame, words: int) -> DataFrame:
    """(``v``, ``n``, ``shingles``) of the ``chosen`` (``v``, ``key``, ``id``), from a second scan of the texts."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).alias("_text"))
    wanted = _bounded(chosen).withColumnRenamed("key", "k")
    rows = rows.join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("v", "_text")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in small_batches(batches, "_text", 4 << 20):
            sets = [shingle_hashes(h, words).view(np.int64) for h in word_hashes([t.lower() for t in utf8_texts(batch.column(1))])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["v", "n", "shingles"]
            )

    return rows.mapInArrow(work, "v long, n long, shingles array<long>")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the candidate ``pairs`` (``a``, ``b``) that link, by probing one set for the shingles of the other."""
    one = sets.select(F.col("v").alias("a"), F.col("n").alias("n_a"), F.array_sort("shared").alias("set_a"))
    two = sets.select(F.col("v").alias("b"), F.col("n").alias("n_b"), F.array_sort("shared").alias("set_b"))

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, set_a, set_b = batch.columns
            keep = []
            for k in range(batch.num_rows):
                short, long = sorted((set_a[k].values.to_numpy(), set_b[k].values.to_numpy()), key=len)
                at = np.searchsorted(long, short)
                at[at == len(long)] = 0
                both = int(np.count_nonzero(long[at] == short)) if len(short) else 0
                keep.append(100 * both >= percent * (n_a[k].as_py() + n_b[k].as_py() - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "set_a", "set_b")
    return both.mapInArrow(probe, "a long, b long")


def links_of(sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets (``v``, ``n``, ``m``, ``shared`` in order of list length) that connect what is connected.

    Two sets that link are connected by the result, if perhaps through others.
    ``room`` is what a set has left from its place in a list on, in the order of
    all lists. The first list in which two linked sets meet leaves both of them
    room for the overlap they need, so pairs are taken from such lists only; the
    smaller of the two then has room for a partner of its own size.
    """
    short = f"slice(shared, 1, CAST(m - ({percent} * n + 99) div 100 + 1 AS INT))"
    lists = written(
        sets.select("v", "n", "m", F.posexplode(F.expr(short)).alias("k", "h")).selectExpr(
            "h", "v", "n", "m / n AS central", "m - k AS room"
        ),
        "short-lists",
    )
    meet = F.expr(f"{100 + percent} * least(room_a, room_b) >= {percent} * (n_a + n_b)")
    members = lists.selectExpr("h", "v AS a", "n AS n_a", "room AS room_a")
    hubs = lists.groupBy("h").agg(F.max(F.struct("central", "n", "v", "room")).alias("hub"), F.count("*").alias("df")).filter("df >= 2")
    hubs = hubs.selectExpr("h", "hub.v AS b", "hub.n AS n_b", "hub.room AS room_b")
    to_hub = members.join(hubs, "h").filter(meet & (F.col("a") != F.col("b"))).select("a", "b").distinct()
    links = written(linked(to_hub, sets, percent), "hub-links")

    labels = connected_components(links)
    split = lists.drop("central").join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    split = written(split, "labelled-lists")
    several = split.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("h")
    split = written(split.join(several, "h"), "split-lists")
    smaller = split.filter(f"{100 + percent} * room >= {2 * percent} * n")
    smaller = smaller.selectExpr("h", "v AS a", "n AS n_a", "room AS room_a", "label AS label_a")
    larger = split.selectExpr("h", "v AS b", "n AS n_b", "room AS room_b", "label AS label_b")
    across = smaller.join(larger, "h").filter(meet & F.expr("n_a <= n_b AND label_a <> label_b"))
    across = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return links.unionByName(linked(across, sets, percent))


def _class_components(docs: DataFrame, doc_id: str, text: str, words: int, percent: int, rows: DataFrame) -> DataFrame:
    """(``digest``, ``component_id``, ``staying``) of each distinct set of the ``rows``; tables of a step go when the next is written."""
    spark = docs.sparkSession
    first_row = F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id").alias("id"), F.col("v").alias("v"))
    classes = written(rows.filter("n > 0").groupBy("digest").agg(F.min(first_row).alias("least")).select("digest", "least", F.col("least.v").alias("v")), "classes")

    sets = rows.join(classes.select("v"), "v")
    entries = sets.select("v", F.explode("first").alias("h"))
    seen = _shared(entries).groupBy("v").agg(F.count("*").alias("seen"))
    # A partner has at least `needed` shingles, and so reads on by this much at least.
    enough = f"seen >= 1 + {EXTRA_PERCENT} * (({percent} * n + 99) div 100) div 100"
    with collected() as of_sets:
        hopeful = written(rows.drop("first", "digest").join(seen, "v").filter(enough).select("v", "key", F.col("doc_id").alias("id")), "hopeful")

        whole = written(whole_sets(docs, doc_id, text, hopeful, words), "whole-sets")
        if whole.count() > hopeful.count():
            # Some rows repeat an id with its text.
            whole = written(whole.dropDuplicates(["v"]), "whole-sets")
        shared = (
            _shared(whole.select("v", "n", F.explode("shingles").alias("h")))
            .groupBy("v", "n")
            .agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("lists"))
            .select("v", "n", F.size("lists").cast("long").alias("m"), F.col("lists.h").alias("shared"))
            .filter(f"m >= ({percent} * n + 99) div 100")
        )
    with collected() as of_links:
        shared = written(shared, "shared-sets")
        remove_paths(spark, of_sets)
        links = links_of(shared, percent)
    links = written(links, "all-links")
    remove_paths(spark, of_links)
    labels = connected_components(links)

    named = classes.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    named = written(named.select("digest", "label", "least"), "class-labels")
    smallest = named.groupBy("label").agg(F.min("least").alias("least"))
    return named.select("digest", "label").join(smallest, "label").select("digest", F.col("least.id").alias("component_id"), F.col("least.v").alias("staying"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``stays``, ``key`` (several actions).

    ``component_id`` is the smallest id reachable by links (ids that are null
    come last); ``stays`` marks one row of each component; ``key`` is the hash of
    the text. Documents with equal sets are one vertex, so copies are never
    paired. Null texts and texts without words have no shingles and stay as they
    are; a text of fewer words than a shingle has one; rows that repeat an id
    and text are copies; an empty table gives an empty result; other columns are
    not read.
    """
    spark = docs.sparkSession
    rows = written(shingle_rows(docs, doc_id, text, words, percent).withColumn("v", F.monotonically_increasing_id()), "shingle-rows")
    with collected() as scratch:
        named = _class_components(docs, doc_id, text, words, percent, rows)
        with collected() as result:
            named = written(named, "components")
    remove_paths(spark, scratch)
    hand_over(result)
    return rows.join(named, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("v") == F.col("staying"))).alias("stays"),
        "key",
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those that another of their component stands for, with the columns of ``docs``.

    Rows that repeat an id and its text go or stay together.
    """
    with collected() as scratch:
        found = jaccard_components(docs, doc_id, text, words, percent)
    gone = found.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.max("stays").alias("stays")).filter("NOT stays")
    gone = written(gone.drop("stays"), "near-copies")
    remove_paths(docs.sparkSession, scratch)
    names = docs.columns
    at = {n: f"c{i}" for i, n in enumerate(names)}
    key = F.xxhash64(F.coalesce(F.col(at[text]), F.lit("")))
    same = (key == F.col("_key")) & F.col(at[doc_id]).eqNullSafe(F.col("_id"))
    kept = docs.toDF(*at.values()).join(_bounded(gone), same, "left_anti")
    return kept.select(*[F.col(c).alias(n) for n, c in at.items()])

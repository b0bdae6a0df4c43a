"""How the vocabularies of a language's sources differ, over run-length coded columns.

Each source is a column with one count per kept term. The terms are put in an
order in which equal counts stand together, and each column is kept as runs. A
pair of sources is compared run against run: the boundaries of both are merged,
and the divergence of a piece, the same for all its terms, counts as often as
the piece is long. Columns are cut into blocks of terms, so a task holds the runs
of one block, however large the vocabulary is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import small_batches, utf8_texts
from roadpulse.llm.numbering import numbered
from roadpulse.sources.shared_dir import written

# Documents that hold a kept term, added to counts, scale of p, ranks of the terms.
FEWEST_DOCUMENTS = 10
SMOOTHING = 2
SCALE = 1_000_000_000
MOST_TERMS = 10

#: Terms of a block.
BLOCK = 1024

#: Sources by whose counts terms are sorted before the rest decides.
KEY_SOURCES = 3

_HELD_BYTES = 64 << 20
_ENTRY_BYTES = 150
_PIECE = 1 << 20

# ASCII letters and all that is not ASCII stay, in lower case; the rest separates terms.
_AS_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _term_counts(text: bytes) -> Counter[bytes]:
    plain = text.translate(_AS_TERMS)
    found: Counter[bytes] = Counter()
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + _PIECE)
        end = len(plain) if end < 0 else end
        found.update(plain[start:end].split())
        start = end
    return found


def group_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term (lazy).

    A task adds up its documents and sends its sums when they take up a fixed
    number of bytes, so what is shuffled is terms per task and not words.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("_lang"), F.coalesce(F.col(source), F.lit("")).alias("_source"), F.col(text).alias("_text")
    )
    names = ["lang", "source", "term", "n", "docs"]

    def sent(groups: dict) -> Iterable[pa.RecordBatch]:
        for (of, at), terms in groups.items():
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([of] * size, pa.string()),
                    pa.array([at] * size, pa.string()),
                    pa.array(list(terms), pa.binary()).cast(pa.string()),
                    pa.array([n for n, _ in terms.values()], pa.int64()),
                    pa.array([d for _, d in terms.values()], pa.int64()),
                ],
                names=names,
            )

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        groups: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        held = 0
        for batch in small_batches(batches, "_text", 4 << 20):
            for of, at, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8_texts(batch.column(2))):
                terms = groups.setdefault((of, at), {})
                for term, n in _term_counts(one).items():
                    entry = terms.get(term)
                    if entry is None:
                        terms[term] = [n, 1]
                        held += len(term) + _ENTRY_BYTES
                    else:
                        entry[0] += n
                        entry[1] += 1
                if held > _HELD_BYTES:
                    yield from sent(groups)
                    groups, held = {}, 0
        yield from sent(groups)

    found = rows.mapInArrow(work, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(count: Column, all_counts: Column, size: Column) -> Column:
    """Smoothed share of a count, in whole parts of ``SCALE``; exact beyond 64 bits too."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(SMOOTHING).cast("decimal(1,0)"))
    below = all_counts.cast("decimal(20,0)") + F.lit(SMOOTHING).cast("decimal(1,0)") * size.cast("decimal(18,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def _f(p: Column, q: Column) -> Column:
    """(p - q)^2 / (p + q), rounded down; p and q are at most ``SCALE`` + 1, so 64 bits hold it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(counts: DataFrame, fewest_documents: int = FEWEST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, column): the kept terms with their counts per source.

    ``column`` lists (source, n) by source, at most one entry per source of the
    language, whatever the number of documents.
    """
    return (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("column"))
        .filter(F.col("docs") >= fewest_documents)
        .drop("docs")
    )


def runs(entries: DataFrame) -> DataFrame:
    """Runs of equal counts of consecutive places, per language, source and block.

    ``entries`` has (lang, source, place, block, n), places with a count only.
    """
    inside = Window.partitionBy("lang", "source", "block").orderBy("place")
    step = (F.lag("place").over(inside) == F.col("place") - 1) & (F.lag("n").over(inside) == F.col("n"))
    begun = entries.withColumn("_begins", F.when(step, 0).otherwise(1)).withColumn("_run", F.sum("_begins").over(inside))
    return begun.groupBy("lang", "source", "block", "_run").agg(F.min("place").alias("first"), F.count("*").alias("length"), F.first("n").alias("n")).drop("_run")


def _columns(batch: pa.Table, block: int) -> tuple[list[str], list[np.ndarray], list[np.ndarray], int]:
    """Of a block: its sources, and per source the first places and the p of its runs, zero runs filled in."""
    source = batch.column("source").to_pylist()
    first = batch.column("first").to_numpy()
    length = batch.column("length").to_numpy()
    p = batch.column("p").to_numpy()
    heads = {source[k]: int(p[k]) for k in np.flatnonzero(length == 0)}
    size = int(batch.column("size")[0].as_py())
    names = sorted(heads)
    of: dict[str, list[int]] = {name: [] for name in names}
    for k in np.flatnonzero(length > 0):
        of[source[k]].append(k)
    starts, values = [], []
    for name in names:
        held = np.array(of[name], np.int64)
        held = held[np.argsort(first[held])]
        begin, end = first[held] % block, first[held] % block + length[held]
        # A run of zeros may stand before each run and after the last; empty ones go.
        at = np.empty(2 * len(held) + 1, np.int64)
        at[0], at[1::2], at[2::2] = 0, begin, end
        value = np.full(len(at), heads[name], np.int64)
        value[1::2] = p[held]
        real = np.diff(at, append=size) > 0
        starts.append(at[real])
        values.append(value[real])
    return names, starts, values, size


def pair_sums(columns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, source, item, value): divergence of every two sources of a language, from their runs.

    ``columns`` has (lang, block, source, first, length, p, size); a row of length 0
    per source and block gives the p of a count of zero.
    """

    def work(batch: pa.Table) -> pa.Table:
        names, starts, values, size = _columns(batch, block)
        left, right, total = [], [], []
        for a in range(len(names)):
            for b in range(a):
                cuts = np.union1d(starts[a], starts[b])
                p = values[a][np.searchsorted(starts[a], cuts, side="right") - 1]
                q = values[b][np.searchsorted(starts[b], cuts, side="right") - 1]
                value = int(((p - q) ** 2 // (p + q) * np.diff(cuts, append=size)).sum())
                left += [names[a], names[b]]
                right += [names[b], names[a]]
                total += [value, value]
        lang = batch.column("lang")[0].as_py()
        return pa.table(
            [pa.array([lang] * len(left), pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(total, pa.int64())],
            names=["lang", "source", "item", "value"],
        )

    found = columns.groupBy("lang", "block").applyInArrow(work, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence_audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    fewest_documents: int = FEWEST_DOCUMENTS,
    most_terms: int = MOST_TERMS,
    block: int = BLOCK,
) -> DataFrame:
    """Per (lang, source): every other source by divergence, and the terms it uses most above its language (several actions).

    Columns ``lang, source, part, item, value, rank``; part ``pair`` or ``term``.
    Null text, lang and source are empty strings, and an empty string is a value
    like any other. Every row is a document, repeated rows too. A language without
    kept terms has pairs of value 0 and no terms; a source alone in its language
    has no pairs; ties go by the item's bytes; an empty table gives no rows. Other
    columns are not read, so their names cannot clash.
    """
    named = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"))
    all_groups = written(named.distinct(), "divergence-groups")
    kept = written(kept_terms(group_counts(docs, text, lang, source), fewest_documents), "divergence-terms")
    # The first sources and counts and then all of them, as a hash: terms with the same counts in
    # all sources stand together, and those with the same first ones near them. The key stays
    # small however many sources there are, since the sort's ranges come from a sample of keys.
    order = [F.col("lang"), F.slice("column", 1, KEY_SOURCES), F.xxhash64("column"), F.col("term")]
    terms = numbered(kept, order, "divergence-order")
    langs = terms.groupBy("lang").agg(F.min("number").alias("before"), F.count("*").alias("terms"), F.sum("total").alias("lang_all"))
    langs = written(langs, "divergence-langs")
    placed = terms.join(langs, "lang").withColumn("place", F.col("number") - F.col("before"))
    entries = placed.select(
        "lang", "term", "total", "place", "terms", "lang_all", F.floor(F.col("place") / block).alias("block"), F.inline("column")
    )
    entries = written(entries, "divergence-entries")
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("group_all"))
    groups = written(
        all_groups.join(langs, "lang", "left").join(sums, ["lang", "source"], "left").select(
            "lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), "lang_all", F.coalesce("group_all", F.lit(0)).alias("group_all")
        ),
        "divergence-sums",
    )

    with_terms = groups.filter("terms > 0")
    sizes = [F.col("group_all"), F.col("terms")]
    heads = with_terms.select(
        "lang", F.explode(F.expr(f"sequence(0L, (terms - 1) div {block})")).alias("block"), "source", F.lit(0).cast("long").alias("first"),
        F.lit(0).cast("long").alias("length"), _p(F.lit(0), *sizes).alias("p"), "terms",
    )
    coded = runs(entries).join(with_terms, ["lang", "source"]).select("lang", "block", "source", "first", "length", _p(F.col("n"), *sizes).alias("p"), "terms")
    columns = heads.unionByName(coded).withColumn("size", F.least(F.lit(block), F.col("terms") - F.col("block") * block)).drop("terms")
    other = F.col("source").alias("item")
    none = groups.filter("terms = 0").select("lang", "source")
    unlike = none.join(none.select("lang", other), "lang").filter("source <> item").withColumn("value", F.lit(0).cast("long"))
    pairs = pair_sums(columns, block).unionByName(unlike)
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))

    own = entries.join(with_terms.select("lang", "source", "group_all"), ["lang", "source"])
    own = own.withColumn("p", _p(F.col("n"), *sizes)).withColumn("q", _p(F.col("total"), F.col("lang_all"), F.col("terms")))
    own = own.filter("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    top = own.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most_terms).withColumn("part", F.lit("term"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*names).unionByName(top.select(*names))

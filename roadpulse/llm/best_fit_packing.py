"""Bulk-synchronous best-fit packing of tokenised documents into fixed sequences.

A superstep places all pieces of one length, longest first. Pieces of one length
and open sequences with one gap are interchangeable, so a superstep works on
runs: a gap size with the sequences that have it. The successor sweep finds the
smallest gap that holds the length; of the pieces that want it the first by rank
get it; those sequences move to their new gap; the rest of the pieces goes on
with the next successor, and in the end opens new sequences. There are at most as
many sizes as a sequence has tokens, however many pieces there are, so the sweep
over sizes is held by the driver; sorting the pieces by range, ranking them and
giving each its place is done by the cluster.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.byte_bpe import OTHER_SPACE, load_tokenizer, pieces
from roadpulse.llm.common import ENTRY_BYTES, small_batches
from roadpulse.llm.pair_merges import pair_merges
from roadpulse.sources.shared_dir import written

# Tokens of a sequence, token after each document.
CAPACITY = 2048
END = 0

#: What a worker remembers of pieces at most, besides those of one batch.
MOST_BYTES = 96 << 20

_JOINED = 30_000
_ALONE = 5_000
_MOST_RANK = 1 << 40


class Vocabulary:
    """Token ids of pieces met so far, in one flat array; filled a batch at a time."""

    def __init__(self, path: str | None):
        self.tokenizer = load_tokenizer(path)
        self.merges = pair_merges(path)
        special = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab()
        # A character of a token's name stands for one byte, but in special tokens.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for name, i in vocabulary.items():
            self.bytes[i] = special.get(i, len(name))
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        self.flat = np.zeros(1 << 20, np.uint32)
        self.starts = np.zeros(1 << 18, np.int64)
        self.lengths = np.zeros(1 << 18, np.int64)
        self.used = 0

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces not met yet.

        Pieces that begin with white space and do not end with it encode in one
        text as they do alone, so they are joined, and merged side by side where
        that gives the library's ids. The others go to the library one by one.
        """
        joined, alone = [], []
        for piece in pieces:
            (joined if piece[0].isspace() and not piece[-1].isspace() else alone).append(piece)
        self._learn(joined, alone)

    def _learn(self, joined: list[str], alone: list[str]) -> None:
        for at in range(0, len(joined), _JOINED):
            self._learn_joined(joined[at : at + _JOINED], alone)
        for at in range(0, len(alone), _ALONE):
            part = alone[at : at + _ALONE]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self._add(part, np.fromiter((i for x in found for i in x), np.uint32, int(lengths.sum())), lengths)

    def _learn_joined(self, part: list[str], alone: list[str]) -> None:
        """Encode pieces as one text; those for which that does not do are added to ``alone``."""
        merges = self.merges
        if not merges.usable:
            alone += part
            return
        text = "".join(part)
        odd = [*merges.odd_characters(text), *(s for s in merges.special if s in text)]
        if odd:
            alone += [p for p in part if any(s in p for s in odd)]
            part = [p for p in part if not any(s in p for s in odd)]
            text = "".join(part)
        ids = merges.ids(text).astype(np.uint32)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
        if not text.isascii():
            data = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))[ends]
        upto = np.cumsum(self.bytes[ids])
        last = np.searchsorted(upto, ends)
        if len(part) and last[-1] == len(ids) - 1 and (upto[last] == ends).all():
            self._add(part, ids, np.diff(last, prepend=-1))
        else:
            alone += part

    def _add(self, part: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.index)
        while first + len(part) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.lengths[first : first + len(part)] = lengths
        self.starts[first : first + len(part)] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.held += sum(map(len, part)) + 4 * len(ids) + ENTRY_BYTES * len(part)
        self.index.update(zip(part, range(first, first + len(part))))

    def ids(self, texts: Sequence[list[str]], end: int) -> list[np.ndarray]:
        """Ids of texts given in pieces, each followed by ``end``."""
        self._make_room()
        every = list(itertools.chain.from_iterable(texts))
        return self._joined_ids(self._places(every), np.array([len(t) for t in texts], np.int64), end)

    def ids_of_column(self, column: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of the texts of an Arrow column, null as empty, each followed by ``end``.

        Where single spaces and line feeds are all the white space there is, words
        are split and told apart in Arrow, and only the different ones become
        strings; other texts are cut into ``pieces``.
        """
        column = column.cast(pa.large_string()).fill_null("")
        texts = column.to_pylist()
        words = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        counts = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        code, known = coded.indices.to_numpy(), coded.dictionary
        # A word that is empty or a line feed alone comes of more white space than one.
        wide = pc.is_in(known, pa.array(["", "\n"], known.type)).to_numpy(zero_copy_only=False)
        plain = np.array([not OTHER_SPACE.search(t) for t in texts], bool)
        starts = np.cumsum(counts) - counts
        if len(texts):
            plain &= ~np.logical_or.reduceat(wide[code], starts)
        self._make_room()
        out: list[np.ndarray | None] = [None] * len(texts)
        rows = np.flatnonzero(plain)
        if len(rows):
            kept = np.repeat(plain, counts)
            kept[starts[rows]] = False
            used = np.zeros(len(known), bool)
            used[code[kept]] = True
            # The space before a word was taken off, and a text's first word has none.
            used = np.flatnonzero(used)
            different = [w if w[0] == "\n" else " " + w for w in known.take(pa.array(used)).to_pylist()]
            place = np.zeros(len(known), np.int64)
            place[used] = self._places(different, plain=True)
            at = place[code]
            firsts = known.take(pa.array(code[starts[rows]])).to_pylist()
            at[starts[rows]] = self._places(firsts)
            for row, ids in zip(rows.tolist(), self._joined_ids(at[np.repeat(plain, counts)], counts[rows], end)):
                out[row] = ids
        others = np.flatnonzero(~plain).tolist()
        cut = [pieces(texts[k]) for k in others]
        for row, ids in zip(others, self._joined_ids(self._places(list(itertools.chain.from_iterable(cut))), np.array([len(t) for t in cut], np.int64), end)):
            out[row] = ids
        return out

    def _make_room(self) -> None:
        """Called between batches only: what is looked up stays for the batch."""
        if self.held > MOST_BYTES:
            self.clear()

    def _places(self, every: list[str], plain: bool = False) -> np.ndarray:
        """Where each piece is held, new ones learnt; ``plain`` ones are different words after one white space."""
        at = np.fromiter(map(self.index.get, every, itertools.repeat(-1)), np.int64, len(every))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            unknown = [every[k] for k in new]
            if plain:
                self._learn(unknown, [])
            else:
                self.learn(dict.fromkeys(unknown))
            at[new] = np.fromiter(map(self.index.__getitem__, unknown), np.int64, len(unknown))
        return at

    def _joined_ids(self, at: np.ndarray, counts: np.ndarray, end: int) -> list[np.ndarray]:
        """Ids of texts of so many pieces each, held at these places."""
        lengths = self.lengths[at]
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(at) else 0
        flat = self.flat[np.repeat(self.starts[at] - upto + lengths, lengths) + np.arange(total)]
        # Where each text ends among the pieces, and so among the ids.
        ends = np.append(0, upto)[np.cumsum(counts)] if len(counts) else []
        out, start = [], 0
        for stop in ends:
            ids = np.empty(stop - start + 1, "<u4")
            ids[:-1], ids[-1] = flat[start:stop], end
            out.append(ids)
            start = stop
        return out


_vocabularies: dict[str | None, Vocabulary] = {}


def tokenised_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens (lazy): (doc_id, piece, start, length, ids_crc32[, ids]).

    A document's ids are those of its text and ``end``. Only a longer one is cut,
    so that all its pieces but the first are full. Null text is empty: one piece
    with ``end`` alone.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if path not in _vocabularies:
            _vocabularies[path] = Vocabulary(path)
        vocabulary = _vocabularies[path]
        for batch in small_batches(batches, "_text", 4 << 20):
            row, out = [], [[] for _ in types]
            for k, ids in enumerate(vocabulary.ids_of_column(batch.column(1), end)):
                edge = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(edge, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[a:b]
                    row.append(k)
                    for column, value in zip(out, (n, a, b - a, zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None)):
                        column.append(value)
            columns = [pa.array(v, t) for v, t in zip(out[: len(names) - 1], types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *columns], names=names)

    return rows.mapInArrow(
        work, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    )


class Step(NamedTuple):
    """Pieces of one length and of consecutive ranks, placed alike."""

    length: int
    rank: int
    sequence: int
    per_sequence: int
    offset: int


def supersteps(lengths: Mapping[int, int], capacity: int = CAPACITY) -> list[Step]:
    """Best-fit, longest first, over the number of pieces of each length.

    Each ``Step`` holds up to the next one of its length: the piece of rank ``r``
    goes to sequence ``sequence + (r - rank) // per_sequence``.
    """
    steps: list[Step] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    sequences = 0

    def move(gap: int, first: int, count: int) -> None:
        if not gap or not count:
            return
        if gap not in runs:
            runs[gap] = []
            bisect.insort(sizes, gap)
        runs[gap].append((first, count))

    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, count = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], sizes[at]
            else:
                gap = capacity
                first, count = sequences, -(-left // (capacity // length))
                sequences += count
            each = gap // length
            steps.append(Step(length, rank, first, each, capacity - gap))
            filled = min(count, left // each)
            placed = filled * each
            move(gap - each * length, first, filled)
            if filled < count:
                rest = min(left - placed, each)
                placed += rest
                if rest:
                    move(gap - rest * length, first + filled, 1)
                    filled += 1
                move(gap, first + filled, count - filled)
            rank += placed
            left -= placed
    return steps


def best_fit(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows with ``length`` (1 to ``capacity``), with ``sequence_id`` and ``offset`` added (several actions).

    Rows are range-sorted by length and written; a row's rank among those of its
    length is its place in its partition plus the rows of that length in the
    partitions before, so a length that a third of all rows have is spread over
    many tasks. The driver holds the number of rows per length and the steps,
    both bounded by ``capacity``.
    """
    spark = lengths.sparkSession
    names = lengths.columns
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in names])
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = lengths.repartitionByRange(partitions, F.col("length").desc(), spread).sortWithinPartitions(F.col("length").desc())
    ordered = written(ordered.withColumn("_at", F.monotonically_increasing_id()), "pieces-by-length")
    held = (
        ordered.groupBy("length", F.shiftright("_at", 33).alias("_part"))
        .agg(F.count("*").alias("n"), F.min("_at").alias("first"))
        .selectExpr(
            "length AS _length", "_part", "first - sum(n) OVER (PARTITION BY length ORDER BY _part) + n AS _origin", "n"
        )
    )
    held = written(held, "ranks")
    counts = {r["_length"]: r["n"] for r in held.groupBy("_length").agg(F.sum("n").alias("n")).collect()}
    steps = sorted(supersteps(counts, capacity))
    table = np.array(steps, np.int64).reshape(-1, len(Step._fields))
    keys = table[:, 0] * _MOST_RANK + table[:, 1]

    ranked = ordered.withColumn("_part", F.shiftright("_at", 33)).join(
        held.select("_length", F.col("_part").alias("_of"), "_origin"), (F.col("length") == F.col("_length")) & (F.col("_part") == F.col("_of"))
    ).select(*[F.col(f"`{c}`") for c in names], (F.col("_at") - F.col("_origin")).alias("_rank"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False)
            step = table[np.searchsorted(keys, length * _MOST_RANK + rank, side="right") - 1]
            beyond = rank - step[:, 1]
            sequence = step[:, 2] + beyond // step[:, 3]
            offset = step[:, 4] + beyond % step[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    schema = lengths.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces with their sequence and place in it (several actions).

    Sequences are numbered from 0 and filled from offset 0 without gaps. Repeated
    rows are packed as often as they occur; null ids stay null; an empty table
    gives an empty result; other columns are not read.
    """
    found = tokenised_pieces(docs, doc_id, text, path, capacity, end, with_ids)
    # Written first: to find its ranges, the sort reads its input twice.
    return best_fit(written(found, "pieces"), capacity)

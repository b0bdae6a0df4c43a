"""What several text operators share."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words.
SPACE = r"\x20\x09-\x0D"

#: What an entry of a memo takes up besides its key.
ENTRY_BYTES = 150

_IN_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
_FACTOR, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xCBF29CE484222325)
_OF_BYTE = np.array([xxhash.xxh64_intdigest(bytes([c])) for c in range(256)], np.uint64)
# Words of more bytes are hashed one by one.
_LONG = 48


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def carried(df: DataFrame, columns: Iterable[str], added: Iterable[str]) -> list[str]:
    """Those of ``columns`` that do not clash (in any case) with a column to be added."""
    taken = {c.lower() for c in added}
    return [c for c in columns if c.lower() not in taken]


def word_count(text: Column) -> Column:
    """Number of runs of other characters than white space; null counts none.

    Each word with the space before it becomes one character, so no list of words is built.
    """
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+$", "")
    return F.length(F.regexp_replace(trimmed, f"[{SPACE}]*[^{SPACE}]+", "x")).cast("long")


class Remembered(dict):
    """Values worked out once per key, dropped when they take up about ``most_bytes``.

    The value must follow from the key alone, so dropping costs time and nothing
    else. A key of more than ``longest`` characters is worked out each time.
    """

    def __init__(self, work, most_bytes: int = 64 << 20, longest: int = 64):
        super().__init__()
        self.work, self.most_bytes, self.longest, self.held = work, most_bytes, longest, 0

    def __missing__(self, key):
        value = self.work(key)
        if len(key) <= self.longest:
            self.put([key], [value])
        return value

    def put(self, keys: Collection, values: Iterable) -> None:
        """Remember values worked out elsewhere."""
        if self.held > self.most_bytes:
            self.clear()
            self.held = 0
        self.held += sum(map(len, keys)) + ENTRY_BYTES * len(keys)
        self.update(zip(keys, values))


def word_hashes(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Per text, a 64-bit hash of each of its words in order, many words at a time.

    Words are hashed side by side, their first bytes at once, then their second
    ones, and so on; nothing is remembered from one call to the next.
    """
    if not texts:
        return []
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edges = np.flatnonzero(np.diff(_IN_WORD[joined], prepend=False))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    out = np.full(len(starts), _SEED, np.uint64)
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    own = out[order]
    long = int(np.searchsorted(-left, -_LONG, side="left"))
    for k in range(long):
        own[k] = xxhash.xxh64_intdigest(joined[at[k] : at[k] + left[k]].tobytes())
    for k in range(int(left[long]) if long < len(left) else 0):
        upto = int(np.searchsorted(-left, -k, side="left"))
        part = own[long:upto]
        part ^= _OF_BYTE[joined[at[long:upto] + k]]
        part *= _FACTOR
        part ^= part >> np.uint64(32)
    out[order] = own
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return np.split(out, np.searchsorted(starts, bounds[:-1]))


def utf8_texts(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null as empty."""
    return [t or b"" for t in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], text: str = "text", most_bytes: int = 8 << 20):
    """Arrow batches cut so that the texts of one hold about ``most_bytes`` (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        rows = batch.num_rows
        step = max(1, int(rows * most_bytes / max(1, column.nbytes))) if rows else 1
        for start in range(0, rows, step):
            yield batch.slice(start, step)

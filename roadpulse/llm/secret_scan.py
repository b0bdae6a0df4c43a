"""Secrets in texts: certain ones by pattern, uncertain ones by what stands near them.

A named or unmistakable secret is reported on its own. An identifier, an unnamed
random string or the address of a service is no finding alone; it is one where
the parts of a credential meet: a secret and, in the same scope (a stretch
without blank lines) and within reach, an identifier or an address. The parts
are intervals of their text. They are joined by the bins of text in which
intervals begin and end, each bin with its outermost ends, so no pairs are made
however many parts a text holds.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import carried, small_batches
from roadpulse.sources.shared_dir import written

# Kinds in their order, patterns and fewest characters of the certain ones.
KINDS = ("assign", "access", "hex", "identifier", "unnamed", "endpoint")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
FEWEST = {"assign": 6, "access": 20}
CERTAIN = 3

#: Characters between the parts of a credential at most.
REACH = 200

#: Fewest characters, and bits of entropy a character, of an unnamed secret.
UNNAMED_CHARS = 20
UNNAMED_BITS = 3.5

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_NAMES = re.compile(
    rb"""(?<![A-Za-z0-9])(?:access_?key_?id|key_?id|client_?id|tenant_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]{3,})""",
    re.I,
)
_HOSTS = re.compile(rb"""(?<![A-Za-z0-9])(?:end_?point|host_?name|host|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9][A-Za-z0-9.:/_-]{2,})""", re.I)
_TEMPORARY = re.compile(rb"(?<![A-Za-z0-9])A(?:SIA|IDA|ROA)[A-Z0-9]{12,}")
_ADDRESS = re.compile(rb"""[A-Za-z][A-Za-z0-9+.-]*://(?:([^\s:/@"'<>]+):([^\s/@"'<>]+)@)?([^\s/@"'<>?#]+)""")
_RANDOM = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % UNNAMED_CHARS)
_BREAK = re.compile(rb"\n[\x20\t\r]*\n")

_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _mask(members: bytes) -> bytes:
    return bytes(120 if c in members else 32 for c in range(256))


_HEX_MASK = _mask(_DIGITS + b"abcdef")
_RANDOM_MASK = _mask(_DIGITS + _LOWER + _UPPER + b"+/_=-")

Part = tuple[int, int, int]


def certain_parts(plain: bytes) -> list[Part]:
    """(start, kind, end) of the certain secrets. ``plain`` has one byte per character, ``?`` for all that is not ASCII."""
    found = []
    low = plain.lower()
    if any(word in low for word in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(plain) if m.end(2) - m.start(2) >= FEWEST["assign"]]
    if b"AKIA" in plain:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(plain) if m.end() - m.start() >= FEWEST["access"]]
    # A run shorter than the pattern's fewest characters holds no match, so looking for runs is enough.
    if b"x" * 24 in plain.translate(_HEX_MASK):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(plain)]
    return sorted(found)


def _looks_random(piece: bytes) -> bool:
    if not all(any(c in group for c in piece) for group in (_DIGITS, _LOWER, _UPPER)):
        return False
    return -sum(n / len(piece) * math.log2(n / len(piece)) for n in Counter(piece).values()) >= UNNAMED_BITS


def uncertain_parts(plain: bytes, certain: list[Part]) -> list[Part]:
    """(start, kind, end) of what may be part of a credential, apart from the certain secrets and from each other."""
    found = []
    if b":" in plain or b"=" in plain:
        found += [(m.start(1), 3, m.end(1)) for m in _NAMES.finditer(plain)]
        found += [(m.start(1), 5, m.end(1)) for m in _HOSTS.finditer(plain)]
    if b"://" in plain:
        for m in _ADDRESS.finditer(plain):
            found += [(m.start(k), kind, m.end(k)) for k, kind in ((1, 3), (2, 4), (3, 5)) if m.group(k)]
    found += [(m.start(), 3, m.end()) for m in _TEMPORARY.finditer(plain)]
    if b"x" * UNNAMED_CHARS in plain.translate(_RANDOM_MASK):
        found += [(m.start(), 4, m.end()) for m in _RANDOM.finditer(plain) if _looks_random(m.group())]
    starts, ends = [s for s, _, _ in certain], sorted(e for _, _, e in certain)
    kept, free = [], 0
    for start, kind, end in sorted(found):
        # Begun before its end, and not ended by its start: some certain secret overlaps it.
        if start >= free and bisect_right(starts, end - 1) == bisect_right(ends, start):
            kept.append((start, kind, end))
            free = end
    return kept


def extracted(docs: DataFrame, text: str = "text", carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``_parts``: (start, kind, end, scope) of every part of a text (lazy)."""
    names = carried(docs, carry, ())
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(text).alias("_text"))
    columns = [*rows.columns[:-1], "_parts"]
    part = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())])

    def parts(text: str | None) -> list[tuple[int, int, int, int]]:
        plain = (text or "").encode("ascii", "replace")
        certain = certain_parts(plain)
        found = sorted(certain + uncertain_parts(plain, certain))
        breaks = [m.start() for m in _BREAK.finditer(plain)] if found else []
        return [(start, kind, end, bisect_right(breaks, start)) for start, kind, end in found]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in small_batches(batches, "_text", 8 << 20):
            found = pa.array([parts(t) for t in batch.column(len(names)).to_pylist()], pa.list_(part))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], found], names=columns)

    kept = rows.drop("_text").schema.simpleString().removeprefix("struct<").removesuffix(">")
    schema = ", ".join(filter(None, [kept, "_parts array<struct<start: bigint, kind: int, end: bigint, scope: bigint>>"]))
    return rows.mapInArrow(work, schema)


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The uncertain ones of ``parts`` that a complementary part stands near.

    ``parts`` has (row, scope, start, kind, end). A secret's complements are
    identifiers and addresses, and the other way round. A part begins in one bin
    of ``reach`` characters and ends in one. Whatever has an end in either of
    these is near enough; of the bins before and after only the outermost end counts.
    """
    # Even kinds are secrets (assign, hex, unnamed) and odd ones (access, identifier, endpoint) are not.
    sides = parts.withColumn("side", F.col("kind") % 2)
    at = {name: F.floor(F.col(name) / reach) for name in ("start", "end")}
    marks = sides.select("row", "scope", "side", F.explode(F.array(*[F.struct(at[n].alias("bin"), F.col(n).alias("edge")) for n in at])).alias("m"))
    marks = marks.groupBy("row", "scope", "side", "m.bin").agg(F.min("m.edge").alias("least"), F.max("m.edge").alias("most"))
    probes = F.array(
        F.struct((at["start"] - 1).alias("bin"), (F.col("start") - reach).alias("low"), F.lit(None).cast("long").alias("high")),
        F.struct(at["start"].alias("bin"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")),
        F.struct(at["end"].alias("bin"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")),
        F.struct((at["end"] + 1).alias("bin"), F.lit(None).cast("long").alias("low"), (F.col("end") + reach).alias("high")),
    )
    uncertain = sides.filter(F.col("kind") >= CERTAIN).withColumn("wanted", 1 - F.col("side"))
    looking = uncertain.select("row", "scope", "start", "kind", "end", "wanted", F.inline(probes))
    near = (
        (looking.row == marks.row)
        & (looking.scope == marks.scope)
        & (looking.wanted == marks.side)
        & (looking.bin == marks.bin)
        & (F.coalesce(marks.most >= looking.low, F.lit(True)))
        & (F.coalesce(marks.least <= looking.high, F.lit(True)))
    )
    return looking.join(marks, near, "left_semi").select("row", "start", "kind", "end").distinct()


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_secrets(docs: DataFrame, text: str = "text", carry: Iterable[str] = ("doc_id",), reach: int = REACH) -> DataFrame:
    """The secrets of every text (several actions): counts and digest of the certain ones, and ``spans`` of all.

    Adds ``n_assign, n_access, n_hex, base_sha256, spans`` to the carried columns.
    ``base_sha256`` is of the certain spans as ``kind:start:end`` in characters, by
    start and then kind; ``spans`` is an array of (start, kind, end), the linked
    uncertain ones among them. Null and empty texts have none. Every row is a text
    of its own, repeated rows too; spans that begin together go by kind; an empty
    table gives no rows; carried columns that have the name of a result are left out.
    """
    added = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    names = carried(docs, [c for c in docs.columns if c in set(carry)], added)
    rows = extracted(docs, text, names).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "secret-parts")
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    uncertain = F.exists("_parts", lambda p: p["kind"] >= CERTAIN)
    parts = rows.filter(uncertain).select(F.col("_row").alias("row"), F.inline("_parts"))
    more = linked(parts, reach).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_more"))
    certain = F.transform(
        F.filter("_parts", lambda p: p["kind"] < CERTAIN), lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"))
    )
    # Only texts with uncertain parts meet the links; the rest passes straight through.
    met = rows.filter(uncertain).join(more, F.col("_row") == F.col("row"), "left").drop("row")
    alone = rows.filter(~uncertain).withColumn("_more", F.lit(None).cast(more.schema["_more"].dataType))
    count = [F.size(F.array_remove(F.col("_parts.kind"), F.lit(k))) for k in range(CERTAIN)]
    count = [(F.size("_parts") - n).cast("long").alias(f"n_{KINDS[k]}") for k, n in enumerate(count)]
    every = F.array_sort(F.concat(certain, F.coalesce("_more", F.array().cast(more.schema["_more"].dataType))))
    return met.unionByName(alone).select(*own, *count, F.sha2(_joined(certain), 256).alias("base_sha256"), every.alias("spans"))


def joined_spans(spans: str = "spans") -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return _joined(F.col(spans))

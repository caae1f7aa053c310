"""Document fingerprints by locally consistent parsing.

A text's UTF-8 bytes are parsed into phrases, phrases into phrases of phrases, and so on. On each level
runs of one symbol become one symbol first; deterministic coin tossing (a symbol's label: the lowest bit
in which it differs from its left neighbour, and that bit's value), repeated until labels are below
8, then makes every local maximum of the labels begin a phrase. Whether a phrase begins at a place is
thus decided by a few symbols around it, so equal substrings are parsed alike, but for their edges,
at whatever offset they stand. A phrase is named by a 64-bit hash of its symbols' names.

The signature of a text is the set of its names on levels ``LEVEL`` and above, of short texts
also on as many lower levels as bring it to ``FEW`` names. The fingerprint holds the ``SIZE`` least hashes of that set as hex; two fingerprints' likeness is
the share of the smaller sets' names that both have, 2J / (1 + J) of their estimated Jaccard index J.

The query's edited texts need the next document: rows are range-partitioned and sorted by descending id, each
row meets the next within its task, and the last row of a task meets the first of the next task's by a join of
those few rows. Nothing is gathered, and the text is shuffled once. Ranges are cut by id and by the text's beginning, so that
rows with null or equal ids do not go to one task, unless their texts begin alike.

Defined results: a null text is empty; empty texts have an empty fingerprint and likeness 1 among themselves, 0 to others; rows with
equal ids are ordered by text, null ids come last; a single row is its own next. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged
from .ranges import slice_count

LEVEL, FEW, SIZE, DIGITS = 3, 16, 64, 8
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
NULL_ID = -(2**63)
#: Code points of a text that, after its id, take part in cutting the ranges.
BEGIN = 64
#: Lowest differing bit of two bytes, twice that (for the label) by their exclusive or.
LOWEST = np.array([0] + [2 * ((x & -x).bit_length() - 1) for x in range(1, 256)], np.uint8)
BIT = np.array([[(b >> (x // 2)) & 1 for b in range(256)] for x in range(16)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(27))


def _toss_bytes(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing among labels below 256."""
    low = LOWEST[label[1:] ^ label[:-1]]
    found = np.empty_like(label)
    found[0] = label[0] & 1
    found[1:] = low + ((label[1:] >> (low >> 1)) & 1)
    found[first] = label[first] & 1
    return found


def _starts(symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places at which a phrase begins; neighbours in one text differ. first: begins of texts."""
    if symbol.dtype == np.uint8:
        label = _toss_bytes(_toss_bytes(_toss_bytes(symbol, first), first), first)
    else:
        differ = symbol[1:] ^ symbol[:-1]
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
        label = np.empty(len(symbol), np.uint8)
        label[0] = symbol[0] & np.uint64(1)
        label[1:] = (np.uint64(2) * low + ((symbol[1:] >> np.minimum(low, np.uint64(63))) & np.uint64(1))).astype(np.uint8)
        label[first] = (symbol[first] & np.uint64(1)).astype(np.uint8)
        for _ in range(3):
            label = _toss_bytes(label, first)
    peak = np.zeros(len(label), bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    after = first[first > 0]
    peak[after - 1] = False  # a text's last symbol begins no phrase, nor does the one after its first
    peak[np.minimum(first + 1, len(peak) - 1)] = False
    peak[first] = True
    return np.flatnonzero(peak)


def _named(name: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The names of the phrases that begin at ``starts``."""
    lengths = np.diff(np.append(starts, len(name)))
    place = np.arange(len(name)) - np.repeat(starts, lengths)
    inner = _mixed(name + (place.astype(np.uint64) + np.uint64(1)) * STEP)
    return _mixed(np.add.reduceat(inner, starts) ^ (lengths.astype(np.uint64) * STEP))


def signatures(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted names of each text's signature, each a number below 16 ** DIGITS."""
    sizes = np.array([len(t) for t in texts])
    found: list[list[np.ndarray]] = [[] for _ in texts]
    owner = np.flatnonzero(sizes)
    if not len(owner):
        return [np.zeros(0, np.uint32)] * len(texts)
    symbol: np.ndarray = np.frombuffer(b"".join(texts), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes[owner])[:-1]])
    level = 0
    while True:
        new = np.empty(len(symbol), bool)
        new[0] = True
        new[1:] = symbol[1:] != symbol[:-1]
        new[first] = True
        runs = np.flatnonzero(new)
        lengths = np.diff(np.append(runs, len(symbol)))
        symbol = symbol[runs]
        first = np.searchsorted(runs, first)
        name = _mixed(symbol.astype(np.uint64) * STEP + lengths.astype(np.uint64) + np.uint64(level << 40))
        starts = _starts(symbol, first)
        symbol = _named(name, starts)
        first = np.searchsorted(starts, first)
        level += 1
        counts = np.diff(np.append(first, len(symbol)))
        over = counts == 1  # this text is one phrase now
        for k in range(len(owner)):
            found[owner[k]].append(symbol[first[k] : first[k] + counts[k]])
        if over.all():
            break
        keep = ~over
        symbol, owner = symbol[np.repeat(keep, counts)], owner[keep]
        first = np.concatenate([[0], np.cumsum(counts[keep])[:-1]])
    return [_signature(levels) for levels in found]


def _signature(levels: list[np.ndarray]) -> np.ndarray:
    if not levels:
        return np.zeros(0, np.uint32)
    lowest = min(LEVEL, len(levels)) - 1
    while lowest and sum(map(len, levels[lowest:])) < FEW:
        lowest -= 1
    names = _mixed(np.concatenate(levels[lowest:]))
    return np.unique((names >> np.uint64(64 - 4 * DIGITS)).astype(np.uint32))


def fingerprint_bytes(signature: np.ndarray) -> bytes:
    """The least SIZE names, big-endian."""
    return signature[:SIZE].astype(f">u{DIGITS // 2}").tobytes()


def fingerprint_text(signature: np.ndarray) -> str:
    return fingerprint_bytes(signature).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness (0 to 1) of two fingerprints, each at most SIZE least names, sorted."""
    a, b = a[:SIZE], b[:SIZE]
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SIZE]  # the least of the union; a sketch knows all of its own among them
    common = np.intersect1d(np.intersect1d(a, b, True), both, True)
    jaccard = len(common) / len(both)
    return 2 * jaccard / (1 + jaccard)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(ids: list[int], texts: list[str], following: list[str]) -> pa.RecordBatch:
    """The result rows of documents and their next ones."""
    changed = [edited(t, f).encode() for t, f in zip(texts, following, strict=True)]
    nexts = following[-1:] if following[:-1] == texts[1:] else following
    own = signatures([t.encode() for t in texts] + [t.encode() for t in nexts])
    own, after = own[: len(texts)], own[1:] if len(nexts) == 1 else own[len(texts) :]
    other = signatures(changed)
    rows = [
        [None if i == NULL_ID else i for i in ids],
        [len(t) for t in texts],
        [hashlib.sha256(c).hexdigest() for c in changed],
        [fingerprint_bytes(s) for s in own],
        [fingerprint_bytes(s) for s in other],
        [likeness(a, b) for a, b in zip(own, other, strict=True)],
        [likeness(a, b) for a, b in zip(own, after, strict=True)],
    ]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(rows, FIELDS, strict=True)], names=[n for n, _ in FIELDS])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row: the plain operator, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            own = signatures([t or b"" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint_text(s) for s in own])], names=["doc_id", "fingerprint"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def in_order(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``key`` (null: the least) and ``text`` by descending id and text, in slices."""
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("key")
    rows = docs.select(key, F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    begin = F.substring("text", 1, BEGIN).desc()  # in text order too, but short enough to be sampled
    return rows.repartitionByRange(slice_count(docs), F.desc("key"), begin).sortWithinPartitions(F.desc("key"), F.desc("text"))


def edited_likeness(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and likeness to these and to the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, begun = TaskContext.get().partitionId(), [], [], False
        for batch in slices(batches, "text", 1 << 20):
            if not begun and batch.num_rows:
                yield edge(part, "first", batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
                begun = True
            ids, texts = ids + batch.column(0).to_pylist(), texts + batch.column(1).to_pylist()
            if len(ids) > 1:
                yield whole(compared(ids[:-1], texts[:-1], texts[1:]))
                ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield edge(part, "last", ids[0], texts[0])

    def edge(part: int, kind: str, doc: int, text: str) -> pa.RecordBatch:
        values = [None] * len(FIELDS)
        arrays = [pa.array([v], t) for v, (_, t) in zip(values, FIELDS, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part], pa.int64()), pa.array([doc], pa.int64()), pa.array([text]), *arrays], names=["edge", "part", "key", "text", *(n for n, _ in FIELDS)])

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        lead = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
        return pa.RecordBatch.from_arrays([*lead, *batch.columns], names=["edge", "part", "key", "text", *batch.schema.names])

    done = staged(in_order(docs, id_column, text_column).mapInArrow(run, f"edge string, part long, key long, text string, {SCHEMA}"), "parsed")
    # one first and one last row a task: numbered in order, the last of one meets the first of the next
    order = Window.orderBy("part")
    heads = done.where("edge = 'first'").select("part").withColumn("nth", F.row_number().over(order) - 1)
    n = heads.count()
    firsts = done.where("edge = 'first'").select("part", F.col("text").alias("following")).join(heads, "part")
    firsts = firsts.select(F.pmod(F.col("nth") - 1, F.lit(max(1, n))).alias("nth"), "following")
    lasts = done.where("edge = 'last'").select("part", "key", "text").join(heads, "part").select("nth", "key", "text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, following = (batch.column(c)[i].as_py() for c in range(3))
                yield compared([doc], [text], [following])

    met = lasts.join(firsts, "nth").select("key", "text", "following").mapInArrow(finish, SCHEMA)
    found = done.where("edge IS NULL").drop("edge", "part", "key", "text").union(met)
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})

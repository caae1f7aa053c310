"""SimHash near-duplicates: fingerprints linked by few differing bits, and their components.

Finding links: a 64-bit fingerprint is cut into segments of 4 bits and mapped to its point of 16
bit counts. The Manhattan distance of two points is a lower bound of the differing bits, so pairs
within ``max_bits`` lie within ``max_bits`` on the grid of points, and some grid cell lies within half
that of both. Every *distinct* fingerprint goes to the cells within that radius; fingerprints
meeting in a cell are compared bit by bit, and only a spanning forest of a cell's links is handed on.

A crowded cell (very many near copies) is not compared pair by pair: its fingerprints go, exactly,
to all bit patterns within half of ``max_bits`` instead. Fingerprints that meet at a pattern are
within ``max_bits`` of each other, and every linked pair meets at one; such a group has at most 65
members for 2 bits.

Defined results: A-Z are lower-cased and words are runs of other than ASCII white space; fewer words than the
shingle length make one shingle of all words; no words (or a null text) give fingerprint zero,
linked like any other. Repeated rows and rows with equal ids are fingerprinted one by one; a null id is
ignored as a smallest id (a component of null ids alone has a null id). Ids are integers. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import fresh, slices, staged
from .components import connected

SEED, SEGMENT, SEGMENTS = 42, 4, 16
WEIGHTS = (SEGMENT + 1) ** np.arange(SEGMENTS, dtype=np.int64)
#: Shingles whose bits are counted at a time; members from which a cell counts as crowded.
CHUNK, CROWDED = 65536, 512


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of a text: a bit is set if over half of the shingles' XXH64 have it."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space alone
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    total, counts = len(words) - shingle + 1, np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        hashes = [xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` (of the exact text) and ``fp`` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            fps = np.array([fingerprint(t or b"", shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _offsets(radius: int) -> np.ndarray:
    """All steps on the grid of at most ``radius`` in sum."""
    steps = {(0,) * SEGMENTS}
    for n in range(1, radius + 1):
        for axes in combinations_with_replacement(range(SEGMENTS), n):
            for signs in range(1 << n):
                v = [0] * SEGMENTS
                for i, axis in enumerate(axes):
                    v[axis] += 1 if signs >> i & 1 else -1
                steps.add(tuple(v))
    return np.array(sorted(steps), np.int8)


def cells_of(fps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, cell) of all cells within the offsets of each fingerprint's point."""
    nibbles = np.stack([fps >> np.uint64(4 * i) & np.uint64(15) for i in range(SEGMENTS)], 1)
    counts = np.bitwise_count(nibbles).astype(np.int8)
    near = counts[:, None, :] + offsets[None]
    inside = ((near >= 0) & (near <= SEGMENT)).all(axis=2)
    codes = (counts.astype(np.int64) @ WEIGHTS)[:, None] + (offsets.astype(np.int64) @ WEIGHTS)[None]
    return np.nonzero(inside)[0], codes[inside]


def patterns_of(fps: np.ndarray, radius: int) -> np.ndarray:
    """All bit patterns within ``radius`` bits of each fingerprint (rows)."""
    masks = {0}
    for _ in range(radius):
        masks |= {m ^ (1 << b) for m in masks for b in range(64)}
    return fps[:, None] ^ np.array(sorted(masks), np.uint64)[None]


def _forest(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among rows of one cell; rows are sorted by cell."""
    index, left, right = np.arange(len(cell)), [], []
    for step in range(1, len(cell)):
        index = index[index + step < len(cell)]
        index = index[cell[index] == cell[index + step]]
        if not len(index):
            break
        linked = index[np.bitwise_count(fp[index] ^ fp[index + step]) <= max_bits]
        left.append(linked)
        right.append(linked + step)
    if not left:
        return fp[:0], fp[:0]
    a, b, label = np.concatenate(left), np.concatenate(right), np.arange(len(cell))
    while True:
        low = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        np.minimum.at(now, label, now)
        now = now[now]
        if (now == label).all():
            break
        label = now
    moved = np.flatnonzero(label != np.arange(len(cell)))
    return fp[moved], fp[label[moved]]


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(u, v): edges among the distinct fingerprints ``fp`` with the components of all links."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits is an even number")
    radius = max_bits // 2
    offsets = _offsets(radius)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                row, cell = cells_of(fps[at : at + 4096], offsets)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fps[at + row].view(np.int64))], names=["cell", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if not len(cell):
                continue
            whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            yield edges(*_forest(cell[:whole], fp[:whole], max_bits))
            cell, fp = cell[whole:], fp[whole:]
        yield edges(*_forest(cell, fp, max_bits))

    def edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                pattern = patterns_of(fps[at : at + 4096], radius)
                yield edges(pattern.reshape(-1), np.repeat(fps[at : at + 4096], pattern.shape[1]))

    cells = distinct.select("fp").mapInArrow(spread, "cell long, fp long")
    crowded = staged(cells.groupBy("cell").count().where(F.col("count") > CROWDED).select("cell"), "crowded")
    calm = cells.join(crowded, "cell", "left_anti").repartition("cell").sortWithinPartitions("cell")
    found = calm.mapInArrow(compare, "u long, v long")
    met = cells.join(crowded, "cell", "left_semi").select("fp").distinct().mapInArrow(around, "pattern long, fp long")
    least = met.select("fp", F.min("fp").over(Window.partitionBy("pattern")).alias("v")).where("fp != v")  # at most 65 members for 2 bits
    return found.union(least.select(F.col("fp").alias("u"), "v"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable) and text_hash."""
    rows = staged(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    rooted = staged(connected(links(distinct, max_bits)), "roots")
    known = distinct.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    known = staged(known, "rooted-fingerprints")
    least = staged(known.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = staged(known.join(least, "root").select("fp", "component_id"), "components")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id", "text_hash")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id.

    Of repeated rows (equal id and text) one stays; rows whose component has only null ids stay once for each text."""
    found = near_duplicates(docs, shingle, max_bits, id_column, text_column)
    kept = staged(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct(), "kept")
    own_hash, nth = fresh(docs, "__text_hash"), fresh(docs, "__nth")
    kept = kept.withColumnsRenamed({"kept_id": fresh(docs, "kept_id"), "kept_hash": fresh(docs, "kept_hash")})
    mine = docs.withColumn(own_hash, F.xxhash64(text_column))
    stay = mine.join(kept, mine[id_column].eqNullSafe(kept[kept.columns[0]]) & (mine[own_hash] == kept[kept.columns[1]]), "left_semi")
    one = Window.partitionBy(id_column, own_hash).orderBy(own_hash)
    return stay.withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1).select(*docs.columns)

"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A document leaks an item if it holds, within ``edit_rate`` edits, some stretch of ``stretch`` characters of the item
(the whole item if it is shorter). Such a stretch of L characters with at most e edits keeps at
least ``L - q + 1 - q * e`` of its q-grams, on diagonals (place in the document less place in the item) that span
at most e. So the documents' q-grams are looked up among the items', the hits are
counted in bands of 2e diagonals, one every e, and stretches of an item with too few hits
in a band are out. The rest are aligned in the band, for all their starts at once, and kept if the edits are in the budget.

Texts are compared as characters with A-Z lower-cased; a run of ASCII white space is one space, and of a run of another character
that is no letter or digit the first ``RUN`` count, so that indents and rules match as one and a text of them has few hits; places are
given in the text as it is.
Hits are met in portions of ``MOST_HITS`` at most, by documents and then by items.
The benchmark is the stated query set: it is held by every task in blocks of at most ``block_chars``
characters, and a larger benchmark takes one pass over the documents for each block.

An item of fewer than ``least_item`` characters, for which q-grams of that length are too long, takes shorter ones: with a budget of e
edits one of its e + 1 disjoint parts stands unchanged (q = floor(L / (e + 1)) keeps the bound at one), and the whole item is
aligned around each. Where its budget is no edit at all it is leaked where it stands whole between word ends (letters
and digits of scripts that space their words). At its edges white space does not count.

Defined results: null and empty texts leak nothing; items with null text or without a letter or digit are no evidence if so short, and
are left out; repeated rows and equal or null ids are judged row by row; an item that occurs in several places of a document
gives a row for each; an empty benchmark leaks nothing. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

Q, STRETCH, EDIT_RATE, LEAST_ITEM = 10, 80, 0.0625, 20
BLOCK_CHARS, CHUNK_BYTES, SIEVE_BITS, MOST_HITS, RUN = 4_000_000, 1 << 20, 22, 1 << 21, 3
LOWER = np.arange(128, dtype=np.uint32)
LOWER[65:91] += 32
LOWER[9:14] = 32


def characters(text: str) -> np.ndarray:
    """Code points as they are compared."""
    found = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(found < 128, LOWER[np.minimum(found, 127)], found)


def compared(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The characters that are compared, and the place of each in the text (and the text's end)."""
    codes = characters(text)
    at = np.arange(len(codes))
    if len(codes):
        begins = np.concatenate([[True], codes[1:] != codes[:-1]])
        nth = at - np.maximum.accumulate(np.where(begins, at, 0))
        kinds, of = np.unique(codes, return_inverse=True)
        most = np.array([1 if c == 32 else len(codes) if chr(c).isalnum() else RUN for c in kinds.tolist()])
        at = at[nth < most[of]]
    return codes[at], np.append(at, len(codes))


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit name of the q-gram at each place."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    step, total = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(codes) - q + 1, np.uint64)
    for i in range(q):
        total = total * step + codes[i : len(codes) - q + 1 + i]
    return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def band_edits(item: np.ndarray, text: np.ndarray, starts: np.ndarray, length: int, low: int, high: int) -> np.ndarray:
    """For each start: least edits of item[start : start + length] against text, on diagonals low..high.

    The alignment may begin and end on any diagonal of the band."""
    width = high - low + 1
    column = np.arange(width)
    cost = np.zeros((len(starts), width), np.int32)
    padded = np.concatenate([text, np.array([0xFFFFFFFF], np.uint32)])
    for k in range(length):
        place = (starts + k)[:, None] + low + column[None]
        inside = (place >= 0) & (place < len(text))
        same = padded[np.where(inside, place, len(text))] == item[starts + k][:, None]
        through = cost + ~same
        skipped = np.full_like(cost, 1 << 20)  # the item's character left out: one diagonal lower
        skipped[:, :-1] = cost[:, 1:] + 1
        now = np.minimum(through, skipped)
        cost = np.minimum.accumulate(now - column, axis=1) + column  # characters of the text left out
    return cost.min(axis=1)


@dataclass
class Items:
    """A block of the benchmark with its q-gram index: sorted names, and item and place of each."""

    ids: list
    codes: list[np.ndarray]
    names: np.ndarray
    item: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    #: By size, the items that are met whole: sorted names, characters and item of each.
    short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple], least_item: int = LEAST_ITEM) -> Items:
        rows = [(i, compared(t.strip())[0], t) for i, t in rows if t is not None]
        brief = [(i, c) for i, c, t in rows if len(c) < least_item and any(x.isalnum() for x in t)]
        rows = [(i, c) for i, c, _ in rows if len(c) >= least_item]
        codes = [c for _, c in rows]
        own = [grams(c) for c in codes]
        names = np.concatenate([*own, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(own)), [len(g) for g in own])
        place = np.concatenate([*(np.arange(len(g)) for g in own), np.zeros(0, int)])
        order = np.argsort(names, kind="stable")
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[names >> np.uint64(64 - SIEVE_BITS)] = True
        short = {}
        for size in {len(c) for _, c in brief}:
            at = np.array([k for k, (_, c) in enumerate(brief) if len(c) == size])
            own_names = np.concatenate([grams(brief[k][1], size) for k in at])
            own_order = np.argsort(own_names, kind="stable")
            short[size] = own_names[own_order], np.stack([brief[k][1] for k in at[own_order]]), len(rows) + at[own_order]
        return cls([i for i, _ in [*rows, *brief]], codes, names[order], item[order], place[order], sieve, short)


def _windows(places: np.ndarray, size: int, length: int, least: int) -> np.ndarray:
    """Starts of item stretches with at least ``least`` hit q-gram places."""
    hit = np.zeros(size + 1, np.int64)
    hit[places + 1] = 1
    seen = np.cumsum(hit)
    starts = np.arange(size - length + 1)
    return starts[seen[starts + length - Q + 1] - seen[starts] >= least]


def _met(names: np.ndarray, at: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, entry of ``known``) for all equal names at the places ``at``."""
    first, last = (np.searchsorted(known, names[at], side) for side in ("left", "right"))
    many = last - first
    at, first, many = at[many > 0], first[many > 0], many[many > 0]
    if not len(at):
        return at, first
    return np.repeat(at, many), np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())


def _aligned(text: np.ndarray, letters: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each item against the text around ``at`` (where its first character would be), within first..last: least edits, and start and end there.

    Starts and ends are taken at the place of fewest edits, nearest to the item's own length."""
    offs = np.arange(-edits, edits + 1)
    cost, start = np.zeros((len(at), len(offs)), np.int32), np.broadcast_to(offs, (len(at), len(offs))).copy()
    padded = np.append(text, np.uint32(0xFFFFFFFF))
    for k in range(letters.shape[1]):
        place = at[:, None] + k + offs
        inside = (place >= first[:, None]) & (place < last[:, None])
        through = cost + ~(padded[np.where(inside, place, len(text))] == letters[:, k : k + 1])
        skipped = np.full_like(cost, 1 << 20)  # the item's character left out: one diagonal lower
        skipped[:, :-1] = cost[:, 1:] + 1
        begun = start.copy()
        begun[:, :-1] = np.where(skipped[:, :-1] < through[:, :-1], start[:, 1:], start[:, :-1])
        cost, start = np.minimum(through, skipped), begun
        for j in range(1, len(offs)):  # characters of the text left out
            better = cost[:, j - 1] + 1 < cost[:, j]
            cost[:, j] = np.where(better, cost[:, j - 1] + 1, cost[:, j])
            start[:, j] = np.where(better, start[:, j - 1], start[:, j])
    best = (cost * 100 + np.abs(offs)).argmin(axis=1)
    row = np.arange(len(at))
    return cost[row, best], np.maximum(at + start[row, best], first), np.minimum(at + letters.shape[1] + offs[best], last)


def _whole(text: np.ndarray, base: np.ndarray, items: Items, edit_rate: float) -> list[tuple]:
    """The places of the short items, as in ``leaks``."""
    found: list[tuple] = []
    if not items.short:
        return found
    kinds, of = np.unique(text, return_inverse=True)
    word = np.array([c < 0xE00 and chr(c).isalnum() for c in kinds.tolist()], bool)[of]  # scripts from Thai on: mostly no spaces
    for size, (known, letters, item) in items.short.items():
        edits = int(size * edit_rate)
        if edits:
            found += _parts(text, base, letters, item, edits)
            continue
        names = grams(text, size)
        at, entry = _met(names, np.arange(len(names)), known)
        row, end = np.searchsorted(base, at, "right") - 1, at + size
        good = end <= base[row + 1]
        good &= (at == base[row]) | ~word[at - 1] | ~word[at]
        good &= (end >= base[row + 1]) | ~word[np.minimum(end, len(text) - 1)] | ~word[end - 1]
        good &= (text[at[:, None] + np.arange(size)] == letters[entry]).all(axis=1)
        at, row, entry = at[good], row[good], entry[good]
        found += [(r, k, a, a + size, 0) for r, k, a in zip(row.tolist(), item[entry].tolist(), (at - base[row]).tolist(), strict=True)]
    return found


def _parts(text: np.ndarray, base: np.ndarray, letters: np.ndarray, item: np.ndarray, edits: int) -> list[tuple]:
    """The places of short items of one size with up to ``edits`` edits."""
    found: set[tuple] = set()
    q = letters.shape[1] // (edits + 1)
    names = grams(text, q)
    for part in range(edits + 1):
        own = np.concatenate([grams(row[part * q : (part + 1) * q], q) for row in letters])
        order = np.argsort(own, kind="stable")
        at, entry = _met(names, np.arange(len(names)), own[order])
        row = np.searchsorted(base, at, "right") - 1
        inside = at + q <= base[row + 1]
        at, entry, row = at[inside], order[entry[inside]], row[inside]
        for lo in range(0, len(at), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            cost, start, end = _aligned(text, letters[entry[s]], at[s] - part * q, base[row[s]], base[row[s] + 1], edits)
            for k in np.flatnonzero((cost <= edits) & (end > start)).tolist():
                r = int(row[s][k])
                found.add((r, int(item[entry[s][k]]), int(start[k] - base[r]), int(end[k] - base[r]), int(cost[k])))
    return list(found)


def leaks(texts: list[str], items: Items, stretch: int = STRETCH, edit_rate: float = EDIT_RATE) -> list[tuple]:
    """(row, item index, start and end in the text, least edits) of every leak."""
    both = [compared(t) for t in texts]
    codes, places = [c for c, _ in both], [p for _, p in both]
    if not items.ids or not codes:
        return []
    base = np.cumsum([0] + [len(c) for c in codes])
    text = np.concatenate(codes)
    merged: list[tuple] = []
    found = _whole(text, base, items, edit_rate) + _edited(codes, text, base, items, stretch, edit_rate)
    for one in sorted((r, k, int(places[r][a]), int(places[r][b - 1]) + 1, e) for r, k, a, b, e in found):
        if merged and merged[-1][:2] == one[:2] and one[2] < merged[-1][3]:
            before = merged.pop()
            one = (*one[:2], before[2], max(before[3], one[3]), min(before[4], one[4]))
        merged.append(one)
    return merged


def _edited(codes: list[np.ndarray], text: np.ndarray, base: np.ndarray, items: Items, stretch: int, edit_rate: float) -> list[tuple]:
    """The places of the other items, some of them twice."""
    names = grams(text)
    maybe = np.flatnonzero(items.sieve[names >> np.uint64(64 - SIEVE_BITS)])
    row = np.searchsorted(base, maybe, "right") - 1
    maybe, row = maybe[maybe + Q <= base[row + 1]], row[maybe + Q <= base[row + 1]]  # not over a text's end
    first, last = (np.searchsorted(items.names, names[maybe], side) for side in ("left", "right"))
    by_row = np.bincount(row, weights=last - first, minlength=len(codes))
    found: list[tuple] = []
    portion, of = np.floor(np.cumsum(by_row) / MOST_HITS), row
    for p in np.unique(portion[of]) if len(of) else ():
        some = portion[of] == p
        hits = int((last - first)[some].sum())
        lots = max(1, -(-hits // MOST_HITS))  # of one text's hits, by items
        for lot in range(lots):
            mine = np.flatnonzero(items.item % lots == lot) if lots > 1 else slice(None)
            at, entry = _met(names, maybe[some], items.names[mine])
            entry = mine[entry] if lots > 1 else entry
            if len(at):
                found += _banded(codes, base, items, at, entry, stretch, edit_rate)
    return found


def _banded(codes: list[np.ndarray], base: np.ndarray, items: Items, at: np.ndarray, entry: np.ndarray, stretch: int, edit_rate: float) -> list[tuple]:
    """The places that hits (place in the text, entry of the index) lead to; all hits of a text with an item are there."""
    row = np.searchsorted(base, at, "right") - 1
    item, place = items.item[entry], items.place[entry]
    sizes = np.array([len(c) for c in items.codes])
    length = np.minimum(stretch, sizes)
    edits = np.floor(length * edit_rate).astype(int)
    least = np.maximum(1, length + 1 - Q * (edits + 1))
    half = np.maximum(1, edits[item])
    band = (at - place) // half
    # bands of two halves, one half apart, so that any e + 1 diagonals in a row lie in one of them
    row, item, place, at = (np.concatenate([v, v]) for v in (row, item, place, at))
    band = np.concatenate([band, band - 1])
    order = np.lexsort((place, band, item, row))
    r, i, b, p, x = row[order], item[order], band[order], place[order], at[order]
    cut = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])]))
    ends = np.append(cut[1:], len(r))
    enough = (ends - cut) >= least[i[cut]]
    found = []
    for s, e in zip(cut[enough].tolist(), ends[enough].tolist(), strict=True):
        k = int(i[s])
        starts = _windows(p[s:e], int(sizes[k]), int(length[k]), int(least[k]))
        if not len(starts):
            continue
        own, step = codes[r[s]], max(1, int(edits[k]))
        low = int(b[s]) * step - int(base[r[s]])
        cost = band_edits(items.codes[k], own, starts, int(length[k]), low - step, low + 3 * step)
        good = starts[cost <= edits[k]]
        if len(good):
            held = (p[s:e] >= good[0]) & (p[s:e] < good[-1] + length[k])
            places = x[s:e][held] - base[r[s]]
            found.append((int(r[s]), k, int(places.min()), int(places.max()) + Q, int(cost.min())))
    return found


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, block_chars: int) -> Iterator[Items]:
    """The benchmark as blocks of bounded size, one at a time."""
    rows = benchmark.select(F.col(id_column).alias("item_id"), F.col(text_column).alias("text")).where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == block).collect()
        yield Items.of(sorted(((r["item_id"], r["text"]) for r in part), key=str))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end (characters of the text) and edits of every leak."""
    spark = docs.sparkSession
    kinds = docs.schema[id_column].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start long, end long, edits long"
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def one(items: Items) -> DataFrame:
        held = spark.sparkContext.broadcast(items)  # bounded by block_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", CHUNK_BYTES):
                got = leaks([t or "" for t in batch.column(1).to_pylist()], held.value)
                if got:
                    row, item, start, end, edits = zip(*got, strict=True)
                    ids = pa.array([held.value.ids[i] for i in item])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), ids, *(pa.array(v, pa.int64()) for v in (start, end, edits))], names=["doc_id", "item_id", "start", "end", "edits"])

        return rows.mapInArrow(run, schema)

    return reduce(DataFrame.union, [one(items) for items in _blocks(benchmark, item_column, item_text, block_chars)])


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns unchanged."""
    at, schema, spark = docs.columns.index(text_column), docs.schema, docs.sparkSession
    for items in _blocks(benchmark, item_column, item_text, block_chars):
        held = spark.sparkContext.broadcast(items)  # bounded by block_chars

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_column, CHUNK_BYTES):
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in leaks([t or "" for t in batch.column(at).to_pylist()], held.value)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs

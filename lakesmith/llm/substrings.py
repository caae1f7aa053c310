"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document; a word is removed if it is covered by a window whose word sequence
also starts in a document with a smaller id. The minimiser of a window is the least hash among its
runs of ``SEED_WORDS`` words, so equal windows have equal minimisers. Consecutive windows that share
one travel as one packed string (their words, one space between) to the minimiser's bucket. There the
windows of those minimisers that several packed strings share are sorted, equal ones meet, and the least id of each
is known exactly, from the words themselves.

A task sends a block of documents' packed strings to a bucket as one compressed row; a string that occurs
more than once in the block is sent once, with its occurrences. A string with over ``HOT`` occurrences in a block
(a passage of a large share of all documents) is sent with its least id alone; its occurrences stay apart: the same reading
of the texts deals them over all buckets, and they meet the string's verdict in a join on its digest, which Spark splits over tasks. No task thus
gets all occurrences of a common passage. The verdicts on occurrences come back as word ranges by document.

Defined results: words are runs of other than ASCII white space, unchanged; null texts have none, and texts of
fewer than ``window`` words lose none. Rows with equal ids are one document: they do not remove each other's windows,
so repeated rows get equal results. Rows with null ids neither remove nor lose words. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc, fresh, give_back, slices, staged
from .ranges import slice_count

WINDOW, SEED_WORDS = 13, 3
#: Text bytes of a block, occurrences from which a string's go apart, buckets for a shuffle partition, windows of a string.
BLOCK_BYTES, HOT, SPREAD, LONGEST = 4 << 20, 64, 4, 1024
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
CODEC = pa.Codec("zstd", compression_level=5)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(27))


def word_places(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts joined by one space, each word's start and end in that, and its text's number."""
    raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(np.concatenate([[1], sizes[:-1] + 1])) if len(sizes) else np.zeros(0, int)
    space = SPACE[raw]
    keep = ~space
    keep[1:] |= ~space[:-1]  # one space after each word
    packed = raw[keep]
    solid = ~space[keep]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    at_raw = np.flatnonzero(keep)[starts]
    return np.where(solid, packed, 32).astype(np.uint8).tobytes(), starts, ends, np.searchsorted(begins, at_raw, "right") - 1


def word_hashes(packed: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, of its bytes alone."""
    raw, lengths = np.frombuffer(packed, np.uint8), ends - starts
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(first, lengths)
    letters = raw[np.repeat(starts, lengths) + place].astype(np.uint64)
    return _mixed(np.add.reduceat(_mixed((letters + np.uint64(1)) * STEP + place.astype(np.uint64)), first) + lengths.astype(np.uint64))


def super_kmers(texts: list[bytes], window: int = WINDOW) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words as bytes, byte start, byte end, minimiser, text number, first word) of every super-k-mer."""
    packed, starts, ends, owner = word_places(texts)
    n = len(starts) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return packed, none, none, none.astype(np.uint64), none, none
    word = word_hashes(packed, starts, ends)
    seed_words = min(SEED_WORDS, window)
    seeds = np.zeros(len(word) - seed_words + 1, np.uint64)
    for i in range(seed_words):
        seeds = _mixed(seeds * STEP + word[i : len(word) - seed_words + 1 + i])
    span, have, least = window - seed_words + 1, 1, seeds
    while have < span:  # sliding minimum by doubling
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    valid = owner[:n] == owner[window - 1 :]
    same = valid[1:] & valid[:-1] & (least[1:] == least[:-1]) & (owner[1:n] == owner[: n - 1])
    begin = np.flatnonzero(valid & ~np.concatenate([[False], same]))
    end = np.flatnonzero(valid & ~np.concatenate([same, [False]]))
    pieces = (end - begin) // LONGEST + 1  # of a text that repeats a few words, a run may be as long as the text
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end = np.repeat(begin, pieces) + nth * LONGEST, np.repeat(end, pieces)
        end = np.minimum(end, begin + LONGEST - 1)
    first_word = np.searchsorted(owner, owner[begin])
    return packed, starts[begin], ends[end + window - 1], least[begin], owner[begin], begin - first_word


def window_places(packed: bytes, window: int) -> list[bytes]:
    """The windows of a packed string, in order."""
    words = packed.split(b" ")
    return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]


def least_ids(strings: dict[bytes, int], window: int = WINDOW) -> dict[bytes, list[int]]:
    """For packed strings of one minimiser, with the least id of each: the least id of each of their windows."""
    rows = sorted((w, owner, p, i) for p, owner in strings.items() for i, w in enumerate(window_places(p, window)))
    found = {p: [0] * (p.count(b" ") + 2 - window) for p in strings}
    last, least = None, 0
    for w, owner, p, i in rows:  # of equal windows, the least id comes first
        if w != last:
            last, least = w, owner
        found[p][i] = least
    return found


def _squeeze(data: bytes) -> bytes:
    return CODEC.compress(data, asbytes=True)


def _loosen(data: bytes, size: int) -> bytes:
    return CODEC.decompress(data, size, asbytes=True)


def covered(start: int, least: list[int], own: int, window: int) -> Iterator[tuple[int, int]]:
    """Ranges of words (from, to) that the windows with a smaller least id cover."""
    lo = hi = -1
    for i, other in enumerate(least):
        if other < own:
            if lo >= 0 and start + i <= hi:
                hi = start + i + window
            else:
                if lo >= 0:
                    yield lo, hi
                lo, hi = start + i, start + i + window
    if lo >= 0:
        yield lo, hi


PACKED = "bucket long, strings binary, sizes binary, seeds binary, leasts binary, hot binary, string_of binary, doc_of binary, start_of binary, raw_size long, n_calm long, n_known long, digest binary"
RANGES = "doc_id long, text_hash long, lo int, hi int, digest binary, least array<long>, doc_of binary, start_of binary, n_calm long"


def removed_ranges(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, lo, hi): the word ranges of every text that are covered by removed windows."""
    partitions = slice_count(docs, 3.0)  # packed strings are up to three times the stored texts
    buckets = SPREAD * partitions
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).cast("binary").alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)], 1)
            words, start, end, seed, text, first = super_kmers(batch.column(2).to_pylist(), window)
            bucket = (_mixed(seed) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield from bucket_rows(int(bucket[order[a]]), words, order[a:b], start, end, seed, ids[text], first)

    def bucket_rows(bucket: int, words: bytes, at: np.ndarray, start, end, seed, ids, first) -> Iterator[pa.RecordBatch]:
        """A bucket's row of packed strings, and a row for each string whose occurrences stay apart."""
        number: dict[bytes, int] = {}
        of = np.array([number.setdefault(words[s:e], len(number)) for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)])
        hot, strings = np.bincount(of, minlength=len(number)) > HOT, list(number)
        for k in np.flatnonzero(hot):
            own, digest = at[of == k], hashlib.sha256(strings[k]).digest()
            spread = crc(digest + ids[own[0]].tobytes()) % buckets  # any bucket: there the row is passed on as it is
            yield pa.RecordBatch.from_pylist([{"bucket": spread, "digest": digest, "doc_of": _squeeze(ids[own].astype("<i8").tobytes()), "start_of": _squeeze(first[own].astype("<u4").tobytes()), "n_calm": len(own)}], schema=SENT)
        least = np.full(len(number), 2**63 - 1)
        np.minimum.at(least, of, ids[at, 0])
        seeds = np.zeros(len(number), np.uint64)
        seeds[of] = seed[at]
        calm = ~hot[of]
        known, doc_of = np.unique(ids[at[calm]], axis=0, return_inverse=True)
        data = b" ".join(strings)
        yield pa.RecordBatch.from_pylist([{
            "bucket": bucket, "strings": _squeeze(data), "sizes": _squeeze(np.array([len(s) for s in strings], "<u4").tobytes()), "seeds": seeds.tobytes(),
            "leasts": _squeeze(least.astype("<i8").tobytes()), "hot": np.packbits(hot).tobytes(), "string_of": _squeeze(of[calm].astype("<u4").tobytes()),
            "doc_of": known.astype("<i8").tobytes() + _squeeze(doc_of.reshape(-1).astype("<u4").tobytes()), "start_of": _squeeze(first[at[calm]].astype("<u4").tobytes()), "raw_size": len(data), "n_calm": int(calm.sum()), "n_known": len(known),
        }], schema=SENT)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["digest"] is not None:
                    yield pa.RecordBatch.from_pylist([{c: row[c] for c in ("digest", "doc_of", "start_of", "n_calm")}], schema=FOUND)
                    continue
                if held and held[-1]["bucket"] != row["bucket"]:
                    yield from verdicts(held)
                    held = []
                held.append(row)
        if held:
            yield from verdicts(held)

    def verdicts(held: list[dict]) -> Iterator[pa.RecordBatch]:
        """The ranges of one bucket: first the strings whose minimiser others share, then their windows."""
        unpack = lambda data, n, kind: np.frombuffer(_loosen(data, n * np.dtype(kind).itemsize), kind) if n else np.zeros(0, kind)
        seeds = np.concatenate([np.frombuffer(r["seeds"], "<u8") for r in held])
        names, inverse, counts = np.unique(seeds, return_inverse=True, return_counts=True)
        shared = counts[inverse] > 1
        at, groups, parts = 0, {}, []
        for r in held:
            n = len(r["seeds"]) // 8
            sizes, least, hot = unpack(r["sizes"], n, "<u4"), unpack(r["leasts"], n, "<i8"), np.unpackbits(np.frombuffer(r["hot"], np.uint8), count=n).astype(bool)
            known_bytes = r["doc_of"]
            n_calm, n_known = r["n_calm"], r["n_known"]
            known = np.frombuffer(known_bytes, "<i8", 2 * n_known).reshape(-1, 2)
            string_of, doc_of, start_of = unpack(r["string_of"], n_calm, "<u4"), unpack(known_bytes[16 * n_known :], n_calm, "<u4"), unpack(r["start_of"], n_calm, "<u4")
            several = np.zeros(n, bool)  # in more than one document of this block
            several[string_of[known[doc_of, 0] != least[string_of]]] = True
            wanted = np.flatnonzero(shared[at : at + n] | several | hot)
            if len(wanted):
                data = _loosen(r["strings"], r["raw_size"])
                ends = np.cumsum(sizes.astype(np.int64) + 1) - 1
                texts = {int(k): data[int(ends[k]) - int(sizes[k]) : int(ends[k])] for k in wanted}
                for k, text in texts.items():
                    own = groups.setdefault(int(inverse[at + k]), {})
                    own[text] = min(own.get(text, 2**63 - 1), int(least[k]))
                parts.append((texts, string_of, known[doc_of], start_of, hot, inverse[at : at + n]))
            at += n
        found = {g: least_ids(own, window) for g, own in groups.items()}
        rows: list[tuple] = []
        told: set[bytes] = set()
        for texts, string_of, docs_of, start_of, hot, group in parts:
            for k in np.flatnonzero(np.isin(string_of, list(texts))):
                s = int(string_of[k])
                doc, text_hash = (int(v) for v in docs_of[k])
                for lo, hi in covered(int(start_of[k]), found[int(group[s])][texts[s]], doc, window):
                    rows.append((doc, text_hash, lo, hi, None, None))
                if len(rows) >= 10_000:
                    yield ranges(rows)
                    rows = []
            for s in texts:
                if hot[s] and texts[s] not in told:
                    told.add(texts[s])
                    rows.append((None, None, None, None, hashlib.sha256(texts[s]).digest(), found[int(group[s])][texts[s]]))
        if rows:
            yield ranges(rows)

    def ranges(rows: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*rows, strict=True), *[[None] * len(rows)] * 3]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, FOUND.types, strict=True)], schema=FOUND)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_calm"]
                ids, starts = np.frombuffer(_loosen(row["doc_of"], 16 * n), "<i8").reshape(-1, 2), np.frombuffer(_loosen(row["start_of"], 4 * n), "<u4")
                found = [(int(d), int(h), lo, hi, None, None) for (d, h), s in zip(ids, starts, strict=True) for lo, hi in covered(int(s), row["least"], int(d), window)]
                if found:
                    yield ranges(found)

    strings = rows.mapInArrow(send, PACKED).repartition(partitions, "bucket").sortWithinPartitions("bucket")
    judged = staged(strings.mapInArrow(judge, RANGES), "judged")
    # its bucket told a hot string's verdict once; its occurrences come in one row a block, from the same reading
    # of the texts, as another reading could cut other blocks, in which other strings are hot
    hot = judged.where("doc_of IS NOT NULL").select("digest", "doc_of", "start_of", "n_calm")
    hot = hot.join(judged.where("least IS NOT NULL").select("digest", "least"), "digest").mapInArrow(apart, RANGES)
    return judged.where("digest IS NULL").union(hot).select("doc_id", "text_hash", "lo", "hi")


FOUND = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("digest", pa.binary()), ("least", pa.list_(pa.int64())), ("doc_of", pa.binary()), ("start_of", pa.binary()), ("n_calm", pa.int64())])
SENT = pa.schema([(n, pa.int64() if t == "long" else pa.binary()) for n, t in (c.split() for c in PACKED.split(", "))])


def _lost(n: int, ranges: list[dict]) -> np.ndarray:
    gone = np.zeros(n, bool)
    for r in ranges or ():
        gone[r["lo"] : r["hi"]] = True
    return gone


def with_ranges(docs: DataFrame, window: int, id_column: str, text_column: str, held: str) -> DataFrame:
    """``docs`` with one more, last column ``held``: the removed word ranges of the row's text."""
    own_hash, other_id, other_hash = (fresh(docs, n) for n in ("__text_hash", "__id", "__hash"))
    ranges = removed_ranges(docs, window, id_column, text_column)
    ranges = staged(ranges.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("lo", "hi")).alias(held)), "removed-ranges")
    ranges = ranges.withColumnsRenamed({"doc_id": other_id, "text_hash": other_hash})
    mine = docs.withColumn(own_hash, F.xxhash64(text_column))
    met = mine.join(ranges, (mine[id_column].cast("long") == ranges[other_id]) & (mine[own_hash] == ranges[other_hash]), "left")
    return met.select(*docs.columns, held)


def removed_words(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by one space) of every row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            rows = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or b"").split()
                gone = _lost(len(words), ranges)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if ranges else words
                rows.append((len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = with_ranges(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), window, "doc_id", "text", "__ranges")
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"), "__ranges")
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """``docs`` with the removed words taken out of the texts that have any (kept words joined by one space).

    Other texts stay as they are; ``length_column``, if there, gets the new number of characters. The texts stay in the
    JVM: a text is cut to words only where some go, and each word is looked at once.
    """
    ranges, words, kept = (fresh(docs, n) for n in ("__ranges", "__words", "__kept"))
    rows = with_ranges(docs, window, id_column, text_column, ranges)
    blank = "[ \\t\\n\\x0B\\f\\r]"
    cut = F.split(F.regexp_replace(text_column, f"^{blank}+|{blank}+\\z", ""), f"{blank}+")
    rows = rows.withColumn(words, F.when(F.col(ranges).isNotNull(), cut))
    gone = F.flatten(F.transform(ranges, lambda r: F.sequence(r["lo"], r["hi"] - 1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(words) - 1), gone)
    rows = rows.withColumn(kept, F.when(F.col(words).isNotNull(), F.array_join(F.transform(stay, lambda i: F.col(words)[i]), " ")))
    new = {text_column: F.coalesce(kept, text_column)}
    if length_column in docs.columns:
        size = F.char_length(kept).cast(docs.schema[length_column].dataType)
        new[length_column] = F.coalesce(size, length_column)
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])

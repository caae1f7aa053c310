"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

A text falls into matches of a pattern; each match is merged for itself, from its bytes, always the
pair of least rank first, the leftmost of equals. A match gives the same ids wherever it stands, so
a task encodes the *distinct* matches of a block of its rows, all at once: an inverted index holds for
every rank the positions of the token pairs that merge into it, and the ranks are replayed in
order; a merge touches its own two neighbours only. Merging may bring up a pair of a lower
rank than the one being replayed; that rank is then replayed first, so each match sees the order
it would see alone.

Defined results: a null text is empty, an empty text has no ids and decodes to no bytes; repeated rows
and rows with equal or null ids are encoded one by one; extra columns are not read. Whole texts
are encoded, at any length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lasting, slices

#: Bytes of text that a task encodes at a time, and distinct pieces whose ids it remembers.
BLOCK_BYTES, MOST_REMEMBERED = 4 << 20, 200_000
#: A piece is white space with what follows, up to the next white space or the end of its first run of ASCII and
#: Latin-1 letters before ASCII punctuation (not the apostrophe) or a digit; no pattern match crosses a piece's end.
PIECE = re.compile(r"[ \n\r\t]*[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^ \n\r\t!-&(-@\[-`{-~])|[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
#: With any other white space in a text that does not hold, and the pattern is run over the whole text.
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and rank in each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """The ids of each word, by one replay of the merges over all words."""
    token: list[bytes | None] = []
    before: list[int] = []
    after: list[int] = []
    starts: list[int] = []
    for w in words:
        at, n = len(token), len(w)
        starts.append(at)
        token += [w[i : i + 1] for i in range(n)]
        before += range(at - 1, at + n - 1)
        after += range(at + 1, at + n + 1)
        if n:
            before[at] = after[-1] = -1
    index: dict[int, list[int]] = {}
    get = ranks.get
    for i, j in enumerate(after):
        if j >= 0 and (r := get(token[i] + token[j])) is not None:
            index.setdefault(r, []).append(i)
    queue = sorted(index)
    while queue:
        rank = heappop(queue)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        for k, i in enumerate(places):
            left = token[i]
            j = after[i] if left is not None else -1
            if j < 0 or get(left + token[j]) != rank:
                continue  # a neighbour was merged away since
            token[i] = merged = left + token[j]
            token[j] = None
            h, n = before[i], after[j]
            after[i] = n
            lower = False
            if n >= 0:
                before[n] = i
                if (r := get(merged + token[n])) is not None:
                    if r not in index:
                        index[r] = []
                        heappush(queue, r)
                    index[r].append(i)
                    lower = r < rank
            if h >= 0 and (r := get(token[h] + merged)) is not None:
                if r not in index:
                    index[r] = []
                    heappush(queue, r)
                index[r].append(h)
                lower = lower or r < rank
            if lower and k + 1 < len(places):
                index.setdefault(rank, []).extend(places[k + 1 :])
                heappush(queue, rank)
                break
    found = []
    for at, w in zip(starts, words, strict=True):
        ids = []
        i = at if w else -1
        while i >= 0:
            ids.append(ranks[token[i]])
            i = after[i]
        found.append(ids)
    return found


class Encoder:
    """Encodes and decodes texts; remembers the ids of the last blocks' pieces, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) > MOST_REMEMBERED:
            self.older, self.known = self.known, {}
        new = []
        for p in pieces - self.known.keys():
            if (ids := self.older.get(p)) is not None:
                self.known[p] = ids
            else:
                new.append(p)
        matches = {p: self.pattern.findall(p) for p in new}
        words = list({w for ws in matches.values() for w in ws})
        ids = dict(zip(words, replay([w.encode() for w in words], self.ranks), strict=True))
        for p, ws in matches.items():
            self.known[p] = array("I", [i for w in ws for i in ids[w]]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        pieces = [PIECE.findall(t) if OTHER_SPACE.search(t) is None else self.pattern.findall(t) for t in texts]
        self._learn({p for ps in pieces for p in ps})
        get = self.known.__getitem__
        return [b"".join(map(get, ps)) for ps in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lasting
def encoder(load: Callable[[], dict[bytes, int]], pattern: str) -> Encoder:
    """One encoder a worker process; its memory of pieces lasts over the tasks of this operator."""
    return Encoder(load(), pattern)


class RankFile:
    """Loads a rank file that the driver hands to every executor (a vocabulary is of bounded size)."""

    def __init__(self, spark, path: str) -> None:
        self.name = path.rstrip("/").rsplit("/", 1)[-1]
        spark.sparkContext.addFile(path)

    def __call__(self) -> dict[bytes, int]:
        return read_ranks(SparkFiles.get(self.name))

    def __hash__(self) -> int:
        return hash(self.name)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, RankFile) and other.name == self.name


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """``doc_id``, n_tokens, ids_sha256, decoded_sha256 (and ``ids``) of every row.

    The ids are decoded again for ``decoded_sha256``, the hash of the decoded bytes.
    """
    load = RankFile(docs.sparkSession, ranks_path)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(load, pattern)
        for batch in slices(batches, "text", BLOCK_BYTES, keep=encoder):
            ids = own.encode([t or "" for t in batch.column(1).to_pylist()])
            columns = [
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids]),
            ]
            if keep_ids:
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, schema)

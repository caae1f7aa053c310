"""Token files: ids in fixed-width bit packing, with block offsets for numpy unpacking and random access.

Format of a file (integers little-endian): the blocks, the index, and a foot of 28 bytes:
``b"BPK1"``, u32 bits of an id, u32 ids of a block, u64 documents, u64 ids. A block packs its ids
(the last block has fewer) one after another, least significant bit first, padded to a byte, so block b starts
at byte ``b * ceil(block * bits / 8)`` and any range of ids is read by its blocks alone. The index
has, per document, i64 id (the least i64: null) and i64 end of its ids in the file.

Writing: texts are encoded where they lie, the packed ids are range-partitioned by ascending id,
and each partition becomes one file. A task names its file anew in each attempt and the manifest
row goes through Spark's committer, so files of lost or repeated attempts are never read.
The first id of each file comes from the manifest's counts (one row a file).

Defined results: a null text is empty; an empty text has only the end id; rows with null ids come
first; rows with equal ids are ordered by their ids' bytes (ranges are cut by these too, so that they do not go to one
task unless they begin alike); extra columns are not read. An empty
table makes no files and an empty result.
"""

from __future__ import annotations

import math
import os
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc, filesystem, lasting, scratch_uri, slices, staged

MAGIC, FOOT = b"BPK1", 28
NULL_ID = -(2**63)
#: Packed bytes of a document that, after its id, take part in cutting the ranges.
BEGIN = 64
#: Ids of a block; bytes of text encoded at a time; distinct words whose ids a worker remembers.
BLOCK_IDS, BLOCK_BYTES, MOST_REMEMBERED = 65536, 4 << 20, 200_000
#: Packed bytes aimed at for a file, and blocks read at a time by one task.
FILE_BYTES, READ_BLOCKS = 256 << 20, 256


def bits_for(vocabulary: int) -> int:
    """The least bits that hold every id of a vocabulary of this size."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4")


def block_bytes(bits: int, block: int) -> int:
    return (bits * block + 7) // 8


class FileWriter:
    """Writes one token file, block by block."""

    def __init__(self, out, bits: int, block: int = BLOCK_IDS) -> None:
        self.out, self.bits, self.block = out, bits, block
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.index: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        ends = self.n_ids + np.cumsum(counts)
        self.index.append(np.stack([doc_ids.astype("<i8"), ends.astype("<i8")], 1))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            self._flush(self.n_held // self.block * self.block)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for at in range(0, upto, self.block):
            self.out.write(pack(ids[at : min(upto, at + self.block)], self.bits))
        self.held, self.n_held = [ids[upto:]], len(ids) - upto

    def close(self) -> tuple[int, int]:
        """(documents, ids) of the file."""
        self._flush(self.n_held)
        index = np.concatenate(self.index) if self.index else np.zeros((0, 2), "<i8")
        self.out.write(index.tobytes())
        self.out.write(MAGIC + np.array([self.bits, self.block], "<u4").tobytes() + np.array([len(index), self.n_ids], "<u8").tobytes())
        return len(index), self.n_ids


class FileReader:
    """Random access to a token file."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = source.read_at(FOOT, size - FOOT)
        if tail[:4] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block = (int(x) for x in np.frombuffer(tail, "<u4", 2, 4))
        self.n_docs, self.n_ids = (int(x) for x in np.frombuffer(tail, "<u8", 2, 12))
        self.index_at = size - FOOT - 16 * self.n_docs

    def index(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of the documents first..last-1."""
        rows = np.frombuffer(self.source.read_at(16 * (last - first), self.index_at + 16 * first), "<i8").reshape(-1, 2)
        return rows[:, 0], rows[:, 1]

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids start..end-1 of the file, from their blocks alone."""
        if end <= start:
            return np.zeros(0, np.uint32)
        wide, found = block_bytes(self.bits, self.block), []
        first, last = start // self.block, (end - 1) // self.block
        stop = min(self.n_ids, (last + 1) * self.block)
        data = self.source.read_at(min(wide * (last + 1), wide * (self.n_ids // self.block) + block_bytes(self.bits, self.n_ids % self.block)) - wide * first, wide * first)
        for b in range(first, last + 1):
            n = min(self.block, stop - b * self.block)
            found.append(unpack(data[wide * (b - first) : wide * (b - first) + block_bytes(self.bits, n)], self.bits, n))
        return np.concatenate(found)[start - first * self.block : end - first * self.block]


#: ASCII punctuation (not the apostrophe) or a digit always begins a pre-token after an ASCII or Latin-1 letter. The
#: letter is looked up behind, as a pattern that begins with the rarer characters is searched for faster.
WORD_END = re.compile(rb"[!-&(-@\[-`{-~](?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))")
#: Words of a-z and Latin-1 letters are one pre-token each, which only has to be lower-cased and spelt by bytes.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Bytes of such letters that the byte-level spelling shows as another character than Latin-1.
SPELT = {0x9F: 0x141, 0xA0: 0x142, 0xAD: 0x143}


class _Known(dict):
    """A word's ids; those of a word that it lacks are learned."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    The vocabulary's normaliser works by character (white space to one space, lower case, NFC, none of which
    crosses ASCII white space) and its pre-tokeniser drops white space, so a text's ids are its
    words' ids. A text that holds the string of an added token, in whatever case, is encoded whole. Words of Latin-1
    letters alone go to the library's model, lower-cased and spelt by bytes. What was
    not met in the last blocks is forgotten, so memory is bounded.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # for words; a text that holds an added token's string goes whole to the other
        self.default = Tokenizer.from_file(path)
        self.added = [t.content.encode().lower() for t in self.default.get_added_tokens_decoder().values()]
        self.size = self.library.get_vocab_size()
        self.model = self.library.model
        self.known, self.older = _Known(self._learn), {}

    def _learn(self, word: bytes) -> bytes:
        if (ids := self.older.get(word)) is not None:
            return ids
        if not LETTERS.fullmatch(word):
            return array("I", self.library.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        spelt = word.decode() if word.isascii() else word.decode().lower().encode().decode("latin-1").translate(SPELT)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        low = [t.lower() for t in texts]  # of bytes: ASCII alone
        whole = {i for i, t in enumerate(low) if any(a in t for a in self.added)}
        words = [[] if i in whole else WORD_END.sub(rb" \g<0>", t).split() for i, t in enumerate(low)]
        if len(self.known) > MOST_REMEMBERED:
            self.older, self.known = self.known, _Known(self._learn)
        get, end = self.known.__getitem__, np.array([end_id], "<u4").tobytes()
        found = [b"".join(map(get, ws)) + end for ws in words]
        for i in whole:
            found[i] = array("I", self.default.encode(texts[i].decode(), add_special_tokens=False).ids).tobytes() + end
        return found


@lasting
def word_encoder(name: str) -> WordEncoder:
    return WordEncoder(SparkFiles.get(name))


def _encoded(docs: DataFrame, vocabulary: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """``doc_id`` (null: the least) and the ids' bytes, packed to whole bytes."""
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(name)
        bits = bits_for(max(own.size, end_id + 1))
        for batch in slices(batches, "text", BLOCK_BYTES, keep=word_encoder):
            ids = own.encode([t or b"" for t in batch.column(1).to_pylist()], end_id)
            packed = pa.array([pack(np.frombuffer(x, "<u4"), bits) for x in ids], pa.binary())
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, packed, pa.array([bits] * len(ids), pa.int32())], names=["key", "n", "ids", "bits"])

    key = F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("key")
    return docs.select(key, F.col(text_column).cast("binary").alias("text")).mapInArrow(run, "key long, n long, ids binary, bits int")


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode all rows, write the token files below ``folder``, return the manifest.

    Manifest: part (ascending id order), path, n_docs, n_ids, start (ids in all files before it).
    """
    spark = docs.sparkSession
    encoded = staged(_encoded(docs, vocabulary, end_id, id_column, text_column), "token-ids", codec="zstd")
    total = encoded.agg(F.sum(F.length("ids"))).first()[0] or 0
    files = max(1, math.ceil(total / FILE_BYTES), spark.sparkContext.defaultParallelism)
    # packed ids begin in the order of the packed ids: many rows of one id are cut by their ids' beginnings
    ordered = encoded.repartitionByRange(files, "key", F.substring("ids", 1, BEGIN)).sortWithinPartitions("key", "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        part, writer, out, path = TaskContext.get().partitionId(), None, None, f"{root}/{uuid.uuid4().hex}.bpk"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                out = fs.open_output_stream(path, compression=None)
                bits = batch.column(3)[0].as_py()
                writer = FileWriter(out, bits)
            counts = batch.column(1).to_numpy()
            ids = [unpack(x, bits, n) for x, n in zip(batch.column(2).to_pylist(), counts.tolist(), strict=True)]
            writer.add(batch.column(0).to_numpy(), counts, np.concatenate(ids))
        if writer is not None:
            n_docs, n_ids = writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "n_docs": n_docs, "n_ids": n_ids}])

    manifest = staged(ordered.mapInArrow(write, "part long, path string, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32 (of the ids as u32).

    A file is read by several tasks, each a range of its documents."""
    step = 20_000
    ranges = manifest.select("path", "start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(step).cast("long"))).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(row["path"]) as source:
                    yield from _documents(FileReader(source), row["start"], row["first"], step)

    def _documents(reader: FileReader, base: int, first: int, count: int) -> Iterator[pa.RecordBatch]:
        last = min(reader.n_docs, first + count)
        lead = max(0, first - 1)
        doc_ids, ends = reader.index(lead, last)
        starts = np.concatenate([[0], ends[:-1]]) if first == 0 else ends[:-1]
        doc_ids, ends = doc_ids[first - lead :], ends[first - lead :]
        most = READ_BLOCKS * reader.block
        i = 0
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + most, "right")))
            if ends[i] - starts[i] > most:  # one long document, by its blocks
                checks, at = 0, int(starts[i])
                while at < ends[i]:
                    upto = min(int(ends[i]), at + most)
                    checks = _crc_on(reader.ids(at, upto), checks)
                    at = upto
                sums = [checks]
            else:
                ids = reader.ids(int(starts[i]), int(ends[j - 1])).astype("<u4")
                data, base_at = memoryview(ids.tobytes()), int(starts[i])
                sums = [crc(data[4 * (s - base_at) : 4 * (e - base_at)]) for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)]
            own = doc_ids[i:j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, mask=own == NULL_ID), pa.array(base + starts[i:j]), pa.array(ends[i:j] - starts[i:j]), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )
            i = j

    n = manifest.agg(F.sum(F.ceil(F.col("n_docs") / step))).first()[0] or 1
    return ranges.repartition(max(1, min(int(n), 100_000))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _crc_on(ids: np.ndarray, before: int) -> int:
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes(), before) & 0xFFFFFFFF


def pack_documents(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write the token files of all documents to the shared folder and read them back."""
    folder = scratch_uri(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, vocabulary, end_id), folder)

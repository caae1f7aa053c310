"""Phrase collocations: n-gram counts by counting quotient filters, merged across shards.

1. Each task cuts its texts to words and writes them in blocks, as numbers of the block's own word list.
2. The word lists are counted together. A phrase of ``least`` occurrences has only words of as many, so words below are
   left out, as are the phrases across them; the others get dense ids, numbered over slices. No task needs the
   whole vocabulary: each block's list is joined with it, and the ids go back to their block.
3. A block's n-grams of ids are packed, permuted and counted, and leave as one quotient filter for each bucket. Equal n-grams have
   equal buckets, where the sorted filters are merged, and the numbers with enough counts are undone to ids.
4. The counts of a candidate's parts meet it by joins; so does the largest count of a longer candidate around it.
5. The first ``most`` of each language are found in two steps, by salted and then by whole languages, first without the words.

Defined results: null texts are empty; a null language is ``und``, together with a language of that name. Repeated rows count each.
Texts of any length are counted whole. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quotient
from .common import staged, utf8_bytes
from .ranges import numbered, slice_count

#: Words of a phrase at most; words from which a block is closed; numbers that a merge holds beyond those of one filter;
#: n-gram occurrences a bucket is meant for; groups of a language's candidates in the first step of the ranking.
LONGEST, BLOCK_WORDS, MERGE, BUCKET, SALTS = 4, 1 << 21, 1 << 22, 1 << 23, 64
#: What ends a piece; the language of rows without one.
ENDS, UNKNOWN = b".,;:!?\n\x0b\x0c\r", "und"
TABLE = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
IDS = [f"w{k}" for k in range(1, LONGEST + 1)]
BLOCKS = "block string, codes binary, n long, words array<struct<lang: string, word: string, n: long>>"
FILTERS = "size int, bucket int, n int, quotient int, runs binary, remainders binary, counts binary"
PHRASES = f"size int, {', '.join(f'{w} long' for w in IDS)}, a long"


class _Numbers(dict):
    """Word -> number of the block's list; blanks are -2, the end of a piece -1."""

    def __init__(self, words: list):
        super().__init__({b"": -2, b"\n": -1})
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) batches as blocks: int32 codes, and the words they stand for with their languages and counts."""
    words: list = []
    langs: dict[str, _Numbers] = {}
    codes: list[np.ndarray] = []
    size = 0

    def block() -> pa.RecordBatch:
        all_codes = np.concatenate(codes)
        counts = np.bincount(all_codes[all_codes >= 0], minlength=len(words))
        lang_of = np.empty(len(words), object)
        for lang, numbers in langs.items():
            lang_of[[v for v in numbers.values() if v >= 0]] = lang
        rows = pa.StructArray.from_arrays([pa.array(lang_of.tolist(), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"])
        data = quotient.CODEC.compress(all_codes.tobytes(), asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([data], pa.binary()), pa.array([len(all_codes)], pa.int64()), pa.ListArray.from_arrays([0, len(words)], rows)], names=["block", "codes", "n", "words"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), utf8_bytes(batch.column(1)), strict=True):
            tokens = text.translate(TABLE).replace(b"\n", b" \n ").split(b" ")
            tokens.append(b"\n")
            if lang not in langs:
                langs[lang] = _Numbers(words)
            own = np.fromiter(map(langs[lang].__getitem__, tokens), np.int32, len(tokens))
            codes.append(own[own != -2])
            size += len(codes[-1])
            if size >= BLOCK_WORDS:
                yield block()
                words, langs, codes, size = [], {}, [], 0
    if size:
        yield block()


def ngrams(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """The ids at each place of all runs of ``size`` words without a gap (-1) in them."""
    n = len(ids) - size + 1
    if n <= 0:
        return [ids[:0]] * size
    places = [ids[k : n + k] for k in range(size)]
    whole = np.logical_and.reduce([p >= 0 for p in places])
    return [p[whole] for p in places]


def counter(bits: int, shard_bits: int):
    """Blocks (codes, n, ids) -> the filters of their n-grams."""
    layouts = {size: quotient.Layout(size, bits, shard_bits) for size in range(2, LONGEST + 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column(1)[i].as_py()
                codes = np.frombuffer(quotient.CODEC.decompress(batch.column(0)[i].as_buffer(), 4 * n, asbytes=True), np.int32)
                given = batch.column(2)[i].values  # of the block's words, those that are frequent in all
                at, to = (given.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                names = np.full(int(codes.max(initial=-1)) + 2, -1, np.int64)  # the last: the end of a piece
                names[at] = to
                ids = names[codes]
                for size, layout in layouts.items():
                    rows = [(size, *row) for row in quotient.filters(layout, *quotient.counted(*layout.permuted(ngrams(ids, size))))]
                    for k in range(0, len(rows), 64):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 64], strict=True), SENT.types, strict=True)], schema=SENT)

    return run


def merger(bits: int, shard_bits: int, least: int):
    """Filters sorted by (bucket, size) -> the phrases of ``least`` or more occurrences, as ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting = None, [], 0
        for batch in batches:
            for size, bucket, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now and now != (size, bucket):
                    yield from frequent(now[0], merged(held))
                    held, waiting = [], 0
                now = (size, bucket)
                held.append(quotient.opened(quotient.Layout(size, bits, shard_bits), bucket, *rest))
                waiting += len(held[-1][0])
                if waiting > MERGE:
                    held, waiting = [merged(held)], 0
        if now:
            yield from frequent(now[0], merged(held))

    def merged(held: list[tuple]) -> tuple:
        return quotient.counted(*(np.concatenate(c) for c in zip(*held, strict=True)))

    def frequent(size: int, found: tuple) -> Iterator[pa.RecordBatch]:
        top, rest, counts = found
        enough = counts >= least
        ids = quotient.Layout(size, bits, shard_bits).restored(top[enough], rest[enough])
        n = int(enough.sum())
        ids += [np.full(n, -1, np.int64)] * (LONGEST - size)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, size, np.int32)), *map(pa.array, ids), pa.array(counts[enough])], schema=FOUND)

    return run


SENT = pa.schema([(n, {"int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in FILTERS.split(", "))])
FOUND = pa.schema([("size", pa.int32()), *[(w, pa.int64()) for w in IDS], ("a", pa.int64())])


def counted_phrases(docs: DataFrame, least: int, text_column: str = "text", lang_column: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, f, id) and phrases (size, w1.., a) of ``least`` or more occurrences; words of each language (lang, n)."""
    rows = docs.select(F.coalesce(F.col(lang_column), F.lit(UNKNOWN)).alias("lang"), F.col(text_column).alias("text")).where("text IS NOT NULL")
    blocks = staged(rows.mapInArrow(as_blocks, BLOCKS), "word-blocks", "zstd")
    listed = blocks.select("block", F.posexplode("words").alias("at", "entry")).select("block", "at", "entry.*")
    totals = staged(listed.groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
    langs = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    words = numbered(totals.where(F.col("f") >= least), [F.col("lang"), F.col("word")], slice_count(totals), "words").withColumnRenamed("pos", "id")
    words = staged(words, "numbered-words")

    size = totals.agg(F.sum(F.when(F.col("f") >= least, 1)), F.sum("f")).first()
    partitions = max(slice_count(docs), -(-(size[1] or 0) // BUCKET))
    shard_bits = (partitions - 1).bit_length()
    bits = max((size[0] or 0).bit_length(), -(-shard_bits // 2), 1)
    if bits > 32:
        raise ValueError(f"{size[0]} words need ids of over 32 bits")

    ids = listed.select("block", "at", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    ids = ids.groupBy("block").agg(F.collect_list(F.struct("at", "id")).alias("ids"))
    given = blocks.select("block", "codes", "n").join(ids, "block").select("codes", "n", "ids")
    sent = given.mapInArrow(counter(bits, shard_bits), FILTERS)
    sent = sent.repartition(partitions, "bucket").sortWithinPartitions("bucket", "size")
    phrases = staged(sent.mapInArrow(merger(bits, shard_bits, least), PHRASES), "phrases")
    return words, phrases, langs


def part(first: int, last: int) -> list[Column]:
    """The key of a candidate's words from ``first`` up to ``last``."""
    return [F.col(IDS[first + k]) if first + k < last else F.lit(-1).cast("long") for k in range(LONGEST)]


def requests(phrases: DataFrame, shortest: int, spans) -> DataFrame:
    """For each candidate and each (slot, from, to) of ``spans(size)``, the key of that part beside the candidate."""
    arms = []
    for size in range(shortest, LONGEST + 1):
        found = [F.struct(F.lit(slot).alias("slot"), *[c.alias(f"p_{w}") for c, w in zip(part(lo, hi), IDS, strict=True)]) for slot, lo, hi in spans(size)]
        arms.append(F.when(F.col("size") == size, F.array(*found)))
    return phrases.where(F.col("size") >= shortest).select("*", F.explode(F.coalesce(*arms)).alias("p")).select(*phrases.columns, "p.*")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Every candidate with the counts ``l`` and ``r`` of its lowest-scoring cut, that score, and its language."""
    known = words.select(F.col("id").alias("w1"), *[F.lit(-1).cast("long").alias(w) for w in IDS[1:]], "f", "lang")
    known = known.unionByName(phrases.select(*IDS, F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")))
    known = known.withColumnsRenamed({w: f"p_{w}" for w in IDS})
    cuts = requests(phrases, 2, lambda size: [cut for k in range(1, size) for cut in ((2 * k, 0, k), (2 * k + 1, k, size))])
    met = cuts.join(known, [f"p_{w}" for w in IDS]).groupBy("size", *IDS, "a")
    count = lambda slot: F.max(F.when(F.col("slot") == slot, F.col("f")))
    met = met.agg(F.max(F.when(F.col("slot") == 2, F.col("lang"))).alias("lang"), *[count(2 * k + side).alias(f"{'lr'[side]}{k}") for k in range(1, LONGEST) for side in (0, 1)])
    # decimals of 38 digits: 2000000 * a stays whole, and so does its division
    by_cut = [F.when(F.col("size") > k, F.struct(F.expr(f"(CAST(2000000 AS DECIMAL(18, 0)) * CAST(a AS DECIMAL(20, 0))) DIV (l{k} + r{k})").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]
    return met.withColumn("cut", F.array_min(F.array_compact(F.array(*by_cut)))).select("size", *IDS, "a", "lang", "cut.score", "cut.l", "cut.r")


def covered(phrases: DataFrame, share: int) -> DataFrame:
    """The candidates inside a longer one with ``share`` percent of their occurrences, or more."""
    spans = requests(phrases, 3, lambda size: [(0, lo, hi) for wide in range(2, size) for lo in range(size - wide + 1) for hi in (lo + wide,)])
    most = spans.groupBy(*[f"p_{w}" for w in IDS]).agg(F.max("a").alias("longer")).withColumnsRenamed({f"p_{w}": w for w in IDS})
    return phrases.join(most, IDS).where(F.col("longer") * 100 >= F.col("a") * share).select(*IDS)


def firsts(rows: DataFrame, order: list[Column], most: int, salt: Column) -> DataFrame:
    """The first ``most`` rows of each language with their ``rank``: of each salted part first, so that no task gets a whole language."""
    for by in (["lang", "salt"], ["lang"]):
        rows = rows if "salt" not in by else rows.withColumn("salt", F.pmod(salt, F.lit(SALTS)))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)
    return rows.drop("salt")


def collocations(docs: DataFrame, least: int = 30, share: int = 80, most: int = 2000, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``most`` phrases of 2 to 4 words."""
    words, phrases, langs = counted_phrases(docs, least, text_column, lang_column)
    rows = staged(scored(words, phrases).join(covered(phrases, share), IDS, "left_anti"), "candidates")
    salt, best = F.xxhash64(*IDS), [F.col("score").desc(), F.col("a").desc()]
    cut = firsts(rows.select("lang", "score", "a", *IDS), best, most, salt).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("cut"))
    rows = rows.join(cut, "lang").where(F.struct("score", "a") >= F.col("cut"))  # ties with the last one are all here

    places = rows.select(*IDS, F.posexplode(F.array(*IDS)).alias("at", "id")).where("id >= 0").join(words.select("id", "word"), "id")
    texts = places.groupBy(*IDS).agg(F.concat_ws(" ", *[F.max(F.when(F.col("at") == k, F.col("word"))) for k in range(LONGEST)]).alias("phrase"))
    rows = firsts(rows.join(texts, IDS), [*best, F.col("phrase").asc()], most, salt)
    return rows.join(langs, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

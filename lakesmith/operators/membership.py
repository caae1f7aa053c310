"""Filter-first anti-join: rows without a parent, of which only those that may have one are shuffled.

A plain anti-join shuffles every row of the large side, although most of them may have no parent at all (rows that a small
load does not touch, codes that a reference lacks). Here a Bloom filter of the parents' keys decides first:

* a row that the filter rejects surely has no parent and is kept where it is, without a shuffle;
* a row that it lets through meets the parents' keys in an exact anti-join, so false positives cost work, never rows.

The filter is a table: a key's hash picks one 64-bit word and ``PROBES`` bits in it, and the words of equal number are or-ed by an
aggregate with map-side combine. It has at most ``bits / 64`` rows whatever the number of parents, which is the proven bound of
its broadcast. More parents than the bits are made for raise the share of false positives alone. The rows are read
once for each of the two branches, both times with the same pushed filters and pruned columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a filter: 2^20 words, whatever the number of keys.
FILTER_BITS = 1 << 26
#: Bits that a key sets in its word.
PROBES = 4
#: Key types whose equal values have equal hashes.
HASHED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BinaryType, T.BooleanType)


def _word(keys: Sequence[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words).cast("bigint"))


def _mask(keys: Sequence[Column]) -> Column:
    """``PROBES`` bits of a second hash, six of its bits for each."""
    second = F.xxhash64(F.lit("bits"), *keys)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(second, 6 * i).bitwiseAND(63).cast("int")) for i in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def key_filter(parent: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The filter of the parents' keys: ``word`` and its ``mask``, at most ``bits / 64`` rows. Keys with a NULL are left out."""
    columns = [F.col(k) for k in keys]
    known = parent.where(_complete(columns))
    return known.groupBy(_word(columns, _words(bits)).alias("word")).agg(F.bit_or(_mask(columns)).alias("mask"))


def _words(bits: int) -> int:
    if bits < 64:
        raise ValueError("a filter has 64 bits at least")
    return bits // 64


def _complete(columns: Sequence[Column]) -> Column:
    return F.greatest(*[c.isNull().cast("int") for c in columns], F.lit(0)) == 0


def _checked(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> None:
    for own, other in on:
        kinds = child.select(own).schema[0].dataType, parent.select(other).schema[0].dataType
        collated = isinstance(kinds[0], T.StringType) and kinds[0] != T.StringType()
        if kinds[0] != kinds[1] or not isinstance(kinds[0], HASHED) or collated:
            raise ValueError(f"{own} and {other} are {kinds[0].simpleString()} and {kinds[1].simpleString()}: cast both to one exact type")


def split_by_filter(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows that surely have no parent, rows that may have one), with the columns of ``child``."""
    _checked(child, parent, on)
    own = [F.col(c) for c, _ in on]
    longest = max(map(len, child.columns))
    word, mask = "w" * (longest + 1), "m" * (longest + 1)  # names that no column of the child has
    found = key_filter(parent, [p for _, p in on], bits).select(F.col("word").alias(word), F.col("mask").alias(mask))
    # a key with a NULL has no word, so it meets none
    probed = child.join(F.broadcast(found), F.when(_complete(own), _word(own, _words(bits))) == F.col(word), "left")
    wanted = _mask(own)
    may = F.coalesce(F.col(mask).bitwiseAND(wanted) == wanted, F.lit(False))
    return probed.where(~may).select(*child.columns), probed.where(may).select(*child.columns)


def filtered_anti_join(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``child`` that have no row in ``parent``, as a left anti-join gives them.

    ``on`` pairs columns of the child and of the parent. Repeated rows are kept as often as they come, rows with a NULL in their key
    are kept, parents with one are no parents, and an empty ``parent`` keeps all. Key columns must be of one type with exact
    equality (no floating point), else ``ValueError``.
    """
    sure, possible = split_by_filter(child, parent, on, bits)
    names = [f"__parent_{i}" for i in range(len(on))]
    known = parent.select(*[F.col(p).alias(n) for (_, p), n in zip(on, names, strict=True)])
    same = [possible[c] == known[n] for (c, _), n in zip(on, names, strict=True)]
    return sure.unionByName(possible.join(known, same, "left_anti"))

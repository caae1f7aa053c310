"""URL filter: longest-rule verdicts through a cascade of Bloom filters.

A rule is (verdict, host, path); it fits its host and all subdomains if the url's path starts with
the rule's path. Every url has a few *lookup keys*: host suffix + path prefix, for the host label
counts and path lengths that occur in the rules. A rule fits exactly if its string is one of the
url's lookup keys, so a verdict is a set-membership question.

The rules of one verdict are held by a cascade of Bloom filters. Level 0 encodes the listed keys; level 1 encodes
the false positives of level 0 over the *complete universe* of lookup keys of the corpus; level 2
the listed keys that level 1 takes wrongly, and so on until a level errs no more. On that universe
membership is then exact, and applying it needs no join. Its size is bounded by the rule list:
level 0 is sized so that it errs on about as many universe keys as there are rules.

Defined results: a null url or one without ``://`` has empty host and path and fits no rule; a url
that fits no rule gets the default verdict; repeated rows are judged one by one; of two fitting
rules the longer string wins, block before allow on a tie (the same string in both lists); an empty
rule list gives the default everywhere. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: Most rules of a list, which the driver and every task hold; false positives are bounded by it.
MAX_RULES = 5_000_000
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass
class Bloom:
    bits: np.ndarray
    size: int
    hashes: int
    salt: int

    @classmethod
    def of(cls, keys: np.ndarray, error: float, salt: int) -> Bloom:
        size = max(64, math.ceil(1.45 * len(keys) * math.log2(1 / error)))
        made = cls(np.zeros(size, bool), size, max(1, round(math.log2(1 / error))), salt)
        for at in made.places(keys):
            made.bits[at] = True
        return made

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        """keys: two 64-bit hashes a row."""
        a, b = keys[:, 0] ^ np.uint64(SEEDS[0] * (self.salt + 1) % 2**64), keys[:, 1] | np.uint64(1)
        a = (a ^ (a >> np.uint64(31))) * np.uint64(SEEDS[1])
        for i in range(self.hashes):
            yield ((a + np.uint64(i) * b) >> np.uint64(11)) % np.uint64(self.size)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for at in self.places(keys):
            found &= self.bits[at]
        return found


def cascade_has(levels: list[Bloom], keys: np.ndarray) -> np.ndarray:
    """Membership by the alternate levels: a key is listed if the first level that lacks it is odd."""
    result = np.zeros(len(keys), bool)
    alive = np.arange(len(keys))
    for i, level in enumerate(levels):
        if not len(alive):
            break
        hit = level.has(keys[alive])
        result[alive[~hit]] = i % 2 == 1
        alive = alive[hit]
    result[alive] = len(levels) % 2 == 1
    return result


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty if it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def lookup_keys(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The url's host suffixes x path prefixes at the label counts and path lengths of the rules."""
    labels = sorted({r.host.count(".") + 1 for r in rules})
    sizes = sorted({len(r.path) for r in rules})
    have = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    keys = [
        F.when((have >= n) & (F.length(path) >= size) & (host != ""), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size)))
        for n in labels
        for size in sizes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(key, F.lit(1))]


def _pairs(rows) -> np.ndarray:
    return np.array([(r[0], r[1]) for r in rows], np.int64).reshape(-1, 2).view(np.uint64)


def build_cascade(universe: DataFrame, keys: list[str], n_universe: int) -> list[Bloom]:
    """The levels that separate ``keys`` from all other rows of ``universe`` (column ``key``)."""
    spark = universe.sparkSession
    keys = sorted(set(keys))
    if not keys:
        return []
    if len(keys) > MAX_RULES:
        raise ValueError(f"{len(keys)} rules; the driver holds {MAX_RULES} at most")
    rules = spark.createDataFrame([(k,) for k in keys], "key string")
    listed = _pairs(rules.select(*_hashes(F.col("key"))).collect())
    others = universe.join(rules, "key", "left_anti").select(F.col("key"), *[h.alias(f"h{i}") for i, h in enumerate(_hashes(F.col("key")))])
    most = 1000 + 8 * len(keys)
    for salt in range(8):
        first = Bloom.of(listed, min(0.5, len(keys) / max(1, n_universe) / 2**salt), salt)

        def passing(batches, first=first):
            for b in batches:
                pair = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], 1).view(np.uint64)
                yield b.filter(pa.array(first.has(pair)))

        wrong = others.select("h0", "h1").mapInArrow(passing, "h0 bigint, h1 bigint").limit(most + 1)
        got = _pairs(wrong.collect())
        if len(got) <= most:  # else not all are here: a sparser level 0 is tried
            break
    else:
        raise RuntimeError("no level 0 separates the rules from the corpus")
    levels, inside, outside = [first], listed, got
    while len(outside):
        levels.append(Bloom.of(outside, 0.5, len(levels) + 16))
        inside, outside = outside, inside[levels[-1].has(inside)]
        if len(levels) > 200:
            raise RuntimeError("two keys share both hashes")
    return levels


def judge_urls(pages: DataFrame, rules: list[Rule], id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """``id_column``, host, path, rule and verdict of every row of ``pages``."""
    host, path = parsed(F.col(url_column))
    urls = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("keys", lookup_keys(F.col("host"), F.col("path"), rules))
    universe = urls.select(F.explode("keys").alias("key")).distinct()
    n_universe = universe.count()
    verdicts = sorted({r.verdict for r in rules}, key=lambda v: v != "block")
    cascades = {v: build_cascade(universe, [r.key for r in rules if r.verdict == v], n_universe) for v in verdicts}
    hashed = urls.withColumns({"h0": F.transform("keys", lambda k: _hashes(k)[0]), "h1": F.transform("keys", lambda k: _hashes(k)[1])})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            counts = pc.list_value_length(at["keys"]).to_numpy(zero_copy_only=False)
            row, text = np.repeat(np.arange(b.num_rows), counts), at["keys"].flatten()
            pair = np.stack([at[h].flatten().to_numpy(zero_copy_only=False) for h in ("h0", "h1")], 1).view(np.uint64)
            size = pc.utf8_length(text).to_numpy(zero_copy_only=False)
            best, rule = np.full(b.num_rows, -1), np.full(b.num_rows, -1)
            verdict = np.full(b.num_rows, len(verdicts))
            for v, name in enumerate(verdicts):
                for i in np.flatnonzero(cascade_has(cascades[name], pair)):
                    if size[i] > best[row[i]]:
                        best[row[i]], rule[row[i]], verdict[row[i]] = size[i], i, v
            yield pa.RecordBatch.from_arrays(
                [at["page_id"], at["host"], at["path"], text.take(pa.array(rule, mask=rule < 0)).cast(pa.string()), pa.array([*verdicts, default]).take(pa.array(verdict))],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    kind = pages.schema[id_column].dataType.simpleString()
    return hashed.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
